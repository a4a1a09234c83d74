import pytest

from lexispark.llm.main_text import main_text

from .test_main_text import P1, P2, page

ASIDE = "<div class=sidebar><p>Related, things, to read, for you, today.</p></div>"
BOTH = f"{P1} {P2}"
WHOLE = f"<p>{P1}</p><p>{P2}</p>"


@pytest.mark.parametrize("name", ["content has-sidebar", "layout sidebar-right", "site header-fixed", "content-with-sidebar", "side"])
@pytest.mark.parametrize("inner", [WHOLE, f"<article>{WHOLE}</article>", f"<div class=content>{WHOLE}</div>{ASIDE}", f"<main>{WHOLE}</main>{ASIDE}"])
def test_a_container_around_the_article_stays(name, inner):
    assert main_text(page(f"<div class='{name}'>{inner}</div>")) == BOTH
    assert main_text(page(f"<nav><a href=x>Menu</a></nav><div id='{name}'>{inner}</div><footer>End</footer>")) == BOTH


def test_an_article_with_fewer_points_than_the_rest_stays():
    more = "".join(f"<div class=box><p>Teaser {i}, of, another, page.</p></div>" for i in range(9))
    assert BOTH in main_text(page(f"<div class='wrap sidebar-left'><article>{WHOLE}</article></div><div>{more}</div>"))


def test_comments_and_named_parts_stay_out():
    many = "".join(f"<li><article class=comment-body><p>I like this, very much, thanks, a lot, number {i}.</p></article></li>" for i in range(50))
    assert main_text(page(f"<div class=content>{WHOLE}<div id=comments class=comments-area><ol>{many}</ol></div></div>")) == BOTH
    assert main_text(page(f"<div class='layout sidebar-right'><div class=content>{WHOLE}<div class=post-sidebar><p>Other, posts, here.</p></div></div>{ASIDE}</div>")) == BOTH


def test_names_are_dropped_if_they_leave_nothing():
    assert main_text(page(f"<div class=comments>{WHOLE}</div>")) == BOTH
    assert main_text(page(f"<div class=sidebar><p>{P1}</p></div><div class=widget><p>{P1}</p></div>"))
