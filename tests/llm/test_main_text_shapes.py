"""Ordinary shapes of pages: none may lose its article, and none may take its surroundings along."""

import pytest

from lexispark.llm.main_text import extract, main_text

from .test_main_text import P1, P2, page

BOTH = f"{P1} {P2}"
WHOLE = f"<p>{P1}</p><p>{P2}</p>"
MENU = "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News, of, today</a></ul></nav>"
END = "<footer><p>Imprint, contact, terms, and more.</p></footer>"
SEARCH = "<form action=/s><label>Search</label><input name=q><button>Go</button></form>"

SHAPES = {
    "form around the page": f"<form id=aspnetForm>{MENU}<div>{WHOLE}</div>{END}</form>",
    "form around an article": f"<form>{MENU}<article>{WHOLE}</article>{END}</form>",
    "form around main": f"<form>{MENU}<main>{WHOLE}</main>{END}</form>",
    "form around named content": f"<form><div id=content>{WHOLE}</div></form>",
    "fieldset around the text": f"<div><fieldset><legend></legend>{WHOLE}</fieldset></div>",
    "form in a form's place": f"<form>{SEARCH.replace('form', 'div')}<div>{WHOLE}</div></form>",
    "search and article": f"{SEARCH}<article>{WHOLE}</article>",
    "anchor without end": f"<a name=top><div>{WHOLE}</div>",
    "anchor without end in front of an article": f"<a name=top>{MENU}<article>{WHOLE}</article>",
    "link without end": f"<div><a href=/x>Skip</div><article>{WHOLE}</article>",
    "button without end": f"<button>Menu<article>{WHOLE}</article>",
    "button without end, others with": f"<button>Menu<article>{WHOLE}</article><button>Close</button>",
    "textarea without end": f"<div><textarea>Note<div>{WHOLE}</div></div>",
    "noscript without end": f"<noscript>No script here<article>{WHOLE}</article>",
    "select without end": f"<select><option>One<option>Two<article>{WHOLE}</article>",
    "iframe without end": f"<iframe src=x><article>{WHOLE}</article>",
    "two kinds without end": f"<button>Menu<div><noscript>None</div><article>{WHOLE}</article>",
    "paragraphs without end": f"{MENU}<div><p>{P1}<p>{P2}</div>{END}",
    "table layout": f"<table><tr><td><a href=/a>Home</a></td><td>{WHOLE}</td></tr></table>",
    "body alone": WHOLE,
    "main in sections": f"{MENU}<main><section><div>{WHOLE}</div></section></main>{END}",
    "upper case": f"<DIV CLASS=Content><P>{P1}</P><P>{P2}</P></DIV><FOOTER>End</FOOTER>",
    "comment form behind it": f"<article>{WHOLE}<form><p>Leave a reply, please, here.</p><textarea></textarea></form></article>",
    "newsletter form between": f"<article><p>{P1}</p><form><p>Your mail</p><input></form><p>{P2}</p></article>",
}


@pytest.mark.parametrize("name", SHAPES)
def test_article_is_kept_alone(name):
    got = main_text(page(SHAPES[name]))
    assert got.replace("Home ", "") == BOTH if name == "table layout" else got == BOTH


def test_head_of_an_article_is_a_part_of_it():
    assert main_text(page(f"<header><p>Site, name, here.</p></header><article><header><h1>Title</h1><p>Lead, of the text.</p></header>{WHOLE}</article>")) == f"Title Lead, of the text. {BOTH}"


def test_forms_without_prose_stay_out():
    assert main_text(page("<form><div>User</div><input><div>Password</div><input></form>")) == ""
    assert main_text(page(f"<div>{WHOLE}</div><form><p>Mail, please, here</p></form>")) == BOTH


def test_many_elements_without_end_are_read_a_few_times():
    assert BOTH in main_text(page("<button>x<select><noscript>" * 2000 + f"<article>{WHOLE}</article>"))


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, page(f"<article>{WHOLE}</article>"), "x", "y")], "page_id bigint, html string, Text string, _html string")
    got = extract(df)
    assert got.columns == ["page_id", "html", "_html", "text"] and got.first().text == BOTH
    assert extract(df, into="HTML").select("HTML").first()[0] == BOTH
