from lexispark.llm.common import table
from lexispark.llm.main_text import extract, main_text

P1 = "The first paragraph has commas, clauses, and enough text to give some points to what holds it."
P2 = "A second one follows, with more words, so that the container is clearly the article of the page."


def page(inner, head=""):
    return f"<html><head><title>T</title>{head}</head><body>{inner}</body></html>"


def test_article_without_the_rest():
    html = page(
        f"<header><p>Site, name, and, more, words.</p></header><nav><ul><li><a href=/a>Home</a></li></ul></nav><div class='cookie-notice'><p>We use cookies, a lot, of them, here.</p></div>"
        f"<div id=wrap><div class=sidebar><p>Related, things, to read, for you, today.</p></div><div class=content><h1>Title &amp; more</h1><p>{P1}<p>{P2} See <a href=x>this</a>.</p>"
        "<ul><li>one item<li>two items</ul><div class=ad>Buy, now, cheap.</div><form><p>Mail, please, here</p></form><script>var x='<p>no</p>'</script>"
        "<div id=comments><p>I like this, very much, thanks, a lot.</p></div></div></div><footer>&copy; 2020</footer>"
    )
    assert main_text(html) == f"Title & more {P1} {P2} See this. one item two items"


def test_blocks_and_white_space():
    assert main_text(page(f"<article><p> a \n b&nbsp;c<br>d<p>{P1}</article>")) == f"a b c d {P1}"
    assert main_text(page(f"<article><p>1 &lt; 2 &#233; &eacute &unknown; x</p><p>{P1}</p></article>")) == f"1 < 2 é é &unknown; x {P1}"


def test_siblings_of_the_best_container():
    html = page(f"<div><div class=part><p>{P1}</p><p>{P2}</p></div><p>This stands beside it and is prose that belongs to the text, too.</p><div><a href=a>Link</a> <a href=b>list</a></div></div>")
    assert "stands beside" in main_text(html) and "list" not in main_text(html)


def test_odd_pages():
    for html in (None, "", "   ", "<", "<![if x]><p>", "<html><head><script>", "<!-- open", "&", "\x00", "<p" * 1000):
        assert isinstance(main_text(html), str)
    assert main_text("just words") == "just words"
    assert main_text(page("<nav><p>Only, a, menu, here.</p></nav>")) == ""
    deep = "<div>" * 3000 + f"<p>{P1}</p>"
    assert main_text(page(deep)) == P1
    long = f"<p>{P1}</p>" * 5000
    assert len(main_text(page(f"<article>{long}</article>"))) == 5000 * (len(P1) + 1) - 1


def test_given_pages(spark, sf_dir):
    """All words of the article's paragraphs, in order, and none of the menus, adverts and footers."""
    import html
    import re

    pages = table(spark, sf_dir, "pages")
    for r in extract(pages).collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S).group(1)
        want = html.unescape(re.sub("<[^>]+>", " ", re.sub("</?b>", "", article)))
        assert r.text == " ".join(want.split())


def test_table_with_odd_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (1, "u", None, "x"), (None, None, page(f"<p>{P1}</p>"), "y"), (2, "v", "", "z")], "page_id bigint, url string, html string, text string")
    assert sorted(r.text for r in extract(df).collect()) == ["", "", "", P1]
    assert extract(df.limit(0)).count() == 0
