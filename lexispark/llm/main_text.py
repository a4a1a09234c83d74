"""Main text of HTML pages by scoring the tree of containers.

A page is read once into blocks of text, each with the path of containers it lies in. Paragraphs give points for their length and
their commas to the nearest containers above; a container's points are discounted by its share of link text and
moved by what its tag, class and id say. A name like ``sidebar`` or ``header`` leaves a container out, unless it is also named like
an article or holds it: then the name only lowers its points. The best container is the article, and neighbours that score like it or read like
prose are kept with it; what lies in menus, forms, adverts or comments inside them is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unused

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template iframe object svg canvas head title select option button textarea".split())
OUTSIDE = frozenset("nav header footer aside menu dialog".split())
#: Left out like a container of an unlikely name, unless prose lies in them: whole pages can be wrapped in one.
FORMS = frozenset("form fieldset".split())
#: Left out up to their end; one that never ends is given up where it starts.
OPTIONAL_END = DROPPED - {"script", "style"}
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPHS = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6 figcaption".split())
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "caption", "tr", "tbody", "thead", "tfoot"}
TAG_POINTS = {"article": 25, "main": 20, "section": 5, "div": 5, "blockquote": 3, "td": 3, "pre": 3, "ul": -3, "ol": -3, "dl": -3, "form": -3, "li": -3, "th": -5, "table": 0}
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|commentlist|disqus|replies|respond|consent|cookies?|gdpr|footer|header|masthead|menu|nav|"
    r"navbar|navigation|newsletter|notice|alert|pager|pagination|popup|modal|overlay|promo|related|recommended|share|sharing|social|sidebar|side|skip|sponsor(?:ed)?|subscribe|toolbar|widget|rail)(?:$|[\s_-])"
)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text|blog|prose)(?:$|[\s_-])")
#: Names of readers' comments, which can hold most paragraphs of a page, and in elements named article, without being its text.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?:$|[\s_-])")
UNLIKELY_ROLES = frozenset("navigation banner complementary contentinfo search alert alertdialog dialog menu menubar".split())
SPACE = re.compile(r"[ \t\n\r\f\v\x1c-\x1f\x85\xa0  -     　]+")


ENDED = re.compile(r"[.!?]( |$)")


class Node:
    """An open or closed element that holds blocks."""

    __slots__ = ("tag", "up", "depth", "weight", "never", "named", "comments", "sure", "out", "points", "size", "links", "likely", "held", "main", "form", "prose", "within")

    def __init__(self, tag: str, up: Node | None, attrs: dict):
        self.tag, self.up = tag, up
        self.depth = up.depth + 1 if up else 0
        hint = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()
        role = (attrs.get("role") or "").lower()
        self.likely = bool(LIKELY.search(hint)) or role in ("main", "article")
        unlikely, by_role = bool(UNLIKELY.search(hint)), role in UNLIKELY_ROLES
        hidden = "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "").lower()
        free = tag in ("html", "body", "article", "main")
        lead = tag == "header" and up is not None and up.within  # the head of an article is a part of it
        self.within = tag in ("article", "main") or bool(up and up.within)
        self.form = tag in FORMS
        self.prose = False
        self.never = bool(up and up.never) or (tag in OUTSIDE and not lead) or hidden or (by_role and not free)
        self.named = (unlikely and not free and not lead) or self.form
        self.comments = unlikely and self.named and bool(COMMENTS.search(hint))
        # one name is an article's and nothing else: 'content has-sidebar', but not 'post-sidebar'
        self.sure = self.named and any(LIKELY.search(x) and not UNLIKELY.search(x) for x in hint.split())
        self.main = tag == "main" or role == "main"
        self.weight = TAG_POINTS.get(tag, 0) + (25 if self.likely else 0) - (25 if unlikely or by_role else 0)
        self.out = self.never
        self.points, self.size, self.links, self.held = 0.0, 0, 0, 0.0


class Reader(HTMLParser):
    """Blocks of a page in order: text, link characters in it, and its container."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [Node("html", None, {})]
        self.nodes = self.open[:]
        self.blocks: list[tuple[str, int, Node, bool]] = []
        self.parts: list[str] = []
        self.linked, self.in_link, self.link_text = 0, 0, False
        self.skip, self.skip_at = [], (1, 0)

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip(" ")
        if text:
            node = self.open[-1]
            self.blocks.append((text, min(self.linked, len(text)), node, node.tag in PARAGRAPHS))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.skip:
            if tag == self.skip[-1] and tag not in VOID:
                self.skip.append(tag)
            if not (self.skip[-1] in ("head", "title") and tag in ("body", "article", "main", "div", "p")):
                return
            self.skip.clear()  # a head that was never closed
        if tag in ("br", "wbr", "img"):
            self.parts.append(" " if tag == "br" else "")
        elif tag in DROPPED:
            self.skip.append(tag)
            self.skip_at = self.getpos()
        elif tag == "a":
            self.in_link = len(self.open) if any(k == "href" for k, _ in attrs) else 0
            self.link_text = False
        elif tag in BLOCKS:
            if self.in_link and (self.link_text or len(self.open) < self.in_link):
                self.in_link = 0  # a link that was never closed
            self.flush()
            if tag in CLOSES_P:
                self.close("p", stop=("td", "th", "div", "article", "section", "li"))
            if tag in ("li", "tr", "td", "th", "dd", "dt"):
                self.close(tag, stop=("ul", "ol", "table", "dl", "tr" if tag in ("td", "th") else "table"))
            if tag not in VOID:
                self.open.append(Node(tag, self.open[-1], dict(attrs)))
                self.nodes.append(self.open[-1])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def close(self, tag: str, stop: tuple = ()) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in stop:
                return

    def handle_endtag(self, tag: str) -> None:
        if self.skip:
            if tag == self.skip[-1]:
                self.skip.pop()
            return
        if tag == "a":
            self.in_link = 0
        elif tag in BLOCKS:
            self.flush()
            self.close(tag)
            if len(self.open) < self.in_link:
                self.in_link = 0

    def close_all(self) -> None:
        super().close()
        self.flush()

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data.strip())
                self.link_text |= len(self.open) == self.in_link and not data.isspace()


def parsed(html: str) -> Reader:
    """The blocks of a page; a marked section that the parser can't read is text."""
    reader = Reader()
    try:
        reader.feed(html)
        reader.close_all()
    except AssertionError:
        return parsed(html.replace("<![", "&lt;!["))
    return reader


def read_page(html: str) -> Reader:
    """The blocks of a page. An element to be left out that never ends takes its own text along, and not the rest of the page.

    Each kind of element can be given up once, so a page is read a few times at most.
    """
    reader, given_up = parsed(html), set()
    while reader.skip and reader.skip[0] in OPTIONAL_END - given_up:
        tag, (line, column) = reader.skip[0], reader.skip_at
        given_up.add(tag)
        at = 0
        for _ in range(line - 1):
            at = html.index("\n", at) + 1
        html = html[: at + column] + re.sub(rf"<{tag}\b[^<>]*>[^<]*|</{tag}\s*>", " ", html[at + column :], flags=re.I)
        reader = parsed(html)
    return reader


def density(node: Node) -> float:
    """Share of a container's text that is links."""
    return node.links / node.size if node.size else 0.0


def counted(node: Node, paragraph: bool) -> bool:
    """Whether a block of this container gives points, names aside."""
    return not node.never and (paragraph or node.tag in ("div", "section", "article", "main", "body", "html"))


def points_of(text: str) -> float:
    return 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)


def prose(text: str) -> bool:
    return len(text) > 80 or ENDED.search(text) is not None


def leave_out(page: Reader) -> bool:
    """Marks what the names of containers leave out; false if no name does.

    A container of an unlikely name stays if it is surely named like an article too, or holds the page's main part, the article
    with the most points or more than half of all points (comments: the main part only). So does a form, if there is prose in it.
    """
    if not any(n.named for n in page.nodes):
        return False
    total = 0.0
    for text, _, node, paragraph in page.blocks:
        if counted(node, paragraph):
            node.held += points_of(text)
            node.prose |= prose(text)
            total += points_of(text)
    for node in reversed(page.nodes):  # what lies in a container counts for those above
        if node.up is not None:
            node.up.held += node.held
            node.up.prose |= node.prose
            node.up.main |= node.main and not node.never
    best = max((n for n in page.nodes if n.tag == "article" and not n.never and not in_comments(n)), key=lambda n: n.held, default=None)
    above = set()
    while best is not None and best.held:
        above.add(id(best))
        best = best.up
    for n in page.nodes:  # those above come first
        kept = (n.sure or n.main or (not n.comments and (id(n) in above or n.held > total / 2))) and (n.prose or not n.form)
        n.out = n.never or bool(n.up and n.up.out) or (n.named and not kept)
    return any(n.out and not n.never for n in page.nodes)


def in_comments(node: Node | None) -> bool:
    while node is not None and not node.comments:
        node = node.up
    return node is not None


def scored(page: Reader) -> dict[int, float]:
    """Points of the containers (by place in ``page.nodes``) that have any."""
    for n in page.nodes:
        n.points, n.size, n.links = 0.0, 0, 0
    for text, linked, node, paragraph in page.blocks:
        node.size += len(text)
        node.links += linked
        if node.out or not counted(node, paragraph):
            continue
        points = points_of(text)
        up = node.up if paragraph and node.up is not None else node
        for share in (1, 2, 6):
            if up is None:
                break
            up.points += points / share
            up = up.up
    for node in reversed(page.nodes):  # what lies in a container counts for those above
        if node.up is not None:
            node.up.size += node.size
            node.up.links += node.links
    return {i: (n.points + n.weight) * (1 - density(n)) for i, n in enumerate(page.nodes) if n.points and not n.out}


def main_text(html: str | None) -> str:
    """The blocks of the article in page order, joined by one blank; empty if there are none.

    If names leave nothing of a page, it is scored again without them.
    """
    if not html:
        return ""
    page = read_page(html)
    named = leave_out(page)
    text = article(page)
    if named and not text:
        for n in page.nodes:  # those above come first
            n.out = n.never or bool(n.up and n.up.out) or (n.form and not n.prose)
        text = article(page)
    return text


def article(page: Reader) -> str:
    score = scored(page)
    if not score:
        return ""
    at = max(score, key=lambda i: (score[i], -page.nodes[i].depth, -i))
    best, limit = page.nodes[at], max(10.0, 0.2 * score[at])
    inside, listed, sibling = {}, {}, {}
    for i, n in enumerate(page.nodes):  # those above come first
        up = id(n.up)
        inside[id(n)] = n is best or inside.get(up, False)
        links = density(n) > 0.5 and n.size < 2000 and n.tag in ("ul", "ol", "table", "div", "section", "dl")
        listed[id(n)] = n is not best and inside[id(n)] and (links or listed.get(up, False))
        beside = best.up is not None and n.up is best.up and n is not best
        sibling[id(n)] = (n, score.get(i, 0.0)) if beside else sibling.get(up)
    out = []
    for text, _, node, _ in page.blocks:
        if node.out:
            continue
        if inside[id(node)]:
            if not listed[id(node)]:
                out.append(text)
        elif sibling[id(node)]:
            top, points = sibling[id(node)]
            if points >= limit or top.tag == "h1" or (top.tag == "p" and density(top) < 0.25 and prose(text)):
                out.append(text)
    return " ".join(out)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text (replacing a column of that name, in capitals or not). Null and empty pages give empty text; nothing is cut."""
    names = [c for c in pages.columns if c.lower() != into.lower()]
    if html not in names:
        pages, html = pages.withColumn(unused(pages, "_html"), F.col(f"`{html}`")), unused(pages, "_html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = pa.array([main_text(x.as_py()) for x in part.column(html)], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), found], [*names, into])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in names] + [f"`{into}` string"])
    return pages.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, html])]).mapInArrow(run, schema)
