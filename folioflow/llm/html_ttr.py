"""Main text of web pages by text-to-tag ratios over streamed parser events.

The standard library's parser streams events; block boundaries cut them into
lines, and each line knows its text, how many tags stood in it, how much of
its text is link text, and the containers around it. Then:

1. lines in containers that say they are something else (menus, headers,
   footers, sidebars, notices, adverts, forms, comments: by element, role, or a
   class or id that is such a name as a whole) count as all tags and no text. A
   form or a named wrapper that holds the page's heading and most of its text
   is a wrapper about the article, whatever its name, and counts as any other;
2. the ratio of text outside links to tags of every line is smoothed over the
   neighbouring lines with a Gaussian, and a threshold (a share of the smoothed
   ratios' deviation) clusters the lines into content regions and the rest;
3. the regions' text chooses the holders of the article: the outermost
   <article>s (else <main>s) that regions stand in, unless these hold but a
   small part of all regions' text; else the innermost container about
   nearly all of it;
4. within the holders, content regions are the article, with what belongs to
   them: a line below the threshold stays if it has text of its own and is a
   paragraph of a block that holds a region, or lies between two lines of one;
   loose link lines that smoothing drew in go. A list of mere links goes, unless
   it stands in an <article> between two lines of its regions, as references do;
5. inside an <article> or <main> a class, id or role of a paragraph, or one that
   article parts may have too (WEAK_NAMES), rules nothing out by itself: such
   lines are weighed like any other, and stay if they are in a region and have
   text of their own.

Character references are decoded, white space inside a line becomes one space,
and the lines are joined in page order.

Edge cases: null or empty html gives an empty text; a page without any block
element is one line; unclosed elements end with their parents, and an unclosed
head with the first element or text that cannot stand in it; a page whose every
line is boilerplate gives an empty text; lines of equal ratio are all content
or all not; repeated rows are separate rows; an empty table gives no rows;
other columns of any name go. A page is held whole, no part of it is cut.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, slices

RESULT = "page_id long, url string, text string, n_chars long"

#: Elements whose text is never shown.
UNSEEN = frozenset({"script", "style", "template", "noscript", "head", "title", "iframe", "object", "svg", "canvas", "audio", "video", "datalist"})
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset({"title", "meta", "link", "script", "style", "base", "noscript", "template", "object"})
#: Elements that are no article text wherever they stand.
OTHER = frozenset({"nav", "footer", "aside", "menu", "dialog", "button", "select", "textarea", "option", "input", "label", "fieldset"})
#: Elements that end a line of text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option optgroup p pre search section select summary table tbody td textarea tfoot th thead tr ul".split())
#: Elements that have no end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Blocks that a new one of their kind ends, and what keeps them apart.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset({"table", "ul", "ol", "dl", "div", "section", "article", "main", "aside", "nav", "header", "footer", "blockquote", "body", "select", "td", "th", "li", "form"})
#: Elements that a paragraph cannot hold, so that they end it.
ENDS_P = BLOCKS - {"option", "optgroup", "legend", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html"}
#: Blocks that hold paragraphs of their own, as against paragraphs, lists and tables within one.
HOLDERS = frozenset({"", "html", "body", "div", "section", "article", "main", "center", "form", "header", "hgroup", "details"})
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
#: Lists and tables, which go as a whole if they are mere links.
LISTS = frozenset({"ul", "ol", "dl", "table", "dir"})
#: Names of what stands beside an article, as a class, id or role or as the parts of one.
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsored promo promos promotion menu menus nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer sidebar sidebars aside related recommended recommendations widget cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments respond replies disqus pagination pager toolbar copyright complementary contentinfo search".split()
)
#: Words that may stand beside such a name without changing what it names.
PLAIN_NAMES = frozenset("area bar block box btn button buttons container content footer form group holder icons inline inner item items left link links list main message outer page panel post row right section site skip slot small text the title top bottom unit wrap wrapper".split())
#: Names of these that a part of an article may have too.
WEAK_NAMES = frozenset({"notice", "alert", "search", "comment", "promotion", "subscription", "sponsor", "sponsored", "related"})
#: A name that begins with one of these says that the thing is not there, or merely present.
NEGATIONS = frozenset({"no", "has", "with", "without", "hide", "is"})
_PARTS = re.compile(r"[^\W\d_]+|\d+")
_SPACE = re.compile(r"\s+")
#: Gaussian over lines: its deviation, and how far it reaches.
SIGMA, REACH = 1.0, 3
#: Lines over this share of the smoothed ratios' deviation are content.
THRESHOLD = 0.5
#: Characters outside links for each tag that make a line, or a list, text of its own.
OWN_TEXT = 1.0
#: Lines that a list of links has at least before it can go.
LINK_LINES = 3
#: Share of the content regions' text that named holders need, that a sibling needs of the largest, and that a container is about.
TRUSTED, SIBLING, NEARLY_ALL = 0.1, 0.1, 0.85
#: How a container is ruled out: not; by its name, which its content can overrule; by what it is; by a name that leaves it to the regions.
IN, NAMED, OUT, WEAK = 0, 1, 2, 3


def says_aside(value: str, within: bool, ignored: frozenset[str] = frozenset()) -> bool:
    """Whether a class, id or role names something beside the article; an article's own header is part of it. ignored: names that count for nothing."""
    for name in value.lower().split():
        parts = [x for x in _PARTS.findall(name) if not x.isdigit()]
        if not parts or parts[0] in NEGATIONS:
            continue
        named = [x for x in parts if x in ASIDE_NAMES and x not in ignored and not (within and x == "header")]
        if named and all(x in ASIDE_NAMES or x in PLAIN_NAMES for x in parts):
            return True
    return False


class Line:
    """A line of the page: its text, tags, link characters and containers, outermost first."""

    __slots__ = ("boxes", "links", "tags", "text")

    def __init__(self, text: str, tags: int, links: int, boxes: tuple[int, ...]) -> None:
        self.text, self.tags, self.links, self.boxes = text, tags, links, boxes

    def own(self) -> int:
        """Characters outside links."""
        return max(0, len(self.text) - self.links)


class LineParser(HTMLParser):
    """Streams a page into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.kind: list[str] = [""]  # by container number; 0 is the page
        self.ruled_out: list[int] = [IN]
        self.stack: list[tuple[str, int]] = []  # element, its container number or 0
        self.boxes: tuple[int, ...] = (0,)
        self.text: list[str] = []
        self.tags = self.links = self.in_link = self.unseen = self.articles = 0

    def _end_line(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                self.lines.append(Line(text, self.tags, self.links, self.boxes))
            self.text = []
        self.tags = self.links = 0

    def _end_head(self) -> None:
        if self.stack and self.stack[-1][0] == "head":
            self._pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCKS:
            if tag in CLOSES:
                self._close(CLOSES[tag], SCOPES - {tag, "td", "th"} if tag in ("td", "th", "tr") else SCOPES - {tag})
            if tag in ENDS_P and tag != "p":
                self._close(("p",), SCOPES)
            self._end_line()
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag == "a":
            self.in_link += 1
        if tag in UNSEEN:
            self.unseen += 1
        box = 0
        if tag in BLOCKS or attrs:
            out = self._standing(tag, attrs)
            if tag in BLOCKS or out:
                box = len(self.kind)
                self.kind.append(tag)
                self.ruled_out.append(out)
                if tag not in BLOCKS:
                    self._end_line()
                self.boxes += (box,)
        self.articles += tag in ("article", "main")
        self.stack.append((tag, box))

    def _standing(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        """IN, NAMED or OUT for an element that begins here."""
        if tag in ("html", "body"):
            return IN
        within = self.articles > 0 or tag in ("article", "main")
        if tag in OTHER or any(k == "hidden" or (k == "aria-hidden" and (v or "").lower() == "true") for k, v in attrs):
            return OUT
        if tag == "form" or (tag == "header" and not within):
            return NAMED
        names = [v for k, v in attrs if k in ("class", "id", "role") and v]
        if not any(says_aside(v, within) for v in names):
            return IN
        weak = within and (tag not in HOLDERS | LISTS or not any(says_aside(v, within, WEAK_NAMES) for v in names))
        return WEAK if weak else NAMED

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _pop(self) -> None:
        tag, box = self.stack.pop()
        if tag in BLOCKS or box:
            self._end_line()
        if box:
            self.boxes = self.boxes[:-1]
        self.in_link -= tag == "a"
        self.unseen -= tag in UNSEEN
        self.articles -= tag in ("article", "main")

    def _close(self, kinds: tuple[str, ...], scopes: frozenset[str]) -> None:
        """End the innermost open element of ``kinds``, unless a scope lies between."""
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in kinds:
                while len(self.stack) > i:
                    self._pop()
                return
            if tag in scopes:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in VOID:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            open_tag = self.stack[i][0]
            if open_tag == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            if tag not in BLOCKS and open_tag in BLOCKS and open_tag != "p":
                break  # an inline end tag does not end a container
        if tag in BLOCKS:
            self._end_line()

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head()
        if not self.unseen:
            self.text.append(data)
            if self.in_link:
                self.links += len(data)

    def finish(self) -> list[Line]:
        self.close()
        while self.stack:
            self._pop()
        self._end_line()
        return self.lines


def left_out(parser: LineParser, lines: list[Line]) -> list[bool]:
    """Whether each line lies in a container that is something beside the article.

    A container ruled out by its name alone is not if it holds the page's first
    headings and named holders, all of them, and half of the text that no element rules out.
    """
    standing = parser.ruled_out
    if NAMED in standing:
        size: dict[int, int] = defaultdict(int)
        heads: dict[int, int] = defaultdict(int)
        total = all_heads = 0
        for line in lines:
            if all(standing[b] != OUT for b in line.boxes):
                total += line.own()
                main = any(parser.kind[b] in ("h1", "article", "main") for b in line.boxes)
                all_heads += main
                for b in line.boxes:
                    if standing[b] == NAMED and parser.kind[b] not in ("article", "main", "header"):
                        size[b] += line.own()
                        heads[b] += main
        wrappers = {b for b, n in heads.items() if n == all_heads > 0 and 2 * size[b] >= total}
        standing = [IN if b in wrappers else x for b, x in enumerate(standing)]
    return [any(standing[b] in (NAMED, OUT) for b in x.boxes) for x in lines]


def content_lines(lines: list[Line], out: list[bool]) -> np.ndarray:
    """True for lines in content regions: smoothed text-to-tag ratio over the threshold."""
    ratio = np.array([0.0 if o else x.own() / max(1, x.tags) for x, o in zip(lines, out)])
    at = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-0.5 * (at / SIGMA) ** 2)
    inside = slice(REACH, REACH + len(ratio))
    smooth = np.convolve(ratio, kernel, "full")[inside] / np.convolve(np.ones(len(ratio)), kernel, "full")[inside]
    return (smooth >= min(THRESHOLD * smooth.std(), smooth.max())) & ~np.array(out)


def holders_of(parser: LineParser, lines: list[Line], content: np.ndarray) -> tuple[set[int], bool]:
    """The containers that hold the article, and whether they are <article>s."""
    weight: dict[int, int] = defaultdict(int)
    outermost: dict[str, set[int]] = {"article": set(), "main": set()}
    for line, chosen in zip(lines, content):
        if chosen:
            for b in line.boxes:
                weight[b] += len(line.text)
            for kind, found in outermost.items():
                if (b := next((b for b in line.boxes if parser.kind[b] == kind), None)) is not None:
                    found.add(b)
    total = weight[0]
    for kind, found in outermost.items():
        if found and sum(weight[b] for b in found) >= TRUSTED * total:
            return {b for b in found if weight[b] >= SIBLING * max(weight[x] for x in found)}, kind == "article"
    # Of the containers about nearly all of the regions' text, the innermost: they lie within each other.
    about = [b for b, n in weight.items() if n >= NEARLY_ALL * total and parser.kind[b] in HOLDERS]
    return {max(about)} if about else {0}, False


def mere_links(parser: LineParser, lines: list[Line]) -> set[int]:
    """Lists and tables of LINK_LINES lines or more with hardly any text outside links."""
    texts: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    for line in lines:
        for b in line.boxes:
            if parser.kind[b] in LISTS:
                texts[b][0] += line.own()
                texts[b][1] += line.tags
                texts[b][2] += 1
    return {b for b, (own, tags, n) in texts.items() if n >= LINK_LINES and own < OWN_TEXT * tags}


def article_lines(parser: LineParser, lines: list[Line], out: list[bool], content: np.ndarray) -> list[bool]:
    """Which lines are the article, by the content regions and what belongs to them."""
    holders, named = holders_of(parser, lines, content)
    held = [not o and not holders.isdisjoint(x.boxes) for x, o in zip(lines, out)]
    links = mere_links(parser, lines)
    block = [next(b for b in reversed(x.boxes) if parser.kind[b] in HOLDERS) for x in lines]
    regions = [i for i, chosen in enumerate(content) if chosen and held[i]]
    span: dict[int, tuple[int, int]] = {}
    for i in regions:
        span[block[i]] = (span.get(block[i], (i, i))[0], i)

    def belongs(i: int) -> bool:
        line = lines[i]
        own, paragraph = line.own() >= OWN_TEXT * line.tags, parser.kind[line.boxes[-1]] not in HOLDERS
        if any(parser.ruled_out[b] == WEAK for b in line.boxes):
            return own and bool(content[i])
        if not links.isdisjoint(line.boxes):
            return named and bool(regions) and regions[0] < i < regions[-1]
        if content[i]:
            return own or paragraph
        if block[i] not in span:
            return False
        first, last = span[block[i]]
        return (line.own() > 0 or (named and first < i < last)) if paragraph else own and first < i < last

    return [h and belongs(i) for i, h in enumerate(held)]


def main_text(html: str | None) -> str:
    """The article of one page, a line a block."""
    if not html:
        return ""
    parser = LineParser()
    parser.feed(html)
    lines = parser.finish()
    if not lines:
        return ""
    out = left_out(parser, lines)
    kept = article_lines(parser, lines, out, content_lines(lines, out))
    return "\n".join(x.text for x, k in zip(lines, kept) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html", 8 << 20):
                texts = [main_text(x) for x in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pick(pages, page_id="long", url="string", html="string").mapInArrow(run, RESULT)
