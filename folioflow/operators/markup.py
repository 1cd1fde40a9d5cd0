"""Inline markup of digitised books, parsed to a tree of flat nodes.

The markup marks readings (｜base《reading》), glyphs outside the character set
(※［＃…］), accented Latin (〔…〕), and everything else with bracketed notes
(［＃…］): emphasis and styles of a quoted passage or between two notes,
reading marks of classical Chinese, layout of lines and blocks, figures, and
notes of the typist.

A scanner cuts a text into marks and runs; a table of patterns says what a
bracketed note is; a builder keeps the stack of open spans and blocks. Text is
never refused: a note of no known kind becomes a ``note`` node, an end without
a beginning is marked as such, and what is open at the end is closed there.

A node is (node_id, parent_id, ord, tag, text, attrs, start, stop); the offsets
are code points of the whole text, so every node can be traced to its source.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from ..functions.text import KANJI_RUN

# The words of the notes.
LINES = ("傍線", "波線", "破線", "鎖線")
DOTS = ("傍点", "白ゴマ傍点", "丸傍点", "白丸傍点", "×傍点", "黒三角傍点", "白三角傍点", "二重丸傍点", "蛇の目傍点", "白四角傍点")
STYLES = ("太字", "斜体", "分数", "上付き小文字", "下付き小文字", "篆書体", "小書き", "行右小書き", "行左小書き", "横組み", "縦中横", "合字", "ローマ数字")
HEADINGS = ("大", "中", "小")
KANJI_NUMBERS = "一二三四五六七八九十"

_EMPHASIS = "|".join(sorted([*(f"(?:二重)?{x}" for x in LINES), *map(re.escape, DOTS)], key=len, reverse=True))
_STYLE = "|".join(sorted([rf"(?:窓|同行)?[{''.join(HEADINGS)}]見出し", "(?:二重)?罫囲み", *STYLES], key=len, reverse=True))
_NUMBER = rf"[0-9]+|[０-９]+|[{KANJI_NUMBERS}]"
_SIZE = rf"(?:{_NUMBER})段階(?:大きな|小さな)文字"
_QUOTED = r"(?P<ruby>ルビの)?「(?P<of>.+?)」"


def number(text: str) -> int:
    """ASCII, full-width or one kanji numeral."""
    return KANJI_NUMBERS.index(text) + 1 if text in KANJI_NUMBERS else int(text)


#: Kinds of notes: tag, how it acts (mark, begin, end, line, block), and its pattern. The first that fits counts.
NOTES: list[tuple[str, str, re.Pattern]] = [
    (tag, act, re.compile(pattern))
    for tag, act, pattern in [
        ("emphasis", "mark", rf"{_QUOTED}に(?P<value>{_EMPHASIS})"),
        ("left_emphasis", "mark", rf"{_QUOTED}の左に(?P<value>{_EMPHASIS})"),
        ("left_ruby", "mark", rf"{_QUOTED}の左に「(?P<value>.+)」のルビ"),
        ("style", "mark", rf"{_QUOTED}は(?P<value>{_STYLE})"),
        ("char_size", "mark", rf"{_QUOTED}は(?P<value>{_SIZE})"),
        ("annotation", "mark", rf"{_QUOTED}(?:の左)?に「(?P<value>.+)」の注記"),
        ("source_reading", "mark", rf"{_QUOTED}は底本では「(?P<value>.+)」"),
        ("as_in_source", "mark", rf"{_QUOTED}は(?P<value>ママ)"),
        ("source_note", "mark", r"底本では(?P<value>.+)"),
        ("page_end", "line", r"本文終わり"),
        ("okuri", "mark", r"（(?P<value>[^）]+)）"),
        ("return_mark", "mark", r"(?P<value>[一二三四上中下天地人甲乙丙丁]レ?|レ)"),
        ("figure", "mark", rf"(?P<of>[^（(]+)[（(](?P<file>[^、）)]+\.png)(?:、横(?P<width>{_NUMBER})×縦(?P<height>{_NUMBER}))?[）)]入る"),
        ("page_break", "line", r"(?P<value>改丁|改ページ|改見開き)"),
        ("column_break", "line", r"改段"),
        ("centered", "line", r"ページの左右中央"),
        ("line_break", "mark", r"改行"),
        ("split_note", "begin", r"割り注"),
        ("split_note", "end", r"割り注終わり"),
        ("indent", "line", rf"(?:天から)?(?P<n>{_NUMBER})字下げ"),
        ("from_bottom", "line", rf"地から(?P<n>{_NUMBER})字上げ"),
        ("flush_bottom", "line", r"地付き"),
        ("lowered_bottom", "line", rf"下げて、地より(?P<n>{_NUMBER})字あきで"),
        ("indent_block", "block", rf"ここから(?P<flush>改行天付き、折り返して)?(?P<n>{_NUMBER})字下げ(?:、折り返して(?P<hanging>{_NUMBER})字下げ)?"),
        ("width_block", "block", rf"ここから(?P<n>{_NUMBER})字詰め"),
        ("flush_bottom_block", "block", r"ここから地付き"),
        ("from_bottom_block", "block", rf"ここから地から(?P<n>{_NUMBER})字上げ"),
        ("column_block", "block", rf"ここから(?P<n>{_NUMBER})段組み(?P<rule>、段間に罫)?"),
        ("size_block", "block", rf"ここから(?P<n>{_NUMBER})段階(?P<value>大きな|小さな)文字"),
        ("style_block", "block", rf"ここから(?P<value>{_STYLE})"),
        ("indent_block", "block_end", r"ここで字下げ終わり"),
        ("width_block", "block_end", r"ここで字詰め終わり"),
        ("flush_bottom_block", "block_end", r"ここで地付き終わり"),
        ("from_bottom_block", "block_end", r"ここで字上げ終わり"),
        ("column_block", "block_end", r"ここで段組み終わり"),
        ("size_block", "block_end", r"ここで(?:大きな|小さな)文字終わり"),
        ("style_block", "block_end", rf"ここで(?:{_STYLE})終わり"),
        ("span", "end", rf"(?:左に)?(?:{_EMPHASIS}|{_STYLE}|大きな文字|小さな文字)終わり"),
        ("span", "begin", rf"(?P<value>(?:左に)?(?:{_EMPHASIS})|{_STYLE}|{_SIZE})"),
    ]
]
_NUMBERS = {"n", "hanging", "width", "height"}
_KANJI_TAIL = re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", r"\\u\1", KANJI_RUN) + "$")
_ACCENTS = re.compile(r"〔(?=[a-zA-Zα-ωΑ-ΩА-яЁё])(?P<accent>[^〔〕\n]+)〕")
_MARKS = re.compile("[\n※［《｜〔]")
_GLYPH = re.compile(r"※［＃(?P<glyph>[^］]*)］")


@dataclass
class Node:
    tag: str
    start: int
    stop: int = -1
    text: str | None = None
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node] = field(default_factory=list)


def note_at(text: str, at: int) -> int:
    """The end of the bracketed note that begins at ``at``: brackets inside it pair up; -1 if it never ends on its line."""
    depth, i = 0, at
    while i < len(text) and text[i] != "\n":
        if text.startswith("［＃", i):
            depth += 1
            i += 2
            continue
        if text[i] == "］":
            depth -= 1
            if depth == 0:
                return i + 1
        i += 1
    return -1


def classify(body: str) -> tuple[str, str, dict[str, str]]:
    """Tag, action and attributes of a note's content."""
    for tag, act, pattern in NOTES:
        if m := pattern.fullmatch(body):
            attrs = {k: str(number(v)) if k in _NUMBERS else v for k, v in m.groupdict().items() if v}
            if attrs.pop("ruby", None):
                attrs["in"] = "ruby"
            for flag in ("flush", "rule"):
                if flag in attrs:
                    attrs[flag] = "true"
            return tag, act, attrs
    return "note", "mark", {"value": body}


class Builder:
    """Builds the tree of one text; ``open`` is the path of open nodes."""

    def __init__(self, text: str, whole_run: bool) -> None:
        self.text, self.whole_run = text, whole_run
        self.root = Node("document", 0, len(text))
        self.open = [self.root]
        self.base: int | None = None  # where a marked base began: the index of its first child

    def add(self, node: Node) -> None:
        self.open[-1].children.append(node)

    def push(self, node: Node) -> None:
        self.add(node)
        self.open.append(node)

    def close(self, stop: int, tags: tuple[str, ...]) -> bool:
        """Close up to the innermost open node of ``tags``; False if there is none."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                for node in self.open[i:]:
                    node.stop = stop
                del self.open[i:]
                return True
        return False

    def paragraph(self, at: int) -> None:
        if not any(n.tag == "paragraph" for n in self.open):
            self.push(Node("paragraph", at))

    def run(self, start: int, stop: int) -> None:
        """Plain text, joined to the run before it."""
        if start >= stop:
            return
        self.paragraph(start)
        siblings = self.open[-1].children
        if siblings and siblings[-1].tag == "text" and siblings[-1].stop == start and self.base != len(siblings):
            siblings[-1].stop, siblings[-1].text = stop, self.text[siblings[-1].start : stop]
        else:
            self.add(Node("text", start, stop, self.text[start:stop]))

    def ruby(self, start: int, stop: int) -> None:
        """A reading takes the marked base, or the last run before it: of kanji, or the whole of it."""
        reading, siblings = self.text[start + 1 : stop - 1], self.open[-1].children
        taken: list[Node] = []
        if self.base is not None and self.base <= len(siblings):
            taken = siblings[self.base :]
            del siblings[self.base :]
        elif siblings and siblings[-1].tag == "text" and siblings[-1].stop == start:
            last = siblings[-1]
            tail = None if self.whole_run else _KANJI_TAIL.search(last.text)
            cut = last.start + tail.start() if tail else last.start
            if tail and cut > last.start:
                taken = [Node("text", cut, last.stop, self.text[cut : last.stop])]
                last.stop, last.text = cut, self.text[last.start : cut]
            else:
                taken = [siblings.pop()]
        elif siblings and siblings[-1].tag in ("glyph", "accent") and siblings[-1].stop == start:
            taken = [siblings.pop()]
        self.base = None
        self.paragraph(start)
        self.add(Node("ruby", taken[0].start if taken else start, stop, None, {"reading": reading}, taken))

    def note(self, start: int, stop: int) -> None:
        tag, act, attrs = classify(self.text[start + 2 : stop - 1])
        if act == "block":
            self.close(start, ("paragraph",))
            if tag == "indent_block":
                self.close(start, ("indent_block",))  # a new indent replaces one that is open
            self.push(Node(tag, start, -1, None, attrs))
        elif act == "block_end":
            self.close(start, ("paragraph",))
            if not self.close(stop, (tag,)):
                self.add(Node("unmatched_end", start, stop, self.text[start:stop], {"of": tag}))
        elif act == "begin":
            self.paragraph(start)
            self.push(Node(tag, start, -1, None, attrs))
        elif act == "end":
            if not self.close(stop, (tag,)):
                self.paragraph(start)
                self.add(Node("unmatched_end", start, stop, self.text[start:stop], {"of": tag}))
        elif tag in ("page_break", "column_break", "page_end", "centered"):
            self.close(start, ("paragraph",))
            self.add(Node(tag, start, stop, None, attrs))
        else:
            self.paragraph(start)
            self.add(Node(tag, start, stop, None, attrs))

    def build(self) -> Node:
        text, at, begun = self.text, 0, 0
        while (mark := _MARKS.search(text, at)) is not None:
            at = mark.start()
            c = text[at]
            end = 0
            if c == "\n":
                self.run(begun, at)
                if any(n.tag == "paragraph" for n in self.open):
                    self.close(at + 1, ("paragraph",))
                elif text[at - 1 : at] in ("", "\n"):
                    self.add(Node("paragraph", at, at + 1))  # an empty line
                self.base = None
                at = begun = at + 1
                continue
            if c == "※" and (m := _GLYPH.match(text, at)):
                self.run(begun, at)
                self.paragraph(at)
                self.add(Node("glyph", at, m.end(), None, {"value": m["glyph"]}))
                end = m.end()
            elif c == "［" and text.startswith("［＃", at) and (stop := note_at(text, at)) > 0:
                self.run(begun, at)
                self.note(at, stop)
                end = stop
            elif c == "《" and (stop := text.find("》", at)) > 0 and "\n" not in text[at:stop]:
                self.run(begun, at)
                self.ruby(at, stop + 1)
                end = stop + 1
            elif c == "｜":
                self.run(begun, at)
                self.paragraph(at)
                self.base = len(self.open[-1].children)
                end = at + 1
            elif c == "〔" and (m := _ACCENTS.match(text, at)):
                self.run(begun, at)
                self.paragraph(at)
                self.add(Node("accent", at, m.end(), m["accent"]))
                end = m.end()
            if end:
                at = begun = end
            else:
                at += 1
        self.run(begun, len(text))
        for node in self.open[1:]:
            node.stop = len(text)
        return self.root


def parse(text: str, whole_run: bool = False) -> Node:
    """The tree of a text. whole_run: a reading without a base mark takes all of the run before it, not its last kanji."""
    return Builder(text.replace("\r\n", "\n"), whole_run).build()


def flatten(root: Node) -> Iterator[tuple]:
    """(node_id, parent_id, ord, tag, text, attrs, start, stop) of all nodes, parents first."""
    todo, made = [(root, -1, 0)], 0
    while todo:
        node, parent, order = todo.pop()
        yield made, parent, order, node.tag, node.text, node.attrs, node.start, node.stop
        todo += [(child, made, i) for i, child in reversed(list(enumerate(node.children)))]
        made += 1


def plain(node: Node) -> str:
    """The text of a tree without its markup."""
    if node.tag in ("text", "accent"):
        return node.text or ""
    return "".join(map(plain, node.children)) + ("\n" if node.tag == "paragraph" else "")


NODES = "node_id int, parent_id int, ord int, tag string, text string, attrs map<string,string>, start int, stop int"


def parse_column(rows: DataFrame, key: str, column: str, whole_run: bool = False) -> DataFrame:
    """A row a node of each text, with the text's key; null texts have none."""
    kind = dict(rows.dtypes)[key]
    names = [key, *[x.split()[0] for x in NODES.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for k, text in zip(batch[key], batch[column]):
                if isinstance(text, str):
                    out += [(k, *node) for node in flatten(parse(text, whole_run))]
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return rows.select(key, column).mapInPandas(run, f"`{key}` {kind}, {NODES}")
