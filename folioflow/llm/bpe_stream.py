"""Streaming byte-level BPE: a bounded-lookahead transducer and an incremental decoder.

Encoding. A text enters the transducer piece by piece, and tokens leave once
nothing that follows can change them. Two lookaheads bound what is held back:

* pretokens: where one ends is final two code points later (a contraction is at
  most three), so complete ones leave, and only the last one or two stay;
* merges: a later byte changes an earlier token boundary only through a chain
  of merges: a merge loses its right symbol (or that symbol's last part) to a
  merge of better rank further right, which in turn can lose its own right
  symbol, and so on. Ranks fall strictly along such a chain, so its length in
  bytes is bounded by the merge list alone; ``sufficient_lookahead`` computes
  that bound in one pass. The pretoken that a piece of text breaks off in, of
  more than OPEN code points, goes on through ``ByteTransducer``, whatever its
  length turns out to be: that holds ``block + lookahead`` bytes at most, merges
  them, emits the tokens that end ``lookahead`` bytes or more before the end, and
  goes on from that boundary (a run of a text's tokens is the encoding of the
  bytes it covers); what it still holds when the pretoken ends leaves then.

Every text takes this one path in pieces of PIECE code points, and no piece is
known to be the last one; so memory is constant in the text's length, and tokens
leave while the text is still being read. The texts of a batch go through
transducers side by side, a piece of each at a time; their new complete pretokens
are merged together, and a pretoken's ids are cached.

Decoding. Token bytes enter a UTF-8 state machine that keeps an unfinished
character's bytes (three at most) until it can emit the character or U+FFFD.

Edge cases: a null text is the empty text (no tokens); special tokens written
out in a text become their ids, as the library does by default; repeated rows
give equal results; ties of rank go to the leftmost pair; an empty table gives
no rows; other columns of any name go.
"""

from __future__ import annotations

import codecs
import contextlib
import hashlib
import heapq
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .bpe_merge import MergeTable
from .common import pick, resident, slices, tokenizer_path

#: How byte-level vocabularies of this family cut a text into pretokens (fixed value).
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes merged at a time in a long pretoken, besides the lookahead.
BLOCK = 2048
#: Pretokens up to so many bytes are merged many at a time and cached.
SHORT = 64
#: Cached pretokens of a worker before the cache starts anew (about 250 MB).
CACHE_WORDS = 900_000
_ANY = regex.compile(PRETOKENS)
#: The same for text of Latin-1 characters alone, whose letters, digits and white space can be listed.
_LATIN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+".format(
        L="".join(map(re.escape, filter(regex.compile(r"\p{L}").match, map(chr, range(256))))), N="".join(filter(regex.compile(r"\p{N}").match, map(chr, range(256)))), S="".join(filter(regex.compile(r"\s").match, map(chr, range(256)))),
    )
)
#: Code points of a text that enter at a time.
PIECE = 1024
#: Code points after a pretoken's end from which on it is final.
SETTLED = 2
#: Code points of the longest contraction: a longer pretoken that has no end yet can only go on as what it is.
OPEN = 3
#: What goes on with a pretoken: letters, digits, other characters, white space.
_KINDS = [regex.compile(x) for x in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")]
_SPACE = 3

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def sufficient_lookahead(table: MergeTable) -> int:
    """Bytes beyond a token's end after which nothing can change the token.

    ``reach[r]``: how far to the right of merge r's boundary a chain can go,
    namely over r's right symbol and then along the worst earlier merge that
    can take that symbol, or a last part of it from before it was formed.
    """
    length = {t: len(b) for t, b in table.token_bytes.items()}
    worst: dict[int, int] = {}  # by symbol: the reach of the merges so far that take it as their left side
    tail: dict[int, int] = {}  # by symbol: the reach through its own last parts, as of their merging
    most = 0
    for a, b, made in zip(table.left.tolist(), table.right.tolist(), table.made.tolist()):
        chain = max(worst.get(b, 0), tail.get(b, 0))
        reach = length[b] + chain
        most = max(most, reach)
        worst[a] = max(worst.get(a, 0), reach)
        tail[made] = max(tail.get(made, 0), chain)
    return most + max(length.values())


def pretokens_in(text: str) -> list[str]:
    """The pretokens of a text, or of a stretch that a special token or the end of the text bounds."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ANY.findall(text)
    return _LATIN.findall(text)


class ByteTransducer:
    """Encodes one pretoken of any length from pieces of bytes, in constant memory."""

    def __init__(self, table: MergeTable, lookahead: int, block: int = BLOCK, rules: dict | None = None) -> None:
        self.first, self.lookahead, self.block = table.first.tolist(), lookahead, block
        self.token_bytes = table.token_bytes
        self.rules = rules or {(a, b): (r, m) for r, (a, b, m) in enumerate(zip(table.left.tolist(), table.right.tolist(), table.made.tolist()))}
        self.buffer = b""

    def _merge(self, data: bytes) -> list[int]:
        """Merge by rank, leftmost first, with a heap of pairs and links between symbols."""
        symbols = [self.first[b] for b in data]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rules = self.rules
        heap = [(rule[0], i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (rule := rules.get((symbols[i], symbols[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = rules[a, b][1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if rule := rules.get((symbols[i], symbols[k])):
                    heapq.heappush(heap, (rule[0], i, symbols[i], symbols[k]))
            if (h := before[i]) >= 0 and (rule := rules.get((symbols[h], symbols[i]))):
                heapq.heappush(heap, (rule[0], h, symbols[h], symbols[i]))
        return [s for s in symbols if s >= 0]

    def feed(self, data: bytes) -> Iterator[int]:
        """Take bytes; yield the tokens that have become final."""
        for i in range(0, len(data), self.block):
            self.buffer += data[i : i + self.block]
            if len(self.buffer) >= self.block + self.lookahead:
                end, final = 0, len(self.buffer) - self.lookahead
                for token in self._merge(self.buffer):
                    if end + len(self.token_bytes[token]) > final:
                        break
                    end += len(self.token_bytes[token])
                    yield token
                self.buffer = self.buffer[end:]

    def finish(self) -> Iterator[int]:
        """End of the pretoken: yield what is left."""
        yield from self._merge(self.buffer)
        self.buffer = b""


class Transducer:
    """Takes a text in pieces; gives out what has become final, in constant memory.

    What it gives are units: a complete pretoken (str), or a tuple of ids, of a
    special token or of a stretch of a pretoken that has no end yet.
    """

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        self.buffer = ""
        self.kind: int | None = None  # of the pretoken that goes on in ``bytes``
        self.bytes: ByteTransducer | None = None

    def feed(self, piece: str, last: bool = False) -> list[str | tuple[int, ...]]:
        """Take a piece; with ``last``, the end of the text as well."""
        text, self.buffer = self.buffer + piece, ""
        encoder = self.encoder
        if encoder.special is None or encoder.mark not in text:
            units = self._ordinary(text)
        else:
            units, held = [], encoder.unfinished(text)
            parts = encoder.special.split(text[: len(text) - held])
            for i, part in enumerate(parts):
                if i % 2:
                    # A special token ends what stands before it, as the end of the text does.
                    units += [*self._end(), (encoder.table.special[part],)]
                else:
                    units += self._ordinary(self.buffer + part)
            if held:
                self.buffer += text[len(text) - held :]
        return units + self._end() if last else units

    def finish(self) -> list[str | tuple[int, ...]]:
        """The end of the text: what was held back leaves."""
        return self._end()

    def _end(self) -> list[str | tuple[int, ...]]:
        units: list[str | tuple[int, ...]] = [] if self.kind is None else [self._go_on(True)]
        rest, self.buffer = self.buffer, ""
        return units + pretokens_in(rest)

    def _ordinary(self, text: str) -> list[str | tuple[int, ...]]:
        self.buffer = text
        units: list[str | tuple[int, ...]] = []
        if self.kind is not None:
            units.append(self._go_on(False))
            if self.kind is not None:
                return units
        found = pretokens_in(self.buffer)
        held = 0
        while found and held < SETTLED:
            last = found.pop()
            held += len(last)
        units += found
        if held:
            self.buffer = self.buffer[-held:]
            if held == len(last) > OPEN:
                units.append(self._open())
        return units

    def _open(self) -> tuple[int, ...]:
        """Begin to merge a pretoken before its end is known."""
        lead = self.buffer[0] == " " and not self.buffer[1].isspace()
        self.kind = next(k for k, x in enumerate(_KINDS) if x.match(self.buffer, int(lead)))
        self.bytes = ByteTransducer(self.encoder.table, self.encoder.lookahead, rules=self.encoder.rules)
        ids = tuple(self.bytes.feed(b" ")) if lead else ()
        self.buffer = self.buffer[int(lead) :]
        return ids + self._go_on(False)

    def _go_on(self, last: bool) -> tuple[int, ...]:
        """Merge what goes on with the open pretoken; its end leaves ``kind`` None."""
        m = _KINDS[self.kind].match(self.buffer)
        run = m.end() if m else 0
        ended = last or run < len(self.buffer)
        # White space before a word leaves its last character to what follows.
        take = max(0, run - 1) if self.kind == _SPACE and not (last and run == len(self.buffer)) else run
        ids = [x for i in range(0, take, BLOCK) for x in self.bytes.feed(self.buffer[i : min(take, i + BLOCK)].encode())]
        self.buffer = self.buffer[take:]
        if ended:
            ids += self.bytes.finish()
            self.kind = self.bytes = None
        return tuple(ids)


class Encoder:
    """Texts to ids; keeps the ids of short pretokens as decimal text."""

    def __init__(self, path: str) -> None:
        self.table = MergeTable(path)
        self.lookahead = sufficient_lookahead(self.table)
        self.whole = ByteTransducer(self.table, self.lookahead)
        self.rules = self.whole.rules
        self.pretokens = _ANY
        self.cache: dict[str, str] = {}
        self.run_bytes: dict[str, bytes] = {}
        names = sorted(self.table.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        #: What all special tokens begin with, if they share it: texts without it have none.
        self.mark = os.path.commonprefix(names)[:1]
        self.decimal_bytes = {str(i): b for i, b in self.table.token_bytes.items()} | {str(i): s.encode() for s, i in self.table.special.items()}

    def unfinished(self, text: str) -> int:
        """Code points at the end of ``text`` that may be the beginning of a special token."""
        longest = max(map(len, self.table.special)) - 1
        return next((n for n in range(min(longest, len(text)), 0, -1) if any(s.startswith(text[-n:]) and len(s) > n for s in self.table.special)), 0)

    def _learn(self, words: set[str]) -> None:
        fresh = list(words)
        raw = [w.encode() for w in fresh]
        short = [i for i, b in enumerate(raw) if len(b) <= SHORT]
        for i, ids in zip(short, self.table.encode([raw[i] for i in short])):
            self.cache[fresh[i]] = ",".join(map(str, ids.tolist()))

    def learn_units(self, units: list[list[str | tuple[int, ...]]]) -> None:
        """Merge the short pretokens that are not cached, together."""
        every = set().union(*units)
        new = {w for w in every.difference(self.cache) if type(w) is str}
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = {w for w in every if type(w) is str}
        if new:
            self._learn(new)

    def runs_of(self, units: list[str | tuple[int, ...]]) -> list[str]:
        """Comma-joined ids of each unit (short pretokens are cached); units without any are left out."""
        runs = list(map(self.cache.get, units))
        at = -1
        with contextlib.suppress(ValueError):
            while True:
                at = runs.index(None, at + 1)
                unit = units[at]
                runs[at] = ",".join(map(str, unit if type(unit) is tuple else [*self.whole.feed(unit.encode()), *self.whole.finish()]))
        return runs if at < 0 else list(filter(None, runs))

    def ids_of(self, units: list[str | tuple[int, ...]]) -> Iterator[str]:
        """Comma-joined ids of the units, in one run if there are any."""
        if runs := self.runs_of(units):
            yield ",".join(runs)

    def stream_all(self, texts: list[str], piece: int | None = None) -> Iterator[tuple[int, list[str]]]:
        """(index of a text, runs of comma-joined ids): the texts side by side, a piece of each at a time."""
        size = piece or PIECE
        lanes = [(i, Transducer(self), text) for i, text in enumerate(texts) if text]
        at = 0
        while lanes:
            units = [machine.feed(text[at : at + size]) if at < len(text) else machine.finish() for _, machine, text in lanes]
            self.learn_units(units)
            for (i, _, _), found in zip(lanes, units):
                if runs := self.runs_of(found):
                    yield i, runs
            lanes = [x for x in lanes if at < len(x[2])]
            at += size

    def stream(self, text: str, piece: int | None = None) -> Iterator[str]:
        """The text's ids in order, as comma-joined runs of bounded length."""
        return (",".join(runs) for _, runs in self.stream_all([text], piece))

    def decoder(self) -> codecs.IncrementalDecoder:
        """A UTF-8 state machine for the bytes of a run of tokens after another."""
        return codecs.getincrementaldecoder("utf-8")("replace")

    def bytes_of(self, run: str) -> bytes:
        return b"".join(map(self.decimal_bytes.__getitem__, run.split(",")))

    def bytes_of_runs(self, runs: list[str]) -> bytes:
        """The bytes of runs after another; those of a run are kept as long as the ids of pretokens are."""
        if len(self.run_bytes) > CACHE_WORDS:
            self.run_bytes.clear()
        found = list(map(self.run_bytes.get, runs))
        at = -1
        with contextlib.suppress(ValueError):
            while True:
                at = found.index(None, at + 1)
                found[at] = self.run_bytes[runs[at]] = self.bytes_of(runs[at])
        return b"".join(found)

    def decode(self, runs: Iterator[str]) -> Iterator[str]:
        """Ids back to text, a run at a time."""
        machine = self.decoder()
        for run in runs:
            yield machine.decode(self.bytes_of(run))
        yield machine.decode(b"", True)


def encoder(path: str) -> Encoder:
    """One encoder a Python worker, kept across tasks."""
    return resident(("bpe_stream", path), lambda: Encoder(path))


def round_trip(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Digests of each text's ids and of the text decoded from them (``RESULT``)."""

    def digests(machine: Encoder, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        n = [0] * len(texts)
        ids, back = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
        decoders = [machine.decoder() for _ in texts]
        for i, runs in machine.stream_all(texts):
            run = ",".join(runs)
            ids[i].update(b"," + run.encode() if n[i] else run.encode())
            n[i] += run.count(",") + 1
            back[i].update(decoders[i].decode(machine.bytes_of_runs(runs)).encode())
        for i, rest in enumerate(decoders):
            back[i].update(rest.decode(b"", True).encode())
        return n, [x.hexdigest() for x in ids], [x.hexdigest() for x in back]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(tokenizer_path(vocabulary))
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                n, ids, back = digests(machine, [x or "" for x in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, RESULT)


def encode_ids(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id and the text's ids themselves (array<int>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(tokenizer_path(vocabulary))
        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                ids = [np.array([int(i) for run in machine.stream(x or "") for i in run.split(",")], np.int32) for x in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id and the text decoded from ``ids`` (null ids: empty text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(tokenizer_path(vocabulary))
        for batch in batches:
            texts = ["".join(machine.decode(iter([",".join(map(str, x))] if x else []))) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pick(encoded, doc_id="long", ids="array<int>").mapInArrow(run, "doc_id long, text string")
