"""Token counts of texts without their ids.

Pieces are counted once for each distinct pretoken of the corpus; a document's
tokens are the sum over its pretokens of frequency times pieces. A block of
texts is read once and kept as a sparse table of document, pretoken and
frequency; its distinct pretokens go to their owners, packed, where each is
merged once, and the answers come back to the block (``exchange``), where the
table is multiplied with them. Texts are read once and never shuffled.

Edge cases: a null text counts as empty (no bytes, no tokens); special strings
within a text are one token, as the library's default has it; null and repeated
ids and equal rows each give a row; an empty table gives no rows; other columns
of any name go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_stream import SHORT, Encoder, encoder
from .common import gathered, pick, stored, tokenizer_path
from .exchange import BLOCK_BYTES, by_key, from_planes, owner_of, owners_for, packed_rows, packed_words, planes, unpacked_words, values_of

#: Entries of the sparse table in a row, at least one document.
ENTRIES = 1 << 16

BLOCKS = "block long, owner long, start long, words binary, sizes binary, doc_ids array<long>, n_bytes array<long>, n_special array<long>, lengths binary, codes binary, frequencies binary"
ANSWERS = "block long, start long, counts binary"
RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _batch(n: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {"words": pa.binary(), "sizes": pa.binary(), "doc_ids": pa.list_(pa.int64()), "n_bytes": pa.list_(pa.int64()), "n_special": pa.list_(pa.int64()), "lengths": pa.binary(), "codes": pa.binary(), "frequencies": pa.binary()}
    names = [x.split(" ")[0] for x in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds.get(c, pa.int64())) if c in columns else pa.nulls(n, kinds.get(c, pa.int64())) for c in names], names=names)


def pretokens_of(machine: Encoder, text: str) -> tuple[list[str], int]:
    """The pretokens of a text, and how many special strings stand in it."""
    if machine.special is None or machine.mark not in text:
        return machine.pretokens.findall(text), 0
    parts = machine.special.split(text)
    return [x for part in parts[::2] for x in machine.pretokens.findall(part)], len(parts) // 2


def blocks(docs: DataFrame, vocabulary: str, owners: int) -> DataFrame:
    """Distinct pretokens of blocks (a row for each owner) and the blocks' sparse tables (``BLOCKS``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, task = encoder(tokenizer_path(vocabulary)), TaskContext.get().partitionId()
        for n, batch in enumerate(gathered(batches, "text", BLOCK_BYTES)):
            block = (task << 24) | n
            texts = [x or "" for x in batch.column("text").to_pylist()]
            found, special = zip(*(pretokens_of(machine, x) for x in texts))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            encoded = pa.array([w for words in found for w in words], pa.string()).dictionary_encode()
            entries, codes = encoded.dictionary.to_numpy(zero_copy_only=False), encoded.indices.to_numpy()
            owner = owner_of(entries, owners) if len(entries) else np.zeros(0, np.int64)
            order = np.argsort(owner, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            key, frequency = np.unique(np.repeat(np.arange(len(texts)), sizes) * max(1, len(entries)) + place[codes], return_counts=True)
            doc, code = np.divmod(key, max(1, len(entries)))
            if len(order):
                dealt = owner[order]
                starts = [0, *(np.flatnonzero(np.diff(dealt)) + 1).tolist()]
                words, sizes_ = packed_words(encoded.dictionary.take(pa.array(order)), starts)
                yield _batch(len(starts), block=[block] * len(starts), owner=dealt[starts].tolist(), start=starts, words=words, sizes=sizes_)
            lengths = np.bincount(doc, minlength=len(texts)).astype(np.uint32)
            ends = np.cumsum(lengths)
            ids, n_bytes = batch.column("doc_id").to_pylist(), [len(x.encode()) for x in texts]
            at = 0
            while at < len(texts):
                before = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + ENTRIES, side="right")))
                rows = slice(before, int(ends[to - 1]))
                yield _batch(1, block=[block], start=[at], doc_ids=[ids[at:to]], n_bytes=[n_bytes[at:to]], n_special=[list(special[at:to])], lengths=[planes(lengths[at:to])], codes=[planes(code[rows].astype(np.uint32))], frequencies=[planes(frequency[rows].astype(np.uint32))])
                at = to

    return pick(docs, doc_id="long", text="string").mapInArrow(run, BLOCKS)


def pieces_of(machine: Encoder, words: list[str]) -> np.ndarray:
    """How many tokens each pretoken has: short ones merged many at a time, long ones by the transducer."""
    raw = [w.encode() for w in words]
    pieces = np.zeros(len(raw), np.uint32)
    short = [i for i, b in enumerate(raw) if len(b) <= SHORT]
    pieces[short] = [len(ids) for ids in machine.table.encode([raw[i] for i in short])]
    for i, b in enumerate(raw):
        if len(b) > SHORT:
            pieces[i] = sum(1 for _ in machine.whole.feed(b)) + sum(1 for _ in machine.whole.finish())
    return pieces


def count_pieces(dictionaries: DataFrame, vocabulary: str) -> DataFrame:
    """Each owner merges its distinct pretokens once and answers the blocks that have them (``ANSWERS``)."""

    def run(owner: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(tokenizer_path(vocabulary))
        block, start = values_of(batches, "block"), values_of(batches, "start")
        runs = [unpacked_words(w, n, pa.string()) for w, n in zip(values_of(batches, "words"), values_of(batches, "sizes"))]
        encoded = pa.concat_arrays(runs).dictionary_encode()
        pieces = pieces_of(machine, encoded.dictionary.to_pylist())
        answers = np.split(pieces[encoded.indices.to_numpy()], np.cumsum(list(map(len, runs)))[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(start, pa.int64()), pa.array([planes(x) for x in answers], pa.binary())], names=["block", "start", "counts"])

    return by_key(dictionaries, "owner", ["block"], run, ANSWERS)


def count_tokens(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every text, and whether there are more than ``limit`` (``RESULT``)."""
    spark = docs.sparkSession
    with packed_rows(spark, 500):
        cut = stored(blocks(docs, vocabulary, owners_for(pick(docs, text="string"))), "tokens-blocks", packed=True)
    tables = ["doc_ids", "n_bytes", "n_special", "lengths", "codes", "frequencies"]
    with packed_rows(spark):
        answers = stored(count_pieces(cut.where("words is not null").select("block", "owner", "start", "words", "sizes"), vocabulary), "tokens-pieces", packed=True)
        told = answers.select("block", F.lit(0).alias("kind"), "start", "counts", *[F.lit(None).cast(cut.schema[c].dataType).alias(c) for c in tables])
        rows = cut.where("doc_ids is not null").select("block", F.lit(1).alias("kind"), "start", F.lit(None).cast("binary").alias("counts"), *tables)
        return stored(by_key(told.unionByName(rows), "block", ["kind", "start"], lambda _, batches: _summed(batches, limit), RESULT), "tokens-counts")


def _summed(batches: list[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """A block's documents, from its owners' answers (in order of their entries) and its sparse table."""
    given = [x for x in values_of(batches, "counts") if x is not None]
    pieces = np.concatenate([from_planes(x, "<u4") for x in given]).astype(np.int64) if given else np.zeros(0, np.int64)
    for batch in batches:
        for ids, n_bytes, special, lengths, codes, frequencies in zip(*(batch.column(c).to_pylist() for c in ("doc_ids", "n_bytes", "n_special", "lengths", "codes", "frequencies"))):
            if ids is None:
                continue
            parts = pieces[from_planes(codes, "<u4")] * from_planes(frequencies, "<u4")
            ends = np.cumsum(from_planes(lengths, "<u4").astype(np.int64))
            sums = np.concatenate([[0], np.cumsum(parts)])
            n = sums[ends] - sums[np.concatenate([[0], ends[:-1]])] + np.array(special, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
