"""Blocks of texts, their dictionaries, and how blocks learn what the corpus says of their entries.

A block is a few megabytes of texts that one task has read. Its distinct entries
(words, pretokens) go once to their owners, dealt by hash and packed many to a
row; an owner answers with a number or two for each entry, packed in the same
order. So a join of every occurrence with a corpus-wide table costs one row for
each block and owner, and no table of all entries is ever held in one place.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _ARROW_SETTING

#: Bytes of text in a block, and bytes of the corpus for each owner.
BLOCK_BYTES, OWNER_BYTES = 8 << 20, 4 << 20
#: Owners at least, so that small corpora keep several tasks busy.
LEAST_OWNERS = 16
#: Rows of packed arrays that enter a Python worker at once.
PACKED_ROWS = 64


@contextlib.contextmanager
def packed_rows(spark: SparkSession, rows: int = PACKED_ROWS) -> Iterator[None]:
    """Arrow batches of ``rows`` rows for what is run within (rows hold long arrays)."""
    before = spark.conf.get(_ARROW_SETTING)
    spark.conf.set(_ARROW_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_SETTING, before)


def owners_for(docs: DataFrame, column: str = "text") -> int:
    """How many owners the entries of the corpus are dealt to: in proportion to its bytes."""
    total = docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
    return max(LEAST_OWNERS, -(-total // OWNER_BYTES))


def owner_of(entries: np.ndarray, owners: int) -> np.ndarray:
    """The owner of each entry (str or bytes): a hash that is the same in every process."""
    return (pd.util.hash_array(entries, categorize=False) % np.uint64(owners)).astype(np.int64)


def planes(values: np.ndarray) -> bytes:
    """Unsigned integers as planes of 16 bits, lowest first: high planes are nearly all zero and compress away."""
    wide = np.ascontiguousarray(values)
    return b"" if not len(wide) else np.ascontiguousarray(wide.view("<u2").reshape(len(wide), -1).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    """What ``planes`` packed; kind: the integers' numpy type."""
    n = np.dtype(kind).itemsize // 2
    return np.zeros(0, kind) if not data else np.ascontiguousarray(np.frombuffer(data, "<u2").reshape(n, -1).T).view(kind).ravel()


def packed_words(words: pa.Array, starts: list[int]) -> tuple[list[bytes], list[bytes]]:
    """Runs of a string or binary array as their bytes in a row, and their lengths (``planes``); starts: where runs begin."""
    offsets = np.frombuffer(words.buffers()[1], "<i8" if words.type in (pa.large_string(), pa.large_binary()) else "<i4")[words.offset : words.offset + len(words) + 1]
    data = memoryview(words.buffers()[2] or b"")
    spans = list(zip(starts, [*starts[1:], len(words)]))
    return [bytes(data[offsets[a] : offsets[b]]) for a, b in spans], [planes(np.diff(offsets[a : b + 1]).astype(np.uint32)) for a, b in spans]


def unpacked_words(data: bytes, lengths: bytes, kind: pa.DataType) -> pa.Array:
    """A run of ``packed_words`` as an array of ``kind``, string or binary."""
    sizes = from_planes(lengths, "<u4")
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def by_key(rows: DataFrame, key: str, order: list[str], function: Callable[[int, list[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``function`` of each key's rows, brought together by a shuffle and sorted by ``order``.

    One key's rows are in memory at a time. Keys are blocks or owners, whose
    size is bounded by what made them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for start, stop in zip(cuts, cuts[1:]):
                if stop == start:
                    continue
                if held and keys[start] != now:
                    yield from function(int(now), held)
                    held = []
                now = keys[start]
                held.append(batch.slice(start, stop - start))
        if held:
            yield from function(int(now), held)

    return rows.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def values_of(batches: list[pa.RecordBatch], column: str) -> list:
    return [v for b in batches for v in b.column(column).to_pylist()]
