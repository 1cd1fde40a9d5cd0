"""Concatenate-and-cut packing of tokenised documents.

The corpus is one long token stream (each document's ids, then an end id)
cut every ``length`` tokens. Two passes give every document its place in the
stream without sorting or moving it:

1. each partition tokenises its documents, keeps a running total, and writes
   ids and local starts to the shared folder;
2. the partition totals (one row a partition) are prefix-summed, and the
   stored rows are cut at the multiples of ``length``.

Nothing but one row a partition is shuffled. Only the last sequence of the
whole corpus can be shorter than ``length``.

Edge cases: a null text counts as empty and packs as its end id alone; null
and repeated ids are carried as they are; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe_merge import MergeTable
from .common import gathered, pick, releasing, resident, stored, tokenizer_path

#: Entries kept by a worker before the cache starts anew (about 200 MB).
CACHE_WORDS = 900_000
#: The same, and bytes of text taken at a time, where a worker serves other operators too.
SHARED_WORDS, SHARED_BYTES = 200_000, 2 << 20
#: str.split() also splits at these, the tokenizer does not.
_CONTROLS = "\x1c\x1d\x1e\x1f"
#: Chunks whose lower case and parts need no Unicode tables: ASCII and the composed letters of Latin-1.
_PLAIN = re.compile(r"(?!.*<\|)[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]{1,64}")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class ChunkEncoder:
    """Encodes texts by their white-space chunks, each distinct chunk once.

    The tokenizer drops white space and never merges across it, so a text's
    ids are its chunks' ids in a row. A chunk's ids are kept as packed
    unsigned integers (two bytes for vocabularies that fit). Chunks of plain
    Latin text are merged many at a time; the library encodes all others.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS) -> None:
        self.limit = limit
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = MergeTable(path)
        self.code = "H" if self.merges.size <= 65536 else "I"
        self.width = 2 if self.code == "H" else 4
        self.cache: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        chunked = [x.split() if not any(c in x for c in _CONTROLS) else [x] for x in texts]
        cache = self.cache
        fresh = list(set().union(*chunked).difference(cache)) if chunked else []
        if len(cache) + len(fresh) > self.limit:
            cache.clear()
            fresh = list(set().union(*chunked))
        for i in range(0, len(fresh), 50_000):
            self._learn(fresh[i : i + 50_000])
        get = cache.__getitem__
        return [b"".join(map(get, x)) for x in chunked]

    def _learn(self, chunks: list[str]) -> None:
        plain, other, owners = [], [], []
        for c in chunks:
            if _PLAIN.fullmatch(c):
                parts = _PARTS.findall(c.lower())
                plain += parts
                owners.append((c, len(parts)))
            else:
                other.append(c)
        kind = np.uint16 if self.width == 2 else np.uint32
        ids = self.merges.encode([x.encode() for x in plain])
        ends = np.cumsum([len(x) for x in ids]) * self.width if ids else []
        packed = np.concatenate(ids).astype(kind).tobytes() if ids else b""
        at = done = 0
        for chunk, n in owners:
            at += n
            end = int(ends[at - 1]) if n else done
            self.cache[chunk] = packed[done:end]
            done = end
        for chunk, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False) if other else []):
            self.cache[chunk] = array(self.code, e.ids).tobytes()


def chunk_encoder(path: str, limit: int = CACHE_WORDS) -> ChunkEncoder:
    """One encoder a Python worker, kept across tasks."""
    return resident(("packing", path, limit), lambda: ChunkEncoder(path, limit))


def tokenise(docs: DataFrame, vocabulary: str, end_id: int, release: bool = False) -> DataFrame:
    """doc_id, ids (packed), width, n, part, local_start: a partition's rows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer_path(vocabulary), SHARED_WORDS if release else CACHE_WORDS)
        part, total = TaskContext.get().partitionId(), 0
        tail = array(encoder.code, [end_id]).tobytes()
        for batch in gathered(batches, "text", SHARED_BYTES if release else 8 << 20):
            ids = [x + tail for x in encoder.encode([x or "" for x in batch.column("text").to_pylist()])]
            n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // encoder.width
            ends = total + np.cumsum(n)
            total = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(np.full(len(n), encoder.width, np.int32)), pa.array(n), pa.array(np.full(len(n), part, np.int64)), pa.array(ends - n)],
                names=["doc_id", "ids", "width", "n", "part", "local_start"],
            )

    return pick(docs, doc_id="long", text="string").mapInArrow(lambda batches: releasing(run(batches), release), "doc_id long, ids binary, width int, n long, part long, local_start long")


def cut(placed: DataFrame, length: int) -> DataFrame:
    """Cut documents with a global ``start`` at the multiples of ``length``; a row a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[tuple] = []
            for doc, ids, width, n, at in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "width", "n", "start"))):
                wide = np.frombuffer(ids, dtype="<u2" if width == 2 else "<u4").astype("<u4").tobytes()
                done = 0
                while done < n:
                    take = min(n - done, length - (at + done) % length)
                    out.append((doc, done, take, zlib.crc32(wide[4 * done : 4 * (done + take)]), n, (at + done) // length, (at + done) % length))
                    done += take
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return placed.select("doc_id", "ids", "width", "n", "start").mapInArrow(run, PIECES)


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 1, length: int = 2048, release: bool = False) -> DataFrame:
    """Boundary records of the packed corpus, a row for each piece (``PIECES``)."""
    tokens = stored(tokenise(docs, vocabulary, end_id, release), "packing-tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition of the scan, which the scheduler itself holds: small at any size.
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(offsets), "part").withColumn("start", F.col("base") + F.col("local_start"))
    return cut(placed, length)
