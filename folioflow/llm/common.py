"""Pieces the operators share: column picking, stored stages, Arrow helpers."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: words are runs of anything else.
ASCII_SPACE = r"[\x20\x09-\x0D]"


#: Rows that go to a Python worker at once, so that long texts don't fill it or the JVM's buffers.
ARROW_ROWS = 500
_ARROW_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Make the session's Arrow batches ARROW_ROWS rows, as stages that share workers want them.

    Spark reads the setting when a plan runs, so what a lazy stage asks for must
    stand until then; ``batch_setting_restored`` puts the session's own value back.
    """
    spark.conf.set(_ARROW_SETTING, str(ARROW_ROWS))


@contextlib.contextmanager
def batch_setting_restored(spark: SparkSession) -> Iterator[None]:
    """The session's Arrow batch size is what it was before, afterwards."""
    before = spark.conf.get(_ARROW_SETTING)
    try:
        yield
    finally:
        spark.conf.set(_ARROW_SETTING, before)


def pick(df: DataFrame, **want: str) -> DataFrame:
    """Select ``want`` (name -> type) whatever else ``df`` holds.

    An exact name wins, then the first that differs by case only; an absent
    column becomes null. Extra columns, even ones whose names clash, go.
    """
    names = df.columns
    plain = df.toDF(*[f"_in{i}" for i in range(len(names))])
    out: list[Column] = []
    for name, kind in want.items():
        hits = [i for i, x in enumerate(names) if x == name] or [i for i, x in enumerate(names) if x.lower() == name.lower()]
        source = F.col(f"_in{hits[0]}") if hits else F.lit(None)
        out.append(source.cast(kind).alias(name))
    return plain.select(*out)


#: By application: the folder made where none is named, in local mode.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's checkpoint folder.

    A folder of this machine takes its place in local mode alone; on a cluster
    the executors could not read it, so there the setting is required.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="folioflow-")
    return _LOCAL[context.applicationId]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
    except Exception:  # noqa: BLE001  the session may be gone at exit
        pass


#: Paths that the innermost ``scratch`` will remove; without one, files go when the application ends.
_SCRATCH: list[list[str]] = []


def stored(df: DataFrame, name: str, outlives: bool = False, packed: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back. packed: long arrays of bytes, worth a denser codec.

    Cuts the lineage: a lost executor costs no recomputation of what lies
    before. The files go at the end of the ``scratch`` about it (with
    ``outlives``: not of the innermost), by ``discard``, or with the application.
    """
    spark = df.sparkSession
    ease(spark)
    path = f"{shared_dir(spark)}/folioflow/{name}-{uuid.uuid4().hex}"
    (df.write.option("compression", "zstd") if packed else df.write).parquet(path)
    scopes = _SCRATCH[:-1] if outlives else _SCRATCH
    if scopes:
        scopes[-1].append(path)
    else:
        atexit.register(_remove, spark, path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_path = path
    ease(spark)
    return back


def ease(spark: SparkSession) -> None:
    """Have the driver collect its garbage once its heap has grown past half of what it may take.

    Plans of many columns leave much, and Spark frees the broadcasts and shuffles
    of those that are done only when the driver's garbage goes.
    """
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if 2 * runtime.totalMemory() > runtime.maxMemory():
        spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Remove the files of a ``stored`` table that nothing reads any more."""
    if path := getattr(df, "stored_path", None):
        _remove(df.sparkSession, path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``stored`` writes within goes at the end; results that are to stay are stored with ``outlives``."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            _remove(spark, path)


def arrow_map(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the bytes of ``column`` stay near ``limit`` in each part."""
    array = batch.column(column)
    start, size = 0, 0
    for i, n in enumerate(pc.binary_length(array).to_pylist()):
        size += n or 0
        if size >= limit:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches put together, or cut, to about ``limit`` bytes of ``column``."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, column, limit):
            held.append(part)
            size += part.column(column).nbytes
            if size >= limit:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


_RESIDENT: dict[object, object] = {}


def resident(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps across tasks: one thing at a time.

    Workers outlive stages, so the tables of an earlier operator go when
    another one asks for its own.
    """
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def releasing(batches: Iterator[pa.RecordBatch], release: bool) -> Iterator[pa.RecordBatch]:
    """``batches``; at their end the worker's tables go, if asked for.

    A pipeline asks: its workers serve other operators next, and what they hold
    between stages would stand beside the memory of those.
    """
    yield from batches
    if release:
        _RESIDENT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only where the C library can
            ctypes.CDLL(None).malloc_trim(0)


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary file ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Bits that a bitmap of hashes has for each wanted value, and the most of all: 8 MiB, whatever is wanted. Words of 64 bits that are broadcast in a row.
BITS_EACH, MOST_BITS, ROW_WORDS = 16, 1 << 26, 128


def bitmap(wanted: DataFrame, column: str, bits: int) -> DataFrame:
    """shelf and its ROW_WORDS words, in order, of a bitmap of the hashes of ``column``.

    A row for each word would cost the driver, which builds what is broadcast,
    several times the bitmap in keys and pointers.
    """
    at = lambda: F.pmod(F.xxhash64(column), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at() % 64).cast("int")).alias("bit")
    every = wanted.sparkSession.range(bits // 64).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("bit"))
    words = wanted.select((at() / 64).cast("long").alias("slot"), bit).unionByName(every).groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    shelves = words.groupBy((F.col("slot") / ROW_WORDS).cast("long").alias("shelf")).agg(F.sort_array(F.collect_list(F.struct("slot", "bits"))).alias("words"))
    return shelves.select("shelf", F.col("words.bits").alias("words"))


def marked(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``maybe``: whether ``column`` may be among ``wanted``'s (false: surely not).

    A bitmap of hashes decides, sized by the number of ``wanted`` rows (stored,
    or cheap to count) up to MOST_BITS, so what is broadcast is bounded; a row is
    true wrongly only if its hash meets another's.
    """
    bits = min(MOST_BITS, 1 << max(16, (BITS_EACH * wanted.count()).bit_length()))
    at = F.pmod(F.xxhash64(column), F.lit(bits))
    placed = rows.withColumns({"_shelf": (at / (64 * ROW_WORDS)).cast("long"), "_word": (at / 64).cast("long") % ROW_WORDS, "_place": (at % 64).cast("int")})
    held = placed.join(F.broadcast(bitmap(wanted, column, bits).toDF("_shelf", "_words")), "_shelf")
    return held.select(*rows.columns, (F.call_function("getbit", F.get("_words", F.col("_word").cast("int")), F.col("_place")) == 1).alias("maybe"))


def shuffled(side: DataFrame) -> DataFrame:
    """``side``, to be met in a shuffle whatever Spark takes its size for.

    Spark goes by the bytes of a stored table's files, which say little of its
    rows' memory and nothing of copies made of them, and would have the driver
    build and broadcast tables that grow with the input.
    """
    return side.hint("merge")


def without(rows: DataFrame, gone: DataFrame, column: str) -> DataFrame:
    """``rows`` whose ``column`` is not among ``gone``'s; few other rows are shuffled."""
    told = marked(rows, gone, column)
    kept = told.where(~F.col("maybe")).drop("maybe")
    return kept.unionByName(told.where("maybe").drop("maybe").join(shuffled(gone.select(column)), column, "left_anti").select(*rows.columns))


#: Rows that a side may have to be broadcast, and the ways a larger one's keys are dealt.
BROADCAST_ROWS, SALTS = 50_000, 16


def join_small(rows: DataFrame, small: DataFrame, key: str, how: str = "inner", count: int | None = None) -> DataFrame:
    """``rows`` with what ``small`` (stored, a row a key) says of their key.

    Up to BROADCAST_ROWS rows, counted here or told by ``count``, ``small`` is broadcast. Beyond, both
    sides are dealt by key and salt, so that a key which many rows share falls
    on SALTS tasks, and what follows aggregates partially before it meets.
    """
    if (small.count() if count is None else count) <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), key, how)
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(shuffled(copies), [key, "_salt"], how).drop("_salt")


#: Rows from which on a key's rows are joined where they lie.
HOT_ROWS = 200_000


def join_hot(rows: DataFrame, side: DataFrame, key: str, many: str) -> DataFrame:
    """``rows`` with what ``side`` (stored, a row a key) says of their key.

    many: the column of ``side`` that tells how many rows have the key. Those of
    HOT_ROWS or more, which can be no more than the rows over HOT_ROWS, are
    broadcast, and their rows stay where they are; the others meet in a shuffle.
    """
    hot = side.where(F.col(many) >= HOT_ROWS)
    if hot.isEmpty():
        return rows.join(shuffled(side), key)
    told = rows.join(F.broadcast(hot.select(key, F.lit(True).alias("_hot"))), key, "left")
    there = told.where("_hot").drop("_hot").join(F.broadcast(hot), key)
    return there.unionByName(told.where(F.col("_hot").isNull()).drop("_hot").join(shuffled(side.where(F.col(many) < HOT_ROWS)), key))


#: The columns of ``documents``, which the stages of a pipeline pass on.
DOCUMENT = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
