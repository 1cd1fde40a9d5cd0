"""Session settings and table access."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that results depend on, and adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(app: str = "folioflow", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS. master: only where nothing else names one, as in tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate files: spark.checkpoint.dir, or the context's checkpoint folder.

    Only in local mode, where driver and executors are one machine, a temporary
    folder takes its place.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="folioflow-"))


#: By application: the temporary folder of local mode.
_LOCAL: dict[str, str] = {}


def remove_files(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store, wherever that is; nothing happens if it is gone."""
    with contextlib.suppress(Exception):  # the session may be gone at exit
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Workspace:
    """Tables that an algorithm of several rounds writes to the shared folder and reads again.

    Each cuts the lineage, so that a lost executor repeats one round's work. Their
    files go when the ``with`` ends; what is ``kept`` goes with the application.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder = spark, f"{shared_folder(spark)}/folioflow/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def store(self, rows: DataFrame) -> DataFrame:
        self.n += 1
        return self._written(rows, f"{self.folder}/{self.n}")

    def keep(self, rows: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}-kept-{self.n}"
        atexit.register(remove_files, self.spark, path)
        return self._written(rows, path)

    def _written(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        remove_files(self.spark, self.folder)
