"""Revision history of files in a git repository, as a Python data source.

``spark.read.format("git_revisions")`` with the options ``repo`` and ``kind``:
``blame`` (a row a line of the ``files``, comma-separated), ``log`` (a row a
commit) or ``tags``. A file is a partition; git runs on the executor, which
must see the repository.
"""

from __future__ import annotations

import subprocess
from collections.abc import Iterator
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMAS = {
    "blame": "path string, line_no int, commit string, author string, author_ts timestamp, line string",
    "log": "commit string, author string, author_ts timestamp, subject string",
    "tags": "tag string, commit string, tag_ts timestamp",
}


def git(repo: str, *args: str) -> str:
    return subprocess.run(["git", "-c", "safe.directory=*", "-C", repo, *args], capture_output=True, check=True).stdout.decode("utf-8", "replace")


def open_repository(repo: str) -> str:
    """The path of a repository, begun there if there is none."""
    Path(repo).mkdir(parents=True, exist_ok=True)
    if not (Path(repo) / ".git").exists():
        git(repo, "init", "-q")
    return repo


def pull(repo: str) -> None:
    """Bring a clone up to date (on the machine that holds it)."""
    git(repo, "pull", "--ff-only", "-q")


def commit(repo: str, message: str, tag: str | None = None) -> str:
    """Record what has been written to a repository, under a tag if one is given; the commit's name."""
    git(repo, "add", "-A")
    if git(repo, "status", "--porcelain").strip():
        git(repo, "commit", "-qm", message)
    if tag:
        git(repo, "tag", tag)
    return git(repo, "rev-parse", "HEAD").strip()


def _when(seconds: str) -> datetime:
    return datetime.fromtimestamp(int(seconds), timezone.utc)


def blame(repo: str, path: str) -> Iterator[tuple]:
    """A tuple of SCHEMAS["blame"] for each line of a file, in order."""
    known: dict[str, dict[str, str]] = {}
    commit, number, fields = "", 0, {}
    for line in git(repo, "blame", "--line-porcelain", "--", path).split("\n"):
        if line.startswith("\t"):
            known[commit] = fields
            yield path, number, commit, fields.get("author"), _when(fields["author-time"]), line[1:]
            fields = {}
        elif not fields and len(line.split(" ")[0]) == 40:
            commit, _, rest = line.partition(" ")
            number, fields = int(rest.split(" ")[1]), {"": ""}
        elif line:
            key, _, value = line.partition(" ")
            fields[key] = value


def log(repo: str) -> Iterator[tuple]:
    for line in git(repo, "log", "--pretty=%H%x1f%an%x1f%at%x1f%s").splitlines():
        commit, author, at, subject = line.split("\x1f", 3)
        yield commit, author, _when(at), subject


def tags(repo: str) -> Iterator[tuple]:
    for line in git(repo, "for-each-ref", "--sort=refname", "--format=%(refname:short)%1f%(objectname)%1f%(creatordate:unix)", "refs/tags").splitlines():
        tag, commit, at = line.split("\x1f", 2)
        yield tag, commit, _when(at)


class _Part(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class GitReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.repo, self.kind = options["repo"], options.get("kind", "blame")
        self.files = [f for f in options.get("files", "").split(",") if f]

    def partitions(self) -> list[InputPartition]:
        return [_Part(f) for f in self.files] if self.kind == "blame" else [_Part("")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from blame(self.repo, partition.path) if self.kind == "blame" else log(self.repo) if self.kind == "log" else tags(self.repo)


class GitRevisions(DataSource):
    @classmethod
    def name(cls) -> str:
        return "git_revisions"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "blame")]

    def reader(self, schema) -> DataSourceReader:
        return GitReader(dict(self.options))


def read_revisions(spark: SparkSession, repo: str, files: list[str]) -> DataFrame:
    """The lines of files with the commits they come from."""
    spark.dataSource.register(GitRevisions)
    return spark.read.format("git_revisions").option("repo", repo).option("files", ",".join(files)).load()


def read_log(spark: SparkSession, repo: str) -> DataFrame:
    spark.dataSource.register(GitRevisions)
    return spark.read.format("git_revisions").option("repo", repo).option("kind", "log").load()


def current_tag(spark: SparkSession, repo: str) -> DataFrame:
    """The first tag in the order of names, as one row or none."""
    spark.dataSource.register(GitRevisions)
    return spark.read.format("git_revisions").option("repo", repo).option("kind", "tags").load().orderBy("tag").limit(1)


def file_log(lines: DataFrame) -> DataFrame:
    """Revision lines, latest first."""
    return lines.orderBy(F.desc("author_ts"), "path", "line_no")


def time_span(rows: DataFrame, column: str, low, high) -> DataFrame:
    """Rows after ``low`` and up to ``high``: exclusive below, inclusive above. A filter, which reaches the scan."""
    return rows.where((F.col(column) > low) & (F.col(column) <= high))
