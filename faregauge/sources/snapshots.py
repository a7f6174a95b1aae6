"""Tables that change together: versions in folders, and a commit that names them all.

Every write goes to a folder nobody has used. A commit is one small table that lists, for
every table and month, the folder that holds its rows; readers take the newest complete
commit and see all tables as of it. What a broken run has written is in no commit, so it is
never read, and a reader that has begun keeps its files whatever is committed later.

A commit counts once its ``_SUCCESS`` file is there, which is a single step on any store.
One writer at a time is assumed; a second one that started from the same commit is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregauge.sources.files import hadoop_path, path_exists

VERSION = "version"
LOG = "_commits"
COMMIT = "table string, part_column string, part string, version string"


@dataclass(frozen=True)
class Part:
    """Rows of one table, or of one value of its partition column, in one version."""

    version: str
    column: str | None = None
    value: str | None = None

    def folder(self) -> str:
        own = f"{VERSION}={self.version}"
        return f"{self.column}={self.value}/{own}" if self.column else own


@dataclass(frozen=True)
class Snapshot:
    """All tables as of one commit; number 0 is the state before the first."""

    spark: SparkSession
    root: str
    number: int
    tables: dict[str, tuple[Part, ...]]

    def has(self, name: str) -> bool:
        return name in self.tables

    def paths(self, name: str) -> list[str]:
        return [f"{self.root}/{name}/{part.folder()}" for part in self.tables[name]]

    def read(self, name: str) -> DataFrame:
        """The table, with its partition column if it has one."""
        if not self.has(name):
            raise ValueError(f"no table {name} in commit {self.number} of {self.root}")
        rows = self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*self.paths(name))
        return rows.drop(VERSION)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all commits that were begun, newest first."""
    files, folder = hadoop_path(spark, f"{root}/{LOG}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted((int(name) for name in names if name.isdigit()), reverse=True)


def _commit_path(root: str, number: int) -> str:
    return f"{root}/{LOG}/{number:08}"


def snapshot(spark: SparkSession, root: str, number: int | None = None) -> Snapshot:
    """The newest complete commit, or the complete commit of that number."""
    root = root.rstrip("/")
    for found in _numbers(spark, root) if number is None else [number]:
        path = _commit_path(root, found)
        if path_exists(spark, f"{path}/_SUCCESS"):
            tables: dict[str, tuple[Part, ...]] = {}
            for row in spark.read.schema(COMMIT).parquet(path).orderBy("table", "part").collect():
                part = Part(row["version"], row["part_column"], row["part"])
                tables[row["table"]] = (*tables.get(row["table"], ()), part)
            return Snapshot(spark, root, found, tables)
    if number is not None:
        raise ValueError(f"no complete commit {number} in {root}")
    return Snapshot(spark, root, 0, {})


@dataclass
class Change:
    """Writes on top of a snapshot that nobody sees before ``commit``."""

    base: Snapshot
    token: str = field(default_factory=lambda: f"v{uuid.uuid4().hex}")

    def __post_init__(self) -> None:
        self.spark, self.root = self.base.spark, self.base.root
        self._tables = dict(self.base.tables)
        self._writes = 0

    def pending(self) -> Snapshot:
        """What the commit would show."""
        return Snapshot(self.spark, self.root, self.base.number, dict(self._tables))

    def has(self, name: str) -> bool:
        return name in self._tables

    def read(self, name: str) -> DataFrame:
        return self.pending().read(name)

    def write(self, name: str, rows: DataFrame) -> None:
        """Replace a whole table."""
        version = self._next_version()
        rows.write.parquet(f"{self.root}/{name}/{VERSION}={version}")
        self._tables[name] = (Part(version),)

    def write_parts(self, name: str, rows: DataFrame, column: str, replaces: Iterable[str] | None = None) -> list[str]:
        """Replace the parts of ``column`` that ``rows`` hold, and those that ``replaces`` names.

        ``replaces`` of None stands for all parts. A named part without rows is gone after
        the commit. Returns the values written, which the store's own listing tells.
        """
        version = self._next_version()
        target = f"{self.root}/{name}"
        rows.withColumn(VERSION, F.lit(version)).write.mode("append").partitionBy(column, VERSION).parquet(target)
        files, pattern = hadoop_path(self.spark, f"{target}/{column}=*/{VERSION}={version}")
        found = files.globStatus(pattern) or []
        written = sorted(status.getPath().getParent().getName().split("=", 1)[1] for status in found)
        gone = set(written) | set(replaces or ())
        kept = () if replaces is None else self._tables.get(name, ())
        parts = [part for part in kept if part.value not in gone] + [Part(version, column, value) for value in written]
        self._tables[name] = tuple(sorted(parts, key=lambda part: part.value or ""))
        if not parts:
            del self._tables[name]
        return written

    def scratch(self, name: str) -> str:
        """A folder of its own for what a write needs on its way."""
        return f"{self.root}/_scratch/{VERSION}={self._next_version()}/{name}"

    def _next_version(self) -> str:
        self._writes += 1
        return f"{self.token}-{self._writes}"

    def commit(self) -> Snapshot:
        """Show all writes at once."""
        number = self.base.number + 1
        newest = snapshot(self.spark, self.root).number
        if newest != self.base.number:
            raise RuntimeError(f"commit {newest} was made after this change began at {self.base.number}")
        rows = [(name, part.column, part.value, part.version) for name, parts in self._tables.items() for part in parts]
        # An earlier attempt at this number that never got complete is overwritten.
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("overwrite").parquet(_commit_path(self.root, number))
        return snapshot(self.spark, self.root, number)


def begin(spark: SparkSession, root: str) -> Change:
    return Change(snapshot(spark, root))


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove folders that none of the newest ``keep`` complete commits names; returns them.

    Readers of older commits lose their files, and so does a change that is being written:
    run it when none is.
    """
    if keep < 1:
        raise ValueError("the newest commit has to stay")
    root = root.rstrip("/")
    complete = [n for n in _numbers(spark, root) if path_exists(spark, f"{_commit_path(root, n)}/_SUCCESS")]
    kept = [snapshot(spark, root, n) for n in complete[:keep]]
    if not kept:
        return []
    named = {f"{name}/{part.folder()}" for s in kept for name, parts in s.tables.items() for part in parts}
    removed = []
    for pattern in (f"{root}/*/{VERSION}=*", f"{root}/*/*=*/{VERSION}=*"):
        files, target = hadoop_path(spark, pattern)
        for status in files.globStatus(target) or []:
            segments = status.getPath().toUri().getPath().rstrip("/").split("/")
            depth = 2 if pattern.count("*") == 2 else 3
            folder = "/".join(segments[-depth:])
            if folder not in named:
                files.delete(status.getPath(), True)
                removed.append(folder)
    for number in complete[keep:]:
        files, path = hadoop_path(spark, _commit_path(root, number))
        files.delete(path, True)
    return sorted(removed)
