"""Loads: all tables under one root, replaced together.

A load is prepared as a draft: its tables are written to a folder of its own, which nobody reads. Publication has two phases. First
the draft is sealed: every table it wrote must carry the mark of a finished write. Then its manifest, the map of table names to
folders, is written under a hidden name and renamed to the number after the load that the draft started from. The rename fails if
that number is taken, so of two loads that started from the same one the later publication fails and changes nothing. The
order of loads is the order of these numbers; no clock is involved.

A reader resolves the manifest with the highest number once and sees the tables of that load only. A draft may keep tables of the load
before it by naming their folders, so storing one more result moves no data. A root without loads is itself the folder
of its tables.

On HDFS, ABFS and local disks the rename does not replace a file. On a store without such a rename let one writer publish at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

LOADS, VERSIONS, DONE = "loads", "versions", "_SUCCESS"
#: Called with each load that this process publishes.
FOLLOWERS: list[Callable[[Load], None]] = []


class RivalLoad(RuntimeError):
    """Another load was published since this draft started."""


class _Files:
    """Small files and listings of the store that holds ``root``, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.jvm = spark, spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.system = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return [status.getPath().getName() for status in self.system.listStatus(self.path(folder))]

    def text(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Write a file unless it is there; whether it was written. Nobody sees a part of it."""
        folder, _, own = name.rpartition("/")
        hidden = self.path(f"{folder}/.{own}-{uuid.uuid4().hex}")
        stream = self.system.create(hidden, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        source, target = self.system.makeQualified(hidden), self.system.makeQualified(self.path(name))
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.conf)
        replace_nothing = self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(source, target, replace_nothing)
        except Py4JJavaError as error:
            self.system.delete(hidden, False)
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def remove(self, folder: str) -> None:
        self.system.delete(self.path(folder), True)


class Tables:
    """Tables in one folder, replaced in place."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def paths(self, name: str) -> list[str]:
        """Folders of a table: more than one where lines were appended."""
        return [self.path(name)]

    def read(self, name: str) -> DataFrame:
        parts = [self.spark.read.parquet(path) for path in self.paths(name)]
        return reduce(DataFrame.unionByName, parts)

    def newest(self, name: str) -> DataFrame:
        """The rows of a table that were appended last."""
        return self.spark.read.parquet(self.paths(name)[-1])

    def fresh(self, name: str) -> bool:
        """Whether a draft has written this table itself."""
        return False

    def has(self, name: str) -> bool:
        return _Files(self.spark, self.root).exists(self.path(name))

    def bucketed_path(self, name: str) -> tuple[str, int]:
        """Folder of a table in buckets, and their number."""
        (folder,) = (n for n in _Files(self.spark, self.root).names(self.path(name)) if n.startswith("buckets="))
        return f"{self.path(name)}/{folder}", int(folder.removeprefix("buckets="))

    def write_buckets(self, df: DataFrame, name: str, buckets: int, key: str, table_name: Callable[[str], str]) -> None:
        """Replace a table by sorted buckets of a key. Spark wants a catalog name for that; the folder is what counts."""
        folder = f"{self.path(name)}/buckets={buckets}"
        _Files(self.spark, self.root).remove(self.path(name))
        self.spark.sql(f"DROP TABLE IF EXISTS {table_name(folder)}")
        df.write.option("path", folder).bucketBy(buckets, key).sortBy(key).saveAsTable(table_name(folder))

    def write(self, df: DataFrame, name: str, *partitions: str, **options: str) -> None:
        """Replace a table whole, whatever the session says about partitions."""
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**options)
        writer.partitionBy(*partitions).parquet(self.path(name))


class Load(Tables):
    """The tables of a published load."""

    def __init__(self, spark: SparkSession, root: str, number: int, tables: dict[str, list[str]]):
        super().__init__(spark, root)
        self.number, self.tables = number, tables

    def paths(self, name: str) -> list[str]:
        if name not in self.tables:
            raise ValueError(f"load {self.number} has no table {name}")
        return [f"{self.root}/{folder}" for folder in self.tables[name]]

    def path(self, name: str) -> str:
        (path,) = self.paths(name)
        return path

    def has(self, name: str) -> bool:
        return name in self.tables

    def write(self, df: DataFrame, name: str, *partitions: str, **options: str) -> None:
        raise TypeError("a published load is not written to; write a draft")

    def write_buckets(self, df: DataFrame, name: str, buckets: int, key: str, table_name: Callable[[str], str]) -> None:
        raise TypeError("a published load is not written to; write a draft")


class Draft(Load):
    """A load that is being written. It reads what it wrote and, if it keeps the load before it, that load's other tables."""

    def __init__(self, spark: SparkSession, root: str, before: Load | None, keep: bool):
        super().__init__(spark, root, before.number + 1 if before else 1, dict(before.tables) if before and keep else {})
        self.folder, self.marks = f"{VERSIONS}/{uuid.uuid4().hex}", {}

    def _own(self) -> Tables:
        return Tables(self.spark, f"{self.root}/{self.folder}")

    def write(self, df: DataFrame, name: str, *partitions: str, **options: str) -> None:
        self._own().write(df, name, *partitions, **options)
        self._add(name, name)

    def write_buckets(self, df: DataFrame, name: str, buckets: int, key: str, table_name: Callable[[str], str]) -> None:
        self._own().write_buckets(df, name, buckets, key, table_name)
        self._add(name, f"{name}/buckets={buckets}")

    def fresh(self, name: str) -> bool:
        return name in self.marks

    def extend(self, df: DataFrame, name: str, *partitions: str) -> None:
        """Add rows to a kept table, as one more folder of it."""
        before = self.tables[name]
        self.write(df, name, *partitions)
        self.tables[name] = [*before, *self.tables[name]]

    def _add(self, name: str, written: str) -> None:
        self.tables[name] = [f"{self.folder}/{name}"]
        self.marks[name] = f"{self.root}/{self.folder}/{written}/{DONE}"

    def drop(self, name: str) -> None:
        """Leave a table out of the load."""
        self.tables.pop(name, None)
        self.marks.pop(name, None)


def _manifest(root: str, number: int) -> str:
    return f"{root}/{LOADS}/{number:020d}.json"


def load_numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published loads that are still there, oldest first."""
    names = _Files(spark, root).names(f"{root.rstrip('/')}/{LOADS}")
    return sorted(int(name[:20]) for name in names if name.endswith(".json") and name[:20].isdigit())


def published(spark: SparkSession, root: str, number: int | None = None) -> Load | None:
    """The load with this number, or the last one; None where none was published."""
    root = root.rstrip("/")
    if number is None:
        numbers = load_numbers(spark, root)
        if not numbers:
            return None
        number = numbers[-1]
    told = json.loads(_Files(spark, root).text(_manifest(root, number)))
    return Load(spark, root, told["load"], told["tables"])


def tables_of(spark: SparkSession, target: str | Tables, number: int | None = None) -> Tables:
    """The tables of a root: its last load, the one with this number, or the folder itself."""
    if isinstance(target, Tables):
        return target
    return published(spark, target, number) or Tables(spark, target)


def new_draft(spark: SparkSession, root: str, keep: bool = False) -> Draft:
    return Draft(spark, root, published(spark, root), keep)


def publish(draft: Draft) -> Load:
    """Make a draft the last load of its root."""
    files = _Files(draft.spark, draft.root)
    unfinished = [name for name, mark in draft.marks.items() if not files.exists(mark)]
    if unfinished:
        raise ValueError(f"unfinished tables: {', '.join(unfinished)}")
    text = json.dumps({"load": draft.number, "tables": draft.tables}, sort_keys=True)
    if not files.put_new(_manifest(draft.root, draft.number), text):
        raise RivalLoad(f"load {draft.number} of {draft.root} was published by another writer")
    load = Load(draft.spark, draft.root, draft.number, dict(draft.tables))
    for followed in FOLLOWERS:
        followed(load)
    return load


@contextmanager
def writing(spark: SparkSession, target: str | Tables) -> Iterator[Tables]:
    """Where to write: a draft or folder as it is; for a root with loads a draft that keeps its tables and is published at the end,
    unless a write failed; else the root's folder."""
    if isinstance(target, Tables):
        yield target
    elif published(spark, target) is None:
        yield Tables(spark, target)
    else:
        draft = new_draft(spark, target, keep=True)
        yield draft
        publish(draft)


def remove_loads(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` loads, with every folder that no load left names, and return their numbers. Drafts are
    such folders too, so no load may be in preparation."""
    if keep < 1:
        raise ValueError("the last load stays")
    root, files = root.rstrip("/"), _Files(spark, root)
    numbers = load_numbers(spark, root)
    gone = numbers[:-keep]
    named = {f.split("/")[1] for n in numbers[-keep:] for t in published(spark, root, n).tables.values() for f in t}
    for number in gone:  # the manifests first, so no reader finds one without its tables
        files.remove(_manifest(root, number))
    for folder in files.names(f"{root}/{VERSIONS}"):
        if numbers and folder not in named:
            files.remove(f"{root}/{VERSIONS}/{folder}")
    return gone
