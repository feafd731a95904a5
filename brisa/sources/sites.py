"""Published tables below one folder: plain, or as snapshots that readers see whole.

A plain :class:`Folder` overwrites its tables one by one. A :class:`Change` writes beside what is there::

    <folder>/<table>/run=<id>/...            a whole table
    <folder>/<table>/run=<id>/day=<day>/...  days of a table
    <folder>/_commits/<number>.json          what counts: table -> day ("" for a whole table) -> run

The commit is one small file that is renamed to the next free number when all else is written. A reader takes the highest number
and sees one state of every table, before or after; a run that dies leaves files that nobody reads and :func:`vacuum`
removes. Two runs at a time cannot both take a number: the second one fails and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brisa import schemas
from brisa.operators.filters import on_days
from brisa.operators.joins import new_rows, stack
from brisa.session import scratch, write_out
from brisa.sources.readers import read_days, read_history
from brisa.sources.writers import by_day, publish, remove, save_days, with_day

COMMITS = "_commits"


class Folder:
    """Plain tables: each is overwritten where it lies."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def replace(self, name: str, df: DataFrame) -> None:
        publish(df, f"{self.folder}/{name}")

    def write(self, name: str, writer: Callable[[str], None]) -> None:
        """Replace a table by what ``writer`` writes to the path it gets."""
        writer(f"{self.folder}/{name}")

    def save_days(self, name: str, df: DataFrame, *order: str, rebuilt: DataFrame) -> None:
        """Replace the days ``rebuilt``, of which ``df`` has all rows."""
        path = f"{self.folder}/{name}"
        if not _partitions(self.spark, path):
            remove(self.spark, path)
        save_days(df, path, *order, rebuilt=rebuilt)
        if not _partitions(self.spark, path):
            publish(df.limit(0), path)  # without any day, a table of no rows

    def days(self, name: str, like: DataFrame) -> DataFrame:
        """A table stored by day; empty, with the columns of ``like``, before its first row."""
        return read_days(self.spark, f"{self.folder}/{name}", like)

    def whole(self, name: str, like: DataFrame) -> DataFrame:
        """A table stored as a whole; empty before it is first stored."""
        return read_days(self.spark, f"{self.folder}/{name}", like)

    def history(self, name: str, schema: StructType = schemas.OBSERVATIONS) -> DataFrame:
        return read_history(self.spark, f"{self.folder}/{name}", schema)


def _partitions(spark: SparkSession, path: str) -> list[str]:
    """Days that a table stored by day has a partition for."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []
    return [n.removeprefix("day=") for n in names if n.startswith("day=")]


@dataclass(frozen=True)
class Commit:
    """One committed state: its number, table -> day -> run, and notes of the writer."""

    number: int = -1
    tables: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{COMMITS}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def commits(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the commits that are there."""
    path, system = _files(spark, folder)
    if not system.exists(path):
        return []
    names = [s.getPath().getName() for s in system.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def committed(spark: SparkSession, folder: str, number: int | None = None) -> Commit:
    """The newest commit (or the one of that number); an empty one before the first."""
    numbers = commits(spark, folder)
    if number is None and not numbers:
        return Commit()
    number = numbers[-1] if number is None else number
    text = spark.read.text(f"{folder.rstrip('/')}/{COMMITS}/{number:012d}.json", wholetext=True).first()
    held = json.loads(text["value"])
    return Commit(number, held["tables"], held["notes"])


def _commit(spark: SparkSession, folder: str, state: Commit) -> None:
    """Write a commit under its number; fails if that number is taken."""
    path, system = _files(spark, folder)
    system.mkdirs(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    made, to = hadoop.Path(path, f".{uuid.uuid4().hex}"), hadoop.Path(path, f"{state.number:012d}.json")
    out = system.create(made, False)
    out.write(json.dumps({"tables": state.tables, "notes": state.notes}).encode())
    out.close()
    # This rename, unlike that of a file system, refuses to replace a file.
    context = hadoop.FileContext.getFileContext(made.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(system.makeQualified(made), system.makeQualified(to), spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
    except Exception:
        system.delete(made, False)
        raise


def _read(spark: SparkSession, folder: str, name: str, runs: Mapping[str, str], schema: StructType | None = None) -> DataFrame:
    base = f"{folder.rstrip('/')}/{name}"
    if "" in runs:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(f"{base}/run={runs['']}")
    paths = [f"{base}/run={run}" for run in sorted(set(runs.values()))]
    reader = spark.read.option("basePath", base)
    if schema:
        reader = reader.schema(StructType([*schema.fields, *([] if "day" in schema.names else [schemas.DAY]), schemas.RUN]))
    rows = reader.parquet(*paths)
    # Only partition columns: days that a later run has rebuilt are not listed and never opened.
    live = F.concat_ws("/", F.col("day").cast("string"), F.col("run").cast("string")).isin([f"{d}/{r}" for d, r in runs.items()])
    return rows.where(live).drop("run")


def read(spark: SparkSession, folder: str, name: str, at: Commit | None = None) -> DataFrame:
    """A table as of the newest commit, or of ``at``: tables read with the same commit belong together."""
    at = at or committed(spark, folder)
    if not at.tables.get(name):
        raise ValueError(f"{name} is not in the commit {at.number} of {folder}")
    return _read(spark, folder, name, at.tables[name])


class Change(Folder):
    """The next state of a folder while it is written; reads see what it has written so far."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder)
        self.run = f"r{uuid.uuid4().hex}"  # never a number, whatever Spark takes partition values for
        self.seen = committed(spark, folder)
        self.tables = {name: dict(runs) for name, runs in self.seen.tables.items()}
        self.notes = dict(self.seen.notes)

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}/run={self.run}"

    def replace(self, name: str, df: DataFrame) -> None:
        self.write(name, lambda path: df.write.parquet(path))

    def write(self, name: str, writer: Callable[[str], None]) -> None:
        if self.run in self.tables.get(name, {}).values():
            raise ValueError(f"{name} has been written in this run")
        writer(self._path(name))
        self.tables[name] = {"": self.run}

    def save_days(self, name: str, df: DataFrame, *order: str, rebuilt: DataFrame) -> None:
        by_day(df.where("day IS NOT NULL"), *order).write.partitionBy("day").parquet(self._path(name))
        # Calendar days, so there are few; those without rows any more drop out.
        listed = rebuilt.where("day IS NOT NULL").select(F.col("day").cast("string")).distinct()
        gone = {row["day"] for row in listed.toLocalIterator()}
        written = set(_partitions(self.spark, self._path(name)))
        kept = {day: run for day, run in self.tables.get(name, {}).items() if day not in gone | written}
        self.tables[name] = kept | {day: self.run for day in written}

    def days(self, name: str, like: DataFrame) -> DataFrame:
        runs = self.tables.get(name)
        return _read(self.spark, self.folder, name, runs, like.schema).select(*[F.col(f"`{c}`") for c in like.columns]) if runs else like.limit(0)

    def whole(self, name: str, like: DataFrame) -> DataFrame:
        return self.days(name, like)

    def history(self, name: str, schema: StructType = schemas.OBSERVATIONS) -> DataFrame:
        runs = self.tables.get(name)
        empty = self.spark.createDataFrame([], schema)
        return stack(empty, _read(self.spark, self.folder, name, runs)) if runs else empty

    def commit(self) -> Commit:
        state = Commit(self.seen.number + 1, self.tables, self.notes)
        _commit(self.spark, self.folder, state)
        return state


@contextmanager
def changing(spark: SparkSession, folder: str) -> Iterator[Change]:
    """A change that is committed at the end; if anything fails nothing of it is ever seen."""
    change = Change(spark, folder)
    yield change
    change.commit()


def vacuum(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Remove what the newest ``keep`` commits do not refer to. No run may be writing meanwhile."""
    numbers = commits(spark, folder)
    states = [committed(spark, folder, n) for n in numbers[-keep:]]
    live = {(name, run) for state in states for name, runs in state.tables.items() for run in runs.values()}
    hadoop = spark._jvm.org.apache.hadoop.fs
    path, system = _files(spark, folder)
    for name in [s.getPath().getName() for s in system.listStatus(hadoop.Path(folder)) if s.isDirectory()]:
        for status in system.listStatus(hadoop.Path(f"{folder.rstrip('/')}/{name}")):
            run = status.getPath().getName()
            if run.startswith("run=") and (name, run.removeprefix("run=")) not in live:
                system.delete(status.getPath(), True)
    for number in numbers[:-keep]:
        system.delete(hadoop.Path(path, f"{number:012d}.json"), False)


class Kept(Folder):
    """Deliveries by batch, compacted into days: ``batches`` since the last compaction, ``rows`` for what came before.

    A folder belongs to one stream: a batch is known by its number.
    """

    def state(self) -> Commit:
        return committed(self.spark, self.folder)

    def keep(self, batch: DataFrame, batch_id: int) -> None:
        """Store a batch (with ``day``); one that is run again replaces itself, or must be in the compacted days already."""
        state = self.state()
        if batch_id <= state.notes.get("upto", -1):
            same = [c for c in batch.columns if c != "day"]
            days = batch.select("day")
            if not new_rows(batch, on_days(self._rows(state, batch), days), same).where("day IS NOT NULL").isEmpty():
                raise ValueError(f"batch {batch_id} was compacted with other rows: another stream writes to {self.folder}")
            return
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", "day")
            .parquet(f"{self.folder}/batches")
        )

    def _rows(self, state: Commit, like: DataFrame) -> DataFrame:
        runs = state.tables.get("rows")
        return _read(self.spark, self.folder, "rows", runs, like.schema).select(*[F.col(f"`{c}`") for c in like.columns]) if runs else like.limit(0)

    def _batches(self, state: Commit, like: DataFrame) -> DataFrame:
        numbered = like.withColumn("batch_id", F.lit(0).cast("bigint"))
        rows = read_days(self.spark, f"{self.folder}/batches", numbered)
        return rows.where(F.col("batch_id") > state.notes.get("upto", -1)).select(*[F.col(f"`{c}`") for c in numbered.columns])

    def all(self, like: DataFrame) -> DataFrame:
        """All kept rows, with the columns of ``like``; filters on ``day`` prune partitions."""
        state = self.state()
        batches = self._batches(state, like).drop("batch_id")
        return self._rows(state, like).unionByName(batches).unionByName(self._undated(state, like))

    def compact(self, like: DataFrame, keep: int = 2) -> None:
        """Move all batches into one set of files per day; batches of the commits before go."""
        with scratch(self.spark), changing(self.spark, self.folder) as change:
            batches = self._batches(change.seen, like)
            newest = batches.agg(F.max("batch_id")).first()[0]
            if newest is None:
                return
            batches = batches.where(F.col("batch_id") <= newest).drop("batch_id")
            days = write_out(batches.select("day").distinct(), "days")
            dated = on_days(self._rows(change.seen, like).unionByName(batches), days)
            change.save_days("rows", dated, rebuilt=days)
            undated = batches.where("day IS NULL")
            earlier = self._undated(change.seen, like)
            change.replace("undated", earlier.unionByName(undated).drop("day"))
            change.notes["upto"] = newest
        vacuum(self.spark, self.folder, keep)
        # Readers of the commit before may still read its batches.
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batches")
        for status in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path):
            name = status.getPath().getName()
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= change.seen.notes.get("upto", -1):
                remove(self.spark, f"{self.folder}/batches/{name}")

    def _undated(self, state: Commit, like: DataFrame) -> DataFrame:
        runs = state.tables.get("undated")
        return with_day(_read(self.spark, self.folder, "undated", runs, like.drop("day").schema)).select(*[F.col(f"`{c}`") for c in like.columns]) if runs else like.limit(0)
