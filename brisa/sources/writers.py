"""Publishing tables, keeping history, the run log and the feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa import schemas
from brisa.functions.numbers import null_to_sentinel
from brisa.operators.joins import new_rows
from brisa.session import write_out

# The stored numeric type, at the widest precision Spark has.
STORED_TYPES = {"value": "decimal(38,5)", "import_value": "decimal(38,5)"}


def typed(df: DataFrame, types: Mapping[str, str] = STORED_TYPES) -> DataFrame:
    """Columns cast to the types a target table asks for."""
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in types.items()})


def with_sentinels(df: DataFrame, cols: Sequence[str] = ("value", "import_value")) -> DataFrame:
    """Missing values as the stored sentinel, for targets that expect it."""
    return df.withColumns({c: null_to_sentinel(F.col(c)) for c in cols if c in df.columns})


def publish(df: DataFrame, target: str, types: Mapping[str, str] | None = None) -> None:
    """Overwrite a result table (a name) or a parquet folder (a path)."""
    out = typed(df, types) if types else df
    writer = out.write.mode("overwrite")
    writer.parquet(target) if "/" in target else writer.saveAsTable(target)


def append_new(df: DataFrame, stored: DataFrame, target: str, keys: Sequence[str]) -> None:
    """Append the rows whose keys are not stored yet."""
    new_rows(df, stored, keys).write.mode("append").parquet(target)


def with_day(df: DataFrame, date: str = "from_time") -> DataFrame:
    """Add the partition column ``day``, the UTC date of an hour's begin."""
    return df.withColumn("day", F.to_date(date))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def save_days(df: DataFrame, path: str, *order: str, rebuilt: DataFrame | None = None) -> None:
    """Replace the days (partition column ``day``) that occur in ``df`` and leave all others untouched.

    With ``rebuilt``, the days that ``df`` is the whole of: those without rows any more are cleared.
    Rows without a day are left out.  Rows are gathered by day; adaptive execution splits a large day
    into several files of its advisory size and puts small days into one task.  ``path`` must not be
    what ``df`` is read from.
    """
    df = df.where("day IS NOT NULL")
    cleared = []
    if rebuilt is not None:
        df = write_out(df, "days")  # evaluated once, for the rows and for the days that have any
        gone = rebuilt.where("day IS NOT NULL").select("day").distinct()
        # Calendar days, so there are few. They go last: until then readers find them as they were.
        cleared = [row["day"] for row in new_rows(gone, df, ["day"]).toLocalIterator()]
    by_day(df, *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    for day in cleared:
        remove(df.sparkSession, f"{path.rstrip('/')}/day={day}")


def by_day(df: DataFrame, *order: str) -> DataFrame:
    """Rows gathered by day in partitions of the advisory size, in order within a day."""
    return df.hint("rebalance", F.col("day")).sortWithinPartitions("day", *order)


def save_history(df: DataFrame, path: str, csv: str | None = None, rebuilt: DataFrame | None = None) -> None:
    """Store observations by the day of their begin, replacing only the days that occur.

    History is rebuilt from the kept deliveries, so a run that dies half way is repaired by running
    it again.
    """
    save_days(with_day(df), path, "sampling_point_id", "from_time", rebuilt=rebuilt)
    if csv:
        df.write.mode("overwrite").option("header", True).csv(csv)


def log_run(
    spark: SparkSession,
    path: str,
    time_begin,
    file_found: bool,
    time_file=None,
    rows: int | None = None,
    time_end=None,
    error_script: bool = False,
) -> None:
    """Append one row to the run log."""
    row = (time_begin, file_found, time_file, rows, time_end, error_script)
    log = spark.createDataFrame([row], schemas.INGEST_LOG).coalesce(1)
    log.write.mode("append").option("header", True).option("nullValue", "NA").csv(path)


def log_rows(drop: DataFrame, time_begin: Column, time_end: Column) -> DataFrame:
    """Run-log rows of delivered rows with ``file`` and ``time_file``: one per file, with its row count."""
    return drop.groupBy("file", "time_file").agg(F.count(F.lit(1)).alias("rows")).select(
        time_begin.alias("time_begin"),
        F.lit(True).alias("file_found"),
        "time_file",
        "rows",
        time_end.alias("time_end"),
        F.lit(False).alias("error_script"),
    )


def mark_failed(log: DataFrame, order: str = "time_begin", keys: Sequence[str] = ()) -> DataFrame:
    """The log with its last row (per key) flagged as failed."""
    if not keys:
        last = log.select(F.max(order)).scalar()
        return log.withColumn("error_script", F.col("error_script") | (F.col(order) == last))
    last = log.groupBy(*keys).agg(F.max(order).alias("_last"))
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    failed = F.col("error_script") | (F.col(order) == F.col("_last"))
    return log.alias("l").join(last.alias("r"), same).select(
        *[(failed if c == "error_script" else F.col(f"l.{c}")).alias(c) for c in log.columns]
    )


def write_feed(items: DataFrame, path: str) -> None:
    """Feed items as an RSS 2.0 document with one channel; a board has a handful of items."""
    channel = items.agg(F.collect_list(F.struct(*items.columns)).alias("item"))
    channel.write.mode("overwrite").format("xml").option("rootTag", 'rss version="2.0"').option("rowTag", "channel").save(path)
