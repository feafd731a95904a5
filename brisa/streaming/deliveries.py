"""Deliveries as a stream: a watched folder, late corrections and run-log alerts.

Every batch is first kept in a partition of its own, and derived tables are rebuilt from the kept
batches, day by day.  A batch that is run again replaces its own partitions with the same rows, so a
replay changes nothing and a run that dies half way is repaired by the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from brisa import schemas
from brisa.operators.dedupe import latest_wins
from brisa.operators.filters import on_days
from brisa.operators.joins import only_in, stack
from brisa.plans.alerts import TEXTS, ingest_alerts, kinds_of
from brisa.sources.readers import read_days, typed_drop
from brisa.session import scratch, write_out
from brisa.sources.sites import Kept
from brisa.sources.writers import remove, save_history, with_day
from brisa.streaming.state import LastRun

# State that grows with the number of series lives in RocksDB on the executors' disks.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure_streaming(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def stream_drop(
    spark: SparkSession, path: str, archive: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Typed rows of the files that arrive in a folder, each file read once.

    With ``archive`` a read file is moved there.  ``file`` and ``time_file`` tell each row's delivery.
    """
    reader = spark.readStream.schema(schemas.HOURLY_DROP).option("sep", ";")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(path).select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("time_file"),
    )
    return typed_drop(rows)


def keep_batch(batch: DataFrame, batch_id: int, path: str, partitions: Sequence[str] = ("day",)) -> None:
    """Write a batch to its own partitions of ``path``, replacing them if the batch is run again."""
    (
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "batch_id")
        .parquet(path)
    )


def kept_batches(batch: DataFrame, path: str) -> DataFrame:
    """All kept rows; filters on ``day`` and ``batch_id`` prune partitions."""
    schema = StructType([*batch.schema.fields, StructField("batch_id", LongType())])
    return batch.sparkSession.read.schema(schema).parquet(path)


def upsert_history(deliveries: str, history: str, compact_every: int = 100) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: keep the batch, then rebuild the days it touches, newest delivery first.

    The batch is evaluated once; its days are read from what was kept.  Rows without a time are kept
    but belong to no day, so they never reach the history.  Every ``compact_every`` batches the kept ones become
    one set of files per day (:class:`brisa.sources.sites.Kept`), so a day never has more small files than that.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept, rows = Kept(batch.sparkSession, deliveries), with_day(batch)
        with scratch(batch.sparkSession):
            rows = write_out(rows, "batch")
            kept.keep(rows, batch_id)
            days = write_out(rows.select("day").distinct(), "days")
            save_history(latest_wins(on_days(kept.all(rows), days).drop("day")), history)
        if batch_id - kept.state().notes.get("upto", -1) >= compact_every:
            kept.compact(rows)

    return write


def ingest_stream(
    observations: DataFrame, deliveries: str, history: str, checkpoint: str, compact_every: int = 100
) -> StreamingQuery:
    """Run the upsert for everything that has arrived so far."""
    return (
        observations.writeStream.foreachBatch(upsert_history(deliveries, history, compact_every))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_alerts(
    log: DataFrame,
    keys: Sequence[str],
    patience: float | None = None,
    by_clock: bool = False,
    delay: str = "1 hour",
    texts: Mapping[str, str] = TEXTS,
) -> DataFrame:
    """(keys, time, kind, text): alerts for a stream of runs, in update mode.

    The state is the last run of each feed. With ``patience`` (minutes), a feed of which no run comes for so long after its last
    one gives ``no_data`` once, without any new file, and its next run with a file gives ``restablished``.
    The time that passes is the stream's own (the newest run of any feed less ``delay``), or the clock's with ``by_clock``.
    """
    runs = log.where("time_begin IS NOT NULL").withWatermark("time_begin", delay).select(
        *keys, "time_begin", F.unix_micros("time_begin").alias("at"), F.coalesce("file_found", F.lit(False)).alias("file_found"),
        F.coalesce("error_script", F.lit(False)).alias("error_script"),
    )
    kinds = ", ".join(f"`{k}` {log.schema[k].dataType.simpleString()}" for k in reversed(keys))
    found = runs.groupBy(*keys).transformWithStateInPandas(
        LastRun(tuple(keys), None if patience is None else int(patience * 60_000), by_clock),
        f"{kinds}, at bigint, file_found boolean, error_script boolean, previous_found boolean, silent boolean",
        "update",
        "ProcessingTime" if by_clock else "EventTime",
    )
    return kinds_of(found.withColumn("time_begin", F.timestamp_micros("at")), keys, texts)


def alert_batches(
    log: str, alerts: str, keys: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: alerts for a batch of runs, given the last run before it.

    Batches are expected in time order, as the runs of a log are.  Below ``log``, ``runs`` keeps the
    batches and ``last`` the last run of each key after the newest batches, so a batch reads itself and one
    row per key, however long the log is.  A replayed batch finds the runs from before it, as long as it is one of the last two.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keep_batch(batch, batch_id, f"{log}/runs", partitions=())
        now = kept_batches(batch, f"{log}/runs").where(F.col("batch_id") == batch_id).drop("batch_id")
        states = read_days(spark, f"{log}/last", batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        earlier = states.where(F.col("batch_id") < batch_id)
        before = earlier.where(F.col("batch_id") == earlier.select(F.max("batch_id")).scalar()).drop("batch_id")
        runs = stack(before, now)
        columns = [F.col(c) for c in now.columns if c not in keys]
        last = (
            runs.groupBy(*keys)
            .agg(F.max_by(F.struct(*columns), "time_begin").alias("_row"))
            .where("_row IS NOT NULL")
            .select(*keys, "_row.*")
        )
        keep_batch(last.select(*batch.columns), batch_id, f"{log}/last", partitions=())
        times = now.select(*keys, F.col("time_begin").alias("time"))
        found = only_in(ingest_alerts(runs, keys), times, [*keys, "time"])
        keep_batch(found, batch_id, alerts, partitions=())
        for old in states.where(F.col("batch_id") < batch_id - 1).select("batch_id").distinct().toLocalIterator():
            remove(spark, f"{log}/last/batch_id={old['batch_id']}")

    return write


def delivery_time(default: Column | None = None) -> Column:
    """When a row of :func:`stream_drop` was delivered."""
    return F.col("time_file") if default is None else F.coalesce(F.col("time_file"), default)
