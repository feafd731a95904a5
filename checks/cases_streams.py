"""Queries that run as streams over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brisa.operators import filters
from brisa.session import shared_folder
from brisa.sources.readers import clean_sentinels
from brisa.streaming import aggregates, deliveries
from checks import adapter
from checks.adapter import sql
from checks.cases_rows import COLS, ROW
from checks.registry import SQL, case


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Parts that deliveries are dealt to, and parts of a batch.
PARTS, EACH = 8, 2


def _arrivals(spark, sf):
    """Raw observations as files that arrive one after the other; the deliveries of an hour are in several of them."""
    deliveries.configure_streaming(spark)
    part = F.pmod("seq", F.lit(PARTS))
    path = _folder(spark, "arrivals")
    obs = adapter.observations(adapter.read(spark, sf, "events"))
    obs.repartitionByRange(PARTS, part).write.parquet(path)
    source = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", EACH).parquet(path)
    return filters.drop_future(clean_sentinels(source))


def _obs_stream(spark, sf):
    """Raw observations in the order of their hours, as the table of events has them."""
    deliveries.configure_streaming(spark)
    events = spark.readStream.schema(adapter.TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(sf)
    return filters.drop_future(clean_sentinels(adapter.observations(events)))


def _log_stream(log):
    """A run log as files in the order of time."""
    deliveries.configure_streaming(log.sparkSession)
    path = _folder(log.sparkSession, "log")
    first, last = log.select(F.min("time_begin"), F.max("time_begin")).first()
    share = (F.unix_seconds("time_begin") - F.unix_seconds(F.lit(first))) / max((last - first).total_seconds(), 1)
    for k in range(4):
        log.where(F.least(F.floor(share * 4), F.lit(3)) == k).coalesce(1).write.mode("append").parquet(path)
    return log.sparkSession.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _changes(stream, name):
    """All rows of a stream of changes with their batch, from the files that each batch left."""
    spark = stream.sparkSession
    out, checkpoint = _folder(spark, name), _folder(spark, "checkpoint")

    def keep(batch, batch_id):
        deliveries.keep_batch(batch, batch_id, out, partitions=())

    writer = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return out, deliveries.kept_batches(spark.createDataFrame([], stream.schema), out)


def _newest(changes, *keys):
    """The last that was said about each key."""
    rest = [F.col(c) for c in changes.columns if c not in (*keys, "batch_id")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row")).select(*keys, "_row.*")


@case("stream_latest_wins", sql(f"SELECT {ROW} FROM w1", "w1"))
def stream_latest_wins(spark, sf):
    kept, history, checkpoint = (_folder(spark, n) for n in ("kept", "history", "checkpoint"))
    deliveries.ingest_stream(_arrivals(spark, sf), kept, history, checkpoint).awaitTermination()
    return spark.read.parquet(history).select(COLS)


MEANS = """SELECT sampling_point_id, to_time AS date,
                    CASE WHEN count(value) OVER w >= 18 THEN CAST(round_even(
                      CAST(sum(CAST(value AS DECIMAL(18,6))) OVER w AS DOUBLE) / count(value) OVER w, 0) AS DOUBLE) END AS value
             FROM clean WHERE value > -10 OR value IS NULL
             WINDOW w AS (PARTITION BY sampling_point_id ORDER BY to_time
                          RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW)"""


@case(
    "stream_running_mean_24h",
    sql(f"SELECT * FROM ({MEANS}) WHERE date <= (SELECT max(from_time) FROM kept) - INTERVAL 3 HOUR", "clean"),
)
def stream_running_mean_24h(spark, sf):
    out, checkpoint = _folder(spark, "means"), _folder(spark, "checkpoint")
    means = aggregates.stream_running_mean(_obs_stream(spark, sf), delay="3 hours", seq="seq")
    (
        means.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return spark.read.schema(means.schema).parquet(out)


@case("stream_means", sql(MEANS, "clean"))
def stream_means(spark, sf):
    # Deliveries of all hours are in every batch, so no hour may be too late.
    _, changes = _changes(aggregates.stream_means(_arrivals(spark, sf), delay="400 days", seq="seq"), "means")
    return _newest(changes, "sampling_point_id", "date").where("observed").drop("observed")


@case("stream_daily_worst", SQL["daily_worst"])
def stream_daily_worst(spark, sf):
    indices = aggregates.stream_indices(_arrivals(spark, sf), adapter.mapping(spark), adapter.breaks(spark), delay="400 days", seq="seq")
    path, kept = _changes(indices, "indices")
    changes = spark.readStream.schema(kept.schema).option("maxFilesPerTrigger", EACH).parquet(path)
    _, worst = _changes(aggregates.stream_daily_worst(changes, delay="400 days", order="batch_id"), "worst")
    return _newest(worst, "day", "station", "pollutant").where("NOT gone").drop("gone")


@case("stream_alerts", SQL["ingest_alerts"])
def stream_alerts(spark, sf):
    return _changes(deliveries.stream_alerts(_log_stream(adapter.runlog(spark, sf)), ["feed"]), "alerts")[1].drop("batch_id")


@case(
    "stream_silence",
    sql(
        """
, runs AS (SELECT feed, time_begin, error_script, lag(time_begin) OVER w AS before, lead(time_begin) OVER w AS after,
       max(time_begin) OVER () AS newest FROM runlog WHERE file_found WINDOW w AS (PARTITION BY feed ORDER BY time_begin)),
found AS (
  SELECT feed, time_begin + INTERVAL 150 MINUTE AS time, 'no_data' AS kind FROM runs
    WHERE coalesce(after, newest - INTERVAL 10 MINUTE) > time_begin + INTERVAL 150 MINUTE
  UNION ALL SELECT feed, time_begin, 'restablished' FROM runs WHERE time_begin > before + INTERVAL 150 MINUTE
  UNION ALL SELECT feed, time_begin, 'fail' FROM runs WHERE error_script
  UNION ALL SELECT feed, time_begin, 'alive' FROM (SELECT *, timezone('Europe/Andorra', timezone('UTC', time_begin)) AS local FROM runs)
    WHERE hour(local) IN (8, 16) AND isodow(local) <= 5)
SELECT * FROM found""",
        "runlog",
    ),
)
def stream_silence(spark, sf):
    """Only runs that found a file are in the log: all that tells of a gap is that nothing comes."""
    runs = _log_stream(adapter.runlog(spark, sf).where("file_found"))
    alerts = deliveries.stream_alerts(runs, ["feed"], patience=150, delay="10 minutes")
    return _changes(alerts, "alerts")[1].select("feed", "time", "kind")
