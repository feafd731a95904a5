"""Aggregates on streams of observations and indices, with state that follows corrections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions.numbers import round_half_even
from brisa.operators.dedupe import has_value, verified
from brisa.operators.filters import pollutants
from brisa.operators.indices import aqi_decimal
from brisa.operators.joins import lookup
from brisa.operators.reshape import split_series
from brisa.operators.windows import AVERAGING_HOURS, CAPTURE, CHUNK_HOURS
from brisa.streaming.state import MEANS, DayWorst, HourMeans

# Late corrections arrive for so long; fixed by the deliveries, which repeat the last 24 days.
DELAY = "24 days"


def _hours(obs: DataFrame, width: Column, delay: str, floor: float, seq: str | None, chunk_hours: int) -> DataFrame:
    """Rows of :data:`brisa.streaming.state.HOURS` by series, chunk and width; hours that the next chunk looks back to come twice."""
    hour = F.floor(F.unix_seconds("from_time") / 3600).cast("bigint")
    last = F.expr(f"-`{seq}`") if seq else F.col("value")
    millionths = (F.col("value").try_cast("decimal(16,6)") * 1_000_000).cast("bigint")
    rows = obs.where("from_time IS NOT NULL").withWatermark("from_time", delay).select(
        "sampling_point_id",
        "from_time",
        width.cast("int").alias("width"),
        hour.alias("hour"),
        F.coalesce(F.unix_micros("touched"), F.lit(-(1 << 63))).alias("touched"),
        verified("verification_flag").cast("bigint").alias("verified"),
        has_value("value").alias("has"),
        F.coalesce(last.cast("double"), F.lit(float("-inf"))).alias("last"),
        F.coalesce(millionths, F.lit(0)).alias("millionths"),
        millionths.isNotNull().alias("number"),
        F.coalesce("value", F.lit(0.0)).alias("raw"),
        F.coalesce(F.col("value") > floor, F.lit(True)).alias("plausible"),
    )
    own, reach = (F.floor(h / chunk_hours) for h in (F.col("hour"), F.col("hour") + F.col("width") - 1))
    return rows.withColumn("chunk", F.explode(F.when(reach > own, F.array(own, own + 1)).otherwise(F.array(own))))


def stream_means(
    obs: DataFrame,
    width: int | Column = 24,
    capture: float = CAPTURE,
    delay: str = DELAY,
    floor: float = -10.0,
    seq: str | None = None,
    prompt: bool = True,
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """(sampling_point_id, date, value, observed): running means of the best delivery of each hour, as a stream of changes.

    With ``prompt`` (update mode), a mean goes out with the batch that brings its hour and again whenever a later
    delivery changes it: of several rows of an hour the newest counts, and one that is not ``observed`` takes the hour back,
    because its best delivery is no plausible value any more. Without (append mode), each hour goes out once, when the watermark
    has passed it. ``delay`` is how late deliveries may come; ``date`` is the end of the hour. ``width`` may be a
    column of ``obs``; hours of width 1 keep their value as it is.
    """
    rows = _hours(obs, width if isinstance(width, Column) else F.lit(width), delay, floor, seq, chunk_hours)
    mode = "update" if prompt else "append"
    out = rows.groupBy("sampling_point_id", "chunk", "width").transformWithStateInPandas(
        HourMeans(chunk_hours, prompt), MEANS, mode, "EventTime"
    )
    mean = round_half_even(F.col("total").cast("double") / (F.col("number") * 1_000_000))
    return out.select(
        "sampling_point_id",
        F.timestamp_seconds((F.col("hour") + 1) * 3600).alias("date"),
        F.when(F.col("width") == 1, F.when(F.col("has"), F.col("raw")))
        .when(F.col("number") >= F.ceil(F.lit(capture) * F.col("width")), mean)
        .alias("value"),
        "observed",
    )


def stream_running_mean(
    obs: DataFrame,
    width: int = 24,
    capture: float = CAPTURE,
    delay: str = DELAY,
    floor: float = -10.0,
    seq: str | None = None,
) -> DataFrame:
    """(sampling_point_id, date, value): running means of hours that no correction can reach any more, in append mode."""
    closed = stream_means(obs, width, capture, delay, floor, seq, prompt=False)
    return closed.where("observed").drop("observed")


def stream_indices(
    obs: DataFrame,
    mapping: DataFrame,
    breaks: DataFrame,
    hours: Mapping[str, int] = AVERAGING_HOURS,
    delay: str = DELAY,
    seq: str | None = None,
) -> DataFrame:
    """(station, date, pollutant, value, index, observed): changes of the indices of raw observations, in update mode."""
    coded = split_series(pollutants(obs))
    named = lookup(coded, mapping, ("code", "pollutant_id"), ["notation"])
    cases = F.lit(1)
    for name, width in hours.items():
        cases = F.when(F.col("notation") == name, F.lit(width)).otherwise(cases)
    changes = split_series(stream_means(named, cases, delay=delay, seq=seq))
    rows = lookup(changes, mapping, ("code", "pollutant_id"), ["notation"]).withColumnRenamed("notation", "pollutant")
    return aqi_decimal(rows.select("station", "date", "pollutant", "value", "observed"), breaks)


def stream_daily_worst(index: DataFrame, delay: str = DELAY, order: str | None = None) -> DataFrame:
    """(day, station, pollutant, index): worst index of each day, for a stream of index changes; update mode.

    ``index`` has one row for each new or changed hour, as :func:`stream_indices` gives them; hours that are not ``observed``
    (if there is such a column) are taken back. ``order`` says which of several rows of an hour in one batch is the newest.
    The worst index of a day is sent whenever it changes and can fall as well as rise; a day that loses its last hour is
    sent as null with ``gone``.
    """
    observed = F.col("observed") if "observed" in index.columns else F.lit(True)
    rows = index.where("date IS NOT NULL").withWatermark("date", delay).select(
        F.to_date("date").alias("day"),
        "station",
        "pollutant",
        "date",
        F.unix_micros("date").alias("at"),
        (F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")).alias("version"),
        F.coalesce(F.col("index").cast("double"), F.lit(float("-inf"))).alias("worst"),
        observed.alias("observed"),
    )
    return (
        rows.groupBy("day", "station", "pollutant")
        .transformWithStateInPandas(
            DayWorst(), "day date, station string, pollutant string, worst double, gone boolean", "update", "EventTime"
        )
        .select("day", "station", "pollutant", F.when(F.col("worst") > float("-inf"), F.col("worst")).cast(index.schema["index"].dataType).alias("index"), "gone")
    )
