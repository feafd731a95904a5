"""Worst-of aggregates, extents and counts.  All combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.functions.timeutil import day_of
from brisa.operators.joins import sized

# Fixed value: pollutant order of the calendar, also used to break ties between equal indices.
POLLUTANT_ORDER = ("SO2", "CO", "NO2", "O3", "PM10", "PM2.5")


def rank_in(name, order: Sequence[str]):
    """Position in a fixed list; names outside the list come last."""
    position = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(name))
    return F.when(position > 0, position).otherwise(F.lit(len(order) + 1)).cast("int")


def station_aqi(
    index: DataFrame, keys: Sequence[str] = ("station", "date"), col: str = "index"
) -> DataFrame:
    """Worst pollutant index per station and time; null only if there is none."""
    return index.groupBy(*keys).agg(F.max(col).alias("aqi"))


def culprit(
    index: DataFrame, keys: Sequence[str] = ("station", "date"), col: str = "index"
) -> DataFrame:
    """Worst index and the pollutant that reaches it; ties go to the first in the fixed order."""
    best = F.struct(F.col(col), -rank_in("pollutant", POLLUTANT_ORDER), F.col("pollutant"))
    worst = F.max(F.when(F.col(col).isNotNull(), best))
    return (
        index.groupBy(*keys)
        .agg(worst.alias("_worst"))
        .select(*keys, F.col(f"_worst.{col}").alias("aqi"), F.col("_worst.pollutant").alias("culprit"))
    )


def daily_worst(index: DataFrame, date: str = "date", col: str = "index") -> DataFrame:
    """Worst index per day, station and pollutant."""
    return index.groupBy(day_of(date).alias("day"), "station", "pollutant").agg(F.max(col).alias(col))


def daily_station_aqi(index: DataFrame, date: str = "date", col: str = "index") -> DataFrame:
    """Worst index per day and station."""
    return index.groupBy(day_of(date).alias("day"), "station").agg(F.max(col).alias("aqi"))


def daily_country(daily: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Worst station index per day, over the stations marked global (or over all)."""
    if stations is not None:
        chosen = stations.where("web_global").select(F.col("station_id").alias("station"))
        daily = daily.join(sized(chosen), "station", "left_semi")
    return daily.groupBy("day").agg(F.max("aqi").alias("country_aqi"))


def country_now(board: DataFrame, station: str = "station_id") -> DataFrame:
    """The worst global station of a map board, as one row; ties go to the first station id."""
    cols = board.columns
    first = F.min_by(F.struct(*[f"`{c}`" for c in cols]), F.struct(F.coalesce(-F.col("aqi"), F.lit(1.0)), F.col(station)))
    return board.where("web_global").agg(first.alias("_row")).where("_row IS NOT NULL").select("_row.*")


def series_extent(
    obs: DataFrame, keys: Sequence[str] = ("sampling_point_id",), begin: str = "from_time"
) -> DataFrame:
    """First and last begin per series (``first_time``, ``last_time``).

    Repeated deliveries do not change them, so ``obs`` need not be de-duplicated.
    """
    return obs.groupBy(*keys).agg(F.min(begin).alias("first_time"), F.max(begin).alias("last_time"))


def merge_extents(parts: DataFrame, keys: Sequence[str] = ("sampling_point_id",)) -> DataFrame:
    """One extent per series from extents of parts of the data, such as days."""
    return parts.groupBy(*keys).agg(
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time")
    )


def last_update(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.max(date).alias("last_update"))


def delivery_counts(df: DataFrame, by: str) -> DataFrame:
    """Rows per delivery."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
