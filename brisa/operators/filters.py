"""Row filters.  All are plain predicates that Spark pushes towards the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions import text
from brisa.functions.timeutil import add_days, add_hours
from brisa.operators.joins import only_in


def drop_future(df: DataFrame) -> DataFrame:
    """Only hours that had ended when they were delivered."""
    return df.where(F.col("to_time") < F.col("touched"))


def meteo(df: DataFrame, series: str = "sampling_point_id") -> DataFrame:
    return df.where(text.is_meteo(F.col(series)))


def pollutants(df: DataFrame, series: str = "sampling_point_id") -> DataFrame:
    return df.where(~text.is_meteo(F.col(series)))


def plausible(df: DataFrame, value: str = "value", floor: float = -10.0, keep_null: bool = True) -> DataFrame:
    keep = F.col(value) > floor
    return df.where(keep | F.col(value).isNull() if keep_null else keep)


def since(df: DataFrame, start: Column, date: str = "from_time") -> DataFrame:
    """Rows from ``start`` on; a table partitioned by day is read from that day on."""
    if "day" in df.columns:
        df = df.where(F.col("day") >= F.to_date(start))
    return df.where(F.col(date) >= start)


def last_days(df: DataFrame, as_of: Column, days: int = 30, date: str = "to_time") -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` (a literal or a scalar subquery).

    A partition day holds the begin of an hour, which is up to an hour before the filtered end.
    """
    start = add_days(as_of, -days)
    if "day" in df.columns:
        df = df.where(F.col("day") >= F.to_date(add_hours(start, -1)))
    return df.where(F.col(date) >= start)


def newest_part(df: DataFrame, date: str = "to_time", days: int = 2) -> DataFrame:
    """The rows of the last ``days`` days before the latest row.

    "Latest" questions have the same answer on this part.  The latest time is a scalar subquery, so a
    table partitioned by day is then read from that day on.
    """
    return last_days(df, df.select(F.max(date)).scalar(), days, date)


def on_days(df: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of a table partitioned by ``day`` on the given days; a row without a day is on none of them.

    The span of the days prunes the table's partitions, the join keeps those that are listed.
    """
    listed = days.where("day IS NOT NULL").select("day").distinct()
    first, last = (days.select(end("day")).scalar() for end in (F.min, F.max))
    return only_in(df.where(F.col("day").between(first, last)), listed, ["day"])


def any_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where at least one of ``cols`` has a value."""
    return df.where(F.coalesce(*cols).isNotNull())


def finite(df: DataFrame, col: str = "aqi") -> DataFrame:
    return df.where(F.col(col).isNotNull())


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(cols) if cols else None)


def null_by_rating(df: DataFrame, measurement: str = "measurement", rating: str = "ratid") -> DataFrame:
    """Measurements with rating 2 or 4 count as missing."""
    return df.withColumn(measurement, F.when(F.col(rating).isin(2, 4), None).otherwise(F.col(measurement)))
