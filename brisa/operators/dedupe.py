"""Choosing among several deliveries of the same observation.

A key may be delivered any number of times.  The operators that return one row per key are plain
aggregates, combined on the map side, so a key that holds a large share of the rows reaches its
reducer as one row per map task.  The operators that keep ties join the rows to an aggregate of
their own keys; the deciding value is part of the join key and nothing is sorted per key, which
lets adaptive execution split a hot key into several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.operators.filters import on_days
from brisa.operators.joins import only_in

SERIES_HOUR = ("sampling_point_id", "from_time")


def _best_row(df: DataFrame, keys: Sequence[str], criteria: Sequence[Column]) -> DataFrame:
    """The greatest row per key by the criteria, then by its own columns.

    Criteria and columns travel as one struct.  With the columns behind the criteria the order is
    total, so the choice never depends on the order in which rows happen to be read.
    """
    rest = [f"`{c}`" for c in df.columns if c not in keys]
    ranked = F.struct(*[c.alias(f"_{n}") for n, c in enumerate(criteria)], *rest)
    best = df.groupBy(*keys).agg(F.max(ranked).alias("_row"))
    return best.selectExpr(*[f"`{c}`" if c in keys else f"_row.`{c}` AS `{c}`" for c in df.columns])


def latest_wins(df: DataFrame, keys: Sequence[str] = SERIES_HOUR, by: str = "touched") -> DataFrame:
    """Rows of the newest delivery per key; rows that tie are all kept."""
    newest = df.groupBy(*keys).agg(F.max(by).alias(by))
    return only_in(df, newest, [*keys, by])


def best_verified(
    df: DataFrame, keys: Sequence[str] = ("sampling_point_id", "to_time"), flag: str = "verification_flag"
) -> DataFrame:
    """Rows with the lowest flag per key; a missing flag ranks last and ties are all kept."""
    best = df.groupBy(*keys).agg(F.min(flag).alias(flag))
    return only_in(df, best, [*keys, flag])


def prefer_value(
    df: DataFrame,
    keys: Sequence[str] = ("sampling_point_id", "to_time"),
    value: str = "value",
    newest: str = "touched",
    seq: str | None = None,
) -> DataFrame:
    """One row per key: a row with a value if there is one, then the newest, then the first delivered.

    ``seq`` is the order of delivery.  Without it the remaining columns decide, here and below.
    """
    return _best_row(df, keys, [has_value(value), F.col(newest), *_first_delivered(seq)])


def clean_observations(
    df: DataFrame,
    keys: Sequence[str] = SERIES_HOUR,
    newest: str = "touched",
    flag: str = "verification_flag",
    value: str = "value",
    seq: str | None = None,
) -> DataFrame:
    """:func:`latest_wins`, :func:`best_verified` and :func:`prefer_value` as one aggregate.

    Each step keeps the best rows among the survivors of the one before, which is the same as
    taking the maximum of the three criteria in that order.
    """
    criteria = [F.col(newest), verified(flag), has_value(value), *_first_delivered(seq)]
    return _best_row(df, keys, criteria)


def best_observations(
    df: DataFrame,
    keys: Sequence[str] = ("sampling_point_id", "to_time"),
    flag: str = "verification_flag",
    value: str = "value",
    newest: str = "touched",
    seq: str | None = None,
) -> DataFrame:
    """:func:`best_verified` and :func:`prefer_value` as one aggregate, whatever the delivery time.

    For rows of different origin, such as stored and delivered ones: a validated value outranks a
    newer raw one.
    """
    criteria = [verified(flag), has_value(value), F.col(newest), *_first_delivered(seq)]
    return _best_row(df, keys, criteria)


def verified(flag: str) -> Column:
    """Rank of a verification flag: the lower the flag the better, a missing one last."""
    return F.expr(f"-coalesce(`{flag}`, 2147483647)")


def has_value(value: str) -> Column:
    return F.expr(f"`{value}` IS NOT NULL")


def _first_delivered(seq: str | None) -> list[Column]:
    return [F.expr(f"-`{seq}`")] if seq else []


def keep_newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in load order."""
    return _best_row(df, keys, [F.col(c) for c in order])


def newest_times(df: DataFrame, station: str = "station", date: str = "date", stored: DataFrame | None = None) -> DataFrame:
    """(station, date): each station's newest time in ``df`` and, if given, in an earlier result that is kept.

    With ``stored`` only the new rows have to be read; the kept table is one row per station.
    """
    newest = df.groupBy(station).agg(F.max(date).alias(date))
    if stored is None:
        return newest
    return newest.unionByName(stored.select(station, date)).groupBy(station).agg(F.max(date).alias(date))


def latest_per_station(
    df: DataFrame, station: str = "station", date: str = "date", newest: DataFrame | None = None
) -> DataFrame:
    """Rows at each station's own latest time; ties are kept.

    With ``newest`` (see :func:`newest_times`) ``df`` is read once, and of a table stored by day only the days on which some
    station was last heard of: one that has been silent for years costs its one day. Without, ``df`` is read
    twice, to find those times and to find their rows.
    """
    if newest is None:
        newest = newest_times(df, station, date)
    elif "day" in df.columns:
        # Stored rows lie on the day of an hour's begin, which ``date`` may be the end of.
        begin = F.array(F.to_date(date), F.to_date(F.col(date) - F.make_dt_interval(hours=F.lit(1))))
        df = on_days(df, newest.select(F.explode(begin).alias("day")))
    return only_in(df, newest, [station, date])


def at_latest(df: DataFrame, date: str = "date", of: DataFrame | None = None) -> DataFrame:
    """Rows at the latest time of ``of`` (default: of ``df`` itself)."""
    return df.where(F.col(date) == (df if of is None else of).select(F.max(date)).scalar())
