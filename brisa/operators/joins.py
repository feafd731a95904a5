"""Lookups and joins.

Only :func:`sized` and :func:`lookup` broadcast a side, and only one that :func:`fits` has checked;
elsewhere Spark decides from the sizes it knows or measures.  Beyond those bounds both sides are
shuffled and adaptive execution splits the partitions of hot keys.  It can do so only where both sides
are read straight from their shuffles; null-safe keys give an aggregated side a shuffle of its own and
so keep a join to it splittable.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows up to which a dimension table of unknown size is broadcast.
DIMENSION_ROWS = 100_000

# The column of a dimension table that holds a row's place in its sheet.
POSITION = "pos"

# Estimates from here on mean that Spark does not know a size (rows given by a program).
UNKNOWN_BYTES = 1 << 50


def known_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a frame's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(dim: DataFrame) -> bool:
    """Whether a table is small enough to broadcast, by Spark's estimate and broadcast threshold.

    Only where Spark does not know the size are rows counted, at most one more than the bound.  A
    table that is estimated to be larger is not broadcast here; once its size has been measured,
    adaptive execution may still do so.
    """
    threshold = dim.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if threshold.startswith("-"):
        return False
    size = known_bytes(dim)
    if size >= UNKNOWN_BYTES:
        return dim.limit(DIMENSION_ROWS + 1).count() <= DIMENSION_ROWS
    limit = dim.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(threshold)
    return size <= int(limit)


def sized(side: DataFrame) -> DataFrame:
    """``side``, marked for broadcast if a check says that it is small."""
    return F.broadcast(side) if fits(side) else side


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of all keys: two missing values match."""
    return reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])


def _keys(left: DataFrame, right: DataFrame, keys: Sequence[str] | None) -> list[str]:
    return list(keys) if keys else [c for c in left.columns if c in right.columns]


def _filtering_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    return left.alias("l").join(right.select(*keys).alias("r"), _same(left, right, keys), how)


def only_in(df: DataFrame, other: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``other``."""
    return _filtering_join(df, other, _keys(df, other, keys), "left_semi")


def new_rows(df: DataFrame, stored: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose keys do not occur in ``stored`` (default keys: all shared columns).

    ``stored`` is reduced to distinct keys before its shuffle, so repeated stored rows never pile up
    in one task.
    """
    names = _keys(df, stored, keys)
    return _filtering_join(df, stored.select(*names).distinct(), names, "left_anti")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str | tuple[str, str],
    cols: Sequence[str],
    order: str | Sequence[str] = POSITION,
) -> DataFrame:
    """Add ``cols`` of the first row of ``dim`` with the same key; unmatched rows get nulls.

    ``key`` is one name, or (name in ``df``, name in ``dim``).  ``order`` is what says which row of
    ``dim`` comes first, its place in the sheet unless told otherwise; a table without it is refused.
    The rows of ``df`` are never multiplied.
    """
    left_key, dim_key = (key, key) if isinstance(key, str) else key
    position = [order] if isinstance(order, str) else list(order)
    if not position or not set(position) <= set(dim.columns):
        raise ValueError(f"a lookup takes the first row by {position or 'an order'}, which the table must have")
    known = dim.where(F.col(dim_key).isNotNull())
    small = fits(dim)
    # A table that Spark knows to be small is reduced to first rows in one task, without a shuffle of its own.
    known = known.coalesce(1) if small and known_bytes(dim) < UNKNOWN_BYTES else known
    first = known.groupBy(F.col(dim_key).alias("_key")).agg(
        F.min_by(F.struct(*cols), F.struct(*position, *cols)).alias("_row")
    )
    side = F.broadcast(first) if small else first
    return df.join(side, F.col(left_key).eqNullSafe(F.col("_key")), "left").selectExpr(
        *[f"`{c}`" for c in df.columns], *[f"_row.`{c}` AS `{c}`" for c in cols]
    )


def join_latest(index: DataFrame, obs: DataFrame, keys: Sequence[str] = ("station", "date")) -> DataFrame:
    """Index and last observation side by side, whichever of them exists."""
    return index.join(obs, list(keys), "full")


def merge_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """All distinct rows of both frames; columns missing on one side are null."""
    return old.unionByName(new, allowMissingColumns=True).distinct()


def stack(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pair_by_time(
    left: DataFrame,
    right: DataFrame,
    suffixes: tuple[str, str],
    date: str = "date",
    value: str = "value",
) -> DataFrame:
    """Two sensors side by side, one row per time seen at either."""
    a, b = (
        frame.select(date, F.col(value).alias(value + suffix))
        for frame, suffix in zip((left, right), suffixes)
    )
    return a.join(b, date, "full")


def complete_pairs(
    df: DataFrame, pairs: DataFrame, keys: Sequence[str] = ("station", "pollutant")
) -> DataFrame:
    """Exactly the expected pairs: others are dropped, absent ones come back with nulls."""
    return df.join(pairs, list(keys), "right")
