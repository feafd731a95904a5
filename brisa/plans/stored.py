"""The stored observations by day: deliveries are merged into the days they hold, numbers follow from counts.

:func:`brisa.plans.observations.reconcile` makes the whole next table. Here a delivery costs what its days hold: only those are
read, merged and written, and the counts of their series are stored beside them. A row's number, its place by series and time, is the
sum of the counts before its series and day, and its place in these, so numbers need no order of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa import schemas
from brisa.operators.dedupe import best_observations
from brisa.operators.filters import on_days
from brisa.operators.joins import new_rows, stack
from brisa.plans.observations import STORED_KEYS
from brisa.session import scratch, write_out
from brisa.sources.readers import load_series
from brisa.sources.sites import Folder
from brisa.sources.writers import typed, with_day, with_sentinels

ROWS, COUNTS = "observations", "observation_counts"
COLUMNS = [f.name for f in schemas.OBSERVATIONS.fields]


def _like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], schemas.STORED_DAY)


def store(site: Folder, rows: DataFrame, days: DataFrame) -> None:
    """Replace the days ``days``, of which ``rows`` (with ``day``) are all rows, and their counts."""
    site.save_days(ROWS, rows, "sampling_point_id", "to_time", rebuilt=days)
    counts = rows.groupBy("day", "sampling_point_id").agg(F.count(F.lit(1)).alias("rows"))
    site.save_days(COUNTS, counts, "sampling_point_id", rebuilt=days)


def reconcile_days(site: Folder, incoming: DataFrame, series: DataFrame, keys: Sequence[str] = STORED_KEYS) -> None:
    """Merge the rows of known series into the stored days that they fall on; other days are neither read nor written.

    Rows that are stored already are left out, and a duplicated hour of these days keeps its best verified row.
    """
    with scratch(site.spark):
        known = write_out(with_day(load_series(incoming, series).select(*COLUMNS)).where("day IS NOT NULL"), "incoming")
        days = write_out(known.select("day").distinct(), "days")
        held = on_days(site.days(ROWS, _like(incoming)), days)
        merged = stack(held, new_rows(known, held, keys))
        best = write_out(with_day(best_observations(merged.drop("day"))), "best")
        store(site, best, days)


def stored_observations(site: Folder, days: DataFrame | None = None) -> DataFrame:
    """Stored rows (of all days, or the given ones) as published: numbered by series and time, typed, missing values as sentinels.

    The sums run over one row per series, and within a series over one row per day.
    """
    like = site.spark.createDataFrame([], schemas.STORED_DAY)
    counts = site.days(COUNTS, like.select("day", "sampling_point_id").withColumn("rows", F.lit(0).cast("bigint")))
    before = lambda order: order.rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("sampling_point_id").agg(F.sum("rows").alias("rows"))
    first = F.coalesce(F.sum("rows").over(before(Window.orderBy("sampling_point_id"))), F.lit(0))
    totals = totals.select("sampling_point_id", first.alias("_series"))
    within = F.coalesce(F.sum("rows").over(before(Window.partitionBy("sampling_point_id").orderBy("day"))), F.lit(0))
    offsets = counts.select("day", "sampling_point_id", within.alias("_day"))
    rows = site.days(ROWS, like)
    rows = rows if days is None else on_days(rows, days)
    place = F.row_number().over(Window.partitionBy("sampling_point_id", "day").orderBy("to_time"))
    shared = [F.col("r.sampling_point_id").eqNullSafe(F.col("o.sampling_point_id")), F.col("r.day") == F.col("o.day")]
    placed = rows.withColumn("_place", place).alias("r").join(offsets.alias("o"), shared[0] & shared[1])
    placed = placed.join(totals.alias("t"), F.col("r.sampling_point_id").eqNullSafe(F.col("t.sampling_point_id")))
    number = F.col("_series") + F.col("_day") + F.col("_place")
    found = placed.select(number.cast("bigint").alias("id"), *[F.col(f"r.{c}").alias(c) for c in COLUMNS])
    return typed(typed(with_sentinels(found)), {"verification_flag": "int", "validation_flag": "int"})
