"""Places of rows in a total order within groups, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa.session import write_out


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with each row's place ``i`` in its group, from 0, and the group's count ``n``; groups must not be null.

    Rows are range partitioned and sorted by group and order; what is counted afterwards is one row for each
    group and partition that holds any of it, and a large group lies in many partitions. ``rows`` are read twice.
    """
    place, keys = F.monotonically_increasing_id(), [*group, *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = write_out(ranged.withColumns({"part": F.shiftright(place, 33), "place": place.bitwiseAND(F.lit((1 << 33) - 1))}), "placed")
    sizes = placed.groupBy(*group, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("held"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, "part", "first", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"), F.sum("held").over(whole).alias("n"))
    return placed.join(sizes, [*group, "part"]).select("n", (F.col("before") + F.col("place") - F.col("first")).alias("i"), *rows.columns)
