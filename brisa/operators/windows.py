"""Running means, hourly grids, previous values and row ids.

No window here is partitioned by a series, feed or station alone.  Series are cut into time chunks, and
what a chunk needs from the one before it is handed over, so one series with a large share of the
rows is spread over as many tasks as it has chunks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.session import write_out

# Averaging hours per pollutant, and the share of them that must be present.
AVERAGING_HOURS = {"PM10": 24, "PM2.5": 24, "CO": 8}
CAPTURE = 0.75

HOUR = 3600
CHUNK_HOURS = 31 * 24


def _chunk(seconds: Column, chunk_hours: int) -> Column:
    return F.floor(seconds / F.lit(chunk_hours * HOUR)).cast("bigint")


def running_mean(
    df: DataFrame,
    width: int,
    keys: Sequence[str] = ("station", "pollutant"),
    date: str = "date",
    value: str = "value",
    out: str = "value",
    capture: float = CAPTURE,
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Mean of the last ``width`` hours, rounded half to even, null below the data capture.

    Expects one row per key and hour; gaps need no padding because the frame spans time, not rows.
    The hours at the end of a chunk are copied into the next one, where they only serve as history.
    """
    return _running_mean(df, [width], keys, date, value, out, capture, chunk_hours)


def running_means(
    df: DataFrame,
    hours: Mapping[str, int] = AVERAGING_HOURS,
    keys: Sequence[str] = ("station",),
    date: str = "date",
    pollutant: str = "pollutant",
    value: str = "value",
    capture: float = CAPTURE,
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Replace the values of the pollutants in ``hours`` by their running means; others pass through.

    Everything takes the same single shuffle: each averaging width is one frame over the partitioning,
    and only averaged pollutants hand hours over to the next chunk.
    """
    cases = " ".join(f"WHEN '{name}' THEN {h}" for name, h in hours.items())
    means = _running_mean(
        df.withColumn("_width", F.expr(f"CASE `{pollutant}` {cases} ELSE 1 END")),
        sorted(set(hours.values())),
        [*keys, pollutant],
        date,
        value,
        value,
        capture,
        chunk_hours,
        "_width",
    )
    return means.drop("_width")


def _running_mean(df, widths, keys, date, value, out, capture, chunk_hours, width=None) -> DataFrame:
    """``width`` is each row's own averaging time; rows whose width is not in ``widths`` pass through."""
    if chunk_hours < max(widths):
        raise ValueError("a chunk must be at least as long as the averaging time")
    columns = df.columns if out in df.columns else [*df.columns, out]
    width = width or str(widths[0])
    chunk = f"CAST(floor(({{}}) / {chunk_hours * HOUR}D) AS BIGINT)"
    listed = ", ".join(str(w) for w in widths)
    rows = (
        df.withColumns(
            {
                "_s": F.expr(f"unix_seconds(`{date}`)"),
                # Whole millionths add up exactly, so a mean on a half rounds the same in every run.
                # What is no number below ten billion counts as missing.
                "_v": F.expr(
                    f"CASE WHEN {width} IN ({listed}) "
                    f"THEN CAST(TRY_CAST(`{value}` AS DECIMAL(16,6)) * 1000000 AS BIGINT) END"
                ),
            }
        )
        .withColumns(
            {
                "_own": F.expr(chunk.format("_s")),
                "_reach": F.expr(chunk.format(f"_s + ({width} - 1) * {HOUR}")),
            }
        )
        .withColumn("_chunk", F.expr("explode(CASE WHEN _reach > _own THEN array(_own, _own + 1) ELSE array(_own) END)"))
    )
    series = Window.partitionBy(*keys, "_chunk").orderBy("_s")
    frames = {w: series.rangeBetween(-(w - 1) * HOUR, 0) for w in widths}
    summed = rows.withColumns(
        {f"_n{w}": F.count("_v").over(frame) for w, frame in frames.items()}
        | {f"_t{w}": F.sum("_v").over(frame) for w, frame in frames.items()}
    )
    means = " ".join(
        f"WHEN {w} THEN CASE WHEN _n{w} >= {math.ceil(capture * w)} "
        f"THEN bround(CAST(_t{w} AS DOUBLE) / (_n{w} * 1000000)) END"
        for w in widths
    )
    return (
        summed.where("_chunk = _own")
        .withColumn(out, F.expr(f"CASE {width} {means} ELSE `{value}` END"))
        .select(*[f"`{c}`" for c in columns])
    )


def pad_hours(
    df: DataFrame, keys: Sequence[str] = ("sampling_point_id",), date: str = "from_time"
) -> DataFrame:
    """A row for every hour between the first and the last of each key; added rows are null."""
    extent = df.groupBy(*keys).agg(F.min(date).alias("_from"), F.max(date).alias("_to"))
    days = extent.withColumn(
        "_day", F.explode(F.sequence(F.date_trunc("day", "_from"), F.col("_to"), F.expr("INTERVAL 1 DAY")))
    )
    hours = days.withColumn(
        date, F.explode(F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.col("_day") + F.make_dt_interval(hours=h)))
    ).where(F.col(date).between(F.col("_from"), F.col("_to")))
    return hours.select(*keys, date).join(df, [*keys, date], "left").select(*df.columns)


def with_previous(
    df: DataFrame,
    value: str,
    out: str,
    order: str = "time_begin",
    keys: Sequence[str] = (),
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Add the value of the row before, in time order per key (times are unique per key).

    Rows look back inside their own chunk; the first row of a chunk takes the last value of the
    nearest earlier chunk, found among one summary row per chunk.
    """
    boxed = F.struct(value)  # a box tells "no row before" from "a row before without a value"
    found = _look_back(
        df,
        inside=lambda w: F.lag(boxed).over(w),
        summary=F.max_by(boxed, F.col(order)),
        between=lambda w: F.lag("_summary").over(w),
        order=order,
        keys=keys,
        chunk_hours=chunk_hours,
    )
    return found.withColumn(out, F.col("_found").getField(value)).drop("_found")


def with_latest(
    df: DataFrame,
    value: str,
    out: str,
    order: str = "time_begin",
    keys: Sequence[str] = (),
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Add the greatest value seen up to and including each row, in time order per key."""
    found = _look_back(
        df,
        inside=lambda w: F.max(value).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        summary=F.max(value),
        between=lambda w: F.max("_summary").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        order=order,
        keys=keys,
        chunk_hours=chunk_hours,
    )
    return found.withColumnRenamed("_found", out)


def _look_back(df, inside, summary, between, order, keys, chunk_hours) -> DataFrame:
    """``_found``: what a row finds inside its chunk, or else what earlier chunks hand over."""
    rows = df.withColumn("_chunk", _chunk(F.unix_seconds(F.col(order)), chunk_hours))
    # The summaries are one row per key and chunk, about a dozen a year however many rows a key has.
    chunks = Window.partitionBy(*keys).orderBy("_chunk") if keys else Window.orderBy("_chunk")
    carried = (
        rows.groupBy(*keys, "_chunk").agg(summary.alias("_summary")).withColumn("_carried", between(chunks))
    )
    local = rows.withColumn("_inside", inside(Window.partitionBy(*keys, "_chunk").orderBy(order)))
    shared = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, "_chunk"]]
    return local.alias("l").join(carried.alias("r"), shared, "left").select(
        *[F.col(f"l.{c}") for c in df.columns], F.coalesce("_inside", "_carried").alias("_found")
    )


def assign_ids(
    df: DataFrame, order: Sequence[Column | str], prefix: str | None = "", start: int | Column = 0, out: str = "id"
) -> DataFrame:
    """Number the rows 1, 2, 3 … over a total order, as ``prefix`` + number or as a plain number.

    The rows are written, range-partitioned from what was written (finding the ranges reads them a
    second time), sorted, and written with their place in their partition. What is then counted is
    one row per partition, so no task ever sees the whole table.
    ``start`` continues after an existing highest id; it may be a scalar subquery.
    """
    place = F.monotonically_increasing_id()
    ranged = write_out(df, "rows").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = write_out(
        ranged.withColumns(
            {"_part": F.shiftright(place, 33), "_place": place.bitwiseAND(F.lit((1 << 33) - 1))}
        ),
        "ids",
    )
    # At most one row per shuffle partition.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_place") + F.lit(1) + (start if isinstance(start, Column) else F.lit(start))
    value = number.cast("bigint") if prefix is None else F.concat(F.lit(prefix), number.cast("string"))
    return placed.join(F.broadcast(offsets), "_part").select(
        value.alias(out), *[F.col(f"`{c}`") for c in df.columns if c != out]
    )
