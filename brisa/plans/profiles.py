"""Time-variation profiles: mean concentration by hour, weekday, month and hour of the week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.functions import timeutil
from brisa.operators.dedupe import prefer_value
from brisa.operators.filters import plausible, pollutants
from brisa.plans.observations import named

# Fixed value: two-sided 95 % of the normal distribution.
Z95 = 1.96

VIEWS = (("hour",), ("weekday",), ("month",), ("weekday", "hour"))


def profile_input(obs: DataFrame, mapping: DataFrame, seq: str | None = None) -> DataFrame:
    """Plausible named concentrations, one per series and hour."""
    return plausible(named(prefer_value(pollutants(obs), seq=seq), mapping), keep_null=False)


def time_variation(df: DataFrame, zone: str = timeutil.LOCAL_ZONE) -> DataFrame:
    """Mean, spread, count and 95 % interval per station, pollutant and time slot.

    Rows are first reduced to sums per (month, weekday, hour); the four views are taken from those
    few thousand sums per series instead of expanding every row four times.
    """
    keys = ("station", "pollutant")
    local = timeutil.local_time("date", zone)
    slots = ("month", "weekday", "hour")
    v = F.col("value").try_cast("decimal(16,6)")  # what does not fit counts as missing
    sums = (
        df.select(
            *keys,
            F.month(local).alias("month"),
            F.weekday(local).alias("weekday"),
            F.hour(local).alias("hour"),
            v.alias("v"),
        )
        .groupBy(*keys, *slots)
        .agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("ss"), F.count("v").alias("k"))
    )
    n = F.sum("k")
    s = F.sum("s").cast("double")
    ss = F.sum("ss").cast("double")
    views = [[*[F.col(k) for k in keys], *[F.col(c) for c in view]] for view in VIEWS]
    grouped = sums.groupingSets(views, *keys, *slots).agg(
        n.cast("bigint").alias("n"),
        s.alias("_s"),
        ss.alias("_ss"),
    )
    spread = F.sqrt(F.greatest(F.lit(0.0), (F.col("_ss") - F.col("_s") * F.col("_s") / F.col("n")) / (F.col("n") - 1)))
    return (
        grouped.withColumn("mean", F.try_divide(F.col("_s"), F.col("n")))
        .withColumn("sd", F.when(F.col("n") > 1, spread))
        .withColumn("half", F.lit(Z95) * F.col("sd") / F.sqrt("n"))
        .select(
            *keys,
            *slots,
            "n",
            "mean",
            "sd",
            (F.col("mean") - F.col("half")).alias("lower"),
            (F.col("mean") + F.col("half")).alias("upper"),
        )
    )
