"""Weekly pollen: cleaning, history and levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.functions import timeutil
from brisa.operators.dedupe import latest_wins
from brisa.operators.filters import null_by_rating
from brisa.operators.indices import pollen_level
from brisa.operators.joins import lookup, stack
from brisa.operators.reshape import pivot_values


def pollen_clean(raw: DataFrame) -> DataFrame:
    """(measurement_date, species, measurement): dates typed, names trimmed, unusable ratings missing."""
    return null_by_rating(raw).select(
        timeutil.parse_day("start_date").alias("measurement_date"),
        F.trim("pid").alias("species"),
        "measurement",
    )


def week_bounds(raw: DataFrame) -> DataFrame:
    """First start and last end of the delivered rows; one row."""
    return raw.agg(
        F.min(timeutil.parse_day("start_date")).alias("start_date"),
        F.max(timeutil.parse_day("end_date")).alias("end_date"),
    )


def pollen_weekly(clean: DataFrame) -> DataFrame:
    """Mean per species over the days with a measurement; null if there is none."""
    total = F.sum(F.col("measurement").try_cast("decimal(16,6)")).cast("double")
    count = F.count("measurement")
    return clean.groupBy("species").agg(F.try_divide(total, count.cast("double")).alias("measurement"))


def pollen_weekly_levels(raw: DataFrame, thresholds: DataFrame, names: DataFrame) -> DataFrame:
    """Level per species of the delivered week, with type, name and the week's bounds."""
    levels = pollen_level(pollen_weekly(pollen_clean(raw)), thresholds)
    described = lookup(levels, names, "species", ["type", "web_name_CAT"])
    week = week_bounds(raw)
    return described.select(
        "species",
        "index",
        "type",
        F.col("web_name_CAT").alias("name_CAT"),
        week.select("start_date").scalar().alias("start_date"),
        week.select("end_date").scalar().alias("end_date"),
    )


def merge_historic(historic: DataFrame, new: DataFrame) -> DataFrame:
    """Historic rows replaced, day by day, by those of the newest load.

    Both are long (measurement_date, species, measurement, load_seq); a day comes whole from one load.
    """
    return latest_wins(stack(historic, new), ["measurement_date"], "load_seq")


def pollen_load(raw: DataFrame, load_seq: int) -> DataFrame:
    """The delivered week as rows of the long history; ``load_seq`` grows with every delivery."""
    clean = pollen_clean(raw).groupBy("measurement_date", "species").agg(F.max("measurement").alias("measurement"))
    return clean.withColumn("load_seq", F.lit(load_seq).cast("bigint"))


def process_week(
    raw: DataFrame, historic: DataFrame, load_seq: int, thresholds: DataFrame, names: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(levels of the week, history with the week merged in)."""
    levels = pollen_weekly_levels(raw, thresholds, names)
    return levels, merge_historic(historic, pollen_load(raw, load_seq))


def history_wide(history: DataFrame, species: Sequence[str]) -> DataFrame:
    """The history with one column per species."""
    return pivot_values(history, species, ["measurement_date"], "species", "measurement")
