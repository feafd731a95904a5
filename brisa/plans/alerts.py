"""Ingest alerts as a table; sending them is left to the user."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions import timeutil
from brisa.operators.joins import sized
from brisa.operators.windows import with_latest, with_previous

# Kinds of alerts and what they say; ``{time}`` is filled in.
TEXTS = {
    "no_data": "No data has been received at {time}.",
    "restablished": "Data is being received again at {time}.",
    "fail": "Processing the data received at {time} failed.",
    "no_update": "Data was received at {time}, but the published tables did not change.",
    "alive": "The pipeline is running at {time}.",
    "alive_index": "The air quality at {time} is {band}, index {index} of 6.",
    "pollen": "The pollen file was processed at {time}.",
}

# Local hours of the sign of life (Monday to Friday), hours without data that count.
ALIVE_HOURS = (8, 16)
MARGIN_HOURS = 1


def ingest_alerts(
    log: DataFrame, keys: Sequence[str] = (), texts: Mapping[str, str] = TEXTS, zone: str = timeutil.LOCAL_ZONE
) -> DataFrame:
    """(time, kind, text) for every run of the log that calls for an alert.

    A run without a file gives ``no_data``; the next one with a file gives ``restablished``; a failed
    run gives ``fail``; runs at the fixed local hours of working days give ``alive``.
    """
    return kinds_of(with_previous(log, "file_found", "previous_found", keys=keys), keys, texts, zone)


def kinds_of(
    runs: DataFrame, keys: Sequence[str] = (), texts: Mapping[str, str] = TEXTS, zone: str = timeutil.LOCAL_ZONE
) -> DataFrame:
    """(time, kind, text) of runs that know what the run before found; a ``silent`` row is a run that never came."""
    local = timeutil.local_time("time_begin", zone)
    sign_of_life = F.hour(local).isin(*ALIVE_HOURS) & (F.weekday(local) < 5)
    if "silent" in runs.columns:
        sign_of_life &= ~F.col("silent")
    cases = {
        "no_data": ~F.col("file_found"),
        "restablished": F.col("file_found") & ~F.col("previous_found"),
        "fail": F.col("error_script"),
        "alive": sign_of_life,
    }
    kinds = F.filter(
        F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(kind)) for kind, test in cases.items()]),
        lambda kind: kind.isNotNull(),
    )
    found = runs.select(*keys, "time_begin", local.alias("_local"), F.explode(kinds).alias("kind"))
    return found.select(*keys, F.col("time_begin").alias("time"), "kind", alert_text(texts).alias("text"))


def with_air_quality(alerts: DataFrame, country: DataFrame, texts: Mapping[str, str] = TEXTS, zone: str = timeutil.LOCAL_ZONE) -> DataFrame:
    """Signs of life that say the country's index of their hour; without one they stay as they are.

    ``country`` has (date, aqi, band): the index of the hour that ends at ``date``.
    """
    hourly = country.where("aqi IS NOT NULL").groupBy(F.date_trunc("hour", "date").alias("_hour")).agg(F.max(F.struct("aqi", "band")).alias("_now"))
    found = alerts.withColumn("_at", F.date_trunc("hour", "time")).join(sized(hourly), F.col("_at") == F.col("_hour"), "left")
    said = F.replace(F.lit(texts["alive_index"]), F.lit("{time}"), F.date_format(timeutil.local_time("time", zone), "dd/MM/yyyy HH:mm"))
    said = F.replace(F.replace(said, F.lit("{band}"), F.coalesce("_now.band", F.lit(""))), F.lit("{index}"), F.floor("_now.aqi").cast("string"))
    text = F.when((F.col("kind") == "alive") & F.col("_now").isNotNull(), said).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in alerts.columns])


def unchanged_alerts(runs: DataFrame, published: DataFrame, keys: Sequence[str] = (), texts: Mapping[str, str] = TEXTS) -> DataFrame:
    """``no_update`` for runs that found data while the published tables kept their last update.

    ``published`` has (time_begin, last_update) of the publication after each run.
    """
    both = runs.where("file_found").select(*keys, "time_begin").join(published.select(*keys, "time_begin", "last_update"), [*keys, "time_begin"])
    known = with_previous(both, "last_update", "_before", keys=keys)
    same = known.where(F.col("last_update") <= F.col("_before")).withColumns({"kind": F.lit("no_update"), "_local": timeutil.local_time("time_begin")})
    return same.select(*keys, F.col("time_begin").alias("time"), "kind", alert_text(texts).alias("text"))


def alert_text(texts: Mapping[str, str] = TEXTS, kind: str = "kind", local: str = "_local") -> Column:
    """The text of an alert kind with its local time; kinds without a text give null."""
    template = None
    for name, words in texts.items():
        case = F if template is None else template
        template = case.when(F.col(kind) == name, F.lit(words))
    return F.replace(template, F.lit("{time}"), F.date_format(local, "dd/MM/yyyy HH:mm"))


def pollen_alerts(files: DataFrame, file: str = "file", date: str = "time_begin", texts: Mapping[str, str] = TEXTS) -> DataFrame:
    """One ``pollen`` alert per processed pollen file."""
    rows = files.withColumns({"kind": F.lit("pollen"), "_local": timeutil.local_time(date)})
    return rows.select(
        F.col(date).alias("time"), "kind", alert_text(texts).alias("text"), F.col(file).alias("file")
    )


def hours_without_data(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(time_begin, count_h): hours from the last run that found data up to each run."""
    seen = F.when(F.col("file_found"), F.col("time_begin"))
    runs = with_latest(log.withColumn("_seen", seen), "_seen", "_last", keys=keys)
    return runs.select(*keys, "time_begin", timeutil.hours_between("time_begin", "_last").alias("count_h"))


def count_alerts(counts: DataFrame, keys: Sequence[str] = (), margin: int = MARGIN_HOURS) -> DataFrame:
    """The count rule: (time_begin, count_h) rows of hours since the last data, one per run.

    A run whose count is past the margin by less than an hour gives ``no_data`` once; a run whose
    count dropped gives ``restablished``.
    """
    runs = with_previous(counts, "count_h", "previous_h", keys=keys)
    kind = F.when(
        (F.col("previous_h") > margin) & (F.col("previous_h") < margin + 1), F.lit("no_data")
    ).when((F.col("count_h") < F.col("previous_h")) & (F.col("count_h") >= 1), F.lit("restablished"))
    return runs.select(*keys, "time_begin", "count_h", kind.alias("kind")).where("kind IS NOT NULL")
