"""From delivered rows to cleaned observations and pollutant indices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa import schemas
from brisa.functions import text, timeutil
from brisa.operators.dedupe import best_observations, clean_observations, prefer_value
from brisa.operators.filters import (
    drop_future,
    last_days,
    meteo,
    plausible,
    pollutants,
    since,
)
from brisa.operators.indices import aqi_decimal
from brisa.operators.joins import POSITION, lookup, merge_rows, new_rows, stack
from brisa.operators.reshape import split_series
from brisa.operators.windows import AVERAGING_HOURS, assign_ids, running_means
from brisa.sources.readers import load_series
from brisa.sources.writers import typed, with_sentinels

STORED_KEYS = (
    "sampling_point_id",
    "begin_position",
    "end_position",
    "value",
    "verification_flag",
    "validation_flag",
)


def to_observations(
    drop: DataFrame, mapping: DataFrame, touched: Column, verification_flag: int | Column = 3, order: str = POSITION
) -> DataFrame:
    """Typed delivery rows (see ``sources.readers.typed_drop``) as observation rows.

    ``mapping`` translates the delivered ``Constituant`` to a ``pollutant_id``; its first entry counts.
    ``touched`` is the time of the delivery.
    """
    flag = verification_flag if isinstance(verification_flag, Column) else F.lit(verification_flag)
    coded = lookup(
        drop.withColumns({"_touched": touched, "_flag": flag}), mapping, "Constituant", ["pollutant_id"], order
    )
    end = timeutil.add_hours("begin", 1)
    return coded.select(
        text.make_series_id(F.col("Station"), F.col("pollutant_id")).alias("sampling_point_id"),
        timeutil.format_position("begin").alias("begin_position"),
        timeutil.format_position(end).alias("end_position"),
        F.col("value"),
        F.col("_flag").cast("int").alias("verification_flag"),
        text.validity_of(F.col("Etat")).alias("validation_flag"),
        F.col("_touched").alias("touched"),
        F.col("begin").alias("from_time"),
        end.alias("to_time"),
        F.col("value").alias("import_value"),
    )


def ingest(
    drop: DataFrame, mapping: DataFrame, touched: Column, verification_flag: int | Column = 3, order: str = POSITION
) -> DataFrame:
    """Observation rows of a delivery without hours that had not ended yet."""
    return drop_future(to_observations(drop, mapping, touched, verification_flag, order))


def published_observations(obs: DataFrame, seq: str | None = None) -> DataFrame:
    """One row per series and hour: the newest delivery, best verified, with a value if there is one.

    The text positions are the instants written out, so they are left out of the shuffle and
    written again behind it.
    """
    clean = clean_observations(drop_future(obs).drop("begin_position", "end_position"), seq=seq)
    return clean.withColumns(
        {
            "begin_position": timeutil.format_position("from_time"),
            "end_position": timeutil.format_position("to_time"),
        }
    ).select(*obs.columns)


def with_stored(obs: DataFrame, stored: DataFrame, seq: str | None = None) -> DataFrame:
    """Published observations when older stored rows take part: one best verified row per series and hour.

    Deliveries are settled among themselves first; a stored row then competes by its verification.
    """
    delivered = clean_observations(drop_future(obs), seq=seq)
    return best_observations(merge_rows(stored.drop("id"), delivered), seq=seq)


def series_dimension(capabilities: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Known series with station, pollutant notation and unit, from vocabulary uris."""
    found = lookup(capabilities, vocabulary, ("pollutant", "uri"), ["notation"])
    return found.select(
        "sampling_point_id",
        text.series_station(F.col("sampling_point_id")).alias("station"),
        F.col("notation").alias("pollutant"),
        text.last_token(F.col("concentration")).alias("units"),
    )


def named(clean: DataFrame, mapping: DataFrame) -> DataFrame:
    """Long (station, date, pollutant, value) rows; ``date`` is the end of the hour.

    The code is translated before it is joined with anything else, and a code without a notation
    keeps its place with a null name.
    """
    parts = split_series(clean)
    return lookup(parts, mapping, ("code", "pollutant_id"), ["notation"]).select(
        "station", F.col("to_time").alias("date"), F.col("notation").alias("pollutant"), "value"
    )


def concentrations(clean: DataFrame, mapping: DataFrame) -> DataFrame:
    """Plausible pollutant concentrations with particles and CO as running means."""
    return running_means(plausible(named(pollutants(clean), mapping)))


def pollutant_indices(clean: DataFrame, mapping: DataFrame, breaks: DataFrame) -> DataFrame:
    """(station, date, pollutant, value, index) for every concentration."""
    return aqi_decimal(concentrations(clean, mapping), breaks)


def current_indices(
    clean: DataFrame, mapping: DataFrame, breaks: DataFrame
) -> DataFrame:
    """:func:`pollutant_indices` at the latest hour only.

    Running means reach back no further than the longest averaging time, so just those hours are read.
    """
    base = plausible(pollutants(clean))
    latest = base.select(F.max("from_time")).scalar()
    hours = max(AVERAGING_HOURS.values()) - 1
    index = pollutant_indices(since(base, timeutil.add_hours(latest, -hours)), mapping, breaks)
    return index.where(F.col("date") == timeutil.add_hours(latest, 1))


def temperatures(clean: DataFrame) -> DataFrame:
    """(station, code, date, value) of the meteorological series, and the partition day if there is one."""
    day = ["day"] if "day" in clean.columns else []
    return split_series(meteo(clean)).select("station", "code", F.col("to_time").alias("date"), "value", *day)


def recent_observations(obs: DataFrame, as_of: Column, days: int = 30, seq: str | None = None) -> DataFrame:
    """Observations of the last days, one row per series and hour that prefers a value."""
    return prefer_value(last_days(obs, as_of, days), seq=seq)


def graph_rows(published: DataFrame, as_of: Column, days: int = 30, sentinel: bool = False) -> DataFrame:
    """Pollutant observations of the last days with their local time, for graphs."""
    rows = pollutants(last_days(published, as_of, days))
    rows = with_sentinels(rows) if sentinel else rows
    return rows.withColumn("date_local", timeutil.local_time("to_time"))


def reconcile(
    stored: DataFrame, incoming: DataFrame, series: DataFrame, keys: Sequence[str] = STORED_KEYS
) -> DataFrame:
    """Stored observations plus the rows of known series not stored yet, as the next stored table.

    A duplicated hour keeps its best verified row; rows are numbered by series and time.
    """
    columns = [f.name for f in schemas.OBSERVATIONS.fields]
    known = load_series(incoming, series)
    merged = stack(stored.select(*columns), new_rows(known.select(*columns), stored, keys))
    ordered = assign_ids(best_observations(merged), ["sampling_point_id", "to_time"], prefix=None)
    flags = {"verification_flag": "int", "validation_flag": "int"}
    return typed(typed(with_sentinels(ordered)), flags)
