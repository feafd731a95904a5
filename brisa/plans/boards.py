"""Published boards: latest values, map, stations, series, utilities and daily calendars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.functions import text, timeutil
from brisa.functions.numbers import floor_int, plain_number
from brisa.operators import aggregates
from brisa.operators.aggregates import POLLUTANT_ORDER, rank_in
from brisa.operators.dedupe import at_latest
from brisa.operators.filters import finite, pollutants
from brisa.operators.indices import index_bands
from brisa.operators.joins import POSITION, complete_pairs, lookup, sized
from brisa.operators.reshape import (
    constant_rows,
    matching_columns,
    split_series,
    to_lang_rows,
    unpivot_values,
    without_lang,
)
from brisa.operators.windows import assign_ids

# Pollutants without an index, colour of missing data on the map, station order of the
# calendar, hours until data counts as old, and the corners of the map image.
WITHOUT_INDEX = ("NOX", "NO")
MISSING_COLOR = "#696969"
STATION_ORDER = ("AD0942A", "AD0944A", "AD0945A", "AD0940A", "AD0941A", "AD0943A")
OLD_DATA_HOURS = 3


@dataclass(frozen=True)
class MapBox:
    """Latitude and longitude of the map image's upper left (0) and lower right (100) corner."""

    lat0: float = 42.655784
    lat100: float = 42.428791
    lon0: float = 1.408520
    lon100: float = 1.787182


# --- latest values -------------------------------------------------------------------------------


def latest_rows(
    current: DataFrame, mapping: DataFrame, pairs: DataFrame | None, bands: DataFrame
) -> DataFrame:
    """Board rows with bands and periods, for every expected (station, pollutant).

    ``current`` holds the indices at the latest hour; indices at each station's own latest time
    (:func:`latest_per_station`) give the earlier form of the board, as does leaving out ``pairs``:
    then only pollutants with an index are shown.
    """
    indexed = current.where(~F.col("pollutant").isin(*WITHOUT_INDEX))
    described = lookup(index_bands(indexed, bands), mapping, ("pollutant", "notation"), ["web_units"])
    amount = F.when(F.col("pollutant") == "CO", F.col("value")).otherwise(F.floor(F.col("value")))
    shown = described.withColumn(
        "concentration",
        F.when(F.col("index").isNotNull(), F.concat_ws(" ", plain_number(amount), F.col("web_units"))),
    )
    if pairs is None:
        board = finite(shown, "index")
    else:
        board = complete_pairs(shown, pairs)
    return lookup(
        board,
        mapping,
        ("pollutant", "notation"),
        ["web_pollutant", "web_period_CAT", "web_period_EN", "web_period_FR"],
    )


def latest_board(
    current: DataFrame, mapping: DataFrame, pairs: DataFrame | None, bands: DataFrame
) -> DataFrame:
    """The numbered board with all its columns; missing entries read ``-``."""
    rows = latest_rows(current, mapping, pairs, bands)
    dash = F.lit("-")
    numbered = assign_ids(rows, [F.col("index").desc_nulls_last(), F.col("station"), F.col("pollutant")], "LD")
    return numbered.select(
        "id",
        timeutil.local_time("date").alias("date"),
        "station",
        F.col("web_pollutant").alias("pollutant"),
        F.coalesce("concentration", dash).alias("concentration"),
        F.coalesce(floor_int(F.col("index")).cast("string"), dash).alias("index"),
        F.col("index_color").alias("color"),
        *[F.coalesce(f"index_band_{x}", dash).alias(f"band_{x}") for x in text.LOCALES],
        *[F.col(f"web_period_{x}").alias(f"period_{x}") for x in text.LOCALES],
    )


def latest_common(board: DataFrame) -> DataFrame:
    return without_lang(board)


def latest_lang(board: DataFrame) -> DataFrame:
    return to_lang_rows(board, ["id"], {"band": "band_", "period": "period_"})


def episodes(latest: DataFrame, thresholds: DataFrame, langs: Sequence[str] = tuple(text.LOCALES)) -> DataFrame:
    """Stations whose latest value reaches the pollutant's threshold, with the message for it."""
    return latest.join(sized(thresholds), "pollutant").where("value >= threshold").select(
        "station", "pollutant", "date", "value", "threshold", *[f"message_html_{x}" for x in langs]
    )


# --- stations and series -------------------------------------------------------------------------


def station_rows(dim: DataFrame, *more: str) -> DataFrame:
    """Station sheet with the bare station code and only its published columns, and any others asked for."""
    return dim.select(
        F.substr(F.col("station_id"), F.lit(5)).alias("station_id"), *matching_columns(dim, contains="web_"), *more
    )


def stations_common(dim: DataFrame) -> DataFrame:
    return without_lang(station_rows(dim))


def stations_lang(dim: DataFrame) -> DataFrame:
    families = {"type": "web_type_", "location": "web_ubicacio_", "comments": "web_comentaris_"}
    return to_lang_rows(station_rows(dim), ["station_id"], families)


def series_catalogue(extents: DataFrame, mapping: DataFrame, stations: DataFrame) -> DataFrame:
    """Every pollutant series with a label and its first and last hour as ISO text.

    Extremes are taken of instants (``aggregates.series_extent``), which hash aggregation holds in
    place, and written as text here.
    """
    parts = split_series(pollutants(extents))
    labelled = lookup(parts, mapping, ("code", "pollutant_id"), ["notation"])
    labelled = lookup(labelled, station_rows(stations, POSITION), ("station", "station_id"), ["web_name_noaccents"])
    return labelled.select(
        F.col("sampling_point_id").alias("timeserieid"),
        F.concat_ws(", ", "web_name_noaccents", "notation").alias("label"),
        timeutil.format_position("first_time").alias("fromtime"),
        timeutil.format_position("last_time").alias("totime"),
    )


def mapping_distinct(
    mapping: DataFrame,
    cols: Sequence[str] = (
        "pollutant_id", "unite", "notation", "web_pollutant", "web_units", "web_units_graph", "pollutant_name",
    ),
) -> DataFrame:
    """The language-free part of the pollutant mapping, once per pollutant."""
    return mapping.select(*cols).distinct()


def graph_colors(colors: DataFrame) -> DataFrame:
    """The colour list of graphs: the only column of its sheet, named."""
    return colors.select(F.col(f"`{colors.columns[0]}`").alias("colors"))


def meteo_dims(mapping: DataFrame, known: DataFrame) -> DataFrame:
    """Meteorological entries of the mapping that the pollutant dimension does not have yet."""
    wanted = mapping.where(F.col("pollutant_id") >= text.METEO_FROM).select(
        F.col("pollutant_id").alias("id"), "notation", F.col("pollutant_name").alias("label")
    )
    return wanted.distinct().join(known.select("id").distinct(), "id", "left_anti")


# --- map -----------------------------------------------------------------------------------------


def map_xy(df: DataFrame, box: MapBox = MapBox(), lat: str = "web_lat", lon: str = "web_long") -> DataFrame:
    """Position in percent of the map image; (0, 0) is the upper left corner."""
    return df.withColumns(
        {
            "x_value": F.lit(100.0) * (F.col(lon) - box.lon0) / (box.lon100 - box.lon0),
            "y_value": F.lit(100.0) * (F.lit(box.lat0) - F.col(lat)) / (box.lat0 - box.lat100),
        }
    )


def map_board(current: DataFrame, stations: DataFrame, bands: DataFrame, box: MapBox = MapBox()) -> DataFrame:
    """Worst index per station at the latest hour, with its place on the map.

    ``current`` holds the indices at the latest hour, or at each station's own latest time.
    """
    worst = index_bands(aggregates.station_aqi(current), bands, "aqi")
    placed = lookup(
        worst, station_rows(stations, POSITION), ("station", "station_id"), ["web_global", "web_name", "web_lat", "web_long"]
    )
    missing = F.col("aqi").isNull()
    return map_xy(placed, box).select(
        F.col("station").alias("station_id"),
        timeutil.local_time("date").alias("date"),
        F.coalesce("aqi", F.lit(0.0)).alias("aqi"),
        F.when(missing, F.lit(MISSING_COLOR)).otherwise(F.col("aqi_color")).alias("aqi_color"),
        *[F.coalesce(f"aqi_band_{x}", F.lit("-")).alias(f"aqi_band_{x}") for x in text.LOCALES],
        "web_global",
        "web_name",
        "x_value",
        "y_value",
    )


def map_common(board: DataFrame) -> DataFrame:
    return without_lang(board)


def map_lang(board: DataFrame) -> DataFrame:
    return to_lang_rows(board, ["station_id"], {"aqi_band": "aqi_band_"})


# --- daily calendars -----------------------------------------------------------------------------


def daily_wide(index: DataFrame, names: Sequence[str] = POLLUTANT_ORDER) -> DataFrame:
    """Worst index per day and station (``aqi``) and of each pollutant in ``names``, side by side.

    One hash aggregate of doubles holds a day's pollutants and their worst together, so nothing is
    joined back.
    """
    return index.groupBy(timeutil.day_of("date").alias("day"), "station").agg(
        F.max("index").alias("aqi"),
        *[F.max(F.when(F.col("pollutant") == p, F.col("index"))).alias(p) for p in names],
    )


def daily_rows(daily: DataFrame, bands: DataFrame, names: Sequence[str] = POLLUTANT_ORDER) -> DataFrame:
    """:func:`daily_wide` as one row per pollutant, missing ones included, with bands."""
    long = unpivot_values(daily, names, ["day", "station", "aqi"], values_to="index")
    return index_bands(index_bands(long, bands, "index"), bands, "aqi")


def calendar_order(
    df: DataFrame, stations: Sequence[str] = STATION_ORDER, names: Sequence[str] = POLLUTANT_ORDER
) -> DataFrame:
    """Add the fixed display order: by pollutant, then by station; unknown ones last."""
    return df.withColumns(
        {"pollutant_rank": rank_in("pollutant", names), "station_rank": rank_in("station", stations)}
    )


def calendar(daily: DataFrame, bands: DataFrame) -> DataFrame:
    """The numbered calendar with all its columns, from :func:`daily_wide`."""
    return assign_ids(daily_rows(daily, bands), ["day", "station", "pollutant"], "pAQ")


def numbered_by_day(rows: DataFrame, offsets: DataFrame, order: Sequence[str], prefix: str) -> DataFrame:
    """Rows of some days with the ids that a numbering of all days by day and ``order`` gives them.

    ``offsets`` has (day, before): how many rows the days before hold. A day's rows are numbered by themselves, so
    no other day is read or sorted.
    """
    place = F.row_number().over(Window.partitionBy("day").orderBy(*order))
    # One row per calendar day.
    found = rows.withColumn("_place", place).join(sized(offsets), "day")
    return found.select(F.concat(F.lit(prefix), (F.col("before") + F.col("_place")).cast("string")).alias("id"), *[F.col(f"`{c}`") for c in rows.columns])


def day_offsets(counts: DataFrame) -> DataFrame:
    """(day, rows, before) from (day, rows): prefix sums over one row per calendar day."""
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("day", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))


def moved_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """Days of ``new`` (see :func:`day_offsets`) whose rows have other numbers than in ``old``, or none there."""
    return new.join(old.select("day", F.col("before").alias("_before")), "day", "left").where(~F.col("before").eqNullSafe(F.col("_before"))).select("day")


def calendar_common(board: DataFrame) -> DataFrame:
    return calendar_order(board.select("id", "station", "day", "pollutant", "aqi_color"))


def calendar_lang(board: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    return to_lang_rows(board, list(keys), {"pollutant_band": "index_band_", "aqi_band": "aqi_band_"})


def country_calendar(daily: DataFrame, stations: DataFrame | None, bands: DataFrame) -> DataFrame:
    """Numbered worst index per day over the global stations; ``daily`` has (day, station, aqi)."""
    dim = station_rows(stations) if stations is not None else None
    return assign_ids(index_bands(aggregates.daily_country(daily, dim), bands, "country_aqi"), ["day"], "GAQ")


def country_days(daily: DataFrame, stations: DataFrame, bands: DataFrame) -> DataFrame:
    """:func:`country_calendar` without the numbers."""
    return index_bands(aggregates.daily_country(daily, station_rows(stations)), bands, "country_aqi")


def country_common(board: DataFrame) -> DataFrame:
    return board.select("id", "day", floor_int(F.col("country_aqi")).alias("country_aqi"), "country_aqi_color")


def country_lang(board: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    return to_lang_rows(board, list(keys), {"band": "country_aqi_band_"})


def daily_bands(daily_table: DataFrame, bands: DataFrame, lang: str = "EN") -> DataFrame:
    """Single-language daily table: station and pollutant bands with the country's band of the day."""
    daily = daily_rows(daily_table, bands)
    country = index_bands(aggregates.daily_country(daily_table), bands, "country_aqi", [lang])
    return daily.join(country, "day", "left").select(
        "day",
        "station",
        "pollutant",
        F.col(f"index_band_{lang}").alias("band"),
        F.col(f"aqi_band_{lang}").alias("aqi_band"),
        F.col(f"country_aqi_band_{lang}").alias("country_band"),
    )


# --- inversion, staleness and utilities ----------------------------------------------------------


def inversion_readings(readings: DataFrame, low: str, high: str, code: int = 9054) -> DataFrame:
    """Readings of the two sites: cleaned (station, code, date, value) rows."""
    return readings.where((F.col("code") == code) & F.col("station").isin(low, high))


def temperature_inversion(readings: DataFrame, low: str, high: str, code: int = 9054) -> DataFrame:
    """Whether the lower site is colder than the higher one at the latest hour; one row.

    A missing value on either side, or none at all, counts as no inversion.
    """
    both = inversion_readings(readings, low, high, code)
    at = [F.max(F.when(F.col("station") == s, F.col("value"))) for s in (low, high)]
    latest = at_latest(both).agg(
        F.max("date").alias("date"), at[0].alias("value_low"), at[1].alias("value_high")
    )
    return latest.withColumn("inversion", F.coalesce(F.col("value_low") < F.col("value_high"), F.lit(False)))


def staleness(df: DataFrame, as_of: Column, margin: int = OLD_DATA_HOURS, date: str = "date") -> DataFrame:
    """Latest time, hours since then and whether that counts as old data; one row."""
    hours = timeutil.hours_between(as_of, F.col("last_update"))
    return aggregates.last_update(df, date).withColumns(
        {"count_h": hours, "old_data_bool": hours >= F.lit(margin)}
    )


# Texts per language.
BETWEEN_DATE_AND_TIME = {"CAT": "a les", "EN": "at", "FR": "&agrave;"}
OLD_DATA_MESSAGE = {
    "CAT": "Per problemes t&egrave;cnics no estem rebent dades en temps real",
    "EN": "Due to technical issues we are not receiving real time data",
    "FR": "En raison de probl&egrave;mes techniques, nous ne recevons pas de donn&eacute;es en temps r&eacute;el",
}


def utils_rows(
    freshness: DataFrame, inversion: DataFrame, messages: Mapping[str, Mapping[str, str]], more_info_url: str
) -> DataFrame:
    """One row per language with freshness and inversion texts.

    ``freshness`` and ``inversion`` are the one-row results of :func:`staleness` and
    :func:`temperature_inversion`; ``messages`` has ``true_html``, ``false_html`` and ``moreinfo`` per
    language.
    """
    per_lang = {
        code: {
            "text_between_datetime": BETWEEN_DATE_AND_TIME[code],
            "old_data_message": OLD_DATA_MESSAGE[code],
            "_true": messages[code]["true_html"],
            "_false": messages[code]["false_html"],
            "inversion_moreinfo_text": messages[code]["moreinfo"],
        }
        for code in text.LOCALES
    }
    flagged = freshness.withColumn("inversion_bool", inversion.select("inversion").scalar())
    return constant_rows(flagged, per_lang).select(
        "id",
        timeutil.local_time("last_update").alias("last_update"),
        "text_between_datetime",
        "old_data_message",
        "old_data_bool",
        F.when(F.col("inversion_bool"), F.col("_true")).otherwise(F.col("_false")).alias("inversion_message"),
        "inversion_bool",
        "inversion_moreinfo_text",
        F.lit(more_info_url).alias("inversion_moreinfo_url"),
        "lang",
        "count_h",
    )


# Wording and date formats of the dated message.
DATED_MESSAGE = {
    "CAT": ("Les dades es van actualitzar per &uacute;ltima vegada el ", "dd-MM-yyyy 'a les' HH:mm"),
    "EN": ("The data were last updated on ", "dd-MM-yyyy 'at' HH:mm"),
    "FR": (
        "Les donn&eacute;es ont &eacute;t&eacute; mises &agrave; jour pour la derni&egrave;re fois le ",
        "dd-MM-yyyy '&agrave;' HH:mm",
    ),
}


def utils_dated(freshness: DataFrame, margin: int = OLD_DATA_HOURS) -> DataFrame:
    """Earlier form of :func:`utils_rows`: the message names the last update, at the fixed offset."""
    at_offset = F.from_utc_timestamp("last_update", timeutil.OFFSET)
    rows = [
        F.struct(
            F.lit(f"U{n}").alias("id"),
            F.concat(F.lit(words), F.date_format(at_offset, pattern)).alias("old_data_message"),
            F.lit(code).alias("lang"),
        )
        for n, (code, (words, pattern)) in enumerate(DATED_MESSAGE.items(), 1)
    ]
    return freshness.select(
        at_offset.cast("timestamp_ntz").alias("last_update"),
        F.lit(margin).alias("margin"),
        F.inline(F.array(*rows)),
    )
