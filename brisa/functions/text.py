"""Series identifiers, languages and small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Language codes of the dimension sheets and the locales they are published under.
LOCALES = {"CAT": "ca-ES", "EN": "en-GB", "FR": "fr-FR"}

# Fixed value: codes from here on are meteorological.
METEO_FROM = 9000


# Fixed value: what stands for a missing part of a series identifier.
UNKNOWN = "NA"


def make_series_id(station: Column, code: Column) -> Column:
    """The identifier of a series; a missing station or code is marked, and the rest keeps its place."""
    known = [F.coalesce(part.cast("string"), F.lit(UNKNOWN)) for part in (station, code)]
    return F.concat(F.lit("SPO-AD0"), known[0], F.lit("A-"), known[1])


def series_station(c: Column) -> Column:
    return F.substring(c, 5, 7)


def series_code(c: Column) -> Column:
    return F.substr(c, F.lit(13)).try_cast("int")


def is_meteo(c: Column) -> Column:
    """True for meteorological series; codes are compared as numbers, never as text."""
    return series_code(c) >= METEO_FROM


def last_token(c: Column, separator: str = "/") -> Column:
    """Last part of a uri such as ``http://host/units/ug.m-3``."""
    return F.substring_index(c, separator, -1)


def locale_of(c: Column) -> Column:
    """Locale of a language code; other codes stay as they are."""
    case = None
    for code, locale in LOCALES.items():
        case = F.when(c == code, F.lit(locale)) if case is None else case.when(c == code, F.lit(locale))
    return case.otherwise(c)


def validity_of(state: Column) -> Column:
    """1 for the state letters A and R, otherwise -1."""
    return F.when(state.isin("A", "R"), F.lit(1)).otherwise(F.lit(-1))
