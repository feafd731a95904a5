"""Wide and long forms, translations and composite identifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.functions import text


def split_series(df: DataFrame, series: str = "sampling_point_id") -> DataFrame:
    """Add ``station`` and the numeric ``code`` that a series identifier is made of."""
    return df.withColumns(
        {"station": text.series_station(F.col(series)), "code": text.series_code(F.col(series))}
    )


def pivot_values(
    df: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = ("station", "date"),
    names_from: str = "pollutant",
    values_from: str = "value",
) -> DataFrame:
    """One column per name in ``values``.

    Conditional maxima need one shuffle of partial results; ``groupBy().pivot()`` would group by the
    name first and take two.  A key and name occur once in cleaned data, so the maximum is the value.
    """
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(names_from) == v, F.col(values_from))).alias(v) for v in values]
    )


def unpivot_values(
    df: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = ("station", "date"),
    names_to: str = "pollutant",
    values_to: str = "value",
) -> DataFrame:
    """Back to one row per name; missing values stay as null rows."""
    return df.unpivot(list(keys), [F.col(f"`{v}`") for v in values], names_to, values_to)


def expected_pairs(matrix: DataFrame, station: str = "station") -> DataFrame:
    """(station, pollutant) pairs marked 1 in a station × pollutant matrix."""
    names = [c for c in matrix.columns if c != station]
    long = matrix.select(station, *[F.col(f"`{c}`").cast("int").alias(c) for c in names])
    return unpivot_values(long, names, [station]).where("value = 1").drop("value")


def to_lang_rows(
    df: DataFrame,
    keys: Sequence[str],
    families: Mapping[str, str],
    langs: Mapping[str, str] = text.LOCALES,
) -> DataFrame:
    """One row per key and language.

    ``families`` maps an output column to the prefix of its translated columns, so
    ``{"band": "band_"}`` reads ``band_CAT``, ``band_EN`` and ``band_FR``.  All families of a language
    are taken together from the same input row.
    """
    rows = [
        F.struct(
            F.lit(locale).alias("lang"),
            *[F.col(f"`{prefix}{code}`").alias(name) for name, prefix in families.items()],
        )
        for code, locale in langs.items()
    ]
    return df.select(*keys, F.inline(F.array(*rows)))


def without_lang(df: DataFrame, langs: Mapping[str, str] = text.LOCALES) -> DataFrame:
    """The language-free columns."""
    endings = tuple(f"_{code}" for code in langs)
    return df.select(*[f"`{c}`" for c in df.columns if not c.endswith(endings)])


def matching_columns(
    df: DataFrame,
    starts: str | tuple[str, ...] = (),
    ends: str | tuple[str, ...] = (),
    contains: str | None = None,
) -> list[str]:
    """Names of the columns that start with, end with or contain the given text."""
    return [
        c
        for c in df.columns
        if (starts and c.startswith(starts)) or (ends and c.endswith(ends)) or (contains and contains in c)
    ]


def null_counts(df: DataFrame) -> DataFrame:
    """One row: how many values each column has."""
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all."""
    filled = null_counts(df).first().asDict()
    return df.select(*[f"`{c}`" for c in df.columns if filled[c] > 0])


def constant_rows(df: DataFrame, per_lang: Mapping[str, Mapping[str, str]], prefix: str = "U") -> DataFrame:
    """Repeat each row once per language with that language's constants and a running id."""
    rows = [
        F.struct(
            F.lit(f"{prefix}{n}").alias("id"),
            F.lit(text.LOCALES.get(code, code)).alias("lang"),
            *[F.lit(v).alias(k) for k, v in constants.items()],
        )
        for n, (code, constants) in enumerate(per_lang.items(), 1)
    ]
    return df.select("*", F.inline(F.array(*rows)))
