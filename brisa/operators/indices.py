"""Index classes, decimal indices, bands and pollen levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.functions.numbers import bin_lower_closed, bin_upper_closed, decimal_class
from brisa.operators.joins import sized

# Other names of two pollutants in the break table, and the last band.
BREAK_ALIASES = {"pm10run": "PM10", "pm2.5run": "PM2.5"}
LAST_BAND = 6


def _named(breaks: DataFrame) -> DataFrame:
    return breaks.replace(BREAK_ALIASES, subset=["pol"])


def _index_long(df, breaks, value, out, rule, letters, key="pollutant", dim_key="pol") -> DataFrame:
    columns = [f"`{c}`" for c in df.columns if c != out]
    dim = breaks.selectExpr(f"{dim_key} AS {key}", *[f"{x} AS _{x}" for x in letters])
    found = df.select(*columns).join(sized(dim), key, "left")
    return found.select(*columns, rule(f"`{value}`", [f"_{x}" for x in letters]).alias(out))


def aqi_decimal(df: DataFrame, breaks: DataFrame, value: str = "value", out: str = "index") -> DataFrame:
    """Class 1–6 plus the covered share of its interval.

    Pollutants without breaks and values outside them get null.
    """
    return _index_long(df, _named(breaks), value, out, decimal_class, "abcdefg")


def aqi_class(df: DataFrame, breaks: DataFrame, value: str = "value", out: str = "index") -> DataFrame:
    """Class 1–6; a value on a break belongs to the class below it."""
    return _index_long(df, _named(breaks), value, out, bin_upper_closed, "abcdefg")


def aqi_class_wide(
    df: DataFrame,
    breaks: DataFrame,
    pollutants: Sequence[str],
    suffix: str = "",
    keep_all: bool = False,
    keys: Sequence[str] = ("date",),
    decimal: bool = False,
) -> DataFrame:
    """Wide form: ``index_<p>`` from column ``<p><suffix>`` for every pollutant that has breaks.

    Each pollutant's breaks are a one-row scalar subquery, so the frame itself is only projected.
    """
    dim = _named(breaks)
    rule = decimal_class if decimal else bin_upper_closed
    out = {}
    for p in pollutants:
        limits = dim.where(F.col("pol") == p).agg(F.first(F.array(*"abcdefg")))
        out[f"index_{p}"] = (f"`{p}{suffix}`", limits)
    with_limits = df.withColumns({f"_{name}": limits.scalar() for name, (_, limits) in out.items()})
    columns = [f"`{c}`" for c in (df.columns if keep_all else keys)]
    return with_limits.select(
        *columns,
        *[
            rule(x, [f"`_{name}`[{i}]" for i in range(7)]).alias(name)
            for name, (x, _) in out.items()
        ],
    )


def pollen_level(
    df: DataFrame, thresholds: DataFrame, value: str = "measurement", out: str = "index"
) -> DataFrame:
    """Level 1–4; a value on a threshold belongs to the level above it."""
    return _index_long(df, thresholds, value, out, bin_lower_closed, "abcde", "species", "species")


def index_bands(
    df: DataFrame,
    bands: DataFrame,
    col: str = "index",
    langs: Sequence[str] = ("CAT", "EN", "FR"),
    colors: bool = True,
    last: int = LAST_BAND,
) -> DataFrame:
    """Add band texts ``<col>_band_<lang>`` and the colour ``<col>_color`` of a decimal index.

    Everything from ``last`` on is in the last band (earlier scales end at 5).  A missing index has
    no band and the colour of the table's row 0.
    """
    number = F.expr(
        f"CASE WHEN `{col}` IS NULL THEN 0 WHEN `{col}` >= {last} THEN {last} "
        f"WHEN `{col}` >= 1 THEN CAST(floor(`{col}`) AS INT) END"
    )
    texts = [f"CASE WHEN index > 0 THEN web_band_{lang} END AS `{col}_band_{lang}`" for lang in langs]
    color = [f"web_color AS `{col}_color`"] if colors else []
    dim = bands.selectExpr("CAST(index AS INT) AS _band", *texts, *color)
    return df.withColumn("_band", number).join(sized(dim), "_band", "left").drop("_band")
