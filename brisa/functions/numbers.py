"""Sentinels, rounding and interval binning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers that stand for a missing measurement in stored tables.
SENTINELS = (-999.0, -9900.0)
MISSING = -999.0


def sentinel_to_null(c: Column, sentinels=SENTINELS) -> Column:
    return reduce(F.nullif, [F.lit(s) for s in sentinels], c)


def null_to_sentinel(c: Column, sentinel: float = MISSING) -> Column:
    return F.coalesce(c, F.lit(sentinel))


def decimal_comma(c: Column) -> Column:
    """Number of a text with a decimal comma; null if malformed."""
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def round_half_even(c: Column, places: int = 0) -> Column:
    return F.bround(c, places)


def floor_int(c: Column) -> Column:
    return F.floor(c).cast("bigint")


def plain_number(c: Column) -> Column:
    """Shortest text of a number: no fraction when it is whole."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def _case(branches: list[tuple[str, str]]) -> Column:
    return F.expr("CASE " + " ".join(f"WHEN {test} THEN {result}" for test, result in branches) + " END")


def bin_upper_closed(x: str, breaks: list[str]) -> Column:
    """Class of ``x`` among (b1, b2], (b2, b3] … with the lowest break included; null outside.

    ``x`` and ``breaks`` are SQL expressions, here and below.
    """
    below = [(f"{x} < {breaks[0]}", "CAST(NULL AS INT)")]
    return _case(below + [(f"{x} <= {high}", str(k)) for k, high in enumerate(breaks[1:], 1)])


def bin_lower_closed(x: str, breaks: list[str]) -> Column:
    """Class of ``x`` among [b1, b2), [b2, b3) … with the highest break included; null outside."""
    last = len(breaks) - 1
    below = [(f"{x} < {breaks[0]}", "CAST(NULL AS INT)")]
    inner = [(f"{x} < {breaks[k]}", str(k)) for k in range(1, last)]
    return _case(below + inner + [(f"{x} <= {breaks[last]}", str(last))])


def decimal_class(x: str, breaks: list[str]) -> Column:
    """Class of ``x`` plus the covered share of its interval; null outside the breaks."""
    below = [(f"{x} < {breaks[0]}", "CAST(NULL AS DOUBLE)")]
    steps = enumerate(zip(breaks, breaks[1:]), 1)
    return _case(
        below + [(f"{x} <= {high}", f"{k}D + try_divide({x} - {low}, {high} - {low})") for k, (low, high) in steps]
    )
