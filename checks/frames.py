"""Intermediate frames shared by the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.operators import dedupe, filters
from brisa.operators.reshape import split_series
from brisa.plans import observations
from checks import adapter


def kept(spark: SparkSession, sf: str) -> DataFrame:
    return filters.drop_future(adapter.obs(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.clean_observations(kept(spark, sf), seq="seq")


NARROW = ("sampling_point_id", "from_time", "to_time", "value", "verification_flag", "touched", "seq")


def measured(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned observations with just the columns that indices are made from."""
    return dedupe.clean_observations(kept(spark, sf).select(*NARROW), seq="seq")


def named_all(spark: SparkSession, sf: str) -> DataFrame:
    return observations.named(filters.pollutants(measured(spark, sf)), adapter.mapping(spark))


def conc0(spark: SparkSession, sf: str) -> DataFrame:
    return filters.plausible(named_all(spark, sf))


def conc(spark: SparkSession, sf: str) -> DataFrame:
    return observations.concentrations(measured(spark, sf), adapter.mapping(spark))


def index(spark: SparkSession, sf: str) -> DataFrame:
    return observations.pollutant_indices(measured(spark, sf), adapter.mapping(spark), adapter.breaks(spark))


def current(spark: SparkSession, sf: str) -> DataFrame:
    return observations.current_indices(measured(spark, sf), adapter.mapping(spark), adapter.breaks(spark))


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return split_series(measured(spark, sf))


def as_of(df: DataFrame, col: str = "touched"):
    """The clock of a query: the newest delivery of its own input."""
    return df.select(F.max(col)).scalar()

