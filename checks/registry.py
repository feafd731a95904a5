"""Registry of checked queries: a Spark callable and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from brisa.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def zoneless(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def case(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that has the same result."""

    def register(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(query(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return query

    return register
