"""Reading deliveries, dimension tables, stored observations, history and run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brisa import schemas
from brisa.functions import timeutil
from brisa.functions.numbers import decimal_comma, sentinel_to_null
from brisa.operators.joins import POSITION, only_in, sized, stack


def typed_drop(raw: DataFrame) -> DataFrame:
    """Delivered text rows with typed date and value; the two lead lines of a file drop out."""
    return raw.withColumns(
        {"begin": timeutil.parse_delivery("Date"), "value": decimal_comma(F.col("Valeur"))}
    ).where("begin IS NOT NULL")


def read_hourly(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Hourly deliveries: ``;`` separated, two lead lines, decimal comma."""
    raw = spark.read.csv(path, sep=";", schema=schemas.HOURLY_DROP, mode="PERMISSIVE")
    return typed_drop(raw.withColumn("file", F.input_file_name()))


def read_hourly_meta(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """First line of each delivery: upload time, first and last hour, frequency, comment.

    Splits of a large file start after line one, so the line is the one at offset 0.
    """
    lines = spark.read.text(path).select("*", "_metadata.file_path", "_metadata.file_block_start")
    first = (
        lines.where("file_block_start = 0")
        .withColumn("_n", F.monotonically_increasing_id())
        .groupBy(F.col("file_path").alias("file"))
        .agg(F.min_by("value", "_n").alias("line"))
    )
    parts = F.split("line", ";")
    names = ("time_upload", "first_datetime", "last_datetime", "freq", "comment")
    return first.select("file", *[F.trim(F.get(parts, n)).alias(name) for n, name in enumerate(names)])


def read_pollen(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Weekly pollen counts, without header."""
    return spark.read.csv(path, schema=schemas.POLLEN_WEEK, header=False)


def with_positions(rows: DataFrame, columns: Sequence[str], out: str = POSITION) -> DataFrame:
    """Number the rows of files (a plain read of CSV) 1, 2, 3 … in the order of files and lines.

    A large file is read in blocks, several of them one after the other in a task. Rows of a block follow each other, so a
    row's number is the count of the blocks before its own and its place behind the block's first row.
    """
    block = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    placed = rows.select(*columns, *block, F.monotonically_increasing_id().alias("_row"))
    # One row per block.
    blocks = placed.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_row") - F.col("_first") + 1
    return placed.join(F.broadcast(blocks), ["_file", "_block"]).select(*columns, number.alias(out))


def read_dim(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A dimension table: parquet, or a CSV sheet with a header.

    A sheet without a ``pos`` of its own gets its rows' places in the file, which lookups go by. A parquet table has
    no order: it must have its ``pos``.
    """
    if not path.rstrip("/").endswith(".csv"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    sheet = reader.schema(schema).csv(path) if schema else reader.csv(path)
    if POSITION in sheet.columns:
        return sheet
    return with_positions(sheet, [f"`{c}`" for c in sheet.columns])


def load_dims(spark: SparkSession, folder: str, names: Sequence[str], kind: str = "parquet") -> dict[str, DataFrame]:
    """Several dimension tables of a folder by name."""
    return {name: read_dim(spark, f"{folder.rstrip('/')}/{name}.{kind}") for name in names}


def clean_sentinels(df: DataFrame, cols: Sequence[str] = ("value", "import_value")) -> DataFrame:
    return df.withColumns({c: sentinel_to_null(F.col(c)) for c in cols if c in df.columns})


def read_observations(
    spark: SparkSession, source: str | DataFrame, series: str | Sequence[str] | None = None
) -> DataFrame:
    """Stored observations, whole or for some series, with missing values as nulls.

    ``source`` is a parquet path, a table name or any DataFrame (for example a JDBC read); the filter
    on the series is pushed into it.
    """
    if isinstance(source, str):
        source = spark.read.parquet(source) if "/" in source else spark.read.table(source)
    if series is not None:
        wanted = [series] if isinstance(series, str) else list(series)
        source = source.where(F.col("sampling_point_id").isin(wanted))
    return clean_sentinels(source)


def load_series(df: DataFrame, ids: DataFrame, key: str = "sampling_point_id") -> DataFrame:
    """Rows of the listed series in one scan; series without rows simply add nothing."""
    return only_in(df, sized(ids), [key])


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_history(spark: SparkSession, path: str, schema: StructType = schemas.OBSERVATIONS) -> DataFrame:
    """The growing history, or an empty frame of its schema before the first delivery."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return stack(spark.createDataFrame([], schema), spark.read.option("basePath", path).parquet(path))


def read_days(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table stored by day, with the columns of ``like``; empty before its first row is stored."""
    if not _exists(spark, path):
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(path)


def read_ingest_log(spark: SparkSession, path: str) -> DataFrame:
    """The run log: quoted CSV with a header; missing entries are written NA."""
    return spark.read.csv(path, header=True, schema=schemas.INGEST_LOG, nullValue="NA")


def latest_file(df: DataFrame, file: str = "file") -> DataFrame:
    """Rows of the newest file of a drop (the greatest name)."""
    return df.where(F.col(file) == df.select(F.max(file)).scalar())
