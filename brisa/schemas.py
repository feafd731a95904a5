"""Fixed schemas of the tables the engine reads and writes."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


# Delivered text file: every column is text on read and typed afterwards.
HOURLY_DROP = _schema(
    *[
        (name, StringType())
        for name in ("Organisme", "Station", "Mesure", "Constituant", "Unite", "Date", "Valeur", "Etat")
    ]
)

OBSERVATIONS = _schema(
    ("sampling_point_id", StringType()),
    ("begin_position", StringType()),
    ("end_position", StringType()),
    ("value", DoubleType()),
    ("verification_flag", IntegerType()),
    ("validation_flag", IntegerType()),
    ("touched", TimestampType()),
    ("from_time", TimestampType()),
    ("to_time", TimestampType()),
    ("import_value", DoubleType()),
)

STORED_OBSERVATIONS = StructType([StructField("id", LongType(), True), *OBSERVATIONS.fields])

POLLEN_WEEK = _schema(
    ("site", IntegerType()),
    ("network", StringType()),
    ("pid", StringType()),
    ("start_date", StringType()),
    ("end_date", StringType()),
    ("measurement", DoubleType()),
    ("below_LOD", IntegerType()),
    ("ratid", IntegerType()),
    ("uid", IntegerType()),
    ("mpid", IntegerType()),
)

POLLEN_HISTORY = _schema(
    ("measurement_date", DateType()),
    ("species", StringType()),
    ("measurement", DoubleType()),
    ("load_seq", LongType()),
)

INGEST_LOG = _schema(
    ("time_begin", TimestampType()),
    ("file_found", BooleanType()),
    ("time_file", TimestampType()),
    ("rows", LongType()),
    ("time_end", TimestampType()),
    ("error_script", BooleanType()),
)

AQI_BREAKS = _schema(("pol", StringType()), *[(name, DoubleType()) for name in "abcdefg"])

POLLEN_THRESHOLDS = _schema(("species", StringType()), *[(name, DoubleType()) for name in "abcde"])

BANDS = _schema(
    ("index", IntegerType()),
    ("web_band_CAT", StringType()),
    ("web_band_EN", StringType()),
    ("web_band_FR", StringType()),
    ("web_color", StringType()),
)

# Partition columns of stored tables.
DAY = StructField("day", DateType(), True)
RUN = StructField("run", StringType(), True)

STORED_DAY = StructType([*OBSERVATIONS.fields, DAY])
