"""Queries: reading, filtering, de-duplication, set operations and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brisa.functions import text
from brisa.operators import dedupe, filters, joins, reshape, windows
from brisa.operators.aggregates import delivery_counts
from brisa.plans import observations, stored
from brisa.session import shared_folder
from brisa.sources import readers, sites, writers
from brisa.sources.writers import with_day
from checks import adapter, frames
from checks.adapter import sql
from checks.registry import SQL, case

NAMES = ["NO2", "O3", "PM10", "PM2.5", "SO2"]
ROW = "sampling_point_id, from_time, to_time, touched, value, verification_flag, validation_flag, seq"
COLS = ROW.split(", ")

# --- reading --------------------------------------------------------------------------------------


@case("scan_series", sql(f"SELECT {ROW} FROM obs WHERE sampling_point_id = 'SPO-AD0940A-8'", "obs"))
def scan_series(spark, sf):
    source = adapter.observations(adapter.read(spark, sf, "events"))
    return readers.read_observations(spark, source, "SPO-AD0940A-8").select(COLS)


@case(
    "scan_series_list",
    sql(f"SELECT {ROW} FROM obs WHERE substr(sampling_point_id, 13) IN ('8', '7', '5', '6001', '1')", "obs"),
)
def scan_series_list(spark, sf):
    codes = adapter.mapping(spark).where(F.col("pollutant_id") < text.METEO_FROM).select("pollutant_id").distinct()
    stations = adapter.stations(spark).select(F.substr("station_id", F.lit(8), F.lit(3)).alias("s"))
    ids = codes.select(
        F.explode(F.array(F.lit("940"), F.lit("941"))).alias("s"), "pollutant_id"
    ).join(stations, "s").select(text.make_series_id(F.col("s"), F.col("pollutant_id")).alias("sampling_point_id"))
    return readers.load_series(adapter.obs(spark, sf), ids).select(COLS)


@case(
    "latest_file",
    """SELECT file, event_id, event_type, value
       FROM (SELECT *, 'pollen_' || strftime(ts, '%Y%m%d') || '.csv' AS file FROM events)
       WHERE file = (SELECT max('pollen_' || strftime(ts, '%Y%m%d') || '.csv') FROM events)""",
)
def latest_file(spark, sf):
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd")
    events = adapter.read(spark, sf, "events")
    named = events.withColumn("file", F.concat(F.lit("pollen_"), day, F.lit(".csv")))
    return readers.latest_file(named).select("file", "event_id", "event_type", "value")


@case(
    "to_observations",
    sql(
        """
SELECT 'SPO-AD0' || d.station || 'A-' || coalesce(CAST(m.pollutant_id AS VARCHAR), 'NA') AS sampling_point_id,
       strftime(begin + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S+01:00') AS begin_position,
       strftime(begin + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S+01:00') AS end_position,
       d.value, 3 AS verification_flag, CASE WHEN etat IN ('A', 'R') THEN 1 ELSE -1 END AS validation_flag,
       begin + (1 + seq % 4) * INTERVAL 1 HOUR AS touched,
       begin AS from_time, begin + INTERVAL 1 HOUR AS to_time, d.value AS import_value
FROM drop_rows d LEFT JOIN (SELECT * FROM mapping WHERE pos <> 6) m ON d.constituant = m.Constituant""",
        "mapping",
        "drop_rows",
    ),
)
def to_observations(spark, sf):
    rows = readers.typed_drop(adapter.drop(spark, sf))
    touched = F.col("begin") + F.make_dt_interval(hours=(1 + F.col("seq") % 4).cast("int"))
    return observations.to_observations(rows, adapter.mapping(spark), touched, order="pos")


@case(
    "published_unknown",
    sql(
        """
SELECT 'SPO-AD0' || station || 'A-NA' AS sampling_point_id, begin AS from_time, count(*) AS deliveries,
       max(begin + (1 + seq % 4) * INTERVAL 1 HOUR) AS touched
FROM drop_rows WHERE constituant NOT IN (SELECT Constituant FROM mapping) AND seq % 4 > 0 GROUP BY station, begin""",
        "mapping",
        "drop_rows",
    ),
)
def published_unknown(spark, sf):
    """Rows of a constituent that the mapping does not have: one per station and hour, not one for all stations."""
    rows = readers.typed_drop(adapter.drop(spark, sf))
    touched = F.col("begin") + F.make_dt_interval(hours=(1 + F.col("seq") % 4).cast("int"))
    obs = observations.ingest(rows, adapter.mapping(spark), touched).where("sampling_point_id LIKE '%-NA'")
    counts = obs.groupBy("sampling_point_id", "from_time").agg(F.count(F.lit(1)).alias("deliveries"))
    published = observations.published_observations(obs).select("sampling_point_id", "from_time", "touched")
    return published.join(counts, ["sampling_point_id", "from_time"])


@case(
    "delivery_counts",
    "SELECT strftime(ts, '%Y-%m-%d') AS file, count(*) AS rows FROM events GROUP BY 1",
)
def counts(spark, sf):
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd")
    return delivery_counts(adapter.read(spark, sf, "events").withColumn("file", day), "file")


# --- filters --------------------------------------------------------------------------------------


@case("drop_future", sql(f"SELECT {ROW} FROM kept", "kept"))
def drop_future(spark, sf):
    return frames.kept(spark, sf).select(COLS)


@case(
    "split_spo",
    sql(
        """SELECT seq, substr(sampling_point_id, 5, 7) AS station, CAST(substr(sampling_point_id, 13) AS INTEGER) AS code
           FROM obs""",
        "obs",
    ),
)
def split_spo(spark, sf):
    return reshape.split_series(adapter.obs(spark, sf)).select("seq", "station", "code")


@case(
    "split_meteo",
    sql(
        """SELECT sampling_point_id, seq, value, CAST(substr(sampling_point_id, 13) AS INTEGER) >= 9000 AS meteo
           FROM obs""",
        "obs",
    ),
)
def split_meteo(spark, sf):
    rows = adapter.obs(spark, sf)
    part = lambda df, flag: df.select("sampling_point_id", "seq", "value", F.lit(flag).alias("meteo"))
    return joins.stack(part(filters.meteo(rows), True), part(filters.pollutants(rows), False))


@case("plausible", sql(f"SELECT {ROW} FROM kept WHERE value > -10 OR value IS NULL", "kept"))
def plausible(spark, sf):
    return filters.plausible(frames.kept(spark, sf)).select(COLS)


@case(
    "last_days",
    sql(
        f"SELECT {ROW} FROM obs WHERE to_time >= (SELECT max(touched) FROM obs) - INTERVAL 7 DAY",
        "obs",
    ),
)
def last_days(spark, sf):
    rows = adapter.obs(spark, sf)
    return filters.last_days(rows, frames.as_of(rows), 7).select(COLS)


WIDE_SQL = """
SELECT station, date, max(CASE WHEN pollutant = 'NO2' THEN value END) AS "NO2",
       max(CASE WHEN pollutant = 'O3' THEN value END) AS "O3",
       max(CASE WHEN pollutant = 'PM10' THEN value END) AS "PM10",
       max(CASE WHEN pollutant = 'PM2.5' THEN value END) AS "PM2.5",
       max(CASE WHEN pollutant = 'SO2' THEN value END) AS "SO2"
FROM conc0 GROUP BY station, date"""


def wide(spark, sf):
    return reshape.pivot_values(frames.conc0(spark, sf), NAMES)


@case(
    "any_present",
    sql(
        f"""SELECT * FROM ({WIDE_SQL}) WHERE coalesce("NO2", "O3", "PM10", "PM2.5", "SO2") IS NOT NULL""",
        "conc0",
    ),
)
def any_present(spark, sf):
    return filters.any_present(wide(spark, sf), [f"`{n}`" for n in NAMES])


@case(
    "drop_incomplete",
    sql(f"""SELECT station, date, "NO2", "O3" FROM ({WIDE_SQL}) WHERE "NO2" IS NOT NULL AND "O3" IS NOT NULL""", "conc0"),
)
def drop_incomplete(spark, sf):
    return filters.drop_incomplete(wide(spark, sf).select("station", "date", "NO2", "O3"))


@case(
    "at_latest",
    sql("SELECT station, date, pollutant, value FROM conc0 WHERE date = (SELECT max(date) FROM conc0)", "conc0"),
)
def at_latest(spark, sf):
    return dedupe.at_latest(frames.conc0(spark, sf))


@case("pollen_clean", sql("SELECT measurement_date, species, measurement, count(*) AS n FROM pollen GROUP BY ALL", "pollen"))
def pollen_clean(spark, sf):
    from brisa.plans.pollen import pollen_clean as cleaned

    rows = cleaned(adapter.pollen(spark, sf))
    return rows.groupBy("measurement_date", "species", "measurement").agg(F.count(F.lit(1)).alias("n"))


@case(
    "expected_pairs",
    sql(
        """SELECT DISTINCT station, pollutant FROM conc0
           WHERE value IS NOT NULL AND pollutant IN ('NO2', 'O3', 'PM10', 'PM2.5', 'SO2')""",
        "conc0",
    ),
)
def expected_pairs(spark, sf):
    flagged = frames.conc0(spark, sf).withColumn("measured", F.col("value").isNotNull().cast("int"))
    return reshape.expected_pairs(reshape.pivot_values(flagged, NAMES, ["station"], values_from="measured"))


# --- de-duplication -------------------------------------------------------------------------------


@case("latest_wins", sql(f"SELECT {ROW} FROM w1", "w1"))
def latest_wins(spark, sf):
    return dedupe.latest_wins(frames.kept(spark, sf)).select(COLS)


@case("best_verified", sql(f"SELECT {ROW} FROM w2", "w2"))
def best_verified(spark, sf):
    return dedupe.best_verified(dedupe.latest_wins(frames.kept(spark, sf))).select(COLS)


@case("prefer_value", sql(f"SELECT {ROW} FROM clean", "clean"))
def prefer_value(spark, sf):
    rows = dedupe.best_verified(dedupe.latest_wins(frames.kept(spark, sf)))
    return dedupe.prefer_value(rows, seq="seq").select(COLS)


@case("clean_observations", sql(f"SELECT {ROW} FROM clean", "clean"))
def clean_observations(spark, sf):
    return frames.clean(spark, sf).select(COLS)


@case(
    "bench_dedupe",
    sql(
        """SELECT sampling_point_id, from_time, value, verification_flag, touched, seq FROM (
             SELECT *, row_number() OVER (PARTITION BY sampling_point_id, from_time
                                          ORDER BY touched DESC, verification_flag, seq) AS r FROM bench_obs)
           WHERE r = 1""",
        "bench_obs",
    ),
)
def bench_dedupe(spark, sf):
    rows = dedupe.clean_observations(adapter.bench_obs(spark, sf), seq="seq")
    return rows.select("sampling_point_id", "from_time", "value", "verification_flag", "touched", "seq")


@case(
    "latest_per_station",
    sql(
        """SELECT station, date, pollutant, value FROM (
             SELECT *, rank() OVER (PARTITION BY station ORDER BY date DESC) AS r FROM conc0 WHERE value IS NOT NULL)
           WHERE r = 1""",
        "conc0",
    ),
)
def latest_per_station(spark, sf):
    return dedupe.latest_per_station(frames.conc0(spark, sf).where("value IS NOT NULL"))


@case(
    "keep_newest",
    sql(
        """SELECT measurement_date, species, measurement, seq FROM (
             SELECT *, row_number() OVER (PARTITION BY measurement_date ORDER BY seq DESC) AS r FROM pollen)
           WHERE r = 1""",
        "pollen",
    ),
)
def keep_newest(spark, sf):
    from brisa.functions.timeutil import parse_day

    rows = filters.null_by_rating(adapter.pollen(spark, sf)).select(
        parse_day("start_date").alias("measurement_date"), F.trim("pid").alias("species"), "measurement", "seq"
    )
    return dedupe.keep_newest(rows, ["measurement_date"], ["seq"])


@case(
    "recent_observations",
    sql(
        f"""SELECT {ROW} FROM (
              SELECT *, row_number() OVER (PARTITION BY sampling_point_id, to_time
                                           ORDER BY (value IS NULL), touched DESC, seq) AS r
              FROM obs WHERE to_time >= (SELECT max(touched) FROM obs) - INTERVAL 30 DAY)
            WHERE r = 1""",
        "obs",
    ),
)
def recent_observations(spark, sf):
    rows = adapter.obs(spark, sf)
    return observations.recent_observations(rows, frames.as_of(rows), seq="seq").select(COLS)


@case(
    "with_stored",
    sql(
        f"""
, stored AS (SELECT {ROW} FROM obs WHERE verification_flag = 1),
both_ AS (SELECT {ROW} FROM clean UNION SELECT * FROM stored)
SELECT {ROW} FROM (SELECT *, row_number() OVER (PARTITION BY sampling_point_id, to_time
   ORDER BY verification_flag NULLS LAST, (value IS NULL), touched DESC, seq) AS r FROM both_) WHERE r = 1""",
        "clean",
    ),
)
def with_stored(spark, sf):
    rows = adapter.obs(spark, sf)
    return observations.with_stored(rows, rows.where("verification_flag = 1"), seq="seq").select(COLS)


@case(
    "series_dimension",
    sql(
        """SELECT DISTINCT sampling_point_id, substr(sampling_point_id, 5, 7) AS station, m.notation AS pollutant,
                  CASE WHEN sampling_point_id LIKE '%-9054' THEN 'C' ELSE 'ug.m-3' END AS units
           FROM obs LEFT JOIN (SELECT * FROM mapping WHERE pos <> 6) m ON CAST(substr(sampling_point_id, 13) AS INTEGER) = m.pollutant_id""",
        "obs",
        "mapping",
    ),
)
def series_dimension(spark, sf):
    code = text.series_code(F.col("sampling_point_id"))
    unit = F.when(code == 9054, F.lit("C")).otherwise(F.lit("ug.m-3"))
    capabilities = adapter.obs(spark, sf).select("sampling_point_id").distinct().select(
        "sampling_point_id",
        F.concat(F.lit("http://host/pollutant/"), code.cast("string")).alias("pollutant"),
        F.concat(F.lit("http://host/unit/"), unit).alias("concentration"),
    )
    uri = F.concat(F.lit("http://host/pollutant/"), F.col("pollutant_id").cast("string"))
    vocabulary = adapter.mapping(spark).where("pos <> 6").withColumn("uri", uri)
    return observations.series_dimension(capabilities, vocabulary)


# --- set operations -------------------------------------------------------------------------------

SHORT = "sampling_point_id, from_time, value, verification_flag"


@case("distinct_rows", sql(f"SELECT DISTINCT {SHORT} FROM kept", "kept"))
def distinct_rows(spark, sf):
    return frames.kept(spark, sf).select(SHORT.split(", ")).distinct()


@case(
    "merge_rows",
    sql(
        f"""SELECT {SHORT}, validation_flag FROM kept
            UNION SELECT {SHORT}, NULL FROM kept WHERE verification_flag = 1""",
        "kept",
    ),
)
def merge_rows(spark, sf):
    rows = frames.kept(spark, sf)
    validated = rows.where("verification_flag = 1").select(SHORT.split(", "))
    return joins.merge_rows(validated, rows.select(*SHORT.split(", "), "validation_flag"))


@case(
    "union_by_name",
    sql(
        """SELECT sampling_point_id AS series, from_time, value, NULL::VARCHAR AS kind FROM kept
           UNION ALL SELECT sampling_point_id, from_time, value, kind FROM bench_obs""",
        "kept",
        "bench_obs",
    ),
)
def union_by_name(spark, sf):
    a = frames.kept(spark, sf).select(F.col("sampling_point_id").alias("series"), "from_time", "value")
    b = adapter.bench_obs(spark, sf).select("value", "kind", "from_time", F.col("sampling_point_id").alias("series"))
    return joins.stack(a, b)


SIX = "sampling_point_id, begin_position, end_position, value, verification_flag, validation_flag"


def _anti(keys: str) -> str:
    same = " AND ".join(f"s.{k} IS NOT DISTINCT FROM n.{k}" for k in keys.split(", "))
    return f"NOT EXISTS (SELECT 1 FROM (SELECT * FROM kept WHERE verification_flag = 1) s WHERE {same})"


@case("new_rows", sql(f"SELECT {ROW} FROM kept n WHERE {_anti('sampling_point_id, begin_position, value, validation_flag')}", "kept"))
def new_rows(spark, sf):
    rows = frames.kept(spark, sf)
    stored = rows.where("verification_flag = 1")
    keys = ["sampling_point_id", "begin_position", "value", "validation_flag"]
    return joins.new_rows(rows, stored, keys).select(COLS)


@case(
    "new_rows_natural",
    sql(f"SELECT {SIX}, seq FROM kept n WHERE {_anti(SIX)}", "kept"),
)
def new_rows_natural(spark, sf):
    rows = frames.kept(spark, sf).select(*SIX.split(", "), "seq")
    return joins.new_rows(rows, rows.where("verification_flag = 1").drop("seq"))


@case(
    "semi_join",
    sql(
        f"SELECT {ROW} FROM kept WHERE sampling_point_id IN (SELECT sampling_point_id FROM kept WHERE value > 250)",
        "kept",
    ),
)
def semi_join(spark, sf):
    rows = frames.kept(spark, sf)
    return joins.only_in(rows, rows.where("value > 250"), ["sampling_point_id"]).select(COLS)


@case(
    "typed_observations",
    sql(
        """SELECT sampling_point_id, from_time, seq,
                  CAST(coalesce(value, -999) AS DECIMAL(38,5)) AS value,
                  CAST(coalesce(import_value, -999) AS DECIMAL(38,5)) AS import_value FROM clean""",
        "clean",
    ),
)
def typed_observations(spark, sf):
    rows = writers.typed(writers.with_sentinels(frames.clean(spark, sf)))
    return rows.select("sampling_point_id", "from_time", "seq", "value", "import_value")


STORED = "sampling_point_id, begin_position, end_position, value, verification_flag, validation_flag, touched, from_time, to_time, import_value"


@case(
    "reconcile",
    sql(
        f"""
, stored AS (SELECT {STORED} FROM kept WHERE verification_flag = 1),
fresh AS (SELECT {STORED} FROM kept n WHERE CAST(substr(sampling_point_id, 13) AS INTEGER) < 9000 AND NOT EXISTS (
   SELECT 1 FROM stored s WHERE {" AND ".join(f"s.{k} IS NOT DISTINCT FROM n.{k}" for k in SIX.split(", "))})),
best AS (SELECT {STORED} FROM (
   SELECT *, row_number() OVER (PARTITION BY sampling_point_id, to_time ORDER BY verification_flag NULLS LAST, (value IS NULL),
        touched DESC, value DESC, validation_flag DESC) AS r
   FROM (SELECT * FROM stored UNION ALL SELECT * FROM fresh)) WHERE r = 1)
SELECT row_number() OVER (ORDER BY sampling_point_id, to_time) AS id,
       sampling_point_id, begin_position, end_position, CAST(coalesce(value, -999) AS DECIMAL(38,5)) AS value,
       verification_flag, validation_flag, touched, from_time, to_time,
       CAST(coalesce(import_value, -999) AS DECIMAL(38,5)) AS import_value
FROM best""",
        "kept",
    ),
)
def reconcile(spark, sf):
    rows = frames.kept(spark, sf)
    series = filters.pollutants(rows).select("sampling_point_id").distinct()
    return observations.reconcile(rows.where("verification_flag = 1"), rows, series)


@case("reconcile_days", SQL["reconcile"])
def reconcile_days(spark, sf):
    """The same from a table stored by day, into which three deliveries of some days each are merged."""
    rows = frames.kept(spark, sf)
    series = filters.pollutants(rows).select("sampling_point_id").distinct()
    folder = f"{shared_folder(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    with sites.changing(spark, folder) as site:
        held = with_day(rows.where("verification_flag = 1").select(stored.COLUMNS))
        stored.store(site, held, held.select("day"))
    for k in range(3):
        with sites.changing(spark, folder) as site:
            stored.reconcile_days(site, rows.where(F.pmod(F.dayofyear("from_time"), F.lit(3)) == k), series)
    return stored.stored_observations(sites.Change(spark, folder))


# --- lookups and joins ----------------------------------------------------------------------------


@case(
    "lookup_first",
    """SELECT c_custkey, c_nationkey, s_name, s_suppkey
       FROM customer LEFT JOIN (
         SELECT s_nationkey, s_name, s_suppkey FROM (
           SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS r FROM supplier) WHERE r = 1)
       ON c_nationkey = s_nationkey""",
)
def lookup_first(spark, sf):
    customer = adapter.read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    supplier = adapter.read(spark, sf, "supplier")
    return joins.lookup(customer, supplier, ("c_nationkey", "s_nationkey"), ["s_name", "s_suppkey"], "s_suppkey")


@case(
    "pair_by_time",
    sql(
        """SELECT coalesce(a.date, b.date) AS date, a.value AS value940, b.value AS value941
           FROM (SELECT to_time AS date, value FROM parts WHERE code = 9054 AND station = 'AD0940A') a
           FULL JOIN (SELECT to_time AS date, value FROM parts WHERE code = 9054 AND station = 'AD0941A') b
           ON a.date = b.date""",
        "parts",
    ),
)
def pair_by_time(spark, sf):
    rows = observations.temperatures(frames.measured(spark, sf)).where("code = 9054")
    at = lambda s: rows.where(F.col("station") == s)
    return joins.pair_by_time(at("AD0940A"), at("AD0941A"), ("940", "941"))


@case(
    "complete_pairs",
    sql(
        """SELECT p.station, p.pollutant, c.date, c.value
           FROM (SELECT * FROM conc0 WHERE date = (SELECT max(date) FROM conc0)) c
           RIGHT JOIN pairs p ON c.station = p.station AND c.pollutant = p.pollutant""",
        "conc0",
        "pairs",
    ),
)
def complete_pairs(spark, sf):
    rows = dedupe.at_latest(frames.conc0(spark, sf))
    return joins.complete_pairs(rows, adapter.pairs(spark)).select("station", "pollutant", "date", "value")


# --- reshaping ------------------------------------------------------------------------------------


@case("pivot_pollutants", sql(WIDE_SQL, "conc0"))
def pivot_pollutants(spark, sf):
    return wide(spark, sf)


@case(
    "unpivot_pollutants",
    sql(
        f"""SELECT station, date, pollutant, value FROM ({WIDE_SQL})
            UNPIVOT INCLUDE NULLS (value FOR pollutant IN ("NO2", "O3", "PM10", "PM2.5", "SO2"))""",
        "conc0",
    ),
)
def unpivot_pollutants(spark, sf):
    return reshape.unpivot_values(wide(spark, sf), NAMES)


@case(
    "bench_pivot",
    sql(
        """SELECT sampling_point_id, max(CASE WHEN kind = 'A' THEN value END) AS "A",
                  max(CASE WHEN kind = 'N' THEN value END) AS "N", max(CASE WHEN kind = 'R' THEN value END) AS "R",
                  from_time
           FROM bench_obs GROUP BY sampling_point_id, from_time""",
        "bench_obs",
    ),
)
def bench_pivot(spark, sf):
    return reshape.pivot_values(adapter.bench_obs(spark, sf), ["A", "N", "R"], ["sampling_point_id", "from_time"], "kind")


@case(
    "drop_null_columns",
    sql(f"""SELECT station, date, "NO2", "O3", "PM10", "PM2.5" FROM ({WIDE_SQL})""", "conc0"),
)
def drop_null_columns(spark, sf):
    return reshape.drop_null_columns(wide(spark, sf))


@case(
    "lang_rows",
    """SELECT c_custkey AS id, lang, c_mktsegment || ' ' || code AS band, c_nationkey || code AS period
       FROM customer, (VALUES ('CAT', 'ca-ES'), ('EN', 'en-GB'), ('FR', 'fr-FR')) t(code, lang)""",
)
def lang_rows(spark, sf):
    rows = adapter.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        *[F.concat("c_mktsegment", F.lit(f" {x}")).alias(f"band_{x}") for x in text.LOCALES],
        *[F.concat(F.col("c_nationkey").cast("string"), F.lit(x)).alias(f"period_{x}") for x in text.LOCALES],
    )
    return reshape.to_lang_rows(rows, ["id"], {"band": "band_", "period": "period_"})


# --- windows --------------------------------------------------------------------------------------


def _running(name: str, width: int, need: int) -> str:
    return sql(
        f"""SELECT station, date, pollutant, value,
                   CASE WHEN n >= {need} THEN CAST(round_even(s / n, 0) AS DOUBLE) END AS mean
            FROM (SELECT *, count(value) OVER w AS n,
                         CAST(sum(CAST(value AS DECIMAL(18,6))) OVER w AS DOUBLE) AS s
                  FROM conc0
                  WINDOW w AS (PARTITION BY station, pollutant ORDER BY date
                               RANGE BETWEEN INTERVAL {width - 1} HOUR PRECEDING AND CURRENT ROW))""",
        "conc0",
    )


@case("running_mean_24h", _running("running_mean_24h", 24, 18))
def running_mean_24h(spark, sf):
    return windows.running_mean(frames.conc0(spark, sf), 24, out="mean")


@case("running_mean_8h", _running("running_mean_8h", 8, 6))
def running_mean_8h(spark, sf):
    return windows.running_mean(frames.conc0(spark, sf), 8, out="mean", chunk_hours=48)


@case("running_means", sql("SELECT station, date, pollutant, value FROM conc", "conc"))
def running_means(spark, sf):
    return frames.conc(spark, sf)


@case(
    "bench_running_mean",
    sql(
        """SELECT sampling_point_id, from_time, value,
                  CASE WHEN n >= 18 THEN CAST(round_even(s / n, 0) AS DOUBLE) END AS mean
           FROM (SELECT *, count(value) OVER w AS n, CAST(sum(CAST(value AS DECIMAL(18,6))) OVER w AS DOUBLE) AS s
                 FROM (SELECT sampling_point_id, TIMESTAMP '2000-01-01' + date_diff('day', TIMESTAMP '2000-01-01', from_time) * INTERVAL 1 HOUR AS from_time,
                              max(value) AS value FROM bench_obs GROUP BY 1, 2)
                 WINDOW w AS (PARTITION BY sampling_point_id ORDER BY from_time
                              RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW))""",
        "bench_obs",
    ),
)
def bench_running_mean(spark, sf):
    days = F.datediff(F.col("from_time"), F.lit("2000-01-01").cast("date"))
    hour = F.lit("2000-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=days)
    rows = adapter.bench_obs(spark, sf).groupBy("sampling_point_id", hour.alias("from_time")).agg(F.max("value").alias("value"))
    return windows.running_mean(rows, 24, ["sampling_point_id"], "from_time", out="mean")


@case(
    "pad_hours",
    sql(
        """SELECT g.sampling_point_id, g.from_time, c.value
           FROM (SELECT sampling_point_id, unnest(generate_series(min(from_time), max(from_time), INTERVAL 1 HOUR)) AS from_time
                 FROM clean GROUP BY sampling_point_id) g
           LEFT JOIN clean c ON g.sampling_point_id = c.sampling_point_id AND g.from_time = c.from_time""",
        "clean",
    ),
)
def pad_hours(spark, sf):
    return windows.pad_hours(frames.measured(spark, sf).select("sampling_point_id", "from_time", "value"))


@case(
    "assign_ids",
    """SELECT 'LD' || row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber,
                l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS id,
              l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem""",
)
def assign_ids(spark, sf):
    rows = adapter.read(spark, sf, "lineitem")
    rest = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ]
    numbered = windows.assign_ids(rows, [F.col("l_extendedprice").desc(), *rest], "LD")
    return numbered.select("id", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")


@case(
    "continue_ids",
    """SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS id, c_custkey, c_name
       FROM customer""",
)
def continue_ids(spark, sf):
    start = adapter.read(spark, sf, "orders").select(F.max("o_orderkey")).scalar()
    rows = adapter.read(spark, sf, "customer").select("c_custkey", "c_name")
    return windows.assign_ids(rows, ["c_custkey"], None, start)


@case(
    "calendar_order",
    sql(
        """SELECT station, pollutant, count(*) AS n,
                  CAST(CASE pollutant WHEN 'SO2' THEN 1 WHEN 'CO' THEN 2 WHEN 'NO2' THEN 3 WHEN 'O3' THEN 4
                         WHEN 'PM10' THEN 5 WHEN 'PM2.5' THEN 6 ELSE 7 END AS INTEGER) AS pollutant_rank,
                  CAST(CASE station WHEN 'AD0942A' THEN 1 WHEN 'AD0944A' THEN 2 WHEN 'AD0945A' THEN 3
                         WHEN 'AD0940A' THEN 4 WHEN 'AD0941A' THEN 5 WHEN 'AD0943A' THEN 6 ELSE 7 END AS INTEGER) AS station_rank
           FROM conc0 GROUP BY station, pollutant""",
        "conc0",
    ),
)
def calendar_order(spark, sf):
    from brisa.plans.boards import calendar_order as ordered

    return ordered(frames.conc0(spark, sf).groupBy("station", "pollutant").agg(F.count(F.lit(1)).alias("n")))
