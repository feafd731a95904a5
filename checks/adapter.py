"""Views of the test tables in the shape of sensor observations, and small dimension tables.

Each view is written twice: as a DataFrame here and as SQL text for the checking engine.  The numbers
of the dimension tables are invented for tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.functions import text
from brisa.sources.readers import clean_sentinels

# --- dimension tables (invented numbers) ----------------------------------------------------------

BREAKS = [
    ("NO2", 0, 40, 90, 120, 230, 340, 1000),
    ("O3", 0, 50, 100, 130, 240, 380, 800),
    ("PM10", 0, 20, 40, 50, 100, 150, 1200),
    ("PM2.5", 0, 10, 20, 25, 50, 75, 800),
    ("SO2", 0, 100, 200, 350, 500, 750, 1250),
    ("CO", 0, 2, 4, 6, 8, 10, 100),
]
BANDS = [(k, f"CAT{k}", f"EN{k}", f"FR{k}", f"#{str(k) * 6}") for k in range(7)]
# pos, Constituant, pollutant_id, notation, unite, web_pollutant, web_units, web_units_graph,
# pollutant_name, period CAT, EN, FR; the second entry of code 8 must never be taken,
# though it sorts before the first.
MAPPING = [
    (1, "view", 8, "NO2", "ug", "NO<sub>2</sub>", "&micro;g", "ug/m3", "Nitrogen dioxide", "1 h CAT", "1 h", "1 h FR"),
    (2, "click", 7, "O3", "ug", "O<sub>3</sub>", "&micro;g", "ug/m3", "Ozone", "1 h CAT", "1 h", "1 h FR"),
    (3, "purchase", 5, "PM10", "ug", "PM<sub>10</sub>", "&micro;g", "ug/m3", "Particles 10", "24 h CAT", "24 h", "24 h FR"),
    (4, "signup", 6001, "PM2.5", "ug", "PM<sub>2.5</sub>", "&micro;g", "ug/m3", "Particles 2.5", "24 h CAT", "24 h", "24 h FR"),
    (5, "error", 9054, "TEMP", "C", "T", "&deg;C", "C", "Temperature", "1 h CAT", "1 h", "1 h FR"),
    (6, "view", 8, "AAA", "!", "!second", "!second", "!second", "!second", "!second", "!second", "!second"),
    (7, "none", 1, "SO2", "ug", "SO<sub>2</sub>", "&micro;g", "ug/m3", "Sulphur dioxide", "1 h CAT", "1 h", "1 h FR"),
]
MAPPING_COLUMNS = [
    "pos", "Constituant", "pollutant_id", "notation", "unite", "web_pollutant", "web_units", "web_units_graph",
    "pollutant_name", "web_period_CAT", "web_period_EN", "web_period_FR",
]
STATIONS = [
    ("STA-AD0940A", "First &agrave;", "First", 42.50, 1.50, True),
    ("STA-AD0941A", "Second", "Second", 42.60, 1.60, False),
]
STATION_COLUMNS = ["station_id", "web_name", "web_name_noaccents", "web_lat", "web_long", "web_global"]
PAIRS = [
    ("AD0940A", "NO2"), ("AD0940A", "O3"), ("AD0940A", "PM10"), ("AD0940A", "SO2"),
    ("AD0941A", "NO2"), ("AD0941A", "PM2.5"),
]
POLLEN_THRESHOLDS = [
    ("click", 0, 10, 50, 100, 500), ("view", 0, 5, 25, 50, 200), ("error", 0, 10, 20, 40, 60),
    ("purchase", 0, 48, 49, 50, 400),
]
POLLEN_NAMES = [("click", "pollen", "Click CAT"), ("view", "spore", "View CAT"), ("signup", "pollen", "Signup CAT")]
EPISODES = [("NO2", 30.0), ("O3", 10.0)]


def _frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    fields = [field.split() for field in schema.split(", ")]
    body = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(f"`{name}`" for name, _ in fields)
    casts = ", ".join(f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")


def breaks(spark: SparkSession) -> DataFrame:
    rows = [(r[0], *map(float, r[1:])) for r in BREAKS]
    return _frame(spark, rows, "pol string, a double, b double, c double, d double, e double, f double, g double")


def bands(spark: SparkSession) -> DataFrame:
    schema = "index int, web_band_CAT string, web_band_EN string, web_band_FR string, web_color string"
    return _frame(spark, BANDS, schema)


def mapping(spark: SparkSession) -> DataFrame:
    kinds = {"pos": "int", "pollutant_id": "int"}
    return _frame(spark, MAPPING, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in MAPPING_COLUMNS))


def stations(spark: SparkSession) -> DataFrame:
    schema = "pos int, station_id string, web_name string, web_name_noaccents string, web_lat double, web_long double, web_global boolean"
    return _frame(spark, [(i, *row) for i, row in enumerate(STATIONS)], schema)


def pairs(spark: SparkSession) -> DataFrame:
    return _frame(spark, PAIRS, "station string, pollutant string")


def pollen_thresholds(spark: SparkSession) -> DataFrame:
    rows = [(r[0], *map(float, r[1:])) for r in POLLEN_THRESHOLDS]
    return _frame(spark, rows, "species string, a double, b double, c double, d double, e double")


def pollen_names(spark: SparkSession) -> DataFrame:
    return _frame(spark, [(i, *row) for i, row in enumerate(POLLEN_NAMES)], "pos int, species string, type string, web_name_CAT string")


def episode_thresholds(spark: SparkSession) -> DataFrame:
    rows = [(p, t, *[f"{p} {x}" for x in text.LOCALES]) for p, t in EPISODES]
    messages = ", ".join(f"message_html_{x} string" for x in text.LOCALES)
    return _frame(spark, rows, f"pollutant string, threshold double, {messages}")


# --- views of the test tables ---------------------------------------------------------------------


# Schemas of the tables read, so that no job is spent on finding them out.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


HOUR = "date_trunc('hour', CAST(ts AS timestamp))"
ETAT = "CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'R' ELSE 'I' END"
CODE = "CASE event_type WHEN 'view' THEN 8 WHEN 'click' THEN 7 WHEN 'purchase' THEN 5 WHEN 'signup' THEN 6001 ELSE 9054 END"
VALUE = "CASE event_id % 20 WHEN 0 THEN NULL WHEN 1 THEN -999D WHEN 2 THEN -value ELSE value END"
FLAG = "CASE WHEN event_id % 50 = 7 THEN NULL WHEN event_id % 10 = 0 THEN 1 ELSE 3 END"
POSITION = "date_format(from_utc_timestamp({}, '+01:00'), \"yyyy-MM-dd'T'HH:mm:ss'+01:00'\")"


def observations(events: DataFrame) -> DataFrame:
    """Events as stored observations; every event is one delivery of a series' hour."""
    return events.selectExpr(
        f"concat('SPO-AD0', '94', user_id % 2, 'A-', {CODE}) AS sampling_point_id",
        POSITION.format(HOUR) + " AS begin_position",
        POSITION.format(f"{HOUR} + INTERVAL 1 HOUR") + " AS end_position",
        f"{VALUE} AS value",
        f"{FLAG} AS verification_flag",
        f"CASE WHEN {ETAT} IN ('A', 'R') THEN 1 ELSE -1 END AS validation_flag",
        f"{HOUR} + make_dt_interval(0, CAST(1 + event_id % 4 AS int)) AS touched",
        f"{HOUR} AS from_time",
        f"{HOUR} + INTERVAL 1 HOUR AS to_time",
        f"{VALUE} AS import_value",
        "event_id AS seq",
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with missing values as nulls."""
    return clean_sentinels(observations(read(spark, sf_dir, "events")))


def drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as delivered text rows."""
    return read(spark, sf_dir, "events").selectExpr(
        "'ORG' AS Organisme",
        "concat('94', user_id % 2) AS Station",
        "event_type AS Mesure",
        "CASE WHEN event_id % 7 <> 3 THEN event_type ELSE 'unknown' END AS Constituant",
        "'ug/m3' AS Unite",
        f"date_format(from_utc_timestamp({HOUR}, '+01:00'), 'dd/MM/yyyy HH:mm') AS Date",
        "CASE WHEN event_id % 20 <> 0 THEN replace(format_string('%.2f', value), '.', ',') ELSE 'n/d' END AS Valeur",
        f"{ETAT} AS Etat",
        "event_id AS seq",
    )


def pollen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as pollen rows."""
    day = "date_format(CAST(ts AS timestamp), 'dd/MM/yyyy')"
    return read(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_id % 9 = 0 THEN concat(event_type, '   ') ELSE event_type END AS pid",
        f"{day} AS start_date",
        f"{day} AS end_date",
        "CAST(floor(value) AS double) AS measurement",
        "CAST(event_id % 6 AS int) AS ratid",
        "event_id AS seq",
    )


def runlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event type and hour of the observed time; a run without events found no file."""
    events = read(spark, sf_dir, "events").selectExpr("event_type", f"{HOUR} AS hour", "value")
    counts = events.groupBy("event_type", "hour").agg(F.expr("count(1) AS rows"), F.expr("max(value) AS top"))
    extent = counts.groupBy("event_type").agg(F.expr("min(hour) AS a"), F.expr("max(hour) AS b"))
    grid = extent.selectExpr("event_type", "explode(sequence(a, b, INTERVAL 1 HOUR)) AS hour")
    return grid.join(counts, ["event_type", "hour"], "left").selectExpr(
        "event_type AS feed",
        "hour AS time_begin",
        "rows IS NOT NULL AS file_found",
        "coalesce(rows, 0L) AS rows",
        "coalesce(top > 200, false) AS error_script",
    )


def bench_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as observations: one series per supplier, one hour per day, newest order wins."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "concat('S', l_suppkey) AS sampling_point_id",
        "CAST(l_shipdate AS timestamp) AS from_time",
        "CAST(l_shipdate AS timestamp) AS to_time",
        "l_quantity AS value",
        "l_linenumber AS verification_flag",
        "l_orderkey AS touched",
        "l_partkey * 8 + l_linenumber AS seq",
        "l_returnflag AS kind",
    )


# --- the same views as SQL ------------------------------------------------------------------------


def _literal(v) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _values(name: str, columns, rows, cast="") -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    return f"{name}({', '.join(columns)}) AS (SELECT * FROM (VALUES {body}))"


def _doubles(name: str, key: str, letters: str, rows) -> str:
    casts = ", ".join(f"CAST({x} AS DOUBLE) AS {x}" for x in letters)
    body = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    return f"{name} AS (SELECT {key}, {casts} FROM (VALUES {body}) t({key}, {', '.join(letters)}))"


SQL_DIMS = {
    "breaks": _doubles("breaks", "pol", "abcdefg", BREAKS),
    "bands": _values("bands", ["idx", "band_CAT", "band_EN", "band_FR", "color"], BANDS),
    "mapping": _values("mapping", MAPPING_COLUMNS, MAPPING),
    "stations": "stations AS (SELECT substr(station_id, 5) AS station_id, web_name, web_name_noaccents, "
    "CAST(web_lat AS DOUBLE) AS web_lat, CAST(web_long AS DOUBLE) AS web_long, web_global FROM (VALUES "
    + ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in STATIONS)
    + f") t({', '.join(STATION_COLUMNS)}))",
    "pairs": _values("pairs", ["station", "pollutant"], PAIRS),
    "thresholds": _doubles("thresholds", "species", "abcde", POLLEN_THRESHOLDS),
    "pollen_names": _values("pollen_names", ["species", "type", "web_name_CAT"], POLLEN_NAMES),
    "episode_thresholds": _doubles("episode_thresholds", "pollutant", ["threshold"], EPISODES),
}

SQL_VIEWS = {
    "obs": """
obs AS (
  SELECT 'SPO-AD094' || (user_id % 2) || 'A-' ||
           CASE event_type WHEN 'view' THEN 8 WHEN 'click' THEN 7 WHEN 'purchase' THEN 5
                           WHEN 'signup' THEN 6001 ELSE 9054 END AS sampling_point_id,
         strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S+01:00') AS begin_position,
         strftime(date_trunc('hour', ts) + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S+01:00') AS end_position,
         CASE event_id % 20 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN -value ELSE value END AS value,
         CASE WHEN event_id % 50 = 7 THEN NULL WHEN event_id % 10 = 0 THEN 1 ELSE 3 END AS verification_flag,
         CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE -1 END AS validation_flag,
         date_trunc('hour', ts) + (1 + event_id % 4) * INTERVAL 1 HOUR AS touched,
         date_trunc('hour', ts) AS from_time,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS to_time,
         CASE event_id % 20 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN -value ELSE value END AS import_value,
         event_id AS seq
  FROM events)""",
    "kept": """kept AS (SELECT * FROM obs WHERE to_time < touched)""",
    "w1": """
w1 AS (SELECT * EXCLUDE (r) FROM (
  SELECT *, rank() OVER (PARTITION BY sampling_point_id, from_time ORDER BY touched DESC) AS r FROM kept) WHERE r = 1)""",
    "w2": """
w2 AS (SELECT * EXCLUDE (r) FROM (
  SELECT *, rank() OVER (PARTITION BY sampling_point_id, to_time ORDER BY verification_flag ASC NULLS LAST) AS r
  FROM w1) WHERE r = 1)""",
    "clean": """
clean AS (SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY sampling_point_id, to_time
                               ORDER BY (value IS NULL), touched DESC, seq) AS r FROM w2) WHERE r = 1)""",
    "parts": """
parts AS (SELECT *, substr(sampling_point_id, 5, 7) AS station, CAST(substr(sampling_point_id, 13) AS INTEGER) AS code
          FROM clean)""",
    "conc0": """
conc0 AS (
  SELECT p.station, p.to_time AS date, m.notation AS pollutant, p.value
  FROM parts p LEFT JOIN (SELECT * FROM mapping WHERE pos <> 6) m ON p.code = m.pollutant_id
  WHERE p.code < 9000 AND (p.value > -10 OR p.value IS NULL))""",
    "conc": """
conc AS (
  SELECT station, date, pollutant,
         CASE WHEN pollutant IN ('PM10', 'PM2.5') THEN
                CASE WHEN n24 >= 18 THEN CAST(round_even(s24 / n24, 0) AS DOUBLE) END
              WHEN pollutant = 'CO' THEN CASE WHEN n8 >= 6 THEN CAST(round_even(s8 / n8, 0) AS DOUBLE) END
              ELSE value END AS value
  FROM (SELECT *,
          count(value) OVER w24 AS n24, CAST(sum(CAST(value AS DECIMAL(18,6))) OVER w24 AS DOUBLE) AS s24,
          count(value) OVER w8 AS n8, CAST(sum(CAST(value AS DECIMAL(18,6))) OVER w8 AS DOUBLE) AS s8
        FROM conc0
        WINDOW w24 AS (PARTITION BY station, pollutant ORDER BY date
                       RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW),
               w8 AS (PARTITION BY station, pollutant ORDER BY date
                      RANGE BETWEEN INTERVAL 7 HOUR PRECEDING AND CURRENT ROW)))""",
    "idx": """
idx AS (
  SELECT v.station, v.date, v.pollutant, v.value,
         CASE WHEN v.value < k.a OR v.value > k.g THEN NULL
              WHEN v.value <= k.b THEN 1 + (v.value - k.a) / (k.b - k.a)
              WHEN v.value <= k.c THEN 2 + (v.value - k.b) / (k.c - k.b)
              WHEN v.value <= k.d THEN 3 + (v.value - k.c) / (k.d - k.c)
              WHEN v.value <= k.e THEN 4 + (v.value - k.d) / (k.e - k.d)
              WHEN v.value <= k.f THEN 5 + (v.value - k.e) / (k.f - k.e)
              WHEN v.value <= k.g THEN 6 + (v.value - k.f) / (k.g - k.f) END AS index
  FROM conc v LEFT JOIN breaks k ON v.pollutant = k.pol)""",
    "now_idx": """now_idx AS (SELECT * FROM idx WHERE date = (SELECT max(date) FROM idx))""",
    "drop_rows": """
drop_rows AS (
  SELECT '94' || (user_id % 2) AS station,
         CASE WHEN event_id % 7 <> 3 THEN event_type ELSE 'unknown' END AS constituant,
         date_trunc('hour', ts) AS begin,
         CASE WHEN event_id % 20 <> 0 THEN CAST(printf('%.2f', value) AS DOUBLE) END AS value,
         CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'R' ELSE 'I' END AS etat, event_id AS seq
  FROM events)""",
    "pollen": """
pollen AS (
  SELECT event_type AS species, CAST(ts AS DATE) AS measurement_date,
         CASE WHEN event_id % 6 IN (2, 4) THEN NULL ELSE CAST(floor(value) AS DOUBLE) END AS measurement,
         event_id AS seq
  FROM events)""",
    "weekly": """
weekly AS (SELECT species, CAST(sum(CAST(measurement AS DECIMAL(18,6))) AS DOUBLE) / count(measurement) AS measurement
           FROM pollen GROUP BY species)""",
    "runlog": """
runlog AS (
  SELECT g.feed, g.hour AS time_begin, c.n IS NOT NULL AS file_found, CAST(coalesce(c.n, 0) AS BIGINT) AS rows,
         coalesce(c.top > 200, false) AS error_script
  FROM (SELECT feed, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour FROM (
          SELECT event_type AS feed, min(date_trunc('hour', ts)) AS a, max(date_trunc('hour', ts)) AS b
          FROM events GROUP BY event_type)) g
  LEFT JOIN (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n, max(value) AS top
             FROM events GROUP BY ALL) c ON g.feed = c.event_type AND g.hour = c.hour)""",
    "bench_obs": """
bench_obs AS (
  SELECT 'S' || l_suppkey AS sampling_point_id, l_shipdate AS from_time, l_shipdate AS to_time, l_quantity AS value,
         l_linenumber AS verification_flag, l_orderkey AS touched, l_partkey * 8 + l_linenumber AS seq,
         l_returnflag AS kind
  FROM lineitem)""",
}

CHAINS = {
    "obs": ["obs"],
    "kept": ["obs", "kept"],
    "w1": ["obs", "kept", "w1"],
    "w2": ["obs", "kept", "w1", "w2"],
    "clean": ["obs", "kept", "w1", "w2", "clean"],
}
CHAINS["parts"] = [*CHAINS["clean"], "parts"]
CHAINS["conc0"] = ["mapping", *CHAINS["parts"], "conc0"]
CHAINS["conc"] = [*CHAINS["conc0"], "conc"]
CHAINS["idx"] = ["breaks", *CHAINS["conc"], "idx"]
CHAINS["now_idx"] = [*CHAINS["idx"], "now_idx"]
CHAINS["weekly"] = ["pollen", "weekly"]


def sql(body: str, *views: str) -> str:
    """``body`` over the named views, each with what it is built from."""
    names: list[str] = []
    for view in views:
        names += [n for n in CHAINS.get(view, [view]) if n not in names]
    parts = [{**SQL_DIMS, **SQL_VIEWS}[n].strip() for n in names]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()
