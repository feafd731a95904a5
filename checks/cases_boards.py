"""Queries: indices, boards, calendars, pollen, profiles, alerts and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.functions import numbers, text, timeutil
from brisa.operators import aggregates, dedupe, filters, indices, joins, reshape
from brisa.plans import alerts, boards, feed, observations, pollen, profiles
from brisa.session import write_out
from brisa.sources import writers
from checks import adapter, frames
from checks.adapter import sql
from checks.cases_rows import WIDE_SQL, wide
from checks.registry import case

INDEX = "station, date, pollutant, value, index"

# --- indices --------------------------------------------------------------------------------------


@case("aqi_decimal", sql(f"SELECT {INDEX} FROM idx", "idx"))
def aqi_decimal(spark, sf):
    return frames.index(spark, sf)


CLASS_SQL = """CASE WHEN {v} < k.a THEN NULL WHEN {v} <= k.b THEN 1 WHEN {v} <= k.c THEN 2 WHEN {v} <= k.d THEN 3
     WHEN {v} <= k.e THEN 4 WHEN {v} <= k.f THEN 5 WHEN {v} <= k.g THEN 6 END"""


@case(
    "aqi_class",
    sql(
        f"SELECT station, date, pollutant, value, {CLASS_SQL.format(v='value')} AS index FROM conc v LEFT JOIN breaks k ON v.pollutant = k.pol",
        "conc",
        "breaks",
    ),
)
def aqi_class(spark, sf):
    return indices.aqi_class(frames.conc(spark, sf), adapter.breaks(spark))


@case(
    "aqi_class_wide",
    sql(
        "SELECT station, date, "
        + ", ".join(
            f"(SELECT {CLASS_SQL.format(v=chr(34) + p + chr(34))} FROM breaks k WHERE pol = '{p}') AS \"index_{p}\""
            for p in ("NO2", "O3", "PM10", "SO2")
        )
        + f" FROM ({WIDE_SQL})",
        "conc0",
        "breaks",
    ),
)
def aqi_class_wide(spark, sf):
    return indices.aqi_class_wide(
        wide(spark, sf), adapter.breaks(spark), ["NO2", "O3", "PM10", "SO2"], keys=["station", "date"]
    )


BAND_JOIN = "LEFT JOIN bands {b} ON {b}.idx = CASE WHEN {c} IS NULL THEN 0 WHEN {c} >= 6 THEN 6 WHEN {c} >= 1 THEN floor({c}) END"


def _band(b: str, out: str, empty: str = "NULL") -> str:
    return ", ".join(
        f'CASE WHEN {b}.idx > 0 THEN {b}.band_{x} ELSE {empty} END AS "{out}{x}"' for x in text.LOCALES
    )


@case(
    "index_bands",
    sql(
        f"""SELECT i.station, i.date, i.pollutant, i.index, {_band('b', 'index_band_')}, b.color AS index_color
            FROM idx i {BAND_JOIN.format(b='b', c='i.index')}""",
        "idx",
        "bands",
    ),
)
def index_bands(spark, sf):
    return indices.index_bands(frames.index(spark, sf).drop("value"), adapter.bands(spark))


@case("station_aqi", sql("SELECT station, date, max(index) AS aqi FROM idx GROUP BY station, date", "idx"))
def station_aqi(spark, sf):
    return aggregates.station_aqi(frames.index(spark, sf))


@case(
    "aqi_finite",
    sql("SELECT * FROM (SELECT station, date, max(index) AS aqi FROM idx GROUP BY station, date) WHERE aqi IS NOT NULL", "idx"),
)
def aqi_finite(spark, sf):
    return filters.finite(aggregates.station_aqi(frames.index(spark, sf)))


@case(
    "culprit",
    sql(
        """SELECT station, date, index AS aqi, CASE WHEN index IS NOT NULL THEN pollutant END AS culprit FROM (
             SELECT *, row_number() OVER (PARTITION BY station, date ORDER BY index DESC NULLS LAST,
               list_position(['SO2', 'CO', 'NO2', 'O3', 'PM10', 'PM2.5'], pollutant)) AS r FROM idx)
           WHERE r = 1""",
        "idx",
    ),
)
def culprit(spark, sf):
    return aggregates.culprit(frames.index(spark, sf))


@case(
    "daily_worst",
    sql("SELECT CAST(date AS DATE) AS day, station, pollutant, max(index) AS index FROM idx GROUP BY ALL", "idx"),
)
def daily_worst(spark, sf):
    return aggregates.daily_worst(frames.index(spark, sf))


@case(
    "bench_daily_worst",
    """SELECT CAST(l_shipdate AS DATE) AS day, 'S' || l_suppkey AS station, l_returnflag AS pollutant,
              max(l_quantity) AS index FROM lineitem GROUP BY ALL""",
)
def bench_daily_worst(spark, sf):
    rows = adapter.bench_obs(spark, sf).select(
        F.col("sampling_point_id").alias("station"), F.col("from_time").alias("date"),
        F.col("kind").alias("pollutant"), F.col("value").alias("index"),
    )
    return aggregates.daily_worst(rows)


DAILY_STATION = "SELECT CAST(date AS DATE) AS day, station, max(index) AS aqi FROM idx GROUP BY ALL"


@case("daily_station_aqi", sql(DAILY_STATION, "idx"))
def daily_station_aqi(spark, sf):
    return aggregates.daily_station_aqi(frames.index(spark, sf))


@case(
    "daily_country",
    sql(
        f"""SELECT day, max(aqi) AS country_aqi FROM ({DAILY_STATION})
            WHERE station IN (SELECT station_id FROM stations WHERE web_global) GROUP BY day""",
        "idx",
        "stations",
    ),
)
def daily_country(spark, sf):
    daily = aggregates.daily_station_aqi(frames.index(spark, sf))
    return aggregates.daily_country(daily, boards.station_rows(adapter.stations(spark)))


@case(
    "latest_full_join",
    sql(
        f"""
, aqi AS (SELECT station, date, max(index) AS aqi FROM idx GROUP BY station, date),
a AS (SELECT station, date, aqi FROM (SELECT *, rank() OVER (PARTITION BY station ORDER BY date DESC) AS r FROM aqi) WHERE r = 1),
o AS (SELECT * EXCLUDE (r) FROM (SELECT *, rank() OVER (PARTITION BY station ORDER BY date DESC) AS r FROM (
   {WIDE_SQL.replace('conc0', 'conc')}) WHERE coalesce("NO2", "O3", "PM10", "PM2.5", "SO2") IS NOT NULL) WHERE r = 1)
SELECT coalesce(a.station, o.station) AS station, coalesce(a.date, o.date) AS date, aqi, "NO2", "O3", "PM10", "PM2.5", "SO2"
FROM a FULL JOIN o ON a.station = o.station AND a.date = o.date""",
        "idx",
    ),
)
def latest_full_join(spark, sf):
    names = ["NO2", "O3", "PM10", "PM2.5", "SO2"]
    index = write_out(frames.index(spark, sf), "index")
    rows = filters.any_present(reshape.pivot_values(index, names), [f"`{n}`" for n in names])
    # One row per station and time on both sides, so the newest row needs no join to find it.
    latest = [dedupe.keep_newest(df, ["station"], ["date"]) for df in (aggregates.station_aqi(index), rows)]
    return joins.join_latest(*latest)


# --- latest board ---------------------------------------------------------------------------------

BOARD_SQL = f"""
, board AS (
  SELECT 'LD' || row_number() OVER (ORDER BY i.index DESC NULLS LAST, p.station, p.pollutant) AS id,
         timezone('Europe/Andorra', timezone('UTC', i.date)) AS date, p.station, m.web_pollutant AS pollutant,
         coalesce(CASE WHEN i.index IS NOT NULL THEN CAST(floor(i.value) AS BIGINT) || ' ' || m.web_units END, '-') AS concentration,
         coalesce(CAST(CAST(floor(i.index) AS BIGINT) AS VARCHAR), '-') AS index,
         CASE WHEN i.station IS NOT NULL THEN b.color END AS color, {_band('b', 'band_', "'-'")},
         m.web_period_CAT AS "period_CAT", m.web_period_EN AS "period_EN", m.web_period_FR AS "period_FR"
  FROM pairs p LEFT JOIN now_idx i ON i.station = p.station AND i.pollutant = p.pollutant
  {BAND_JOIN.format(b='b', c='i.index')}
  LEFT JOIN (SELECT * FROM mapping WHERE pos <> 6) m ON p.pollutant = m.notation)"""


def _board(spark, sf):
    return boards.latest_board(
        frames.current(spark, sf), adapter.mapping(spark), adapter.pairs(spark), adapter.bands(spark)
    )


BOARD_VIEWS = ("now_idx", "bands", "pairs")


@case("latest_board", sql(f"{BOARD_SQL} SELECT * FROM board", *BOARD_VIEWS))
def latest_board(spark, sf):
    return _board(spark, sf)


@case(
    "latest_common",
    sql(f"{BOARD_SQL} SELECT id, date, station, pollutant, concentration, index, color FROM board", *BOARD_VIEWS),
)
def latest_common(spark, sf):
    return boards.latest_common(_board(spark, sf))


@case(
    "latest_lang",
    sql(
        f"""{BOARD_SQL}
SELECT id, 'ca-ES' AS lang, "band_CAT" AS band, "period_CAT" AS period FROM board
UNION ALL SELECT id, 'en-GB', "band_EN", "period_EN" FROM board
UNION ALL SELECT id, 'fr-FR', "band_FR", "period_FR" FROM board""",
        *BOARD_VIEWS,
    ),
)
def latest_lang(spark, sf):
    return boards.latest_lang(_board(spark, sf))


@case(
    "latest_own_time",
    sql(
        f"""
, mine AS (SELECT * EXCLUDE (r) FROM (SELECT *, rank() OVER (PARTITION BY station ORDER BY date DESC) AS r FROM idx) WHERE r = 1)
SELECT i.station, i.date, i.pollutant, floor(i.value) AS amount, i.index, b.band_EN AS band, b.color,
       m.web_period_EN AS period
FROM mine i {BAND_JOIN.format(b='b', c='i.index')}
LEFT JOIN (SELECT * FROM mapping WHERE pos <> 6) m ON i.pollutant = m.notation WHERE i.index IS NOT NULL""",
        "idx",
        "bands",
    ),
)
def latest_own_time(spark, sf):
    own = dedupe.latest_per_station(write_out(frames.index(spark, sf), "index"))
    rows = boards.latest_rows(own, adapter.mapping(spark), None, adapter.bands(spark))
    return rows.select(
        "station", "date", "pollutant", F.floor("value").cast("double").alias("amount"), "index",
        F.col("index_band_EN").alias("band"), F.col("index_color").alias("color"), F.col("web_period_EN").alias("period"),
    )


@case(
    "index_bands_five",
    sql(
        """SELECT i.station, i.date, i.pollutant, i.index, b.band_CAT AS "index_band_CAT" FROM (SELECT * FROM idx WHERE index IS NOT NULL) i
           LEFT JOIN bands b ON b.idx = CASE WHEN i.index >= 5 THEN 5 WHEN i.index >= 1 THEN floor(i.index) END""",
        "idx",
        "bands",
    ),
)
def index_bands_five(spark, sf):
    rows = filters.finite(frames.index(spark, sf), "index").drop("value")
    return indices.index_bands(rows, adapter.bands(spark), langs=["CAT"], colors=False, last=5)


@case(
    "episodes",
    sql(
        """SELECT station, i.pollutant, date, value, threshold, i.pollutant || ' CAT' AS "message_html_CAT",
                  i.pollutant || ' EN' AS "message_html_EN", i.pollutant || ' FR' AS "message_html_FR"
           FROM now_idx i JOIN episode_thresholds t ON i.pollutant = t.pollutant WHERE value >= threshold""",
        "now_idx",
        "episode_thresholds",
    ),
)
def episodes(spark, sf):
    return boards.episodes(frames.current(spark, sf), adapter.episode_thresholds(spark))


# --- stations, series, mapping --------------------------------------------------------------------


def _supplier_sheet(spark, sf):
    nation = adapter.read(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    rows = adapter.read(spark, sf, "supplier").join(nation, "s_nationkey")
    return rows.select(
        F.concat(F.lit("STA-S"), F.col("s_suppkey").cast("string")).alias("station_id"),
        F.col("s_name").alias("web_name"),
        (F.lit(42.0) + F.col("s_acctbal") / 10000.0).alias("web_lat"),
        (F.lit(1.0) + F.col("s_suppkey") / 1000.0).alias("web_long"),
        *[F.concat("n_name", F.lit(f" {x}")).alias(f"web_type_{x}") for x in text.LOCALES],
        *[F.concat("s_name", F.lit(f" {x}")).alias(f"web_ubicacio_{x}") for x in text.LOCALES],
        *[F.concat(F.col("s_nationkey").cast("string"), F.lit(x)).alias(f"web_comentaris_{x}") for x in text.LOCALES],
        F.col("s_nationkey").alias("internal"),
    )


@case(
    "stations_lang",
    """SELECT 'S' || s_suppkey AS station_id, lang, n_name || ' ' || code AS type, s_name || ' ' || code AS location,
              s_nationkey || code AS comments
       FROM supplier JOIN nation ON s_nationkey = n_nationkey,
            (VALUES ('CAT', 'ca-ES'), ('EN', 'en-GB'), ('FR', 'fr-FR')) t(code, lang)""",
)
def stations_lang(spark, sf):
    return boards.stations_lang(_supplier_sheet(spark, sf))


@case(
    "stations_common",
    """SELECT 'S' || s_suppkey AS station_id, s_name AS web_name, 42.0::DOUBLE + s_acctbal / 10000.0 AS web_lat,
              1.0::DOUBLE + s_suppkey / 1000.0::DOUBLE AS web_long
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def stations_common(spark, sf):
    return boards.stations_common(_supplier_sheet(spark, sf))


@case(
    "map_xy",
    """SELECT s_suppkey, 42.0::DOUBLE + s_acctbal / 10000.0::DOUBLE AS web_lat, 1.0::DOUBLE + s_suppkey / 1000.0::DOUBLE AS web_long,
              100.0::DOUBLE * ((1.0::DOUBLE + s_suppkey / 1000.0::DOUBLE) - 1.408520::DOUBLE) / (1.787182::DOUBLE - 1.408520::DOUBLE) AS x_value,
              100.0::DOUBLE * (42.655784::DOUBLE - (42.0::DOUBLE + s_acctbal / 10000.0::DOUBLE)) / (42.655784::DOUBLE - 42.428791::DOUBLE) AS y_value
       FROM supplier""",
)
def map_xy(spark, sf):
    rows = adapter.read(spark, sf, "supplier").select(
        "s_suppkey",
        (F.lit(42.0) + F.col("s_acctbal") / 10000.0).alias("web_lat"),
        (F.lit(1.0) + F.col("s_suppkey") / 1000.0).alias("web_long"),
    )
    return boards.map_xy(rows)


@case(
    "series_extent",
    sql(
        """SELECT sampling_point_id, min(begin_position) AS fromtime, max(begin_position) AS totime
           FROM clean GROUP BY sampling_point_id""",
        "clean",
    ),
)
def series_extent(spark, sf):
    extent = aggregates.series_extent(frames.kept(spark, sf))
    return extent.select(
        "sampling_point_id",
        timeutil.format_position("first_time").alias("fromtime"),
        timeutil.format_position("last_time").alias("totime"),
    )


@case(
    "series_catalogue",
    sql(
        """SELECT e.sampling_point_id AS timeserieid, s.web_name_noaccents || ', ' || m.notation AS label, fromtime, totime
           FROM (SELECT sampling_point_id, station, code, min(begin_position) AS fromtime, max(begin_position) AS totime
                 FROM parts WHERE code < 9000 GROUP BY ALL) e
           LEFT JOIN stations s ON e.station = s.station_id
           LEFT JOIN (SELECT * FROM mapping WHERE pos <> 6) m ON e.code = m.pollutant_id""",
        "parts",
        "stations",
        "mapping",
    ),
)
def series_catalogue(spark, sf):
    extents = aggregates.series_extent(frames.kept(spark, sf))
    return boards.series_catalogue(extents, adapter.mapping(spark), adapter.stations(spark))


@case(
    "mapping_distinct",
    "SELECT DISTINCT p_size AS pollutant_id, p_type AS unite, p_brand AS notation FROM part",
)
def mapping_distinct(spark, sf):
    rows = adapter.read(spark, sf, "part").select(
        F.col("p_size").alias("pollutant_id"), F.col("p_type").alias("unite"), F.col("p_brand").alias("notation"), "p_name"
    )
    return boards.mapping_distinct(rows, ["pollutant_id", "unite", "notation"])


@case("graph_colors", "SELECT p_brand AS colors FROM part")
def graph_colors(spark, sf):
    return boards.graph_colors(adapter.read(spark, sf, "part").select("p_brand"))


@case(
    "append_new_dims",
    """SELECT DISTINCT p_size * 250 AS id, p_brand AS notation, p_type AS label FROM part
       WHERE p_size * 250 >= 9000 AND p_size * 250 NOT IN (SELECT (n_nationkey + 20) * 250 FROM nation)""",
)
def append_new_dims(spark, sf):
    rows = adapter.read(spark, sf, "part").select(
        (F.col("p_size") * 250).alias("pollutant_id"), F.col("p_brand").alias("notation"), F.col("p_type").alias("pollutant_name")
    )
    known = adapter.read(spark, sf, "nation").select(((F.col("n_nationkey") + 20) * 250).alias("id"))
    return boards.meteo_dims(rows, known)


# --- map, country, messages -----------------------------------------------------------------------

MAP_SQL = f"""
, map AS (
  SELECT i.station AS station_id, timezone('Europe/Andorra', timezone('UTC', i.date)) AS date,
         coalesce(i.aqi, 0) AS aqi, CASE WHEN i.aqi IS NULL THEN '#696969' ELSE b.color END AS aqi_color,
         {_band('b', 'aqi_band_', "'-'")}, s.web_global, s.web_name,
         100.0::DOUBLE * (s.web_long - 1.408520::DOUBLE) / (1.787182::DOUBLE - 1.408520::DOUBLE) AS x_value,
         100.0::DOUBLE * (42.655784::DOUBLE - s.web_lat) / (42.655784::DOUBLE - 42.428791::DOUBLE) AS y_value
  FROM (SELECT station, date, max(index) AS aqi FROM now_idx GROUP BY station, date) i
  {BAND_JOIN.format(b='b', c='i.aqi')}
  LEFT JOIN stations s ON i.station = s.station_id),
worst AS (SELECT * FROM map WHERE web_global ORDER BY aqi DESC, station_id LIMIT 1)"""
MAP_VIEWS = ("now_idx", "bands", "stations")


def _map(spark, sf):
    return boards.map_board(frames.current(spark, sf), adapter.stations(spark), adapter.bands(spark))


@case("map_table", sql(f"{MAP_SQL} SELECT * FROM map", *MAP_VIEWS))
def map_table(spark, sf):
    return _map(spark, sf)


@case(
    "map_lang",
    sql(
        f"""{MAP_SQL} SELECT station_id, 'ca-ES' AS lang, "aqi_band_CAT" AS aqi_band FROM map
UNION ALL SELECT station_id, 'en-GB', "aqi_band_EN" FROM map UNION ALL SELECT station_id, 'fr-FR', "aqi_band_FR" FROM map""",
        *MAP_VIEWS,
    ),
)
def map_lang(spark, sf):
    return boards.map_lang(_map(spark, sf))


@case("country_now", sql(f"{MAP_SQL} SELECT * FROM worst", *MAP_VIEWS))
def country_now(spark, sf):
    return aggregates.country_now(_map(spark, sf))


@case(
    "aqi_message",
    sql(
        f"""{MAP_SQL}
SELECT 'La qualitat de l''aire a Andorra a les '
       || hour(timezone('Europe/Andorra', timezone('UTC', (SELECT max(touched) FROM kept))))
       || ':00 és ' || "aqi_band_CAT" || ' - índex ' || CAST(floor(aqi) AS BIGINT) || '/6.' AS message FROM worst""",
        *MAP_VIEWS,
    ),
)
def aqi_message(spark, sf):
    return feed.aqi_message(_map(spark, sf), frames.as_of(frames.kept(spark, sf)), "Andorra")


@case(
    "feed_items",
    sql(
        f"""{MAP_SQL}
, updated AS (SELECT strftime(l, '%a, %d %b %Y %H:%M:%S') || ' +0' || CAST(date_diff('hour', t, l) AS BIGINT) || '00' AS moment
  FROM (SELECT max(date) AS t, timezone('Europe/Andorra', timezone('UTC', max(date))) AS l FROM conc WHERE value IS NOT NULL)),
items AS (
  SELECT 'Índex global de qualitat de l''aire' AS title, 'https://example.org/' AS link, "aqi_band_CAT" AS band, aqi FROM worst
  UNION ALL SELECT web_name, 'https://example.org/station?station=' || station_id, "aqi_band_CAT", aqi FROM map
  WHERE station_id IN (SELECT station FROM conc0))
SELECT title, link, link AS guid, 'La qualitat de l''aire és ' || band || ' - índex ' || CAST(floor(aqi) AS BIGINT) || '/6' AS description,
       (SELECT moment FROM updated) AS "pubDate" FROM items""",
        *MAP_VIEWS,
    ),
)
def feed_items(spark, sf):
    listed = frames.conc0(spark, sf).select(F.col("station").alias("station_id")).distinct()
    updated = frames.conc(spark, sf).where("value IS NOT NULL").select(F.max("date")).scalar()
    return feed.feed_items(write_out(_map(spark, sf), "map"), listed, updated, "https://example.org/")


# --- graph, inversion, utilities ------------------------------------------------------------------


@case(
    "graph_rows",
    sql(
        """SELECT sampling_point_id, from_time, to_time, value, seq,
                  timezone('Europe/Andorra', timezone('UTC', to_time)) AS date_local
           FROM parts WHERE code < 9000 AND to_time >= (SELECT max(touched) FROM kept) - INTERVAL 20 DAY""",
        "parts",
    ),
)
def graph_rows(spark, sf):
    graph = observations.graph_rows(frames.measured(spark, sf), frames.as_of(frames.kept(spark, sf)), 20)
    return graph.select("sampling_point_id", "from_time", "to_time", "value", "seq", "date_local")


INVERSION_SQL = """
, temps AS (SELECT station, to_time AS date, value FROM parts WHERE code = 9054),
inv AS (SELECT date, value_low, value_high, coalesce(value_low < value_high, false) AS inversion FROM (
  SELECT max(date) AS date, max(CASE WHEN station = 'AD0940A' THEN value END) AS value_low,
         max(CASE WHEN station = 'AD0941A' THEN value END) AS value_high
  FROM temps WHERE date = (SELECT max(date) FROM temps)))"""


@case("temperature_inversion", sql(f"{INVERSION_SQL} SELECT * FROM inv", "parts"))
def temperature_inversion(spark, sf):
    return boards.temperature_inversion(observations.temperatures(frames.measured(spark, sf)), "AD0940A", "AD0941A")


STALE_SQL = """SELECT last_update, date_diff('hour', last_update, now_) / 1.0::DOUBLE AS count_h,
       date_diff('hour', last_update, now_) >= 3 AS old_data_bool
FROM (SELECT max(date) AS last_update, (SELECT max(touched) FROM obs) AS now_ FROM conc WHERE value IS NOT NULL)"""


def _fresh(spark, sf):
    present = frames.conc(spark, sf).where("value IS NOT NULL")
    return boards.staleness(present, frames.as_of(adapter.obs(spark, sf)))


@case("staleness", sql(STALE_SQL, "conc"))
def staleness(spark, sf):
    return _fresh(spark, sf)


@case("last_update", sql("SELECT max(date) AS last_update FROM conc WHERE value IS NOT NULL", "conc"))
def last_update(spark, sf):
    return aggregates.last_update(frames.conc(spark, sf).where("value IS NOT NULL"))


MESSAGES = {
    x: {"true_html": f"inversion {x}", "false_html": f"no inversion {x}", "moreinfo": f"more {x}"} for x in text.LOCALES
}


def _utils_sql() -> str:
    rows = ", ".join(
        f"('U{n}', '{text.LOCALES[x]}', '{boards.BETWEEN_DATE_AND_TIME[x]}', '{boards.OLD_DATA_MESSAGE[x]}', "
        f"'inversion {x}', 'no inversion {x}', 'more {x}')"
        for n, x in enumerate(text.LOCALES, 1)
    )
    return f"""{INVERSION_SQL}
SELECT t.id, timezone('Europe/Andorra', timezone('UTC', f.last_update)) AS last_update, t.text_between_datetime,
       t.old_data_message, f.old_data_bool, CASE WHEN i.inversion THEN t.yes ELSE t.no END AS inversion_message,
       i.inversion AS inversion_bool, t.more AS inversion_moreinfo_text, 'https://example.org/more' AS inversion_moreinfo_url,
       t.lang, f.count_h
FROM ({STALE_SQL}) f, inv i, (VALUES {rows}) t(id, lang, text_between_datetime, old_data_message, yes, no, more)"""


@case("utils_rows", sql(_utils_sql(), "conc"))
def utils_rows(spark, sf):
    inversion = boards.temperature_inversion(observations.temperatures(frames.measured(spark, sf)), "AD0940A", "AD0941A")
    return boards.utils_rows(_fresh(spark, sf), inversion, MESSAGES, "https://example.org/more")


@case(
    "utils_dated",
    sql(
        """SELECT t + INTERVAL 1 HOUR AS last_update, 3 AS margin, id, words || strftime(t + INTERVAL 1 HOUR, '%d-%m-%Y') || mid || strftime(t + INTERVAL 1 HOUR, '%H:%M') AS old_data_message, lang
           FROM (SELECT max(date) AS t FROM conc WHERE value IS NOT NULL), (VALUES
             ('U1', 'CAT', 'Les dades es van actualitzar per &uacute;ltima vegada el ', ' a les '),
             ('U2', 'EN', 'The data were last updated on ', ' at '),
             ('U3', 'FR', 'Les donn&eacute;es ont &eacute;t&eacute; mises &agrave; jour pour la derni&egrave;re fois le ',
              ' &agrave; ')) v(id, lang, words, mid)""",
        "conc",
    ),
)
def utils_dated(spark, sf):
    return boards.utils_dated(_fresh(spark, sf))


# --- calendars ------------------------------------------------------------------------------------

CALENDAR_SQL = f"""
, daily AS (SELECT CAST(date AS DATE) AS day, station, pollutant, max(index) AS index FROM idx GROUP BY ALL),
worst AS (SELECT CAST(date AS DATE) AS day, station, max(index) AS aqi FROM idx GROUP BY ALL),
cal AS (
  SELECT w.day, w.station, p.pollutant, w.aqi, d.index, {_band('b', 'index_band_')}, {_band('a', 'aqi_band_')},
         b.color AS index_color, a.color AS aqi_color,
         'pAQ' || row_number() OVER (ORDER BY w.day, w.station, p.pollutant) AS id
  FROM worst w CROSS JOIN (VALUES ('SO2'), ('CO'), ('NO2'), ('O3'), ('PM10'), ('PM2.5')) p(pollutant)
  LEFT JOIN daily d ON d.day = w.day AND d.station = w.station AND d.pollutant = p.pollutant
  {BAND_JOIN.format(b='b', c='d.index')}
  {BAND_JOIN.format(b='a', c='w.aqi')})"""


@case("calendar", sql(f"{CALENDAR_SQL} SELECT * FROM cal", "idx", "bands"))
def calendar(spark, sf):
    return boards.calendar(boards.daily_wide(frames.index(spark, sf)), adapter.bands(spark))


@case(
    "calendar_common",
    sql(
        f"""{CALENDAR_SQL} SELECT id, station, day, pollutant, aqi_color,
         CAST(list_position(['SO2', 'CO', 'NO2', 'O3', 'PM10', 'PM2.5'], pollutant) AS INTEGER) AS pollutant_rank,
         CASE station WHEN 'AD0940A' THEN 4 ELSE 5 END AS station_rank FROM cal""",
        "idx",
        "bands",
    ),
)
def calendar_common(spark, sf):
    return boards.calendar_common(boards.calendar(boards.daily_wide(frames.index(spark, sf)), adapter.bands(spark)))


@case(
    "calendar_lang",
    sql(
        f"""{CALENDAR_SQL}
SELECT id, 'ca-ES' AS lang, "index_band_CAT" AS pollutant_band, "aqi_band_CAT" AS aqi_band FROM cal
UNION ALL SELECT id, 'en-GB', "index_band_EN", "aqi_band_EN" FROM cal
UNION ALL SELECT id, 'fr-FR', "index_band_FR", "aqi_band_FR" FROM cal""",
        "idx",
        "bands",
    ),
)
def calendar_lang(spark, sf):
    return boards.calendar_lang(boards.calendar(boards.daily_wide(frames.index(spark, sf)), adapter.bands(spark)))


COUNTRY_SQL = f"""
, country AS (
  SELECT 'GAQ' || row_number() OVER (ORDER BY day) AS id, day, country_aqi, {_band('b', 'band_')}, b.color
  FROM (SELECT day, max(aqi) AS country_aqi FROM ({DAILY_STATION})
        WHERE station IN (SELECT station_id FROM stations WHERE web_global) GROUP BY day) c
  {BAND_JOIN.format(b='b', c='c.country_aqi')})"""
COUNTRY_VIEWS = ("idx", "bands", "stations")


def _country(spark, sf):
    daily = aggregates.daily_station_aqi(frames.index(spark, sf))
    return boards.country_calendar(daily, adapter.stations(spark), adapter.bands(spark))


@case(
    "calendar_global",
    sql(
        f"{COUNTRY_SQL} SELECT id, day, CAST(floor(country_aqi) AS BIGINT) AS country_aqi, color AS country_aqi_color FROM country",
        *COUNTRY_VIEWS,
    ),
)
def calendar_global(spark, sf):
    return boards.country_common(_country(spark, sf))


@case(
    "calendar_global_lang",
    sql(
        f"""{COUNTRY_SQL} SELECT id, 'ca-ES' AS lang, "band_CAT" AS band FROM country
UNION ALL SELECT id, 'en-GB', "band_EN" FROM country UNION ALL SELECT id, 'fr-FR', "band_FR" FROM country""",
        *COUNTRY_VIEWS,
    ),
)
def calendar_global_lang(spark, sf):
    return boards.country_lang(_country(spark, sf))


@case(
    "daily_with_country",
    sql(
        f"""{CALENDAR_SQL}
SELECT c.day, c.station, c.pollutant, c."index_band_EN" AS band, c."aqi_band_EN" AS aqi_band,
       CASE WHEN g.idx > 0 THEN g.band_EN END AS country_band
FROM cal c LEFT JOIN (SELECT day, max(aqi) AS country_aqi FROM worst GROUP BY day) k ON c.day = k.day
{BAND_JOIN.format(b='g', c='k.country_aqi')}""",
        "idx",
        "bands",
    ),
)
def daily_with_country(spark, sf):
    return boards.daily_bands(boards.daily_wide(frames.index(spark, sf)), adapter.bands(spark))


# --- pollen ---------------------------------------------------------------------------------------


@case("pollen_weekly", sql("SELECT species, measurement FROM weekly", "weekly"))
def pollen_weekly(spark, sf):
    return pollen.pollen_weekly(pollen.pollen_clean(adapter.pollen(spark, sf)))


LEVEL_SQL = """CASE WHEN w.measurement < t.a THEN NULL WHEN w.measurement < t.b THEN 1 WHEN w.measurement < t.c THEN 2
     WHEN w.measurement < t.d THEN 3 WHEN w.measurement <= t.e THEN 4 END"""


@case(
    "pollen_level",
    sql(
        f"""SELECT w.species, w.measurement_date, w.measurement, w.seq, {LEVEL_SQL} AS index
            FROM pollen w LEFT JOIN thresholds t ON w.species = t.species""",
        "pollen",
        "thresholds",
    ),
)
def pollen_level(spark, sf):
    rows = adapter.pollen(spark, sf)
    rows = filters.null_by_rating(rows).select(
        F.trim("pid").alias("species"), timeutil.parse_day("start_date").alias("measurement_date"), "measurement", "seq"
    )
    return indices.pollen_level(rows, adapter.pollen_thresholds(spark))


@case(
    "pollen_weekly_levels",
    sql(
        f"""SELECT w.species, {LEVEL_SQL} AS index, n.type, n.web_name_CAT AS "name_CAT",
                   (SELECT min(measurement_date) FROM pollen) AS start_date, (SELECT max(measurement_date) FROM pollen) AS end_date
            FROM weekly w LEFT JOIN thresholds t ON w.species = t.species LEFT JOIN pollen_names n ON w.species = n.species""",
        "weekly",
        "thresholds",
        "pollen_names",
    ),
)
def pollen_weekly_levels(spark, sf):
    return pollen.pollen_weekly_levels(
        adapter.pollen(spark, sf), adapter.pollen_thresholds(spark), adapter.pollen_names(spark)
    )


@case("week_bounds", sql("SELECT min(measurement_date) AS start_date, max(measurement_date) AS end_date FROM pollen", "pollen"))
def week_bounds(spark, sf):
    return pollen.week_bounds(adapter.pollen(spark, sf))


@case(
    "merge_historic",
    sql(
        """SELECT measurement_date, species, measurement, load_seq FROM (
             SELECT *, rank() OVER (PARTITION BY measurement_date ORDER BY load_seq DESC) AS r FROM (
               SELECT measurement_date, species, max(measurement) AS measurement, CAST(1 AS BIGINT) AS load_seq
               FROM pollen GROUP BY 1, 2
               UNION ALL
               SELECT measurement_date, species, max(measurement), CAST(2 AS BIGINT) FROM pollen
               WHERE measurement > 150 GROUP BY 1, 2)) WHERE r = 1""",
        "pollen",
    ),
)
def merge_historic(spark, sf):
    rows = pollen.pollen_clean(adapter.pollen(spark, sf))

    def load(df, seq):
        best = df.groupBy("measurement_date", "species").agg(F.max("measurement").alias("measurement"))
        return best.withColumn("load_seq", F.lit(seq).cast("bigint"))

    return pollen.merge_historic(load(rows, 1), load(rows.where("measurement > 150"), 2))


# --- profiles -------------------------------------------------------------------------------------

LOCAL = "timezone('Europe/Andorra', timezone('UTC', to_time))"


@case(
    "time_variation",
    sql(
        f"""
, once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sampling_point_id, to_time
      ORDER BY (value IS NULL), touched DESC, seq) AS r FROM obs WHERE CAST(substr(sampling_point_id, 13) AS INTEGER) < 9000) WHERE r = 1),
slots AS (SELECT substr(o.sampling_point_id, 5, 7) AS station, m.notation AS pollutant, CAST(month({LOCAL}) AS INTEGER) AS month,
     CAST(isodow({LOCAL}) - 1 AS INTEGER) AS weekday, CAST(hour({LOCAL}) AS INTEGER) AS hour, CAST(value AS DECIMAL(18,6)) AS v
     FROM once o LEFT JOIN (SELECT * FROM mapping WHERE pos <> 6) m ON CAST(substr(o.sampling_point_id, 13) AS INTEGER) = m.pollutant_id
     WHERE value > -10),
sums AS (SELECT station, pollutant, month, weekday, hour, count(*) AS n, CAST(sum(v) AS DOUBLE) AS s,
     CAST(sum(CAST(v * v AS DECIMAL(38,12))) AS DOUBLE) AS ss
     FROM slots GROUP BY GROUPING SETS ((station, pollutant, hour), (station, pollutant, weekday), (station, pollutant, month),
                                        (station, pollutant, weekday, hour))),
stats AS (SELECT *, s / n AS mean, CASE WHEN n > 1 THEN sqrt(greatest(0.0::DOUBLE, (ss - s * s / n) / (n - 1))) END AS sd FROM sums)
SELECT station, pollutant, month, weekday, hour, CAST(n AS BIGINT) AS n, round(mean, 6) AS mean, round(sd, 6) AS sd,
       round(mean - 1.96::DOUBLE * sd / sqrt(n), 6) AS lower, round(mean + 1.96::DOUBLE * sd / sqrt(n), 6) AS upper FROM stats""",
        "obs",
        "mapping",
    ),
)
def time_variation(spark, sf):
    rows = profiles.profile_input(adapter.obs(spark, sf), adapter.mapping(spark), seq="seq")
    table = profiles.time_variation(rows)
    return table.withColumns({c: F.round(c, 6) for c in ("mean", "sd", "lower", "upper")})


# --- run log --------------------------------------------------------------------------------------


@case(
    "ingest_alerts",
    sql(
        """
, runs AS (SELECT *, lag(file_found) OVER (PARTITION BY feed ORDER BY time_begin) AS before,
       timezone('Europe/Andorra', timezone('UTC', time_begin)) AS local FROM runlog),
found AS (
  SELECT feed, time_begin, local, 'no_data' AS kind FROM runs WHERE NOT file_found
  UNION ALL SELECT feed, time_begin, local, 'restablished' FROM runs WHERE file_found AND NOT before
  UNION ALL SELECT feed, time_begin, local, 'fail' FROM runs WHERE error_script
  UNION ALL SELECT feed, time_begin, local, 'alive' FROM runs WHERE hour(local) IN (8, 16) AND isodow(local) <= 5)
SELECT feed, time_begin AS time, kind, CASE kind
    WHEN 'no_data' THEN 'No data has been received at ' || strftime(local, '%d/%m/%Y %H:%M') || '.'
    WHEN 'restablished' THEN 'Data is being received again at ' || strftime(local, '%d/%m/%Y %H:%M') || '.'
    WHEN 'fail' THEN 'Processing the data received at ' || strftime(local, '%d/%m/%Y %H:%M') || ' failed.'
    ELSE 'The pipeline is running at ' || strftime(local, '%d/%m/%Y %H:%M') || '.' END AS text
FROM found""",
        "runlog",
    ),
)
def ingest_alerts(spark, sf):
    return alerts.ingest_alerts(adapter.runlog(spark, sf), ["feed"])


@case(
    "count_alerts",
    sql(
        """
, counts AS (SELECT feed, time_begin, date_diff('hour', last, time_begin) / 1.0::DOUBLE AS count_h FROM (
    SELECT *, max(CASE WHEN file_found THEN time_begin END) OVER (PARTITION BY feed ORDER BY time_begin) AS last FROM runlog)),
runs AS (SELECT *, lag(count_h) OVER (PARTITION BY feed ORDER BY time_begin) AS p FROM counts)
SELECT * FROM (SELECT feed, time_begin, count_h, CASE WHEN p > 0.5 AND p < 1.5 THEN 'no_data'
    WHEN count_h < p AND count_h >= 1 THEN 'restablished' END AS kind FROM runs) WHERE kind IS NOT NULL""",
        "runlog",
    ),
)
def count_alerts(spark, sf):
    counts = alerts.hours_without_data(adapter.runlog(spark, sf), ["feed"])
    return alerts.count_alerts(counts, ["feed"], margin=0.5)


@case(
    "mark_last_failed",
    sql(
        """SELECT feed, time_begin, file_found, rows,
                  time_begin = max(time_begin) OVER (PARTITION BY feed) OR error_script AS error_script
           FROM runlog""",
        "runlog",
    ),
)
def mark_last_failed(spark, sf):
    return writers.mark_failed(adapter.runlog(spark, sf), keys=["feed"])


# --- scalar functions -----------------------------------------------------------------------------


@case(
    "scalar_time",
    """
SELECT o_orderkey, t AS parsed, CAST(t AS DATE) AS day_text, strftime(t + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S+01:00') AS position,
       t AS back, t + INTERVAL 5 HOUR AS plus_hours, t - INTERVAL 30 DAY AS minus_days, l AS local,
       date_diff('minute', o_orderdate, t) / 60.0::DOUBLE AS hours, CAST(t AS DATE) AS day,
       CAST(hour(t) AS INTEGER) AS hour, CAST(isodow(t) - 1 AS INTEGER) AS weekday,
       strftime(l, '%a, %d %b %Y %H:%M:%S') || ' +0' || CAST(date_diff('hour', t, l) AS BIGINT) || '00' AS feed
FROM (SELECT *, timezone('Europe/Andorra', timezone('UTC', t)) AS l FROM (
  SELECT o_orderkey, o_orderdate, o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR + (o_orderkey % 60) * INTERVAL 1 MINUTE AS t
  FROM orders))""",
)
def scalar_time(spark, sf):
    minutes = (F.col("o_orderkey") % 24 * 60 + F.col("o_orderkey") % 60).cast("int")
    start = F.col("o_orderdate").cast("timestamp")
    at_offset = F.from_utc_timestamp(start + F.make_dt_interval(mins=minutes), timeutil.OFFSET)
    rows = adapter.read(spark, sf, "orders").select(
        "o_orderkey",
        start.alias("start"),
        F.date_format(at_offset, timeutil.DELIVERY_FORMAT).alias("text"),
        F.date_format(start + F.make_dt_interval(mins=minutes), timeutil.DAY_FORMAT).alias("text_day"),
    )
    t = timeutil.parse_delivery("text")
    return rows.select(
        "o_orderkey",
        t.alias("parsed"),
        timeutil.parse_day("text_day").alias("day_text"),
        timeutil.format_position(t).alias("position"),
        timeutil.parse_position(timeutil.format_position(t)).alias("back"),
        timeutil.add_hours(t, 5).alias("plus_hours"),
        timeutil.add_days(t, -30).alias("minus_days"),
        timeutil.local_time(t).alias("local"),
        timeutil.hours_between(t, F.col("start")).alias("hours"),
        timeutil.day_of(t).alias("day"),
        F.hour(t).alias("hour"),
        timeutil.weekday(t).alias("weekday"),
        timeutil.feed_date(t).alias("feed"),
    )


@case(
    "scalar_text_num",
    """
SELECT p_partkey, substr(p_type, 1, 3) AS head, CAST(length(p_name) AS INTEGER) AS n_chars, trim('  ' || p_brand || '   ') AS trimmed,
       p_brand AS unit, p_name || ' ' || p_brand AS spaced, p_brand || p_type AS joined, p_type LIKE '%STEEL%' AS steel,
       CAST(floor(p_retailprice) AS BIGINT) AS low, CAST(round_even(p_size / 2.0, 0) AS DOUBLE) AS half_even,
       CASE WHEN p_size >= 25 THEN 'big' ELSE 'small' END AS size_text,
       CASE WHEN p_size = 7 THEN NULL ELSE p_size * 1.0::DOUBLE END AS no_sentinel,
       CASE WHEN p_size = 7 THEN -999.0::DOUBLE ELSE p_size * 1.0::DOUBLE END AS with_sentinel,
       coalesce(CASE WHEN p_size % 5 > 0 THEN CAST(p_size AS VARCHAR) END, '-') AS shown,
       CAST(CASE WHEN p_size < 1 THEN NULL WHEN p_size <= 10 THEN 1 WHEN p_size <= 20 THEN 2 WHEN p_size <= 40 THEN 3 END AS INTEGER) AS upper_closed,
       CAST(CASE WHEN p_size < 1 THEN NULL WHEN p_size < 10 THEN 1 WHEN p_size < 20 THEN 2 WHEN p_size <= 40 THEN 3 END AS INTEGER) AS lower_closed,
       CAST(p_size AS VARCHAR) AS as_text, CASE p_size % 3 WHEN 0 THEN 'ca-ES' WHEN 1 THEN 'en-GB' ELSE 'fr-FR' END AS locale,
       CASE WHEN p_size % 4 IN (0, 1) THEN 1 ELSE -1 END AS validity, p_size + 0.5::DOUBLE AS from_comma
FROM part""",
)
def scalar_text_num(spark, sf):
    size = F.col("p_size")
    as_double = size.cast("double")
    stored = F.when(size == 7, F.lit(-999.0)).otherwise(as_double)
    limits = ["1D", "10D", "20D", "40D"]
    lang = F.when(size % 3 == 0, F.lit("CAT")).when(size % 3 == 1, F.lit("EN")).otherwise(F.lit("FR"))
    letter = F.when(size % 4 == 0, F.lit("A")).when(size % 4 == 1, F.lit("R")).otherwise(F.lit("I"))
    return adapter.read(spark, sf, "part").select(
        "p_partkey",
        F.substring("p_type", 1, 3).alias("head"),
        F.length("p_name").alias("n_chars"),
        F.trim(F.concat(F.lit("  "), "p_brand", F.lit("   "))).alias("trimmed"),
        text.last_token(F.concat(F.lit("http://host/unit/"), "p_brand")).alias("unit"),
        F.concat_ws(" ", "p_name", "p_brand").alias("spaced"),
        F.concat("p_brand", "p_type").alias("joined"),
        F.col("p_type").rlike("STEEL").alias("steel"),
        numbers.floor_int(F.col("p_retailprice")).alias("low"),
        numbers.round_half_even(as_double / 2).alias("half_even"),
        F.when(size >= 25, F.lit("big")).otherwise(F.lit("small")).alias("size_text"),
        numbers.sentinel_to_null(stored).alias("no_sentinel"),
        numbers.null_to_sentinel(numbers.sentinel_to_null(stored)).alias("with_sentinel"),
        F.coalesce(F.when(size % 5 > 0, size.cast("string")), F.lit("-")).alias("shown"),
        numbers.bin_upper_closed("CAST(p_size AS DOUBLE)", limits).alias("upper_closed"),
        numbers.bin_lower_closed("CAST(p_size AS DOUBLE)", limits).alias("lower_closed"),
        size.cast("string").alias("as_text"),
        text.locale_of(lang).alias("locale"),
        text.validity_of(letter).alias("validity"),
        numbers.decimal_comma(F.concat(size.cast("string"), F.lit(",5"))).alias("from_comma"),
    )
