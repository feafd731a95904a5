"""Hand-computed results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa.functions import numbers, text, timeutil
from brisa.operators import aggregates, dedupe, indices, reshape, windows
from brisa.plans import alerts, boards, observations, pollen
from checks import adapter

T0 = dt.datetime(2022, 3, 21)


def hour(n):
    return T0 + dt.timedelta(hours=n)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


NO2 = [
    (0.0, 1, 1.0, "EN1"),
    (20.0, 1, 1.5, "EN1"),
    (40.0, 1, 2.0, "EN2"),
    (65.0, 2, 2.5, "EN2"),
    (90.0, 2, 3.0, "EN3"),
    (1000.0, 6, 7.0, "EN6"),
    (1000.01, None, None, None),
    (-5.0, None, None, None),
    (None, None, None, None),
]


def test_index_class_decimal_and_band(spark):
    df = frame(spark, [(n, "NO2", v) for n, (v, *_) in enumerate(NO2)], "n int, pollutant string, value double")
    dim = adapter.breaks(spark)
    got = indices.index_bands(indices.aqi_decimal(indices.aqi_class(df, dim, out="class"), dim), adapter.bands(spark))
    found = {r["n"]: (r["class"], r["index"], r["index_band_EN"]) for r in got.collect()}
    assert [found[n] for n in range(len(NO2))] == [row[1:] for row in NO2]
    colors = {r["n"]: r["index_color"] for r in got.collect()}
    assert colors[6] == colors[7] == colors[8] == "#000000" and colors[0] == "#111111"


def test_pollutant_without_breaks_and_alias(spark):
    df = frame(spark, [("NO", 5.0), ("PM10", 10.0)], "pollutant string, value double")
    renamed = adapter.breaks(spark).replace("PM10", "pm10run", subset=["pol"])
    assert dict(indices.aqi_decimal(df, renamed).select("pollutant", "index").collect()) == {"NO": None, "PM10": 1.5}


def test_wide_class_keeps_all_columns(spark):
    df = frame(spark, [(T0, 40.0, 7.0)], "date timestamp, NO2_x double, other double")
    got = indices.aqi_class_wide(df, adapter.breaks(spark), ["NO2"], "_x", keep_all=True)
    assert got.columns == ["date", "NO2_x", "other", "index_NO2"] and got.first()["index_NO2"] == 1
    exact = indices.aqi_class_wide(df, adapter.breaks(spark), ["NO2"], "_x", decimal=True).first()
    assert exact["index_NO2"] == 2.0


@pytest.mark.parametrize(
    "value,level", [(0, 1), (9.99, 1), (10, 2), (50, 3), (100, 4), (500, 4), (500.1, None), (None, None)]
)
def test_pollen_level(spark, value, level):
    df = frame(spark, [("click", None if value is None else float(value))], "species string, measurement double")
    assert indices.pollen_level(df, adapter.pollen_thresholds(spark)).first()["index"] == level


def running(spark, present):
    rows = [("s", "p", hour(n), float(n)) for n in present]
    df = frame(spark, rows, "station string, pollutant string, date timestamp, value double")
    means = windows.running_mean(df, 8).collect()
    return {round((r["date"] - T0).total_seconds() / 3600): r["value"] for r in means}


def test_running_mean(spark):
    full = running(spark, range(1, 9))
    assert (full[5], full[6], full[7], full[8]) == (None, 4.0, 4.0, 4.0)
    assert running(spark, [1, 2, 5, 6, 7, 8])[8] == 5.0
    assert running(spark, [1, 2, 6, 7, 8])[8] is None


DELIVERIES = [
    ("A", hour(1), hour(2), 10.0, 3, hour(10), 1),
    ("A", hour(1), hour(2), None, 3, hour(11), 2),
    ("A", hour(1), hour(2), 12.0, 3, hour(11), 3),
    ("B", hour(1), hour(2), 20.0, 3, hour(10), 4),
    ("B", hour(1), hour(2), 21.0, 1, hour(10), 5),
    ("C", hour(1), hour(2), None, None, hour(10), 6),
]
SCHEMA = (
    "sampling_point_id string, from_time timestamp, to_time timestamp, value double, verification_flag int, "
    "touched timestamp, seq bigint"
)


def seqs(df):
    return sorted(r["seq"] for r in df.select("seq").collect())


def test_deduplication_steps(spark):
    w1 = dedupe.latest_wins(frame(spark, DELIVERIES, SCHEMA))
    assert seqs(w1) == [2, 3, 4, 5, 6]
    w2 = dedupe.best_verified(w1)
    assert seqs(w2) == [2, 3, 5, 6]
    assert seqs(dedupe.prefer_value(w2, seq="seq")) == [3, 5, 6]


def test_clean_is_the_three_steps_for_any_row_order(spark):
    for order in (DELIVERIES, DELIVERIES[::-1]):
        df = frame(spark, order, SCHEMA)
        assert seqs(dedupe.clean_observations(df, seq="seq")) == [3, 5, 6]
        assert seqs(dedupe.clean_observations(df)) == [3, 5, 6]


def test_replay_changes_nothing(spark, rows):
    df = frame(spark, DELIVERIES, SCHEMA)
    assert rows(dedupe.clean_observations(df.union(df), seq="seq")) == rows(dedupe.clean_observations(df, seq="seq"))


def test_station_aqi_and_culprit(spark):
    data = [("x", T0, "NO2", 2.5), ("x", T0, "O3", 2.5), ("x", T0, "PM10", None), ("y", T0, "NO2", None)]
    df = frame(spark, data, "station string, date timestamp, pollutant string, index double")
    found = {r["station"]: (r["aqi"], r["culprit"]) for r in aggregates.culprit(df).collect()}
    assert found == {"x": (2.5, "NO2"), "y": (None, None)}
    assert {r["station"]: r["aqi"] for r in aggregates.station_aqi(df).collect()} == {"x": 2.5, "y": None}


def test_day_boundary_and_local_time(spark):
    df = spark.sql(
        """SELECT timestamp'2022-03-21 23:00:00Z' AS a, timestamp'2022-03-22 00:00:00Z' AS b,
                  timestamp'2022-07-27 02:00:00Z' AS s, timestamp'2022-01-27 02:00:00Z' AS w"""
    )
    r = df.select(
        timeutil.day_of("a").alias("a"),
        timeutil.day_of("b").alias("b"),
        F.hour(timeutil.local_time("s")).alias("s"),
        F.hour(timeutil.local_time("w")).alias("w"),
        timeutil.feed_date("s").alias("f"),
    ).first()
    assert (r["a"], r["b"], r["s"], r["w"]) == (dt.date(2022, 3, 21), dt.date(2022, 3, 22), 4, 3)
    assert r["f"] == "Wed, 27 Jul 2022 04:00:00 +0200"


def test_map_position(spark):
    r = boards.map_xy(frame(spark, [(42.50, 1.50)], "web_lat double, web_long double")).first()
    assert (round(r["x_value"], 4), round(r["y_value"], 4)) == (24.1587, 68.6294)


@pytest.mark.parametrize("low,high,flag", [(-1.0, 2.0, True), (3.0, 2.0, False), (None, 2.0, False), (1.0, None, False)])
def test_inversion(spark, low, high, flag):
    data = [("L", 9054, T0, low), ("H", 9054, T0, high), ("L", 9054, T0 - dt.timedelta(hours=1), -50.0)]
    df = frame(spark, data, "station string, code int, date timestamp, value double")
    assert boards.temperature_inversion(df, "L", "H").first()["inversion"] is flag


def test_inversion_without_readings(spark):
    df = frame(spark, [], "station string, code int, date timestamp, value double")
    assert boards.temperature_inversion(df, "L", "H").first()["inversion"] is False


def test_ingest_alerts(spark):
    # Sunday night, so that no sign of life is due.
    log = [(dt.datetime(2022, 3, 20, n), found, False) for n, found in enumerate([True, False, False, True])]
    log.append((dt.datetime(2022, 3, 20, 4), True, True))
    log.append((dt.datetime(2022, 3, 21, 7), True, False))  # Monday 08:00 local
    df = frame(spark, log, "time_begin timestamp, file_found boolean, error_script boolean")
    got = sorted((r["time"].hour, r["kind"]) for r in alerts.ingest_alerts(df).collect())
    assert got == [(1, "no_data"), (2, "no_data"), (3, "restablished"), (4, "fail"), (7, "alive")]
    assert "08:00" in alerts.ingest_alerts(df).where("kind = 'alive'").first()["text"]


def test_pollen_alert(spark):
    df = frame(spark, [("w1.csv", T0)], "file string, time_begin timestamp")
    r = alerts.pollen_alerts(df).first()
    assert (r["kind"], r["file"]) == ("pollen", "w1.csv") and "21/03/2022" in r["text"]


def test_pollen_clean(spark, rows):
    raw = frame(
        spark,
        [("Alnus   ", 5.0, 1, "27/09/2021", "27/09/2021"), ("Cupressus", 1.0, 2, "27/09/2021", "27/09/2021"), ("Corylus", 0.0, 4, "28/09/2021", "28/09/2021")],
        "pid string, measurement double, ratid int, start_date string, end_date string",
    )
    assert rows(pollen.pollen_clean(raw), "species", "measurement") == [("Alnus", 5.0), ("Corylus", None), ("Cupressus", None)]
    week = pollen.week_bounds(raw).first()
    assert (week["start_date"], week["end_date"]) == (dt.date(2021, 9, 27), dt.date(2021, 9, 28))
    levels = {r["species"]: r["measurement"] for r in pollen.pollen_weekly(pollen.pollen_clean(raw)).collect()}
    assert levels == {"Alnus": 5.0, "Cupressus": None, "Corylus": None}


def test_lang_rows(spark, rows):
    df = frame(spark, [("LD1", "x", "y", "1h", "1 h")], "id string, band_EN string, band_FR string, period_EN string, period_FR string")
    got = reshape.to_lang_rows(df, ["id"], {"band": "band_", "period": "period_"}, {"EN": "en-GB", "FR": "fr-FR"})
    assert rows(got) == [("LD1", "en-GB", "x", "1h"), ("LD1", "fr-FR", "y", "1 h")]


def test_series_id(spark):
    df = frame(spark, [("SPO-AD0942A-6001",), ("SPO-AD0942A-9054",), ("SPO-AD0942A-95",)], "sampling_point_id string")
    got = {
        r["code"]: (r["station"], r["m"])
        for r in reshape.split_series(df).withColumn("m", text.is_meteo(F.col("sampling_point_id"))).collect()
    }
    # 95 is below 9000 as a number, although not as text
    assert got == {6001: ("AD0942A", False), 9054: ("AD0942A", True), 95: ("AD0942A", False)}


def test_unpivot_of_pivot(spark, rows):
    data = [("x", T0, "NO2", 1.0), ("x", T0, "PM2.5", None), ("y", T0, "NO2", 3.0), ("y", T0, "PM2.5", 4.0)]
    df = frame(spark, data, "station string, date timestamp, pollutant string, value double")
    again = reshape.unpivot_values(reshape.pivot_values(df, ["NO2", "PM2.5"]), ["NO2", "PM2.5"])
    assert rows(again) == rows(df)


def test_sentinels_and_comma(spark):
    df = frame(spark, [("-999",), ("-9900",), ("3,5",), ("n/d",)], "t string")
    got = [r[0] for r in df.select(numbers.sentinel_to_null(numbers.decimal_comma(F.col("t")))).collect()]
    assert got == [None, None, 3.5, None]


def test_historic_day_comes_whole_from_the_newest_load(spark, rows):
    schema = "measurement_date date, species string, measurement double, load_seq bigint"
    old = frame(spark, [(T0.date(), "a", 1.0, 1), (T0.date(), "b", 2.0, 1)], schema)
    new = frame(spark, [(T0.date(), "a", 5.0, 2)], schema)
    assert rows(pollen.merge_historic(old, new), "species", "measurement") == [("a", 5.0)]


def test_country_now_takes_the_first_of_equal_stations(spark):
    df = frame(spark, [("b", 2.0, True), ("a", 2.0, True), ("c", 5.0, False)], "station_id string, aqi double, web_global boolean")
    assert aggregates.country_now(df).first()["station_id"] == "a"
    assert aggregates.country_now(df.where("NOT web_global")).count() == 0


def test_message_unescapes_the_band(spark):
    from brisa.plans import feed

    data = [("a", 1.5, True, "Excel&middot;lent")]
    df = frame(spark, data, "station_id string, aqi double, web_global boolean, aqi_band_CAT string")
    text_ = feed.aqi_message(df, F.lit("2022-03-22 07:00:00").cast("timestamp"), "Andorra").first()[0]
    assert text_ == "La qualitat de l'aire a Andorra a les 8:00 és Excel·lent - índex 1/6."


def test_recent_observations_prefers_a_value(spark):
    df = frame(spark, DELIVERIES, SCHEMA)
    got = observations.recent_observations(df, F.lit("2022-03-22 00:00:00").cast("timestamp"), 30, seq="seq")
    assert seqs(got) == [3, 4, 6]
    assert observations.recent_observations(df, F.lit("2022-05-22 00:00:00").cast("timestamp"), 30).count() == 0


def test_week_is_processed_and_merged(spark, rows):
    raw = frame(
        spark,
        [("click ", 20.0, 1, "21/03/2022", "21/03/2022"), ("click", 40.0, 1, "22/03/2022", "22/03/2022"), ("signup", 9.0, 1, "22/03/2022", "22/03/2022")],
        "pid string, measurement double, ratid int, start_date string, end_date string",
    )
    old = frame(spark, [(dt.date(2022, 3, 20), "click", 1.0, 1), (dt.date(2022, 3, 21), "click", 2.0, 1)], "measurement_date date, species string, measurement double, load_seq bigint")
    levels, history = pollen.process_week(raw, old, 2, adapter.pollen_thresholds(spark), adapter.pollen_names(spark))
    found = {r["species"]: (r["index"], r["type"], r["start_date"], r["end_date"]) for r in levels.collect()}
    week = (dt.date(2022, 3, 21), dt.date(2022, 3, 22))
    assert found == {"click": (2, "pollen", *week), "signup": (None, "pollen", *week)}
    assert rows(pollen.history_wide(history, ["click", "signup"])) == [
        (dt.date(2022, 3, 20), 1.0, None),
        (dt.date(2022, 3, 21), 20.0, None),
        (dt.date(2022, 3, 22), 40.0, 9.0),
    ]


def test_log_rows_count_each_file(spark):
    from brisa.sources import writers

    df = frame(spark, [("a", T0), ("a", T0), ("b", T0)], "file string, time_file timestamp")
    now = F.lit("2022-03-21 01:00:00").cast("timestamp")
    assert sorted(r["rows"] for r in writers.log_rows(df, now, now).collect()) == [1, 2]
