"""Readers and writers on files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa import schemas
from brisa.plans import observations, pollen
from brisa.sources import readers, writers
from checks import adapter

DROP = """2022-03-22 09:10;22/03/2022 07:00;22/03/2022 08:00;60;hourly
Organisme;Station;Mesure;Constituant;Unite;Date;Valeur;Etat
ORG;940;m;view;ug;22/03/2022 07:00;12,5;A
ORG;940;m;click;ug;22/03/2022 07:00;;R
ORG;941;m;unknown;ug;22/03/2022 08:00;-3,25;I
"""


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "a.txt").write_text(DROP)
    (folder / "b.txt").write_text(DROP.replace("09:10", "10:10").replace("12,5", "13"))
    return folder


def test_hourly_drop(spark, drop):
    df = readers.read_hourly(spark, str(drop / "a.txt"))
    got = sorted((r["Station"], r["Constituant"], r["begin"], r["value"]) for r in df.collect())
    assert got == [
        ("940", "click", dt.datetime(2022, 3, 22, 6), None),
        ("940", "view", dt.datetime(2022, 3, 22, 6), 12.5),
        ("941", "unknown", dt.datetime(2022, 3, 22, 7), -3.25),
    ]


def test_meta_line_of_each_file(spark, drop):
    got = readers.read_hourly_meta(spark, str(drop)).collect()
    assert sorted((r["file"][-5:], r["time_upload"], r["freq"], r["comment"]) for r in got) == [
        ("a.txt", "2022-03-22 09:10", "60", "hourly"),
        ("b.txt", "2022-03-22 10:10", "60", "hourly"),
    ]


def test_drop_to_observations(spark, drop):
    touched = F.lit("2022-03-22 07:30:00").cast("timestamp")
    df = observations.ingest(readers.read_hourly(spark, str(drop / "a.txt")), adapter.mapping(spark), touched)
    assert [f.name for f in df.schema] == [f.name for f in schemas.OBSERVATIONS]
    rows = {r["sampling_point_id"]: r for r in df.collect()}
    # the hour that begins 08:00 (+01:00) had not ended
    assert set(rows) == {"SPO-AD0940A-8", "SPO-AD0940A-7"}
    r = rows["SPO-AD0940A-8"]
    assert (r["begin_position"], r["end_position"]) == ("2022-03-22T07:00:00+01:00", "2022-03-22T08:00:00+01:00")
    assert (r["verification_flag"], r["validation_flag"], r["import_value"]) == (3, 1, 12.5)


def test_newest_file(spark, drop):
    df = readers.latest_file(readers.read_hourly(spark, str(drop)))
    assert {r["file"][-5:] for r in df.collect()} == {"b.txt"}


def test_pollen_file(spark, tmp_path):
    path = tmp_path / "week.csv"
    path.write_text("700,POLLEN,Cupressus,27/09/2021,27/09/2021,1,0,2,138,3\n700,POLLEN,Alnus   ,28/09/2021,28/09/2021,6,0,1,138,3\n")
    rows = {r["species"]: r["measurement"] for r in pollen.pollen_clean(readers.read_pollen(spark, str(path))).collect()}
    assert rows == {"Cupressus": None, "Alnus": 6.0}


def test_dimensions_from_csv_and_parquet(spark, tmp_path):
    adapter.breaks(spark).write.parquet(str(tmp_path / "breaks.parquet"))
    adapter.bands(spark).coalesce(1).write.option("header", True).csv(str(tmp_path / "bands.csv"))
    dims = readers.load_dims(spark, str(tmp_path), ["breaks"])
    assert dims["breaks"].schema == schemas.AQI_BREAKS and dims["breaks"].count() == 6
    assert readers.read_dim(spark, str(tmp_path / "bands.csv"), schemas.BANDS).where("index = 6").first()["web_color"] == "#666666"


def sample(spark):
    return adapter.observations(adapter.read(spark, "/root/testdata/sf0.001", "events")).drop("seq")


def test_history_starts_empty_and_replaces_days(spark, tmp_path, rows):
    path = str(tmp_path / "history")
    assert readers.read_history(spark, path).count() == 0
    obs = observations.published_observations(sample(spark))
    writers.save_history(obs, path)
    stored = readers.read_history(spark, path)
    cols = [f.name for f in schemas.OBSERVATIONS]
    assert rows(stored, *cols) == rows(obs, *cols)
    day, before = stored.select(F.min("day")).first()[0], stored.count()
    changed = obs.where(F.to_date("from_time") == F.lit(day)).withColumn("value", F.lit(1.0))
    writers.save_history(changed, path)
    after = readers.read_history(spark, path)
    assert after.where(F.col("day") == F.lit(day)).where("value <> 1").count() == 0
    assert after.count() == before


def test_stored_series_and_sentinels(spark, tmp_path):
    path = str(tmp_path / "observations")
    writers.publish(writers.with_sentinels(sample(spark)), path, writers.STORED_TYPES)
    assert dict(spark.read.parquet(path).dtypes)["value"] == "decimal(38,5)"
    one = readers.read_observations(spark, path, "SPO-AD0940A-8")
    assert {r[0] for r in one.select("sampling_point_id").distinct().collect()} == {"SPO-AD0940A-8"}
    assert one.where("value IN (-999, -9900)").count() == 0 and one.where("value IS NULL").count() > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(sampling_point_id), EqualTo(sampling_point_id,SPO-AD0940A-8)]" in plan


def test_stored_table_by_name(spark, tmp_path):
    spark.sql(f"CREATE TABLE stored_obs USING parquet LOCATION '{tmp_path}/t' AS SELECT 'x' AS sampling_point_id, -999D AS value")
    try:
        assert readers.read_observations(spark, "stored_obs").first()["value"] is None
    finally:
        spark.sql("DROP TABLE stored_obs")


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    t = dt.datetime(2022, 3, 23, 9, 11)
    writers.log_run(spark, path, t, True, t, 280, t)
    writers.log_run(spark, path, t + dt.timedelta(hours=1), False, None, None, t)
    log = readers.read_ingest_log(spark, path).orderBy("time_begin")
    assert [(r["file_found"], r["rows"], r["error_script"]) for r in log.collect()] == [(True, 280, False), (False, None, False)]
    assert [r["error_script"] for r in writers.mark_failed(log).orderBy("time_begin").collect()] == [False, True]


def test_feed_document(spark, tmp_path):
    items = spark.createDataFrame([("T & U", "l", "l", "d", "p"), ("V", "l", "l", "d", "p")], "title string, link string, guid string, description string, pubDate string")
    path = str(tmp_path / "feed")
    writers.write_feed(items, path)
    back = spark.read.format("xml").option("rowTag", "rss").load(path).first()
    assert [r["title"] for r in back["channel"]["item"]] == ["T & U", "V"]


def test_append_new_dimension_rows(spark, tmp_path):
    path = str(tmp_path / "dims")
    spark.createDataFrame([(1, "a")], "id int, notation string").write.parquet(path)
    more = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, notation string")
    for _ in range(2):
        writers.append_new(more, spark.read.parquet(path), path, ["id"])
    assert spark.read.parquet(path).count() == 3


def test_columns_missing_in_one_load(spark):
    from brisa.operators.joins import stack

    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    assert sorted(tuple(r) for r in stack(a, b).collect()) == [(1, 2), (3, None)]


def test_a_sheet_is_numbered_over_blocks(spark, tmp_path):
    """A CSV sheet without positions gets them from its lines, also where a file is read in many blocks and tasks."""
    from brisa.operators.joins import lookup

    lines = ["code,name"] + [f"{n % 700},name {n}" for n in range(5000)]
    (tmp_path / "sheet.csv").write_text("\n".join(lines) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        sheet = readers.read_dim(spark, f"{tmp_path}/sheet.csv")
        assert sheet.columns == ["code", "name", "pos"]
        assert spark.read.csv(f"{tmp_path}/sheet.csv").rdd.getNumPartitions() > 8
        assert sorted((r["pos"], r["name"]) for r in sheet.collect()) == [(n + 1, f"name {n}") for n in range(5000)]
        codes = spark.createDataFrame([(str(c),) for c in (0, 5, 699, 1000)], "code string")
        found = {r["code"]: r["name"] for r in lookup(codes, sheet, "code", ["name"]).collect()}
        assert found == {"0": "name 0", "5": "name 5", "699": "name 699", "1000": None}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_sheet_keeps_its_own_positions(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("pos,code\n9,a\n4,b\n")
    sheet = readers.load_dims(spark, str(tmp_path), ["sheet"], "csv")["sheet"]
    assert sorted((r["pos"], r["code"]) for r in sheet.collect()) == [("4", "b"), ("9", "a")]


def test_the_feed_names_its_version(spark, tmp_path):
    items = spark.createDataFrame([("a", "b")], "title string, link string")
    writers.write_feed(items, f"{tmp_path}/feed")
    text = "".join(p.read_text() for p in (tmp_path / "feed").glob("part-*"))
    import xml.etree.ElementTree as ET

    root = ET.fromstring(text)
    assert root.tag == "rss" and root.attrib == {"version": "2.0"} and root.find("channel/item/title").text == "a"


def test_newest_times_are_kept(spark):
    """A kept table of newest times finds the same rows, and of a table by day only their days are read."""
    import datetime as dt

    from pyspark.sql import functions as F

    from brisa.operators.dedupe import latest_per_station, newest_times

    at = lambda d, h: dt.datetime(2024, 1, d, h)
    rows = [("a", at(1, 5), 1), ("a", at(1, 5), 2), ("b", at(3, 0), 3), ("b", at(2, 1), 4), ("c", at(9, 9), 5)]
    df = spark.createDataFrame(rows, "station string, date timestamp, v int")
    stored = newest_times(df.where("v <= 3"))
    newest = newest_times(df.where("v > 3"), stored=stored)
    by_day = df.withColumn("day", F.to_date(F.col("date") - F.expr("INTERVAL 1 HOUR")))
    for found in (latest_per_station(df), latest_per_station(df, newest=newest), latest_per_station(by_day, newest=newest)):
        assert sorted(r["v"] for r in found.collect()) == [1, 2, 3, 5]


def test_signs_of_life_say_the_index(spark):
    import datetime as dt

    from brisa.plans.alerts import unchanged_alerts, with_air_quality

    at = lambda h, m=0: dt.datetime(2024, 1, 8, h, m)
    alerts = spark.createDataFrame([(at(7, 10), "alive", "x"), (at(15, 10), "alive", "y"), (at(7, 10), "fail", "z")], "time timestamp, kind string, text string")
    country = spark.createDataFrame([(at(7), 3.7, "Fair"), (at(15), None, None)], "date timestamp, aqi double, band string")
    found = {(r["kind"], r["time"].hour): r["text"] for r in with_air_quality(alerts, country).collect()}
    assert found == {("alive", 7): "The air quality at 08/01/2024 08:10 is Fair, index 3 of 6.", ("alive", 15): "y", ("fail", 7): "z"}
    runs = spark.createDataFrame([(at(h), h != 3) for h in range(1, 6)], "time_begin timestamp, file_found boolean")
    published = spark.createDataFrame([(at(1), at(0)), (at(2), at(1)), (at(3), at(1)), (at(4), at(1)), (at(5), at(4))], "time_begin timestamp, last_update timestamp")
    assert [r["time"].hour for r in unchanged_alerts(runs, published).collect()] == [4]
