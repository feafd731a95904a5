"""The whole publication from observations to tables."""

import json

from pyspark.sql import functions as F

from brisa.functions import text
from brisa.plans import publish
from brisa.sources import readers
from checks import adapter
from checks.cases_boards import MESSAGES


def dimensions(spark):
    names = ["NO2", "O3", "PM10", "PM2.5", "SO2"]
    expected = {}
    for station, pollutant in adapter.PAIRS:
        expected.setdefault(station, set()).add(pollutant)
    matrix = spark.createDataFrame([(s, *[int(n in e) for n in names]) for s, e in expected.items()], ["station", *names])
    stations = adapter.stations(spark)
    for family in ("web_type_", "web_ubicacio_", "web_comentaris_"):
        stations = stations.withColumns({family + x: F.lit(family + x) for x in text.LOCALES})
    return publish.Dimensions(
        mapping=adapter.mapping(spark),
        breaks=adapter.breaks(spark),
        bands=adapter.bands(spark),
        stations=stations,
        pollutants_stations=matrix,
        colors=spark.createDataFrame([("#123456",)], "x string"),
        inversion_messages=MESSAGES,
        more_info_url="https://example.org/more",
        low_station="AD0940A",
        high_station="AD0941A",
    )


def test_every_table_is_written(spark, tmp_path):
    obs = adapter.obs(spark, "/root/testdata/sf0.01").drop("seq")
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    names = publish.publish_site(obs, dimensions(spark), str(tmp_path), as_of)
    assert len(names) == 16
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in names}
    counts = {n: t.count() for n, t in tables.items()}
    assert counts["web_latest_data"] == len(adapter.PAIRS) and counts["web_latest_data_lang"] == 3 * len(adapter.PAIRS)
    assert counts["web_map_lang"] == 3 * counts["web_map"] and counts["web_utils"] == 3
    assert counts["web_daily_aq_poll_lang"] == 3 * counts["web_daily_aq_poll"]
    assert counts["web_daily_aq_global"] == 30 or counts["web_daily_aq_global"] == 31
    assert tables["web_observations"].where("value IS NULL").count() == 0
    ids = {r["id"] for r in tables["web_daily_aq_poll"].select("id").collect()}
    assert ids == {f"pAQ{n + 1}" for n in range(counts["web_daily_aq_poll"])}
    assert set(tables["web_utils"].columns) >= {"last_update", "old_data_bool", "inversion_message", "count_h", "lang"}
    assert json.loads(tables["web_map"].limit(1).toJSON().first())["station_id"].startswith("AD094")


def test_a_second_run_gives_the_same_tables(spark, tmp_path, rows):
    obs = adapter.obs(spark, "/root/testdata/sf0.001").drop("seq")
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    dims = dimensions(spark)
    for folder in ("a", "b"):
        publish.publish_site(obs.repartition(5) if folder == "b" else obs, dims, f"{tmp_path}/{folder}", as_of)
    for name in ("web_observations", "web_map", "web_latest_data", "web_daily_aq_poll", "web_daily_aq_global_lang", "web_utils"):
        a, b = (spark.read.parquet(f"{tmp_path}/{f}/{name}") for f in ("a", "b"))
        assert rows(a, *sorted(a.columns)) == rows(b, *sorted(a.columns)), name


def test_publishing_only_changed_days_equals_publishing_everything(spark, tmp_path, rows):
    obs = adapter.obs(spark, "/root/testdata/sf0.01").drop("seq")
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    dims = dimensions(spark)
    late = F.to_date("from_time").isin("2024-01-09", "2024-01-10", "2024-01-30") & (F.col("validation_flag") == 1)
    publish.publish_site(obs, dims, f"{tmp_path}/whole", as_of)
    publish.publish_site(obs.where(~late), dims, f"{tmp_path}/steps", as_of)
    kept = {f for f in spark.read.parquet(f"{tmp_path}/steps/indices").inputFiles()}
    days = obs.where(late).select(F.to_date("from_time").alias("day"))
    names = publish.publish_site(obs, dims, f"{tmp_path}/steps", as_of, days)
    for name in [*names, "indices", "daily", "extents"]:
        a, b = (spark.read.parquet(f"{tmp_path}/{f}/{name}") for f in ("whole", "steps"))
        columns = [f"`{c}`" for c in sorted(a.columns)]
        assert rows(a, *columns) == rows(b, *columns), name
    # most days were not written again
    assert len(kept & set(spark.read.parquet(f"{tmp_path}/steps/indices").inputFiles())) > len(kept) / 2


def test_stored_observations_keep_their_schema(spark, tmp_path):
    obs = adapter.obs(spark, "/root/testdata/sf0.001").drop("seq")
    publish.publish_site(obs, dimensions(spark), str(tmp_path), F.lit("2024-01-31 00:00:00").cast("timestamp"))
    stored = readers.clean_sentinels(readers.read_history(spark, f"{tmp_path}/web_observations"))
    assert stored.where("value IS NULL").count() > 0


def _site(spark, obs, folder, days=None):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    names = publish.publish_site(obs, dimensions(spark), str(folder), as_of, days)
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def _same(rows, a, b):
    for name in a:
        columns = [f"`{c}`" for c in sorted(a[name].columns)]
        assert rows(a[name], *columns) == rows(b[name], *columns), name


def test_a_withdrawn_day_leaves_every_table(spark, tmp_path, rows):
    obs = adapter.obs(spark, "/root/testdata/sf0.001").drop("seq")
    gone = F.to_date("from_time") == "2024-01-10"
    corrected = obs.withColumn("value", F.when(gone, F.lit(-50.0)).otherwise(F.col("value")))
    _site(spark, obs, tmp_path / "steps")
    steps = _site(spark, corrected, tmp_path / "steps", obs.where(gone).select(F.to_date("from_time").alias("day")))
    _same(rows, steps, _site(spark, corrected, tmp_path / "fresh"))
    # A whole publication also drops days that no delivery has any more.
    _same(rows, _site(spark, obs.where(~gone), tmp_path / "steps"), _site(spark, obs.where(~gone), tmp_path / "less"))


def test_a_first_publication_without_a_plausible_row(spark, tmp_path):
    obs = adapter.obs(spark, "/root/testdata/sf0.001").drop("seq").withColumn("value", F.lit(-50.0))
    tables = _site(spark, obs, tmp_path)
    assert tables["web_daily_aq_poll"].count() == 0 and tables["web_observations"].count() > 0


def test_the_last_update_is_that_of_the_running_means(spark, tmp_path):
    """Particles without a value for the last hours still have a running mean then."""
    hours = spark.range(24).select(F.expr("timestamp'2024-01-30 00:00:00' + make_dt_interval(0, id)").alias("t"), "id")
    obs = hours.select(
        F.lit("SPO-AD0940A-5").alias("sampling_point_id"), F.lit("").alias("begin_position"), F.lit("").alias("end_position"),
        F.when(F.col("id") < 20, F.lit(10.0)).alias("value"), F.lit(3).alias("verification_flag"), F.lit(1).alias("validation_flag"),
        F.expr("t + interval 2 hours").alias("touched"), F.col("t").alias("from_time"), F.expr("t + interval 1 hour").alias("to_time"),
        F.lit(None).cast("double").alias("import_value"),
    )
    row = _site(spark, obs, tmp_path)["web_utils"].first()
    assert str(row["last_update"]) == "2024-01-31 01:00:00" and row["old_data_bool"] is False


def test_nothing_is_left_behind(spark, tmp_path):
    import os

    from brisa.session import shared_folder

    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    _site(spark, adapter.obs(spark, "/root/testdata/sf0.001").drop("seq"), tmp_path)
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before


def test_one_run_writes_everything(spark, tmp_path):
    from brisa.plans import job

    sf = "/root/testdata/sf0.01"
    raw = adapter.pollen(spark, sf).where("start_date LIKE '%/01/2024'")
    old = spark.createDataFrame([], "measurement_date date, species string, measurement double, load_seq bigint")
    week = job.Pollen(raw, old, 1, adapter.pollen_thresholds(spark), adapter.pollen_names(spark))
    log = adapter.runlog(spark, sf).where("feed = 'view'")
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    obs = adapter.obs(spark, sf).drop("seq")
    names = job.run_site(obs, dimensions(spark), str(tmp_path), as_of, "Andorra", "https://example.org/", week=week, log=log)
    assert names[-5:] == ["message", "feed", "pollen_levels", "pollen_history", "alerts"]
    assert "Andorra" in spark.read.parquet(f"{tmp_path}/message").first()["message"]
    channel = spark.read.format("xml").option("rowTag", "rss").load(f"{tmp_path}/feed").first()["channel"]
    assert channel["item"][0]["link"] == "https://example.org/"
    assert all(spark.read.parquet(f"{tmp_path}/{n}").count() > 0 for n in names[-3:])


def test_the_feed_of_silent_analysers_keeps_its_last_update(spark, tmp_path):
    """Temperatures go on for days after the last concentration, which is then the last update, not the present time."""
    from brisa.plans import job

    hours = spark.range(5 * 24).select(F.expr("timestamp'2024-01-25 00:00:00' + make_dt_interval(0, id)").alias("t"), "id")
    series = F.explode(F.when(F.col("id") < 24, F.array(F.lit("SPO-AD0940A-5"), F.lit("SPO-AD0940A-9054"))).otherwise(F.array(F.lit("SPO-AD0940A-9054"))))
    obs = hours.select("t", "id", series.alias("sampling_point_id")).select(
        "sampling_point_id", F.lit("").alias("begin_position"), F.lit("").alias("end_position"),
        F.lit(10.0).alias("value"), F.lit(3).alias("verification_flag"), F.lit(1).alias("validation_flag"),
        F.expr("t + interval 2 hours").alias("touched"), F.col("t").alias("from_time"), F.expr("t + interval 1 hour").alias("to_time"),
        F.lit(None).cast("double").alias("import_value"),
    )
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    job.run_site(obs, dimensions(spark), str(tmp_path), as_of, "Andorra", "https://example.org/")
    assert str(spark.read.parquet(f"{tmp_path}/web_utils").first()["last_update"]).startswith("2024-01-26 0")
    items = spark.read.format("xml").option("rowTag", "rss").load(f"{tmp_path}/feed").first()["channel"]["item"]
    assert {i["pubDate"][:16] for i in items} == {"Fri, 26 Jan 2024"}
