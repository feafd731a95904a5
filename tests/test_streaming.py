"""Streams equal their batch results, also over several batches and replays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa.operators import dedupe, filters
from brisa.plans import alerts, observations
from brisa.streaming import aggregates, deliveries
from checks import adapter, frames
from checks.cases_rows import COLS

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def obs(spark):
    return frames.kept(spark, FOLDER).cache()


def split(obs, path, parts=3):
    """Write observations as one file per part of the deliveries, in order of arrival."""
    for k in range(parts):
        obs.where(F.col("seq") % parts == k).coalesce(1).write.mode("append").parquet(f"{path}/{k}")


def stream(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_files_are_read_once_and_archived(spark, tmp_path):
    drop, archive = tmp_path / "drop", tmp_path / "archive"
    drop.mkdir()
    lines = "up;a;b;60;c\nOrganisme;Station;Mesure;Constituant;Unite;Date;Valeur;Etat\n"

    def deliver(name, value):
        (drop / name).write_text(lines + f"ORG;940;m;view;ug;22/03/2022 07:00;{value};A\n")

    def run():
        rows = deliveries.stream_drop(spark, str(drop), str(archive), 1)
        touched = F.lit("2022-03-22 12:00:00").cast("timestamp")
        obs = observations.to_observations(rows, adapter.mapping(spark), touched)
        writer = obs.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check"))
        writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return sorted(r["value"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    deliver("a.txt", "1,5")
    deliver("b.txt", "2,5")
    assert run() == [1.5, 2.5]
    deliver("c.txt", "3,5")
    assert run() == [1.5, 2.5, 3.5]
    assert list(archive.rglob("a.txt")) and not (drop / "a.txt").exists()


def test_late_corrections_and_replay(spark, obs, tmp_path, rows):
    source, kept, history = (str(tmp_path / n) for n in ("source", "kept", "history"))
    split(obs, source)
    want = rows(dedupe.latest_wins(obs), *COLS)
    for checkpoint in ("first", "again"):  # the second run replays every batch
        query = deliveries.ingest_stream(
            stream(spark, obs.schema, source), kept, history, str(tmp_path / checkpoint)
        )
        query.awaitTermination()
        assert rows(spark.read.schema(obs.schema).parquet(history), *COLS) == want
    assert spark.read.parquet(kept).count() == obs.count()


def test_batches_leave_other_days_alone(spark, obs, tmp_path):
    kept, history = str(tmp_path / "kept"), str(tmp_path / "history")
    upsert = deliveries.upsert_history(kept, history)
    days = F.to_date("from_time")
    upsert(obs.where(days == "2024-01-03"), 0)
    files = {f for f in spark.read.parquet(history).inputFiles()}
    upsert(obs.where(days == "2024-01-05"), 1)
    assert files < set(spark.read.parquet(history).inputFiles())


def test_running_mean_of_closed_hours(spark, obs, tmp_path, rows):
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    for k in range(3):  # each file holds ten days of hours
        first = F.lit("2024-01-01").cast("date")
        part = F.floor(F.datediff(F.to_date("from_time"), first) / 10) == k
        obs.where(part).coalesce(1).write.parquet(f"{source}/{k}")
    deliveries.configure_streaming(spark)
    means = aggregates.stream_running_mean(stream(spark, obs.schema, source), delay="24 days", seq="seq")
    writer = means.writeStream.outputMode("append").format("parquet")
    writer = writer.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True)
    writer.start(out).awaitTermination()
    got = spark.read.schema(means.schema).parquet(out)
    assert got.count() > 0
    clean = filters.plausible(dedupe.clean_observations(obs, seq="seq"))
    from brisa.operators.windows import running_mean

    batch = running_mean(clean, 24, ["sampling_point_id"], "to_time").select(
        "sampling_point_id", F.col("to_time").alias("date"), "value"
    )
    last = got.select(F.max("date")).first()[0]
    assert rows(got) == rows(batch.where(F.col("date") <= F.lit(last)))


def test_alerts_over_batches(spark, tmp_path, rows):
    log = adapter.runlog(spark, FOLDER).cache()
    out = str(tmp_path / "alerts")
    write = deliveries.alert_batches(str(tmp_path / "log"), out, ["feed"])
    day = F.datediff(F.to_date("time_begin"), F.lit("2024-01-01").cast("date"))
    for k in range(3):
        batch = log.where(F.floor(day / 10) == k)
        write(batch, k)
        write(batch, k)  # a replayed batch changes nothing
    cols = ("feed", "time", "kind", "text")
    assert rows(spark.read.parquet(out), *cols) == rows(alerts.ingest_alerts(log, ["feed"]), *cols)


def test_daily_worst_over_batches(spark, tmp_path, rows):
    from brisa.operators.aggregates import daily_worst

    index = frames.index(spark, FOLDER).cache()
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    for k in range(2):
        index.where(F.hour("date") % 2 == k).coalesce(1).write.parquet(f"{source}/{k}")
    worst = aggregates.stream_daily_worst(stream(spark, index.schema, source))

    def keep(batch, batch_id):
        deliveries.keep_batch(batch, batch_id, out, partitions=())

    writer = worst.writeStream.outputMode("update").foreachBatch(keep)
    writer = writer.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True)
    writer.start().awaitTermination()
    got = spark.read.parquet(out).groupBy("day", "station", "pollutant").agg(F.max("index").alias("index"))
    cols = ("day", "station", "pollutant", "index")
    assert rows(got, *cols) == rows(daily_worst(index), *cols)


def test_delivery_time_is_the_file_time(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("ORG;940;m;view;ug;22/03/2022 07:00;1;A\n")
    rows = deliveries.stream_drop(spark, str(tmp_path / "d")).withColumn("touched", deliveries.delivery_time())
    writer = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    touched = spark.read.parquet(str(tmp_path / "out")).first()["touched"]
    assert abs(touched - dt.datetime.fromtimestamp((tmp_path / "d" / "a.txt").stat().st_mtime)) < dt.timedelta(seconds=2)


def test_an_alert_batch_reads_only_the_last_runs(spark, tmp_path):
    log = adapter.runlog(spark, FOLDER).cache()
    write = deliveries.alert_batches(str(tmp_path / "log"), str(tmp_path / "alerts"), ["feed"])
    for k in range(3):
        write(log.where(F.floor(F.datediff(F.to_date("time_begin"), F.lit("2024-01-01").cast("date")) / 10) == k), k)
    kept = spark.read.parquet(f"{tmp_path}/log/last")
    assert kept.groupBy("batch_id").count().where(f"count > {log.select('feed').distinct().count()}").count() == 0


def test_rows_without_a_time_do_not_stop_the_history(spark, tmp_path):
    from brisa.operators.dedupe import latest_wins

    obs = adapter.obs(spark, FOLDER)
    odd = obs.limit(3).withColumn("from_time", F.lit(None).cast("timestamp"))
    write = deliveries.upsert_history(str(tmp_path / "kept"), str(tmp_path / "history"))
    write(odd, 0)
    write(obs.unionByName(odd), 1)
    write(obs.limit(0), 2)
    history = spark.read.parquet(f"{tmp_path}/history")
    assert history.where("from_time IS NULL").count() == 0
    assert history.count() == latest_wins(obs).count() > 0


def hours(spark, rows):
    """Deliveries (series, hour of January, value, hours until delivery) as observations."""
    start = dt.datetime(2024, 1, 1)
    made = [
        (s, start + dt.timedelta(hours=h), start + dt.timedelta(hours=h + 1), start + dt.timedelta(hours=h + late), v, 3, seq)
        for seq, (s, h, v, late) in enumerate(rows)
    ]
    kinds = "sampling_point_id string, from_time timestamp, to_time timestamp, touched timestamp, value double, verification_flag int, seq long"
    return spark.createDataFrame(made, kinds)


def run_changes(spark, tmp_path, batches, transform, name="out"):
    """All changes of a stream over one file per batch, with their batch."""
    deliveries.configure_streaming(spark)
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}-in")
    rows = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}-in")
    out = transform(rows)

    def keep(batch, batch_id):
        deliveries.keep_batch(batch, batch_id, f"{tmp_path}/{name}", partitions=())

    writer = out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/{name}-check")
    writer.trigger(availableNow=True).start().awaitTermination()
    return deliveries.kept_batches(spark.createDataFrame([], out.schema), f"{tmp_path}/{name}")


def test_a_mean_follows_corrections(spark, tmp_path):
    """A correction changes the 24 means that hold its hour, a worse delivery none, and an implausible one takes its hour back."""
    first = hours(spark, [("SPO-AD0940A-5", h, 24.0, 2) for h in range(60)])
    batches = [
        first,
        hours(spark, [("SPO-AD0940A-5", 20, 48.0, 9)]),
        hours(spark, [("SPO-AD0940A-5", 20, 99.0, 1)]),
        hours(spark, [("SPO-AD0940A-5", 59, -50.0, 9)]),
    ]
    changes = run_changes(spark, tmp_path, batches, lambda s: aggregates.stream_means(s, delay="24 days", seq="seq"))
    found = {k: sorted((r["date"], r["value"], r["observed"]) for r in changes.where(F.col("batch_id") == k).collect()) for k in range(4)}
    start = dt.datetime(2024, 1, 1)
    assert len(found[0]) == 60 and found[0][16][1] is None and found[0][17][1] == 24.0
    assert found[1] == [(start + dt.timedelta(hours=h), 25.0, True) for h in range(21, 45)]
    assert found[2] == [] and found[3] == [(start + dt.timedelta(hours=60), 24.0, False)]


def test_means_over_chunks_and_widths(spark, tmp_path, rows):
    """Chunks of two days hand their last hours on, also when those are corrected after the next chunk has begun."""
    from brisa.operators.windows import running_mean

    first = [(s, h, float(h % 17), 2) for s in ("SPO-AD0940A-5", "SPO-AD0941A-5") for h in range(150)]
    later = [(s, h, float(h % 5) + 100, 20) for s in ("SPO-AD0940A-5",) for h in (46, 47, 48, 95, 149)]
    obs = hours(spark, first + later)
    batches = [obs.where("seq < 220"), obs.where("seq >= 220 and seq < 300"), obs.where("seq >= 300")]
    for width in (8, 24):
        changes = run_changes(spark, tmp_path, batches, lambda s, w=width: aggregates.stream_means(s, w, seq="seq", chunk_hours=48), f"w{width}")
        last = changes.groupBy("sampling_point_id", "date").agg(F.max_by(F.struct("value"), "batch_id").alias("r")).select("sampling_point_id", "date", "r.value")
        clean = filters.plausible(dedupe.clean_observations(obs, seq="seq"))
        batch = running_mean(clean, width, ["sampling_point_id"], "to_time").select("sampling_point_id", F.col("to_time").alias("date"), "value")
        assert rows(last) == rows(batch)


def test_a_closed_mean_needs_no_further_delivery_of_its_series(spark, tmp_path):
    """The hours of a series that has ended go out by their timers, as other series move the watermark on."""
    batches = [
        hours(spark, [("SPO-AD0940A-5", h, 24.0, 2) for h in range(30)]),
        hours(spark, [("SPO-AD0941A-5", 200, 1.0, 2)]),
    ]
    deliveries.configure_streaming(spark)
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream_ = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    means = aggregates.stream_running_mean(stream_, delay="2 days", seq="seq")
    writer = means.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/check")
    writer.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    got = spark.read.schema(means.schema).parquet(f"{tmp_path}/out").collect()
    assert sorted(r["date"] for r in got) == [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h + 1) for h in range(30)]


def test_the_daily_worst_falls_and_goes(spark, tmp_path):
    day = dt.datetime(2024, 1, 10)
    kinds = "station string, date timestamp, pollutant string, index double, observed boolean"

    def at(*hours_):
        return spark.createDataFrame([("S", day + dt.timedelta(hours=h), "NO2", i, o) for h, i, o in hours_], kinds)

    batches = [at((1, 2.0, True), (2, 5.0, True)), at((2, 3.0, True)), at((1, 2.5, True)), at((2, 3.0, False)), at((1, None, True)), at((1, None, False))]
    changes = run_changes(spark, tmp_path, batches, aggregates.stream_daily_worst)
    found = [(r["batch_id"], r["index"], r["gone"]) for r in changes.orderBy("batch_id").collect()]
    assert found == [(0, 5.0, False), (1, 3.0, False), (3, 2.5, False), (4, None, False), (5, None, True)]


def test_silence_is_found_without_a_file(spark, tmp_path):
    """The clock alone raises the alert; the next run gives the end of it."""
    import time

    deliveries.configure_streaming(spark)
    kinds = "feed string, time_begin timestamp, file_found boolean, error_script boolean"

    def run(hour):
        spark.createDataFrame([("f", dt.datetime(2024, 1, 6, hour, 30), True, False)], kinds).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    run(1)
    stream_ = spark.readStream.schema(kinds).parquet(f"{tmp_path}/in")
    found = deliveries.stream_alerts(stream_, ["feed"], patience=0.05, by_clock=True)
    query = found.writeStream.outputMode("update").format("memory").queryName("silence").option("checkpointLocation", f"{tmp_path}/check")
    query = query.trigger(processingTime="1 second").start()
    try:
        def kinds_now():
            return [r["kind"] for r in spark.table("silence").orderBy("time").collect()]

        end = time.time() + 60
        while "no_data" not in kinds_now() and time.time() < end:
            time.sleep(0.5)
        assert kinds_now() == ["no_data"]
        run(2)
        while "restablished" not in kinds_now() and time.time() < end:
            time.sleep(0.5)
        assert "restablished" in kinds_now()
    finally:
        query.stop()


def test_runs_that_come_late_or_not_at_all(spark, tmp_path):
    kinds = "feed string, time_begin timestamp, file_found boolean, error_script boolean"

    def at(*runs):
        return spark.createDataFrame([(f, dt.datetime(2024, 1, 6, h), found, False) for f, h, found in runs], kinds)

    batches = [at(("a", 1, True), ("b", 1, True), ("a", 3, True)), at(("a", 2, False), ("a", 4, True)), at(("a", 12, True)), at(("b", 13, True), (None, 13, True))]
    changes = run_changes(spark, tmp_path, batches, lambda s: deliveries.stream_alerts(s, ["feed"], patience=180, delay="6 hours"))
    found = sorted((r["feed"], r["time"].hour, r["kind"]) for r in changes.collect())
    # Feed b is silent from 4 on, found by the time of feed a; feed a's gap from 4 to 12 is found by its own next run.
    assert found == [("a", 2, "no_data"), ("a", 7, "no_data"), ("a", 12, "restablished"), ("b", 4, "no_data"), ("b", 13, "restablished")]
