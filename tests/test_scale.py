"""Hot keys, chunked windows and plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brisa.operators import dedupe, joins, windows
from brisa.plans import observations
from checks import adapter, frames

T0 = dt.datetime(2022, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df) -> str:
    df.collect()
    return plan_of(df)


@pytest.fixture
def tiny_partitions(spark):
    """Thresholds so low that the skew handling shows on test data, and no broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=60_000):
    """A third of all rows belongs to one series and hour, the rest to many."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("S"), key.cast("string")).alias("sampling_point_id"),
        F.lit(T0).alias("from_time"),
        F.lit(T0).alias("to_time"),
        F.lit(T0).alias("touched"),
        F.lit(3).alias("verification_flag"),
        F.rand(7).alias("value"),
        F.col("id").alias("seq"),
    )


def test_hot_key_is_split_when_ties_are_kept(spark, tiny_partitions):
    df = dedupe.latest_wins(hot(spark))
    assert "skew=true" in run_plan(df)
    assert df.count() == 60_000


def test_hot_key_is_split_in_a_lookup_beyond_the_broadcast_bound(spark, tiny_partitions):
    dim = spark.range(0, 60_000).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("k"), F.col("id").alias("name")
    )
    df = joins.lookup(hot(spark), dim, ("sampling_point_id", "k"), ["name"], "k")
    assert "skew=true" in run_plan(df)
    assert df.where("name IS NULL").count() == 0


def test_hot_key_is_split_in_an_anti_join(spark, tiny_partitions):
    rows = hot(spark)
    stored = rows.where("seq % 3 = 1").unionByName(rows.where("seq % 3 = 1"))
    df = joins.new_rows(rows, stored, ["sampling_point_id", "from_time"])
    assert "skew=true" in run_plan(df)
    assert df.count() == 40_000


def test_measured_small_partitions_are_hashed_not_sorted(spark, tiny_partitions):
    assert "ShuffledHashJoin" in run_plan(dedupe.latest_wins(hot(spark)))


def test_hot_key_reaches_the_shuffle_combined(spark):
    plan = plan_of(dedupe.clean_observations(hot(spark), seq="seq"))
    assert plan.index("partial_max(") > plan.index("Exchange hashpartitioning")  # printed top down
    assert plan.count("Exchange") == 1


def brute_mean(values, hour, width, need):
    window = [v for h, v in values.items() if hour - width < h <= hour and v is not None]
    if len(window) < need:
        return None
    return float(round(sum(window) / len(window)))


@pytest.mark.parametrize("width,chunk", [(24, 24), (24, 100), (8, 8), (8, 744)])
def test_chunked_running_mean_is_exact(spark, width, chunk):
    rng = random.Random(5)
    data = {}
    for s in "ab":
        data[s] = {h: (None if rng.random() < 0.1 else float(rng.randint(-5, 90))) for h in range(500) if rng.random() < 0.9}
    rows = [(s, "p", T0 + dt.timedelta(hours=h), v) for s, hours in data.items() for h, v in hours.items()]
    df = spark.createDataFrame(rows, "station string, pollutant string, date timestamp, value double").repartition(7)
    got = windows.running_mean(df, width, chunk_hours=chunk, out="mean").collect()
    assert len(got) == len(rows)
    for r in got:
        hour = round((r["date"] - T0).total_seconds() / 3600)
        assert r["mean"] == brute_mean(data[r["station"]], hour, width, -(-width * 3 // 4)), (r, hour)


def test_running_mean_refuses_chunks_shorter_than_its_width(spark):
    with pytest.raises(ValueError):
        windows.running_mean(spark.createDataFrame([], "station string, pollutant string, date timestamp, value double"), 24, chunk_hours=10)


@pytest.mark.parametrize("chunk", [1, 7, 744])
def test_previous_value_across_chunks(spark, chunk):
    rng = random.Random(3)
    hours = sorted(rng.sample(range(2000), 300))
    log = [(feed, T0 + dt.timedelta(hours=h), rng.choice([True, False, None])) for feed in ("a", None) for h in hours]
    df = spark.createDataFrame(log, "feed string, time_begin timestamp, file_found boolean")
    want, last = {}, {}
    for feed, t, found in log:
        want[feed, t] = last.get(feed)
        last[feed] = found
    got = windows.with_previous(df, "file_found", "previous", keys=["feed"], chunk_hours=chunk).collect()
    assert {(r["feed"], r["time_begin"]): r["previous"] for r in got} == want


@pytest.mark.parametrize("chunk", [1, 50])
def test_latest_value_across_chunks(spark, chunk):
    rows = [(T0 + dt.timedelta(hours=h), (h if h % 7 == 3 else None)) for h in range(0, 400, 2)]
    df = spark.createDataFrame(rows, "time_begin timestamp, x int")
    got = {r["time_begin"]: r["last"] for r in windows.with_latest(df, "x", "last", chunk_hours=chunk).collect()}
    seen, want = None, {}
    for t, x in rows:
        seen = x if x is not None else seen
        want[t] = seen
    assert got == want


def test_ids_are_dense_over_a_hot_order_prefix(spark):
    df = spark.range(0, 20_000, 1, 8).select(F.lit(1).alias("same"), (F.col("id") * 7919 % 20_000).alias("k"))
    got = windows.assign_ids(df, [F.col("same"), F.col("k").desc()], None, start=100).collect()
    assert sorted((r["id"], r["k"]) for r in got) == [(101 + n, 19_999 - n) for n in range(20_000)]


def test_dimension_of_unknown_size_is_counted_before_it_is_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    assert "BroadcastHashJoin" in plan_of(joins.lookup(spark.range(10), rows, ("id", "k"), ["name"], "name"))
    monkeypatch.setattr(joins, "DIMENSION_ROWS", 1)
    assert "SortMergeJoin" in plan_of(joins.lookup(spark.range(10), rows, ("id", "k"), ["name"], "name"))


def test_plans_have_no_cross_join_and_no_python(spark):
    folder = "/root/testdata/sf0.001"
    index = frames.index(spark, folder)
    for df in (index, frames.current(spark, folder), dedupe.latest_per_station(frames.conc(spark, folder))):
        plan = plan_of(df)
        assert not any(word in plan for word in ("Cartesian", "NestedLoop", "Python", "Pandas"))


def test_index_shuffles_twice(spark):
    """One exchange to settle deliveries and one for all running means; the dimensions are broadcast."""
    plan = plan_of(frames.index(spark, "/root/testdata/sf0.001"))
    facts = [line for line in plan.splitlines() if "Exchange hashpartitioning(sampling_point_id" in line or "Exchange hashpartitioning(station" in line]
    assert len(facts) == 2 and "SortMergeJoin" not in plan


def test_scan_reads_only_what_an_index_needs(spark):
    plan = plan_of(frames.index(spark, "/root/testdata/sf0.001"))
    assert "props" not in plan


def test_recent_rows_prune_stored_days(spark, tmp_path):
    from brisa.sources import readers, writers

    path = str(tmp_path / "history")
    obs = observations.published_observations(adapter.obs(spark, "/root/testdata/sf0.001").drop("seq"))
    writers.save_history(obs, path)
    stored = readers.read_history(spark, path)
    current = observations.current_indices(stored, adapter.mapping(spark), adapter.breaks(spark))
    assert "PartitionFilters: [isnotnull(day" in plan_of(current)
    whole = observations.pollutant_indices(stored, adapter.mapping(spark), adapter.breaks(spark))
    last = dedupe.at_latest(whole)
    assert sorted(map(tuple, current.collect())) == sorted(map(tuple, last.collect()))


def test_a_lookup_needs_the_order_of_its_table(spark):
    import pytest

    dim = spark.createDataFrame([(2, 1, "a"), (1, 1, "b")], "pos int, k int, name string")
    assert joins.lookup(spark.range(1, 2), dim, ("id", "k"), ["name"]).first()["name"] == "b"
    with pytest.raises(ValueError):
        joins.lookup(spark.range(1), dim.drop("pos"), ("id", "k"), ["name"])


def test_rows_without_a_day_are_on_no_day(spark):
    from brisa.operators.filters import on_days

    rows = spark.createDataFrame([(1, "2024-01-01"), (2, None), (3, "2024-01-03")], "k int, d string").selectExpr("k", "CAST(d AS date) AS day")
    for extra in (0, 20_000):  # there is no number of days at which this changes
        more = spark.range(extra).selectExpr("date_add(date'1900-01-01', CAST(id AS int)) AS day")
        days = rows.where("k < 3").select("day").union(more)
        assert [r["k"] for r in on_days(rows, days).collect()] == [1]


def test_values_that_are_no_numbers_count_as_missing(spark):
    rows = spark.range(48).selectExpr(
        "'s' AS station", "'PM10' AS pollutant", "timestamp'2024-01-01' + make_dt_interval(0, CAST(id AS int)) AS date",
        "CASE id WHEN 24 THEN 1e13D WHEN 25 THEN double('NaN') WHEN 26 THEN double('Infinity') ELSE 10D END AS value",
    )
    means = [r["value"] for r in windows.running_mean(rows, 24).orderBy("date").collect()]
    assert means[17:] == [10.0] * 31
