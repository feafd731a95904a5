"""Snapshots of a folder of tables: readers see whole states, dead runs leave none, days and batches are compacted."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from brisa.operators import dedupe
from brisa.plans import boards, publish
from brisa.sources import sites
from brisa.sources.writers import with_day
from brisa.streaming import deliveries
from checks import adapter
from checks.cases_rows import COLS


def frame(spark, rows, kinds="day date, v long"):
    return spark.createDataFrame(rows, kinds)


def day(n):
    return dt.date(2024, 1, n)


def days(spark, *numbers):
    return frame(spark, [(day(n),) for n in numbers], "day date")


def values(df):
    return sorted((r["day"].day, r["v"]) for r in df.collect())


def test_days_are_replaced_cleared_and_left_alone(spark, tmp_path):
    folder, like = str(tmp_path), frame(spark, [])
    with sites.changing(spark, folder) as change:
        assert change.days("t", like).count() == 0
        change.save_days("t", frame(spark, [(day(n), n) for n in (1, 2, 3)] + [(None, 9)]), rebuilt=days(spark, 1, 2, 3))
        assert values(change.days("t", like)) == [(1, 1), (2, 2), (3, 3)]
    files = set(sites.read(spark, folder, "t").inputFiles())
    with sites.changing(spark, folder) as change:
        change.save_days("t", frame(spark, [(day(2), 20), (day(4), 40)]), rebuilt=days(spark, 2, 3, 4))
    found = sites.read(spark, folder, "t")
    assert values(found) == [(1, 1), (2, 20), (4, 40)] and found.columns == ["v", "day"]
    # Of the first run only the day that nothing touched is opened.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len(files) == 3
    first = sites.committed(spark, folder, 0)
    assert values(sites.read(spark, folder, "t", first)) == [(1, 1), (2, 2), (3, 3)]


def test_a_dead_run_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    with sites.changing(spark, folder) as change:
        change.replace("a", frame(spark, [(day(1), 1)]))
        change.save_days("b", frame(spark, [(day(1), 1)]), rebuilt=days(spark, 1))
    with pytest.raises(RuntimeError), sites.changing(spark, folder) as change:
        change.replace("a", frame(spark, [(day(1), 2)]))
        change.save_days("b", frame(spark, [(day(1), 2)]), rebuilt=days(spark, 1))
        raise RuntimeError("killed")
    assert values(sites.read(spark, folder, "a")) == values(sites.read(spark, folder, "b")) == [(1, 1)]
    assert len(os.listdir(f"{folder}/a")) == 2
    sites.vacuum(spark, folder)
    assert len(os.listdir(f"{folder}/a")) == len(os.listdir(f"{folder}/b")) == 1
    assert values(sites.read(spark, folder, "a")) == [(1, 1)]


def test_of_two_runs_at_a_time_one_fails(spark, tmp_path):
    folder = str(tmp_path)
    one, other = sites.Change(spark, folder), sites.Change(spark, folder)
    one.replace("a", frame(spark, [(day(1), 1)]))
    other.replace("a", frame(spark, [(day(1), 2)]))
    one.commit()
    with pytest.raises(Exception, match="exist"):
        other.commit()
    assert values(sites.read(spark, folder, "a")) == [(1, 1)] and sites.commits(spark, folder) == [0]
    with pytest.raises(ValueError):
        sites.read(spark, folder, "b")


def test_a_reader_in_a_loop_sees_whole_states(spark, tmp_path):
    folder, done, seen = str(tmp_path), threading.Event(), []

    def write():
        try:
            for k in range(4):
                with sites.changing(spark, folder) as change:
                    change.replace("a", frame(spark, [(day(1), k)]))
                    change.save_days("b", frame(spark, [(day(n), k) for n in range(1, 4)]), rebuilt=days(spark, 1, 2, 3))
                    change.replace("c", frame(spark, [(day(1), k)]))
                sites.vacuum(spark, folder, keep=3)
        finally:
            done.set()

    writer = threading.Thread(target=write)
    writer.start()
    while not done.is_set() or not seen:
        at = sites.committed(spark, folder)
        if at.number >= 0:
            tables = {name: {v for _, v in values(sites.read(spark, folder, name, at))} for name in "abc"}
            assert tables["a"] == tables["b"] == tables["c"] and len(tables["a"]) == 1
            seen.append(at.number)
    writer.join()
    assert seen == sorted(seen) and sites.committed(spark, folder).number == 3


def test_batches_become_one_set_of_files_a_day(spark, tmp_path, rows):
    obs = adapter.obs(spark, "/root/testdata/sf0.001").where("from_time < '2024-01-04'").cache()
    odd = obs.limit(2).withColumn("from_time", F.lit(None).cast("timestamp"))
    kept, history = f"{tmp_path}/kept", f"{tmp_path}/history"
    parts = [obs.where(F.pmod("seq", F.lit(6)) == k) for k in range(6)]
    parts[1] = parts[1].unionByName(odd)
    write = deliveries.upsert_history(kept, history, compact_every=3)
    for k, part in enumerate(parts):
        write(part, k)
    state = sites.committed(spark, kept)
    assert state.notes["upto"] == 5 and len(state.tables["rows"]) == 3
    assert len(sites.read(spark, kept, "rows").inputFiles()) == 3  # one for each day
    want = rows(dedupe.latest_wins(obs), *COLS)
    assert rows(spark.read.schema(obs.schema).parquet(history), *COLS) == want
    # A batch that is run again, compacted or not, changes nothing; other rows under its number are refused.
    for k in (0, 1, 5):
        write(parts[k], k)
    assert rows(spark.read.schema(obs.schema).parquet(history), *COLS) == want
    like = with_day(obs)
    assert sites.Kept(spark, kept).all(like).count() == obs.count() + 2
    with pytest.raises(ValueError, match="another stream"):
        write(parts[0].withColumn("value", F.lit(1e6)), 0)
    write(parts[0].limit(0), 6)
    assert sites.Kept(spark, kept).all(like).count() == obs.count() + 2


def test_numbers_by_day_equal_a_numbering_of_everything(spark, rows):
    from brisa.operators.windows import assign_ids

    made = [(day(n), s, n * 10 + k) for n in (1, 2, 4) for k, s in enumerate(["a", "b", "c"][: 1 + n % 3])]
    table = spark.createDataFrame(made, "day date, station string, v long")
    offsets = boards.day_offsets(table.groupBy("day").agg(F.count("*").alias("rows")))
    numbered = boards.numbered_by_day(table, offsets, ["station"], "p")
    assert rows(numbered) == rows(assign_ids(table, ["day", "station"], "p"))
    fewer = boards.day_offsets(table.where("station <> 'c'").groupBy("day").agg(F.count("*").alias("rows")))
    assert [r["day"].day for r in boards.moved_days(offsets, fewer).collect()] == [4]
    assert boards.moved_days(offsets, offsets).count() == 0


def test_a_whole_site_equals_a_plain_one(spark, tmp_path, rows):
    """Also after a correction, of which only the days that it reaches are written; a reader of the commit before is not disturbed."""
    from test_publish import dimensions

    obs = adapter.obs(spark, "/root/testdata/sf0.001").drop("seq")
    as_of, dims, folder = F.lit("2024-01-31 00:00:00").cast("timestamp"), dimensions(spark), f"{tmp_path}/whole"
    late = (F.to_date("from_time") == "2024-01-10") & (F.col("validation_flag") == 1)
    publish.publish_site(obs.where(~late), dims, folder, as_of, whole=True)
    before = sites.committed(spark, folder)
    counts = {n: sites.read(spark, folder, n, before).count() for n in ("web_observations", "web_daily_aq_poll")}
    names = publish.publish_site(obs, dims, folder, as_of, obs.where(late).select(F.to_date("from_time").alias("day")), whole=True)
    after = sites.committed(spark, folder)
    publish.publish_site(obs, dims, f"{tmp_path}/plain", as_of)
    for name in names:
        plain = spark.read.parquet(f"{tmp_path}/plain/{name}")
        columns = [f"`{c}`" for c in sorted(plain.columns)]
        assert rows(plain, *columns) == rows(sites.read(spark, folder, name, after), *columns), name
    assert counts == {n: sites.read(spark, folder, n, before).count() for n in counts}
    for name in ("indices", "web_daily_aq_poll"):
        changed = [d for d, run in after.tables[name].items() if before.tables[name].get(d) != run]
        assert 0 < len(changed) <= 3
