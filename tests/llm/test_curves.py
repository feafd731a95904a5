"""Hilbert-curve neighbours against brute force: recall, exact scores and order, copies, ties and rows that take no part."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brisa.llm import curves, queries

SCHEMA = "vec_id long, embedding array<float>, label int, class string, vec string, lead string, dim string, rank string, score string"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], 0, *["x"] * 6) for i, v in rows], SCHEMA).repartition(parts)


def takes_part(i, v):
    return i is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)


def brute(rows, asked, k=10):
    items = sorted({(i, tuple(float(np.float32(x)) for x in v)) for i, v in rows if takes_part(i, v)})
    out = {}
    for i, v in items:
        if asked(i):
            away = sorted((math.dist(v, w), j) for j, w in items if (j, w) != (i, v) and len(w) == len(v))
            out.setdefault(i, []).extend((rank, j, d) for rank, (d, j) in enumerate(away[:k], 1))
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def same(spark, rows, **options):
    expected = {q: v for q, v in brute(rows, lambda i: i % 3 == 0).items() if v}
    mine = found(curves.neighbours(frame(spark, rows), F.col("vec_id") % 3 == 0, **options))
    assert mine.keys() == expected.keys()
    for q, answer in expected.items():
        assert [(r, j) for r, j, _ in mine[q]] == [(r, j) for r, j, _ in answer]
        np.testing.assert_allclose([d for *_, d in mine[q]], [d for *_, d in answer], rtol=1e-12)


def test_keys_walk_the_cube_cell_by_cell():
    """Neighbouring keys are neighbouring cells, and every cell has its key."""
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = curves.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(20)]
    rows += [(30, None), (33, []), (36, [0.0] * 6), (39, [1.0, None, 0, 0, 0, 0]), (42, [math.nan] * 6), (45, [math.inf, 0, 0, 0, 0, 0]), (None, [1.0] * 6)]
    rows += [(3, rows[3][1]), (53, rng.normal(size=3).tolist()), (51, rng.normal(size=3).tolist()), (60, rng.normal(size=2).tolist())]
    same(spark, rows)


def test_no_rows_and_one_row(spark):
    for rows in ([], [(0, [1.0, 2.0])], [(0, None), (3, [0.0])]):
        assert curves.neighbours(frame(spark, rows), F.col("vec_id") % 3 == 0).count() == 0


def test_a_third_of_all_rows_are_one_vector(spark):
    """Answers among copies are the smallest ids, also for queries with large ids, and ties between vectors go by id."""
    rng = np.random.default_rng(2)
    rows = [(i, [0.5, 0.25, -1.0, 2.0]) for i in range(0, 900, 3)] + [(10_000 + i, rng.normal(size=4).round(1).tolist()) for i in range(20)]
    rows += [(2000 + i, [float(i == 0), float(i == 1), 0.0, 0.0]) for i in range(2)] + [(2013, [1.0, 1.0, 0, 0])]
    same(spark, rows)


def test_recall_on_clusters_and_a_narrow_window(spark, monkeypatch):
    """Vectors with structure are found in windows of a small part of the table."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(400, 24))
    rows = [(i, (centres[i % 400] + 0.02 * rng.normal(size=24)).tolist()) for i in range(6000)]
    windows, fitted = [], curves.window_for
    monkeypatch.setattr(curves, "window_for", lambda *a: windows.append(fitted(*a)) or windows[-1])
    mine = found(curves.neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0))
    vectors = np.array([v for _, v in rows], np.float32).astype(np.float64)
    hits = 0
    for q, answer in mine.items():
        away = curves.distances(vectors, vectors[q])
        away[q] = np.inf
        hits += len(set(np.argsort(away)[:10].tolist()) & {j for _, j, _ in answer})
        assert [d for *_, d in answer] == sorted(d for *_, d in answer) and len(answer) == 10
        np.testing.assert_allclose([d for *_, d in answer], [away[j] for _, j, _ in answer], rtol=1e-12)
    assert len(mine) == 120 and hits >= 0.9 * 1200 and windows[0] < 600


def test_an_id_with_two_vectors_is_two_queries(spark):
    rows = [(3, [1.0, 0.0]), (3, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.0, 1.1])]
    got = sorted(tuple(r) for r in curves.neighbours(frame(spark, rows), F.col("vec_id") % 3 == 0).select("query_id", "rank", "vec_id").collect())
    assert got == [(3, 1, 1), (3, 1, 2), (3, 2, 1), (3, 2, 3), (3, 3, 2), (3, 3, 3)]


def test_blocks_and_windows_lose_no_pair(spark, monkeypatch):
    """Blocks of 64 ranks: with windows over all ranks, every answer is exact."""
    monkeypatch.setattr(curves, "BLOCK_VALUES", 1)
    rng = np.random.default_rng(4)
    monkeypatch.setattr(curves, "window_for", lambda *a: 10_000)
    same(spark, [(i, rng.normal(size=5).tolist()) for i in range(400)])


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, folder):
    df = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect() if takes_part(r["vec_id"], r["embedding"])]
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    mine, hits = found(queries.QUERIES["op11_hilbert_neighbours"](spark, f"/root/testdata/{folder}")), 0
    assert sorted(mine) == sorted(ids[ids % 100 == 0].tolist())
    for q, answer in mine.items():
        away = curves.distances(vectors, vectors[np.flatnonzero(ids == q)[0]])
        away[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, away))[:10]].tolist()) & {j for _, j, _ in answer})
    assert hits >= 0.9 * 10 * len(mine)
