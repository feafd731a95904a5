"""Periodic runs against brute force over all periods, with runs across many tiles."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import edge_texts, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from brisa.llm import periods
from brisa.llm.batches import Words, text_bytes


def smallest_period(s):
    """From the longest border."""
    border = [0] * len(s)
    for i in range(1, len(s)):
        k = border[i - 1]
        while k and s[i] != s[k]:
            k = border[k - 1]
        border[i] = k + (s[i] == s[k])
    return len(s) - border[-1]


def brute(words):
    """``(start, length, period)`` of all runs by start, then period."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        start = 0
        for m in range(len(words) - q + 1):
            if m == len(words) - q or words[m] != words[m + q]:
                length = m - start + q
                if length >= max(6, 4 * q) and smallest_period(words[start : start + length]) == q:
                    out.append((start, length, q))
                start = m + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def check(spark, texts, parts=3):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, row string, size long").repartition(parts)
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periods.periodic_runs(docs).collect()]
    expected = []
    for i, text in texts:
        words = words_of(text)
        runs = brute(words)
        expected.append((i, len(words), runs, collapse(words, runs)))
    assert sorted(found, key=str) == sorted(expected, key=str)
    return found


def repeats():
    rng = random.Random(5)
    texts = []
    for i in range(60):
        words = prose(i, rng.randint(1, 200)).split(" ")
        block = prose(1000 + i, rng.randint(1, 40)).split(" ")
        times = rng.choice([3, 4, 4, 5, 9])
        stretch = (block * times)[: rng.randint(3 * len(block), times * len(block))]
        texts.append((100 + i, " ".join([*words, *stretch, *words[: rng.randint(0, 30)], *stretch[::-1]])))
    texts.append((200, "a " * 500 + "b " + "a " * 30))
    texts.append((201, "a b " * 300 + "a c a b a b a b a b a c a c a c a c"))
    texts.append((202, ("x " * 7 + "y ") * 9))
    texts.append((203, " ".join(["l one two"] * 5 + ["three"] * 5 + ["four"] * 6)))
    return texts


def test_edges(spark, edge, empty):
    check(spark, [(i, t) for i, t in edge_texts() if t is None or len(t) < 50_000])
    assert periods.periodic_runs(empty).count() == 0
    assert periods.periodic_runs(edge).columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_runs_equal_brute_force(spark):
    found = check(spark, repeats())
    assert sum(len(f[2]) for f in found) > 30


def test_runs_over_many_tiles(spark, monkeypatch):
    """Tiles of 8 words: long runs are stitched from many, and none is joined with its neighbour."""
    monkeypatch.setattr(periods, "TILE", 8)
    check(spark, repeats())


def test_one_long_document_of_one_word(spark):
    text = "same " * 60_000 + "end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    [row] = periods.periodic_runs(docs).collect()
    assert [tuple(r) for r in row["runs"]] == [(0, 60_000, 1)] and row["collapsed"] == "same end"


def test_long_period_over_tiles(spark):
    """A period of many thousand words, whose run spans several tiles of its octave."""
    block = [f"w{i}" for i in range(9_000)]
    words = [*["lead"] * 5, *(block * 5)[:40_123], "tail"]
    [row] = periods.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row["runs"]] == [(5, 40_123, 9_000)] and row["collapsed"].split(" ") == [*words[:5], *block, "tail"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(1, 12), st.integers(1, 6))
def test_fragments_of_all_tiles_hold_all_runs(items, repeat, tile):
    """The parts without Spark: tiles, Z-functions at boundaries, and stitching in plain Python."""
    words = [f"w{i}" for i in items[: len(items) // 2] + items[len(items) // 2 :] * repeat][:300]
    data, offsets = text_bytes(pa.array([" ".join(words).encode(), b"w0 w0 w0 w0 w0 w0"]))
    held = Words(data, offsets)
    old, periods.TILE = periods.TILE, tile
    try:
        spans = {}
        for doc, size, base, ids, boundaries in periods.tiles(held.hashes(), held.first):
            for q, low, high in periods.solve(ids.tolist(), boundaries.tolist(), size):
                spans.setdefault((doc, q), []).append((base + low, base + high))
    finally:
        periods.TILE = old
    runs = {0: [], 1: []}
    for (doc, q), found in spans.items():
        joined = []
        for low, high in sorted(found):
            if joined and low <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], high)
            else:
                joined.append([low, high])
        runs[doc] += [(low, high - low + q, q) for low, high in joined if high - low + q >= max(6, 4 * q)]
    assert sorted(runs[0], key=lambda r: (r[0], r[2])) == brute(words) and runs[1] == [(0, 6, 1)]


@pytest.mark.parametrize("s", [[], [1], [1, 1, 1], [1, 2, 1, 2, 1], [3, 1, 3, 3, 1, 3, 1]])
def test_z_function(s):
    expected = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
    assert periods.z_function(s) == expected


def test_divisors():
    assert [sorted(periods.divisors(q)) for q in (1, 2, 12, 49, 97, 30)] == [[], [1], [4, 6], [7], [1], [6, 10, 15]]
    assert np.all([q % d == 0 for q in range(1, 200) for d in periods.divisors(q)])
