"""The Merkle manifest against a tree built in plain Python, with deep trees, many groups and edge cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.llm import merkle

ROW = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("source", "lang")],
        T.StructField("n_chars", T.LongType()),
        T.StructField("text", T.StringType()),
        # Names that the operator uses inside.
        *[T.StructField(c, T.StringType()) for c in ("g", "key", "node", "leaf", "block", "n", "part", "place", "path", "root")],
    ]
)


def tampering():
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"tampered": {"text": lower}, "when": F.crc32(F.col("doc_id").cast("string")) % 3 == 0}


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def fold(nodes):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def path(levels, place):
    out = []
    for level in levels[:-1]:
        run = place // 8 * 8
        out.append((level[run:place], level[place + 1 : run + 8]))
        place //= 8
    return out


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for group in order:
        made = []
        for doc, source, lang, size, text in groups[group]:
            lower = None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
            leaf, other = [sha(*map(field, (doc, source, lang, size, t))) for t in (text, lower)]
            made.append((doc is not None, doc or 0, leaf, doc, other if hit else leaf))
        made.sort(key=lambda m: m[:3])
        trees[group] = made, fold([m[2] for m in made])
    upper = fold([trees[g][1][-1][0] for g in order])
    for place, group in enumerate(order):
        made, levels = trees[group]
        for i, (*_, leaf, doc, other) in enumerate(made):
            steps, node = path(levels, i) + path(upper, place), other
            for before, after in steps:
                node = sha(*before, node, *after)
            proof = sha(*[s for before, after in steps for s in [*before, *after]])
            out.append((doc, leaf, levels[-1][0], upper[-1][0], proof, node, node == upper[-1][0]))
    return out


def check(spark, rows, parts=3):
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    docs = spark.createDataFrame([(*r, *["x"] * 10) for r in rows], ROW).repartition(parts)
    found = [tuple(r) for r in merkle.manifest(docs, **tampering()).collect()]
    assert sorted(found, key=key) == sorted(plain(rows), key=key)
    return found


EDGES = [
    (1, "a", "en", 3, "Abc"),
    (1, "a", "en", 3, "Abc"),
    (1, "a", "en", 4, "Abd"),
    (None, "a", "en", 3, "Abc"),
    (None, None, None, None, None),
    (2, "", None, 0, ""),
    (3, "b", "", 5, None),
    (4, "b", "é", 200_000, "É Long " * 30_000),
    (5, "b", "z", 1, "\U0001f600 ABC\n"),
    *[(i, "a", "en", i, f"Text {i}") for i in range(10, 40)],
]


def test_edges_equal_brute_force(spark):
    found = check(spark, EDGES)
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


def test_one_row_is_the_root(spark):
    [(doc, leaf, subroot, root, proof, folded, _)] = check(spark, [(7, "a", "en", 1, "x")])
    assert doc == 7 and leaf == subroot == root == folded and proof == sha("")


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], ROW), **tampering()).count() == 0


@pytest.mark.parametrize("height", [1, 3])
def test_several_stages_and_a_hot_group(spark, monkeypatch, height):
    """Blocks of 8 or 512 leaves under more than one stage; a third of all groups have one row, one group has most rows."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 8**height)
    rows = [(i, "a", "hot" if i % 10 else f"l{i}", i, f"Row {i % 50}") for i in range(800)]
    check(spark, rows, parts=7)


def test_nobody_tampers(spark):
    docs = spark.createDataFrame([(*r, *["x"] * 10) for r in EDGES], ROW)
    assert all(r["verified"] for r in merkle.manifest(docs).collect())


def test_versions_share_untouched_nodes():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(70)]
    tree = merkle.Tree(leaves, merkle.levels_of(70))
    for place in (0, 7, 8, 63, 64, 69):
        changed = [*leaves]
        changed[place] = b"\0" * 32
        assert merkle.copied(changed[place], tree.path(place)) == merkle.Tree(changed, 3).root
        assert merkle.copied(leaves[place], tree.path(place)) == tree.root
    assert [merkle.levels_of(n) for n in (1, 2, 8, 9, 64, 65)] == [0, 1, 1, 2, 2, 3]
