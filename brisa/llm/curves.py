"""Approximate nearest neighbours by shifted Hilbert curves.

Each curve projects the vectors to a few dimensions by a random matrix of its own, evens every dimension out by the quantiles of
a sample, shifts the cube, and orders the vectors by their place on a Hilbert curve. The orders are ranges in Spark, so
each vector gets its rank on each curve. A query's candidates are the vectors within a window of ranks around it on
any curve; they are ranked again by their exact distance on the original vectors, and the curves' answers are merged.

How wide a window must be follows the data, not the size of the table: a bounded sample of the queries is compared with all vectors,
and the window is the one that would have found :data:`RECALL` of their true neighbours. On vectors with structure that is a
few ranks; on vectors of independent components, where all distances are nearly equal, it is a large part of the table.

Equal vectors are one class with its ``k + 1`` smallest ids, which is all that any answer can hold, so copies cost one row a task
and never crowd a window. Ranks are cut into blocks of about a megabyte; a task compares the queries of one block with one block.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, take no part. Only
vectors of equal length are compared. Repeated rows count once; of an id with several vectors each is an item of its own. With
fewer than ``k`` candidates in reach of the windows all of them are returned. Of other columns nothing is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.batches import configure_arrow, only
from brisa.llm.ranks import numbered
from brisa.session import scratch, share, write_out

K = 10
CURVES = 4
# Dimensions of the projections and bits of each on the curve; together 64.
DIMS, BITS = 8, 8
# Vectors that the quantiles are taken from, and queries that the window is fitted to.
SAMPLE, TRIALS = 4096, 128
# Share of the trials' true neighbours that the window must hold.
RECALL = 0.97
# Components of the vectors of a block of ranks, and the fewest vectors of one.
BLOCK_VALUES, LEAST_BLOCK = 1 << 17, 64


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve through a cube of 2 ** bits cells a side, of which ``cells`` has the coordinates by row."""
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    # Undo the rotations and reflections of the sub-cubes, from the coarsest on.
    for bit in range(bits - 1, 0, -1):
        high, low = one << np.uint64(bit), (one << np.uint64(bit)) - one
        for axis in range(len(x)):
            set_ = (x[axis] & high) != 0
            swapped = np.where(set_, 0, (x[0] ^ x[axis]) & low).astype(np.uint64)
            x[0] ^= np.where(set_, low, swapped)
            x[axis] ^= swapped
    # Gray code of the axes' bits.
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flips = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> np.uint64(bit)) & one, (one << np.uint64(bit)) - one, 0).astype(np.uint64)
    x ^= flips
    keys = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            keys = keys << one | (x[axis] >> np.uint64(bit)) & one
    return keys


class Curves:
    """The orderings: projections of vectors of any length, quantiles of a sample, shifts."""

    def __init__(self, sample: list[np.ndarray], count: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.seeds = rng.integers(1 << 62, size=count)
        self.shifts = rng.random((count, DIMS)) / 2
        self.quantiles = [np.sort(np.concatenate([np.zeros((0, DIMS)), *[self.project(v[None], c) for v in sample]]), axis=0) for c in range(count)]

    def project(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        matrix = np.random.default_rng([int(self.seeds[curve]), vectors.shape[1]]).normal(size=(vectors.shape[1], DIMS))
        return vectors @ matrix / math.sqrt(vectors.shape[1])

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        """Signed keys that sort as the places on the curve."""
        flat, steps = self.project(vectors, curve), self.quantiles[curve]
        even = np.stack([np.searchsorted(steps[:, d], flat[:, d]) for d in range(DIMS)], axis=1) / len(steps)
        cells = ((even + self.shifts[curve]) / 1.5 * ((1 << BITS) - 1)).astype(np.uint64)
        return (hilbert_keys(cells, BITS) ^ np.uint64(1 << 63)).view(np.int64)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    apart = vectors - query
    return np.sqrt((apart * apart).sum(axis=1))


def nearest(away: np.ndarray, lead: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` smallest distances, ties by ``lead``."""
    places = np.arange(len(away))
    if len(away) > count:
        places = np.flatnonzero(away <= np.partition(away, count - 1)[count - 1])
    return places[np.lexsort((lead[places], away[places]))][:count]


def by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose vectors (column ``vec``) are equally long."""
    sizes = batch.column("dim").to_numpy()
    for size in np.unique(sizes):
        yield batch.filter(pa.array(sizes == size))


def valid(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct ``(vec_id, vec)`` of the rows that take part."""
    rows = only(rows, key, vector).select(F.col(key).alias("vec_id"), F.col(vector).alias("vec"))
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & whole & F.exists("vec", lambda x: x != 0)).distinct()


def classes_of(items: DataFrame, k: int) -> DataFrame:
    """``(class, dim, lead, ids, vec)``: a row per different vector with its ``k + 1`` smallest ids."""
    # A rank limit is applied before the shuffle too, so a vector of a third of all rows is k + 1 rows a task.
    ranked = items.withColumn("place", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    grouped = ranked.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return write_out(grouped.select(F.monotonically_increasing_id().alias("class"), F.size("vec").alias("dim"), F.get("ids", F.lit(0)).alias("lead"), "ids", "vec"), "classes")


def _ranked(classes: DataFrame, curves: int) -> DataFrame:
    """``(class, curve, dim, i, n)``: the place of each class on each curve, among vectors of its length."""
    # At most SAMPLE vectors come to the driver.
    sample = classes.orderBy(F.xxhash64("vec"), "lead").limit(SAMPLE).select("vec").toArrow()
    model = Curves([np.array(v.as_py(), np.float64) for v in sample.column("vec")], curves)
    shared = share(classes.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_length(batch) if batch.num_rows else ():
                vectors = matrix(part.column("vec"))
                for curve in range(curves):
                    columns = [part.column("class"), part.column("lead"), pa.array(np.full(len(vectors), curve, np.int32)), part.column("dim"), pa.array(shared.value.keys(vectors, curve))]
                    yield pa.RecordBatch.from_arrays(columns, ["class", "lead", "curve", "dim", "key"])

    kind = classes.schema["lead"].dataType.simpleString()
    keys = classes.select("class", "lead", "dim", "vec").mapInArrow(run, f"class long, lead {kind}, curve int, dim int, key long")
    with scratch(classes.sparkSession):
        found = numbered(write_out(keys, "keys"), ["curve", "dim"], ["key", "lead", "class"]).select("class", "curve", "dim", "i", "n")
        return write_out(found, "ranks", kept=True)


def _trials(classes: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``(query, class)``: the true nearest classes of a bounded sample of those asked for."""
    chosen = classes.join(asked, "class", "left_semi").orderBy(F.xxhash64("vec"), "lead").limit(TRIALS).select("class", "vec")
    held = chosen.toArrow()
    queries = [(c, np.array(v, np.float64)) for c, v in zip(held.column("class").to_pylist(), held.column("vec").to_pylist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: (np.zeros(0), np.zeros(0, np.int64)) for number, _ in queries}
        for batch in batches:
            for part in by_length(batch) if batch.num_rows else ():
                vectors, own = matrix(part.column("vec")), part.column("class").to_numpy()
                for number, query in queries:
                    if len(query) == vectors.shape[1]:
                        away = np.concatenate([best[number][0], distances(vectors, query)])
                        ids = np.concatenate([best[number][1], own])
                        first = nearest(np.where(ids == number, np.inf, away), ids, k)
                        best[number] = away[first], ids[first]
        for number, (away, ids) in best.items():
            other = ids != number
            columns = [np.full(int(other.sum()), number), ids[other], away[other]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "class", "away"])

    found = classes.select("class", "dim", "vec").mapInArrow(run, "query long, class long, away double")
    order = Window.partitionBy("query").orderBy("away", "class")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("query", "class")


def window_for(ranks: DataFrame, trials: DataFrame, share: float, least: int) -> int:
    """Ranks to either side that hold ``share`` of the trials' neighbours on at least one curve."""
    # At most TRIALS * (k + 1) classes, each with one rank per curve.
    pairs = trials.toArrow().to_pydict()
    ids = sorted({*pairs["query"], *pairs["class"]})
    if not ids:
        return least
    wanted = ranks.sparkSession.createDataFrame([(i,) for i in ids], "class long")
    held = ranks.join(F.broadcast(wanted), "class").select("class", "curve", "i").toArrow()
    place = {(c, v): i for c, v, i in zip(*[held.column(n).to_pylist() for n in ("class", "curve", "i")])}
    curves = sorted({curve for _, curve in place})
    needed = sorted(min(abs(place[q, c] - place[o, c]) for c in curves) for q, o in zip(pairs["query"], pairs["class"]))
    return max(least, needed[math.ceil(share * len(needed)) - 1])


def _blocks(classes: DataFrame, ranks: DataFrame, asked: DataFrame) -> DataFrame:
    """``(curve, dim, block, size, n, members)``: the ranks of a curve in blocks of ``size``, each member with its ranks on all curves."""
    flagged = classes.join(asked.withColumn("asked", F.lit(True)), "class", "left").select("class", "lead", "vec", F.coalesce("asked", F.lit(False)).alias("asked"))
    # All curves have the vectors of one length, so n is the same on each.
    places = ranks.groupBy("class", "dim", "n").agg(F.sort_array(F.collect_list(F.struct("curve", "i"))).alias("found"))
    size = F.greatest(F.lit(LEAST_BLOCK), F.floor(F.lit(BLOCK_VALUES) / F.col("dim"))).cast("long")
    rows = places.select("class", "dim", "n", size.alias("size"), F.col("found.i").alias("ranks")).join(flagged, "class")
    rows = rows.select("*", F.posexplode("ranks").alias("curve", "i")).withColumn("block", F.floor(F.col("i") / F.col("size")))
    gathered = rows.groupBy("curve", "dim", "block", "size", "n").agg(F.sort_array(F.collect_list(F.struct("i", "lead", "class", "asked", "vec", "ranks"))).alias("members"))
    return write_out(gathered, "blocks")


def _compared(blocks: DataFrame, window: int, k: int) -> DataFrame:
    """``(query, class, lead, score)``: of each block within reach of a query its ``k + 1`` nearest classes in the window.

    What lies within the window on an earlier curve is compared there, so no pair comes twice.
    """
    asked = F.filter("members", lambda m: m["asked"])
    packs = blocks.select("curve", "dim", "size", "n", asked.alias("queries")).where("size(queries) > 0")
    first = F.greatest(F.lit(0), F.floor((F.get("queries", F.lit(0))["i"] - window) / F.col("size")))
    last = F.floor(F.least(F.col("n") - 1, F.element_at("queries", -1)["i"] + window) / F.col("size"))
    packs = packs.select("curve", "dim", F.explode(F.sequence(first, last)).alias("block"), *[F.col(f"queries.{c}").alias(f"query_{c}") for c in ("class", "vec", "ranks")])
    pairs = packs.join(blocks.select("curve", "dim", "block", "members"), ["curve", "dim", "block"])
    pairs = pairs.select("curve", "query_class", "query_vec", "query_ranks", *[F.col(f"members.{c}").alias(c) for c in ("lead", "class", "vec", "ranks")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, curve in enumerate(batch.column("curve").to_pylist()):
                held = {n: batch.column(n).slice(row, 1).flatten() for n in batch.schema.names if n != "curve"}
                vectors, queries = matrix(held["vec"]), matrix(held["query_vec"])
                ranks, query_ranks = (held[n].flatten().to_numpy().reshape(len(v), -1) for n, v in (("ranks", vectors), ("query_ranks", queries)))
                leads, own = held["lead"].to_numpy(), held["class"].to_numpy()
                out = []
                for place, number, query in zip(query_ranks, held["query_class"].to_pylist(), queries):
                    near = np.abs(ranks[:, : curve + 1] - place[: curve + 1]) <= window
                    here = np.flatnonzero(near[:, curve] & ~near[:, :curve].any(axis=1))
                    away = distances(vectors[here], query)
                    chosen = nearest(away, leads[here], k + 1)
                    out.append((np.full(len(chosen), number), own[here][chosen], leads[here][chosen], away[chosen]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query", "class", "lead", "score"])

    kind = blocks.schema["members"].dataType.elementType["lead"].dataType.simpleString()
    return pairs.mapInArrow(run, f"query long, class long, lead {kind}, score double")


def neighbours(rows: DataFrame, asked: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", curves: int = CURVES, recall: float = RECALL) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row whose id (``vec_id``) is ``asked`` for."""
    configure_arrow(rows.sparkSession)
    items = valid(rows, key, vector)
    classes = classes_of(items, k)
    # An id for each query with the class of its vector; many queries of one class are answered once.
    queries = write_out(items.where(asked).join(classes.select("class", "vec"), "vec").select(F.col("vec_id").alias("query_id"), "class"), "queries")
    wanted = queries.select("class").distinct()
    ranks = _ranked(classes, curves)
    window = window_for(ranks, _trials(classes, wanted, k), recall, 2 * (k + 1))
    found = _compared(_blocks(classes, ranks, wanted), window, k)
    order = Window.partitionBy("query")
    first = found.withColumn("place", F.row_number().over(order.orderBy("score", "lead", "class"))).where(F.col("place") <= k + 1)
    # The nearest ids among those of the nearest classes, the query's own with them.
    ids = first.join(classes.select("class", "ids"), "class").select("query", "class", "score", F.explode("ids").alias("vec_id"))
    ids = ids.withColumn("place", F.row_number().over(order.orderBy("score", "vec_id", "class"))).where(F.col("place") <= k + 1)
    answers = ids.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id", "class"))).alias("answer"))
    others = F.filter("answer", lambda a: ~((a["vec_id"] == F.col("query_id")) & (a["class"] == F.col("class"))))
    answered = queries.join(answers, queries["class"] == answers["query"]).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "found"))
    return answered.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "found.vec_id", "found.score")
