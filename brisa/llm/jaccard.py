"""N-gram Jaccard join: the product of the document by n-gram incidence with itself, in blocks.

Overlaps are needed only where they can reach the threshold. Sizes bound them: a document of n
n-grams must share ceil(0.8 n) with any partner, so of its n-grams, in one order common to all documents
(frequent ones last), the first n - ceil(0.8 n) + 1 hold one that the partner also starts with. The rows of
the incidence are cut to those prefixes. Blocks of the product are the columns (n-grams); what is left of a
pair's overlap is bounded by both sizes and the place of the shared n-gram, and pairs below the bound go.

Copies of one n-gram set are one row of the matrix. Within a block, documents are first multiplied with one
member only, that which has the block's n-gram earliest (of copies with changes mostly their source, which has no
rare n-grams of its own before it); all that these connect needs no further product. Of pairs that are still apart,
the overlap is accumulated over both prefixes, and only those that can reach the threshold with all that is left are
multiplied whole. No group is collected. What one hub connects is never expanded into its pairs; what it leaves apart is joined
within the block on the n-gram, up to all pairs that sizes and places allow.

Edge cases: a null or wordless text has no n-grams and links with nothing; a text of fewer words than
an n-gram has is one n-gram; repeated rows are copies. ``doc_id`` may be null or repeated (the smallest id of a group
is over what is not null). Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm import bloom
from brisa.llm.batches import LOWER, Words, configure_arrow, fresh, gram_hashes, lists, only, slices, text_bytes
from brisa.llm.graph import components
from brisa.session import share, write_out

SHINGLE, PERCENT = 5, 80
# N-grams known as frequent, at most; they only set the order of the prefixes, so any bound is exact.
FREQUENT = 1 << 16
# N-grams that a task counts at once, and the count there from which it reports one.
COUNTED, REPORTED = 1 << 22, 4


def shingle_sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice."""
    data, offsets = text_bytes(batch.column("text"))
    words = Words(LOWER[data], offsets)
    hashes = words.hashes()
    grams = gram_hashes(hashes, size)
    out = []
    for first, end in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if end - first >= size:
            out.append(np.unique(grams[first : end - size + 1]))
        elif end > first:  # the whole sequence, seeded by its length
            out.append(gram_hashes(hashes[first:end], end - first, seed=end - first))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(grams: np.ndarray) -> int | None:
    """A 64-bit name of a set; none for the empty one."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True) if len(grams) else None


def frequent_grams(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent shingles over all documents, by tasks' own counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def report(held: list[np.ndarray]) -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= REPORTED
            return pa.RecordBatch.from_arrays([pa.array(grams[many].view(np.int64)), pa.array(counts[many])], ["gram", "n"])

        held, total = [], 0
        for batch in slices(batches, "text"):
            held += shingle_sets(batch, size)
            total += sum(map(len, held[-batch.num_rows :]))
            if total >= COUNTED:
                yield report(held)
                held, total = [], 0
        if total:
            yield report(held)

    counted = texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = counted.orderBy(F.desc("n"), "gram").limit(FREQUENT).toArrow()
    grams, counts = found["gram"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(grams)
    return grams[order], counts[order]


def in_order(grams: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A set in the common order: by hash, but what is frequent comes last, the most frequent very last."""
    known, counts = frequent
    if not len(known) or not len(grams):
        return grams
    place = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    weight = np.where(known[place] == grams, counts[place], 0)
    return grams[np.argsort(weight, kind="stable")] if weight.any() else grams


def _signatures(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``(doc_id, content, n, node, prefix)`` per row of ``texts(doc_id, content, text)``."""
    frequent = share(texts.sparkSession, frequent_grams(texts, size))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch, size)
            prefixes = [in_order(s, frequent.value)[: len(s) - -(-percent * len(s) // 100) + 1].view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("content"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_of(s) for s in sets], pa.int64()),
                    lists(prefixes, pa.int64()),
                ],
                ["doc_id", "content", "n", "node", "prefix"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return write_out(texts.mapInArrow(sign, f"doc_id {kind}, content long, n long, node long, prefix array<long>"), "sets")


def _postings(signed: DataFrame) -> DataFrame:
    """``(gram, node, n, place)`` for prefix n-grams that may occur in two rows, once per set."""
    rows = signed.select(F.explode("prefix").alias("gram")).groupBy("gram").count().where("count > 1")
    shared = write_out(rows.select("gram"), "shared")
    words = share(shared.sparkSession, bloom.build(shared, "gram", shared.count()))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            grams = prefix.flatten().to_numpy()
            sizes = prefix.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(grams)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = np.flatnonzero(bloom.contains(words.value, grams))
            row = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[kept]), batch.column("node").take(row), batch.column("n").take(row), pa.array(place[kept])],
                ["gram", "node", "n", "place"],
            )

    rows = signed.where("n > 0").select("node", "n", "prefix").mapInArrow(keep, "gram long, node long, n long, place long")
    return write_out(rows.distinct(), "postings")


def _least(over: int, under: int, n: str) -> str:
    """SQL for the whole number not below ``over * n / under``."""
    return f"(({over} * {n} + {under - 1}) div {under})"


def _reachable(percent: int, n_a: str, place_a: str, n_b: str, place_b: str) -> Column:
    """Whether sizes and the place of a shared n-gram leave the overlap that the threshold needs.

    From the first shared n-gram on, the overlap is at most what both sets have left; a true pair passes at
    that n-gram. overlap >= percent/100 * union, where union = n + n - overlap.
    """
    return F.expr(f"least({n_a} - {place_a}, {n_b} - {place_b}) * {100 + percent} >= ({n_a} + {n_b}) * {percent}")


def _accumulated(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose overlap, accumulated over both prefixes, can still reach the threshold.

    Of two prefixes, the one that ends first in the common order holds all that is shared up to its end, and
    beyond that only the rest of its own set can be shared.
    """
    nodes = write_out(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    words = share(pairs.sparkSession, bloom.build(nodes, "node", nodes.count()))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bloom.contains(words.value, batch.column("node").to_numpy())))

    heads = signed.where("n > 0").select("node", "n", "prefix").mapInArrow(pick, "node long, n long, prefix array<long>")
    heads = write_out(heads.dropDuplicates(["node"]), "heads")
    a, b = heads.toDF("a", "n_a", "prefix_a"), heads.toDF("b", "n_b", "prefix_b")
    most = "size(array_intersect(prefix_a, prefix_b)) + greatest(n_a - size(prefix_a), n_b - size(prefix_b))"
    return pairs.join(a, "a").join(b, "b").where(f"({most}) * {100 + percent} >= (n_a + n_b) * {percent}").select("a", "b")


def _texts_of(pairs: DataFrame, texts: DataFrame, signed: DataFrame) -> DataFrame:
    """``(node, text)`` of the sets in ``pairs``, one text for each."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = signed.select("node", "content").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("content").alias("content"))
    named = write_out(named, "nodes")
    words = share(texts.sparkSession, bloom.build(named, "content", named.count()))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bloom.contains(words.value, batch.column("content").to_numpy())))

    found = texts.select("content", "text").mapInArrow(pick, "content long, text string").dropDuplicates(["content"])
    return write_out(named.join(found, "content").select("node", "text"), "texts")


def _linked(pairs: DataFrame, texts: DataFrame, signed: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets reach the threshold."""
    texts = _texts_of(pairs, texts, signed)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in slices(batches, "text_b"):
            kept = []
            b_sets = shingle_sets(pa.RecordBatch.from_arrays([batch.column("text_b")], ["text"]), size)
            for row, a in enumerate(batch.column("a").to_pylist()):
                if a != last:  # the join on a leaves the pairs of a hub together
                    left = shingle_sets(pa.RecordBatch.from_arrays([batch.column("text_a").slice(row, 1)], ["text"]), size)[0]
                    last = a
                small, large = sorted((left, b_sets[row]), key=len)
                if 100 * len(small) < percent * len(large):
                    continue
                place = np.minimum(np.searchsorted(large, small), len(large) - 1)
                overlap = int((large[place] == small).sum())
                if 100 * overlap >= percent * (len(small) + len(large) - overlap):
                    kept.append(row)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return write_out(pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(multiply, "a long, b long"), "links")


def _grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``(doc_id, content, n, node, component, group_id)`` per row; ``content`` is a hash of the text."""
    configure_arrow(docs.sparkSession)
    texts = only(docs, "doc_id", "text").withColumn("content", F.xxhash64("text"))
    signed = _signatures(texts, size, percent)
    postings = _postings(signed)

    # Blocks with more than one set, and the member of each with the earliest place (then any, by a hash).
    order = F.shiftleft("place", 40) + F.shiftrightunsigned(F.xxhash64("node"), 24)
    postings = postings.withColumn("order", order)
    blocks = postings.groupBy("gram").agg(
        F.count("*").alias("size"), F.min("order").alias("first"), F.min_by("node", "order").alias("hub"), F.min_by("n", "order").alias("hub_n")
    )
    blocks = blocks.where("size > 1").select("gram", "hub", F.struct(F.col("hub_n").alias("n"), F.shiftright("first", 40).alias("place")).alias("at"))
    members = write_out(postings.drop("order").join(blocks, "gram"), "members")
    stars = members.where("node <> hub").where(_reachable(percent, "n", "place", "at.n", "at.place"))
    pairs = write_out(stars.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = _linked(pairs, texts, signed, size, percent)

    # What is still apart within a block.
    found = components(links)
    apart = members.select("gram", "node", "n", "place").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = write_out(apart, "apart")
    mixed = apart.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    apart = apart.join(mixed.select("gram"), "gram", "left_semi")
    # The smaller side also has the shared n-gram within the shorter prefix that its larger partner leaves it.
    x = apart.where(f"place <= n - {_least(2 * percent, 100 + percent, 'n')}").toDF(*[f"{c}_x" for c in apart.columns])
    y = apart.toDF(*[f"{c}_y" for c in apart.columns])
    near = x.join(y, F.col("gram_x") == F.col("gram_y")).where("component_x <> component_y and (n_x < n_y or (n_x = n_y and node_x < node_y))")
    near = near.where(_reachable(percent, "n_x", "place_x", "n_y", "place_y")).select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()
    near = write_out(near.join(pairs.union(pairs.select("b", "a")), ["a", "b"], "left_anti"), "near")
    more = write_out(_accumulated(near, signed, percent), "pairs")
    if not more.isEmpty():
        found = components(links.union(_linked(more, texts, signed, size, percent)))

    classes = signed.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    classes = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = classes.groupBy("component").agg(F.min("first_id").alias("group_id"))
    groups = classes.join(lowest, "component").select("node", "component", "group_id")
    return signed.drop("prefix").join(groups, "node", "left")


def jaccard_groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per document: its group by links of at least ``percent``."""
    return _grouped(docs, size, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("group_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each group, that with the smallest id (then by a hash of the text); all columns are kept.

    Documents without words are linked with nothing and all stay. Of repeated rows any one stays.
    """
    rows = _grouped(docs, size, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "content")).alias("first")
    chosen = rows.where("n > 0").groupBy("component").agg(first).select("first.doc_id", "first.content", F.lit(True).alias("once"))
    kept = write_out(chosen.union(rows.where("n = 0").select("doc_id", "content", F.lit(False)).distinct()), "kept")
    names = {c: fresh(docs, c) for c in ("kept_id", "kept_content", "once", "row")}
    kept = kept.toDF(names["kept_id"], names["kept_content"], names["once"])
    same = docs["doc_id"].eqNullSafe(kept[names["kept_id"]]) & (F.xxhash64(docs["text"]) == kept[names["kept_content"]])
    found = docs.join(kept, same)
    # Rows that are to stay once agree in all of the key; the others never do.
    found = found.withColumn(names["row"], F.when(found[names["once"]], F.lit(0)).otherwise(F.monotonically_increasing_id()))
    return found.dropDuplicates([names["kept_id"], names["kept_content"], names["row"]]).select(*[F.col(f"`{c}`") for c in docs.columns])
