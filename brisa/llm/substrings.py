"""Substring de-duplication: words in windows that also start elsewhere, by prefix-partitioned suffix trees.

Suffixes that cannot share a window are never shuffled. Each window of 35 words holds 24 runs of 12 words; the one with
the smallest hash (the first of equals) is its *anchor*. Equal windows have equal anchors at equal places, so
only the suffixes around anchors that occur twice go on, each as one record: the words before and after the
anchor that its windows reach. Equal records are one leaf with a count.

Records are partitioned by their anchor, a prefix of 12 words. A group of up to ``group_limit`` records is one
subtree: its suffixes are sorted, and neighbours with a common prefix of a whole window hang under the same deep internal
node. Larger groups get longer prefixes, up to whole windows, where a prefix is a node itself and counting
its leaves is an aggregate; so no group is ever gathered, however many rows share it.

Edge cases: null and short texts have no window and lose nothing; a repeated row's windows start elsewhere
too, so they go in both rows; overlapping equal windows within one text count. ``doc_id`` may be null or repeated. Other
columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm import bloom
from brisa.llm.batches import Words, configure_arrow, gram_hashes, only, slices, text_bytes
from brisa.session import share, write_out

WINDOW, PREFIX = 35, 12
# Records that one subtree is built from at most; with 24 suffixes each, some 20 MB of text.
GROUP_LIMIT = 4096


def anchors(hashes: np.ndarray, first: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows within one document, the place of each one's anchor, and the hash at every place."""
    grams = gram_hashes(hashes, prefix)
    choices = window - prefix + 1
    starts = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(first[:-1].tolist(), first[1:].tolist())] or [[]]).astype(np.int64)
    if not len(starts):
        return starts, starts, grams
    # The smallest by (hash, place): places fill the low bits, which the hash gives up for this only.
    low = np.uint64((1 << int(len(grams)).bit_length()) - 1)
    ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    covered = 1
    while covered < choices:  # smallest of 1, 2, 4 ... following places
        step = min(covered, choices - covered)
        ranked = np.minimum(ranked[: len(ranked) - step], ranked[step:])
        covered += step
    return starts, (ranked[starts] & low).astype(np.int64), grams


def _anchor_hashes(texts: DataFrame, window: int, prefix: int) -> DataFrame:
    """``(anchor)`` once for each place that is the anchor of a window."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(*text_bytes(batch.column("text")))
            _, places, grams = anchors(words.hashes(), words.first, window, prefix)
            yield pa.RecordBatch.from_arrays([pa.array(grams[np.unique(places)].view(np.int64))], ["anchor"])

    return texts.mapInArrow(find, "anchor long")


def _records(texts: DataFrame, words_seen: np.ndarray, window: int, prefix: int) -> DataFrame:
    """``(row_key, place, anchor, low, high, words, leaf)``: what the windows of each possibly repeated anchor cover.

    ``low`` and ``high`` are the first and last offset of its windows' starts before the anchor; ``words`` are
    the words from the first window's start to the last one's end; ``leaf`` names the record's content.
    """
    seen = share(texts.sparkSession, words_seen)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(*text_bytes(batch.column("text")))
            starts, places, grams = anchors(words.hashes(), words.first, window, prefix)
            at, group = np.unique(places, return_inverse=True)
            if not len(at):
                continue
            # The windows of an anchor are neighbours: their starts run from the lowest to the highest.
            lowest = np.full(len(at), np.iinfo(np.int64).max)
            highest = np.full(len(at), -1)
            np.minimum.at(lowest, group, starts)
            np.maximum.at(highest, group, starts)
            kept = bloom.contains(seen.value, grams[at])
            at, lowest, highest = at[kept], lowest[kept], highest[kept]
            raw = words.data.tobytes()
            begin, end = words.starts[lowest], words.ends[highest + window - 1]
            texts_ = [b" ".join(raw[a:b].split()) for a, b in zip(begin.tolist(), end.tolist())]
            shape = [(int(p - a), int(p - b)) for p, a, b in zip(at, lowest, highest)]
            leaves = [
                hashlib.blake2b(b"%d %d %s" % (high, low, text), digest_size=16).digest() for (high, low), text in zip(shape, texts_)
            ]
            row = np.searchsorted(words.first, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key").take(pa.array(row)),
                    pa.array(at - words.first[row]),
                    pa.array(grams[at].view(np.int64)),
                    pa.array([low for _, low in shape], pa.int32()),
                    pa.array([high for high, _ in shape], pa.int32()),
                    pa.array(texts_, pa.binary()).cast(pa.string()),
                    pa.array(leaves, pa.binary()),
                ],
                ["row_key", "place", "anchor", "low", "high", "words", "leaf"],
            )

    return texts.mapInArrow(find, "row_key string, place long, anchor long, low int, high int, words string, leaf binary")


def deep_nodes(records: list[tuple[list[str], int, int]], window: int) -> list[int]:
    """The subtree of one anchor: for each record, a bit for each offset whose window another record has too.

    The suffixes that begin at one offset before the anchor, sorted, are the leaves of a subtree in order;
    neighbours that share a whole window are under one deep internal node.
    """
    masks = [0] * len(records)
    for offset in range(min(low for _, low, _ in records), max(high for _, _, high in records) + 1):
        leaves = []
        for row, (words, low, high) in enumerate(records):
            if low <= offset <= high:
                leaves.append((words[high - offset : high - offset + window], row))
        leaves.sort()
        for (suffix, row), (other, following) in zip(leaves, leaves[1:]):
            if suffix == other:
                masks[row] |= 1 << offset
                masks[following] |= 1 << offset
    return masks


def _subtrees(leaves: DataFrame, window: int) -> DataFrame:
    """``(leaf, mask)`` of the small groups. Rows of a group follow each other, so a task holds one group at a time."""
    fields = ["anchor", "leaf", "low", "high", "words"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(group: list[tuple]) -> list[tuple[bytes, int]]:
            if len(group) < 2:
                return []
            masks = deep_nodes([(words.split(" "), low, high) for _, _, low, high, words in group], window)
            return [(row[1], mask) for row, mask in zip(group, masks) if mask]

        def out(found: list[tuple[bytes, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.int64())], ["leaf", "mask"])

        group: list[tuple] = []
        for batch in batches:
            found = []
            for row in zip(*[batch.column(f).to_pylist() for f in fields]):
                if group and group[0][0] != row[0]:
                    found += solved(group)
                    group = []
                group.append(row)
            yield out(found)
        yield out(solved(group))

    return leaves.select(*fields).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(build, "leaf binary, mask long")


def _long_prefixes(leaves: DataFrame, window: int) -> DataFrame:
    """``(leaf, mask)`` of the large groups, whose prefixes are lengthened to whole windows."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            out = []
            for leaf, low, high, text in zip(*[batch.column(c).to_pylist() for c in ("leaf", "low", "high", "words")]):
                words = text.split(" ")
                for offset in range(low, high + 1):
                    part = " ".join(words[high - offset : high - offset + window])
                    out.append((hashlib.blake2b(part.encode(), digest_size=16).digest(), leaf, 1 << offset))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.int64())],
                ["node", "leaf", "bit"],
            )

    suffixes = write_out(leaves.select("leaf", "low", "high", "words").mapInArrow(expand, "node binary, leaf binary, bit long"), "suffixes")
    nodes = suffixes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    return suffixes.join(nodes, "node", "left_semi").groupBy("leaf").agg(F.bit_or("bit").alias("mask"))


def repeated_places(texts: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """``(row_key, place, mask)``: anchors of ``texts(row_key, text)`` with the offsets of their repeated windows."""
    twice = _anchor_hashes(texts.select("text"), window, prefix).groupBy("anchor").count().where("count > 1")
    twice = write_out(twice.select("anchor"), "anchors")
    records = write_out(_records(texts, bloom.build(twice, "anchor", twice.count()), window, prefix), "records")
    leaves = records.groupBy("anchor", "leaf", "low", "high").agg(F.count("*").alias("n"))
    # Equal records repeat every window of theirs; the others meet in the tree of their anchor.
    leaves = write_out(leaves, "leaves")
    whole = F.expr("shiftleft(1L, high + 1) - shiftleft(1L, low)")
    sizes = leaves.groupBy("anchor").agg(F.count("*").alias("size")).where("size > 1")
    contents = records.select("leaf", "words").dropDuplicates(["leaf"])
    grouped = leaves.join(sizes, "anchor").join(contents, "leaf")
    grouped = write_out(grouped.select("anchor", "leaf", "low", "high", "words", "size"), "groups")
    masks = (
        leaves.where("n > 1").select("leaf", whole.alias("mask"))
        .union(_subtrees(grouped.where(F.col("size") <= group_limit), window))
        .union(_long_prefixes(grouped.where(F.col("size") > group_limit), window))
        .groupBy("leaf").agg(F.bit_or("mask").alias("mask"))
    )
    return records.select("row_key", "place", "leaf").join(masks, "leaf").select("row_key", "place", "mask")


def _kept(text: str, marks: list[dict] | None, window: int) -> tuple[list[bytes], int]:
    words = text.encode().split()  # bytes split at exactly the six ASCII space characters
    if not marks:
        return words, 0
    edges = np.zeros(len(words) + 1, np.int64)
    for mark in marks:
        place, mask = mark["place"], mark["mask"]
        while mask:
            low = mask & -mask
            start = place - (low.bit_length() - 1)
            edges[start] += 1
            edges[start + window] -= 1
            mask ^= low
    gone = np.cumsum(edges)[:-1] > 0
    return [w for w, g in zip(words, gone.tolist()) if not g], int(gone.sum())


def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: each document's words that no repeated window covers, joined by one space."""
    configure_arrow(docs.sparkSession)
    # Rows of equal id and text are interchangeable; anything else tells rows apart.
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"), F.length("text").cast("string"))
    rows = only(docs, "doc_id", "text").withColumn("row_key", key)
    places = repeated_places(rows.select("row_key", "text"), window, prefix, group_limit)
    # Equal rows give equal places once each.
    marks = places.distinct().groupBy("row_key").agg(F.collect_list(F.struct("place", "mask")).alias("marks"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = pc.fill_null(batch.column("text"), "").to_pylist()
            kept = [_kept(text, marks, window) for text, marks in zip(texts, batch.column("marks").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(words) + removed for words, removed in kept], pa.int64()),
                    pa.array([removed for _, removed in kept], pa.int64()),
                    pa.array([b" ".join(words) for words, _ in kept], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = rows.join(marks, "row_key", "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(keep, f"doc_id {kind}, n_words long, n_removed long, kept string")
