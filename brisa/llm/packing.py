"""Packing: documents as token sequences of near-equal fill, by Karmarkar-Karp multiway differencing.

A document is its ids and an end id. What fills whole sequences by itself is cut off; the rest is cut into pieces of
at most a quarter sequence, and a task's pieces, as they come, are packed in windows of :data:`GROUP` sequences' worth.
Differencing takes the two partial partitions with the largest imbalance and joins the fullest part of one with the
emptiest of the other, until one partition is left. If a part is over capacity, the same pieces are packed into
one sequence more. Every task packs its own rows, so nothing is shuffled and a lost task is simply run again;
at its end at most one sequence for each :data:`GROUP` is not nearly full.

Edge cases: a null or empty text is its end id alone; repeated rows are packed like any others; ``doc_id`` may be null.
Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.batches import configure_arrow, only, slices
from brisa.llm.tokens import encoder

CAPACITY, END_ID = 1024, 0
# Sequences that are packed together, and the parts of a sequence that a piece is cut to.
GROUP, PARTS = 128, 4


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Split items into ``ways`` parts of near-equal sums; returns the items of each part.

    A partial partition is its non-empty parts, fullest first; the others are empty. Joining two puts the
    fullest of one with the emptiest of the other.
    """
    heap = [(-size, item, [(size, [item])]) for item, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, x = heapq.heappop(heap)
        _, _, y = heapq.heappop(heap)
        spare = ways - len(x)  # empty parts of x
        joined = x + y[:spare]
        for place, (size, items) in enumerate(y[spare:]):
            # y's following parts, fullest first, meet x's from the emptiest on.
            other, held = x[len(x) - 1 - place]
            joined[len(x) - 1 - place] = (other + size, held + items)
        joined.sort(key=lambda part: -part[0])
        imbalance = joined[0][0] - (joined[-1][0] if len(joined) == ways else 0)
        heapq.heappush(heap, (-imbalance, count, joined))
        count += 1
    parts = [items for _, items in heap[0][2]] if heap else []
    return parts + [[] for _ in range(ways - len(parts))]


def pack_group(sizes: list[int], capacity: int) -> list[list[int]]:
    """As few near-equal parts as capacity allows, one more whenever a part is over it."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = differencing(sizes, ways)
        if all(sum(sizes[i] for i in part) <= capacity for part in parts):
            return [part for part in parts if part]
        ways += 1


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)`` per piece; ``tokenizer`` is a file on every executor.

    ``sequence_id`` is the task's number in its upper bits. ``ids`` are little-endian unsigned 32-bit.
    """
    configure_arrow(docs.sparkSession)
    fields = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    doc_type = docs.schema["doc_id"].dataType
    end = np.array([end_id], "<u4").tobytes()
    part = max(1, capacity // PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        pieces: list[tuple] = []
        held = 0
        id_type = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(fields)
            kinds = [id_type, *[pa.int64()] * 5, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], fields)

        def packed(now: list[tuple]) -> None:
            nonlocal sequence
            for window in pack_group([p[2] for p in now], capacity):
                offset = 0
                for item in window:
                    doc, start, length, total, ids = now[item]
                    rows.append((doc, start, length, total, sequence, offset, ids))
                    offset += length
                sequence += 1

        for batch in slices(batches, "text", keep=True):
            id_type = batch.schema.field("doc_id").type
            texts = pc.fill_null(batch.column("text"), "").to_pylist()
            for doc, ids in zip(batch.column("doc_id").to_pylist(), model.encode(texts)):
                ids += end
                total = len(ids) // 4
                start = 0
                while total - start >= capacity:
                    rows.append((doc, start, capacity, total, sequence, 0, ids[4 * start : 4 * (start + capacity)]))
                    sequence += 1
                    start += capacity
                while start < total:
                    length = min(part, total - start)
                    if held + length > group * capacity:
                        packed(pieces)
                        pieces, held = [], 0
                    pieces.append((doc, start, length, total, ids[4 * start : 4 * (start + length)]))
                    held += length
                    start += length
            yield out()
            rows.clear()
        if pieces:
            packed(pieces)
            yield out()

    schema = f"doc_id {doc_type.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return only(docs, "doc_id", "text").mapInArrow(run, schema)


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
