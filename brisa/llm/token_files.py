"""Token ids in ORC: whole documents in ascending id order, to be read in parallel by stripe or by document.

Rows are range partitioned and sorted by ``doc_id``; a file holds one range. ORC writes the ids with its integer
run-length encoding, keeps the smallest and largest id for each stripe and row group, and a Bloom filter of ids, so
a reader of a few documents skips the rest. A row also holds its part and the ids before it there: with one total per
part that gives each document's place in the whole stream without another sort.

Edge cases: a null or empty text is its end id alone. A null ``doc_id`` sorts first; repeated ids follow each other in order
of a hash of their texts. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brisa.llm.batches import configure_arrow, only, slices
from brisa.llm.tokens import encoder

END_ID = 1


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode whole texts and write ``(doc_id, part, before, ids)`` to ``path``; ``tokenizer`` is a file on every executor."""
    configure_arrow(docs.sparkSession)
    end = np.array([end_id], np.int32).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", keep=True):
            texts = pc.fill_null(batch.column("text"), "").to_pylist()
            rows = model.encode(texts)
            flat = np.frombuffer(end.join([*rows, b""]), np.int32)
            ends = np.cumsum([0, *[len(r) // 4 + 1 for r in rows]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(rows), part, np.int32)),
                    pa.array(before + ends[:-1]),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)),
                ],
                ["doc_id", "part", "before", "ids"],
            )
            before += int(ends[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = only(docs, "doc_id", "text").orderBy("doc_id", F.xxhash64("text"))
    encoded = ordered.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, part int, before long, ids array<int>")
    # Run lengths leave little for a compressor to find.
    encoded.write.option("compression", "lz4").option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path)


def read_tokens(spark: SparkSession, path: str, doc_type: str = "bigint") -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``; a filter on ``doc_id`` reaches the files' indexes."""
    rows = spark.read.schema(f"doc_id {doc_type}, part int, before long, ids array<int>").orc(path)
    # One row per part; their running total is the only thing that is in one place.
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.size("ids")).alias("total"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("offset"))
    # As many rows as the writer had partitions, whatever the data: small enough to send to every task.
    return rows.join(F.broadcast(offsets), "part").select("doc_id", (F.col("offset") + F.col("before")).alias("start"), F.size("ids").cast("long").alias("n_tokens"), "ids")


def with_crc(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``: the ids as a checksum of their little-endian unsigned 32-bit form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy().astype("<u4", copy=False)
            ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "start", "n_tokens")], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
