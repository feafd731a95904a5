"""Runs of words that repeat with a period at least four times, found in tiles per octave of the period.

A run is a longest stretch of words with smallest period q, at least ``max(6, 4 * q)`` words long. Its *matches* are the
places m with ``word[m] == word[m + q]``: one interval of at least 3 * q places. For the octave P <= q < 2 * P (P a power of two)
a document has a boundary at every P-th word, so every interval holds boundaries at least P places from both its ends.
At such a boundary two Z-functions give, for all periods of the octave at once, how far the words after it
match those a period later, and how far those before it do; what reaches 2 * P places either way is a fragment of the interval.

Boundaries are dealt in tiles of some thousand words with the words their Z-functions need on both sides, so a tile is solved
by itself, on any executor; only tiles with a boundary where a window of 2 * P words recurs a period later (by rolling hashes of
all windows) can hold anything and are sent. Fragments are shuffled by document and period and stitched: those of one run overlap.
A period whose block of q words is itself periodic belongs to a run of a smaller one and is dropped at the boundary, so at
most one fragment per boundary and octave is left.

Words are compared by 64-bit hashes. Edge cases: null and wordless texts have no words and no runs; repeated and null ids are rows of
their own; whole texts are searched whatever their length. Of columns with other names nothing is read. No rows give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.batches import Words, configure_arrow, mix, only, powers, slices, text_bytes
from brisa.session import write_out

# A run has at least so many words, and its period at least so many times.
LEAST, TIMES = 6, 4
# Words between the first and the last boundary of a tile; long periods have longer tiles.
TILE = 4096


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal those from the start on."""
    n = len(s)
    z = [n] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def divisors(q: int) -> list[int]:
    """``q`` divided by each of its prime factors."""
    out, rest, factor = [], q, 2
    while factor * factor <= rest:
        if rest % factor == 0:
            out.append(q // factor)
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return out + ([q // rest] if rest > 1 else [])


def at_boundary(words: list[int], c: int, size: int) -> Iterator[tuple[int, int, int]]:
    """``(period, low, high)``: matches around boundary ``c`` for periods of ``size`` to ``2 * size - 1``, up to ``2 * size`` either way."""
    reach = 2 * size
    after = z_function(words[c : c + 2 * reach])
    pattern = words[max(0, c - reach) : c][::-1]
    end = min(c + reach, len(words))
    before = z_function([*pattern, -1, *words[max(0, c - reach) : end][::-1]])
    for q in range(size, min(reach, end - c + 1, len(after))):
        low, high = min(before[len(pattern) + 1 + end - c - q], reach), min(after[q], reach)
        if low + high >= 3 * size and not any(after[d] >= q - d for d in divisors(q)):
            yield q, c - low, c + high


def solve(words: list[int], boundaries: list[int], size: int) -> list[tuple[int, int, int]]:
    """Fragments ``(period, low, high)`` of a tile, those that overlap joined."""
    found: dict[int, list[list[int]]] = defaultdict(list)
    for c in boundaries:
        for q, low, high in at_boundary(words, c, size):
            held = found[q]
            if held and low <= held[-1][1]:
                held[-1][1] = max(held[-1][1], high)
            else:
                held.append([low, high])
    return [(q, low, high) for q, spans in found.items() for low, high in spans]


def candidates(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per octave, the boundaries (ascending word numbers of the slice) that may lie within a run.

    ``first`` has the first word of each document. A boundary c stands for the windows of 2 * size words from c - size on and
    from c - size + q on, which must be equal and within one document.
    """
    longest = int(np.diff(first).max(initial=0))
    window, size, step = mix(hashes), 1, powers(2)[1:]
    while TIMES * size <= longest and longest >= LEAST:
        # From windows of ``size`` words to those of twice as many.
        window = window[:-size] * step + window[size:]
        step = step * step
        hit = np.flatnonzero(window[size:] == np.repeat(window[::size], size)[: len(window) - size]) + size
        c = hit // size * size
        within = np.searchsorted(first, c - size, "right") == np.searchsorted(first, hit + 2 * size - 1, "right")
        c = np.unique(c[within])
        if len(c):
            yield size, c
        size *= 2


def tiles(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """``(document, size, base, words, boundaries)``: numbered words of a tile from word ``base`` of its document on, boundaries within."""
    for size, boundaries in candidates(hashes, first):
        doc = np.searchsorted(first, boundaries, "right") - 1
        tile = (boundaries - first[doc]) // max(TILE, 4 * size)
        cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(tile) != 0)) + 1
        for part, number in zip(np.split(boundaries, cuts), doc[np.concatenate([[0], cuts])].tolist()):
            low = max(int(part[0]) - 2 * size, int(first[number]))
            high = min(int(part[-1]) + 4 * size, int(first[number + 1]))
            words = np.unique(hashes[low:high], return_inverse=True)[1].astype(np.int32)
            yield number, size, low - int(first[number]), words, part - low


TILES = "row long, doc_id {}, text string, size int, base int, words binary, boundaries binary"
_TILES = [("text", pa.string()), ("size", pa.int32()), ("base", pa.int32()), ("words", pa.binary()), ("boundaries", pa.binary())]


def _of_slice(batch: pa.RecordBatch) -> tuple[Words, list]:
    words = Words(*text_bytes(batch.column("text")))
    return words, list(tiles(words.hashes(), words.first))


def _tiled(docs: DataFrame) -> DataFrame:
    """Rows of documents that may have runs, each with a number, and rows of their tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text"):
            _, found = _of_slice(batch)
            docs_ = sorted({f[0] for f in found})
            numbers = {doc: row + place for place, doc in enumerate(docs_)}
            row += len(docs_)
            ids, texts = (batch.column(c).take(pa.array(docs_, pa.int64())) for c in ("doc_id", "text"))
            whole = [pa.array(list(numbers.values()), pa.int64()), ids, texts.cast(pa.string()), *[pa.nulls(len(docs_), k) for _, k in _TILES[1:]]]
            names = ["row", "doc_id", *[n for n, _ in _TILES]]
            yield pa.RecordBatch.from_arrays(whole, names)
            held, size = [], 0
            for tile in [*found, None]:
                if tile is None or size > 1 << 22:
                    columns = list(zip(*held)) or [[]] * 5
                    tail = [pa.array(c, k) for c, (_, k) in zip(columns[1:], _TILES[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.nulls(len(held), ids.type), pa.nulls(len(held), pa.string()), *tail], names)
                    held, size = [], 0
                if tile is not None:
                    doc, octave, base, words, boundaries = tile
                    held.append((numbers[doc], octave, base, words.tobytes(), boundaries.astype(np.int32).tobytes()))
                    size += 4 * len(words)

    return docs.mapInArrow(run, TILES.format(docs.schema["doc_id"].dataType.simpleString()))


def _fragments(tiled: DataFrame) -> DataFrame:
    """``(row, period, low, high)`` of all tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, size, base, words, boundaries in zip(*[batch.column(c).to_pylist() for c in ("row", "size", "base", "words", "boundaries")]):
                found = solve(np.frombuffer(words, np.int32).tolist(), np.frombuffer(boundaries, np.int32).tolist(), size)
                out += [(row, q, base + low, base + high) for q, low, high in found]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "period", "low", "high"])

    # Tiles of a long document are solved on many executors; a few bytes are seconds of work, so partitions are not merged by size.
    count = int(tiled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = tiled.where("size is not null").select("row", "size", "base", "words", "boundaries").repartition(count, "row", "size", "base")
    return spread.mapInArrow(run, "row long, period long, low long, high long")


def stitched(fragments: DataFrame) -> DataFrame:
    """``(row, start, length, period)``: fragments of a document and period joined where they overlap, those that are runs."""
    order = Window.partitionBy("row", "period").orderBy("low", "high")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.withColumn("new", F.coalesce((F.col("low") > reached).cast("int"), F.lit(0)))
    joined = marked.withColumn("island", F.sum("new").over(order)).groupBy("row", "period", "island").agg(F.min("low").alias("start"), F.max("high").alias("high"))
    length = F.col("high") - F.col("start") + F.col("period")
    return joined.select("row", "start", length.alias("length"), "period").where((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))


RUNS = "array<struct<start: long, length: long, period: long>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _collapsed(found: DataFrame, kind: str) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of documents with their runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, texts = [], []
            for text, runs in zip(pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist(), batch.column("runs").to_pylist()):
                words = text.split()
                dropped = np.zeros(len(words) + 1, np.int64)
                for r in runs or []:
                    dropped[r["start"] + r["period"]] += 1
                    dropped[r["start"] + r["length"]] -= 1
                kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()
                counts.append(len(words))
                texts.append(b" ".join([words[i] for i in kept] if runs else words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), batch.column("runs").cast(_RUNS), pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return found.mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def _without_tiles(docs: DataFrame) -> DataFrame:
    """The documents that have no tile, so no run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keep = np.ones(batch.num_rows, bool)
            keep[[f[0] for f in _of_slice(batch)[1]]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` per document of ``docs(doc_id, text)``.

    ``runs`` has the runs by start, then period (word numbers from 0); ``collapsed`` the words joined by one space, without those that any
    run holds after its first period.
    """
    configure_arrow(docs.sparkSession)
    docs = only(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    tiled = write_out(_tiled(docs), "tiles")
    runs = stitched(_fragments(tiled)).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
    runs = runs.select("row", F.transform("found", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs"))
    own = tiled.where("size is null").select("row", "doc_id", "text").join(runs, "row", "left")
    none = F.array().cast(RUNS)
    with_tiles = own.select("doc_id", "text", F.coalesce("runs", none).alias("runs"))
    return _collapsed(with_tiles, kind).union(_collapsed(_without_tiles(docs).withColumn("runs", none), kind))
