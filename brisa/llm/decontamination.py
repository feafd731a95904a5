"""Benchmark decontamination: Wu-Manber search for windows of benchmark words in whole documents.

The letters of the search are words, as 64-bit hashes. For patterns of at least m words, the last two words of an m-word window of
the document form a block; a shift table says how far the window can move before any pattern could end with that
block, which for most blocks is m - 1 words. Blocks with shift 0 lead to buckets of the patterns that end so, by the hash of the
whole window, and what is found there is compared word by word. Short patterns would shorten all shifts, so patterns
of each length are a search of their own. A slice of texts is searched from many places at once, as arrays.

Items are read to the driver in slices of at most ``slice_bytes`` of text; a worker holds the tables of one slice, some 40 bytes
for each of its words, and builds them once. One pass over the documents serves one slice; with more than one, the documents
are written once with a number, passes give the hits of the few rows that have any, and hits are joined by number.

Edge cases: null and wordless texts have no words and no hits; null and wordless items occur nowhere; items without an id are ignored;
repeated items and ids count once. Any other columns of documents are kept by :func:`clean`.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import session
from brisa.llm.batches import LOWER, Words, byte_class, configure_arrow, fresh, gram_hashes, held, only, slices, text_bytes

WINDOW = 13
# A document is contaminated if at least one word in this many is hit.
SHARE = 20
SLICE_BYTES = 8 << 20
# Words are ASCII letters (lower-cased) and digits, and all characters beyond ASCII; the rest separates.
_WORD = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
# Words of a text that one place of the search moves through.
STRIDE = 256


def words_of(column: pa.Array) -> Words:
    """The words of a column of texts, A-Z as a-z."""
    data, offsets = text_bytes(column)
    return Words(LOWER[data], offsets, ~_WORD)


class WuManber:
    """Search for word sequences of one length; ``starts`` are the places of patterns in the items' words."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, item: np.ndarray, length: int):
        self.length, self.words = length, words
        self.block = min(2, length)
        self.longest = length - self.block + 1
        blocks = gram_hashes(words, self.block)
        places = _spread(starts, self.longest, len(blocks))
        self.keys, number = np.unique(blocks[places], return_inverse=True)
        at = np.full(len(blocks), -1, np.int32)
        at[places] = number
        self.shift = np.full(len(self.keys), self.longest, np.uint8 if self.longest < 256 else np.int64)
        # The nearest end counts: later rounds are nearer.
        for place in range(self.longest):
            self.shift[at[starts + place]] = self.longest - 1 - place
        # Buckets: different patterns by the hash of all their words, with the items that hold each.
        whole = gram_hashes(words, length)[starts]
        order = np.lexsort((item, whole))
        whole, self.item, starts = whole[order], item[order], starts[order]
        first = np.append(True, whole[1:] != whole[:-1]) if len(whole) else np.zeros(0, bool)
        self.patterns, self.starts = whole[first], starts[first]
        self.bounds = np.append(np.flatnonzero(first), len(whole))

    @property
    def bytes(self) -> int:
        return sum(v.nbytes for v in vars(self).values() if isinstance(v, np.ndarray) and v is not self.words)

    def _moves(self, blocks: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.keys, blocks), len(self.keys) - 1)
        return np.where(self.keys[place] == blocks, self.shift[place], self.longest).astype(np.int64)

    def search(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of the pattern of every occurrence, in any order; ``first`` has the first word of each text, and the end."""
        if not len(self.patterns) or len(words) < self.length:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        blocks = gram_hashes(words, self.block)
        # Last words of windows, dealt to strides of each text.
        low, high = first[:-1] + self.length - 1, first[1:]
        counts = np.maximum(-(-(high - low) // STRIDE), 0)
        begin = np.repeat(low - STRIDE * (np.cumsum(counts) - counts), counts) + STRIDE * np.arange(counts.sum())
        stop = np.minimum(begin + STRIDE, np.repeat(high, counts))
        ends = []
        while len(begin):
            move = self._moves(blocks[begin - self.block + 1])
            ends.append(begin[move == 0])
            begin = begin + np.maximum(move, 1)
            live = begin < stop
            begin, stop = begin[live], stop[live]
        starts = np.concatenate(ends) - self.length + 1
        whole = np.zeros(len(starts), np.uint64)
        if len(starts):
            whole = gram_hashes(words, self.length)[starts]
        number = np.minimum(np.searchsorted(self.patterns, whole), len(self.patterns) - 1)
        same = self.patterns[number] == whole
        starts, number = starts[same], number[same]
        for place in range(self.length):
            same = words[starts + place] == self.words[self.starts[number] + place]
            starts, number = starts[same], number[same]
        return starts, number

    def items(self, number: int) -> np.ndarray:
        """Items that hold a pattern."""
        return self.item[self.bounds[number] : self.bounds[number + 1]]


def _spread(starts: np.ndarray, width: int, count: int) -> np.ndarray:
    """Places within ``width`` from any start."""
    marks = np.zeros(count + width + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return np.flatnonzero(np.cumsum(marks[:count]) > 0)


class Searches:
    """The searches of one slice of items, one for each length of pattern."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.names = [name for name, _ in items]
        words = words_of(pa.array([text for _, text in items], pa.string()))
        hashes, counts = words.hashes(), words.counts()
        sizes = np.minimum(counts, window)
        self.all = []
        for length in np.unique(sizes[sizes > 0]).tolist():
            chosen = np.flatnonzero(sizes == length)
            windows = counts[chosen] - length + 1
            starts = np.repeat(words.first[:-1][chosen] - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
            self.all.append(WuManber(hashes, starts, np.repeat(chosen, windows).astype(np.int32), length))

    @property
    def bytes(self) -> int:
        return sum(s.bytes for s in self.all) + (self.all[0].words.nbytes if self.all else 0)

    def hits(self, words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[str]]]:
        """For each text with any: its number, the starts and ends of occurrences, and the items."""
        hashes = words.hashes()
        found = []
        for number, search in enumerate(self.all):
            starts, patterns = search.search(hashes, words.first)
            found.append((starts, starts + search.length, patterns, np.full(len(starts), number)))
        starts, ends, patterns, by = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
        text = np.searchsorted(words.first, starts, "right") - 1
        order = np.argsort(text, kind="stable")
        cuts = np.flatnonzero(np.diff(text[order])) + 1
        for part in np.split(order, cuts) if len(order) else ():
            number = int(text[part[0]])
            occurring = set(zip(by[part].tolist(), patterns[part].tolist()))
            held_by = np.unique(np.concatenate([self.all[b].items(p) for b, p in occurring]))
            base = words.first[number]
            yield number, starts[part] - base, ends[part] - base, [self.names[i] for i in held_by.tolist()]


RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
    ]
)
EMPTY = hashlib.sha256(b"").hexdigest()
HITS = "row long, starts array<long>, ends array<long>, items array<string>"


def covered(starts: np.ndarray, ends: np.ndarray) -> int:
    """Words within any of the spans."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    reach = np.maximum.accumulate(np.concatenate([[0], ends]))[:-1]
    return int(np.maximum(ends - np.maximum(starts, reach), 0).sum())


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _columns(counts: np.ndarray, found: dict[int, tuple[int, int, str]], share: int) -> list[pa.Array]:
    """The columns of :data:`RESULT` from word counts and, for texts with hits, (hit words, items, digest)."""
    rows = [found.get(i, (0, 0, EMPTY)) for i in range(len(counts))]
    hit, items, digests = (list(c) for c in zip(*rows)) if rows else ([], [], [])
    hit_ = np.array(hit, np.int64)
    return [pa.array(counts, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.int64()), pa.array(digests, pa.string()), pa.array((hit_ > 0) & (share * hit_ >= counts))]


def _once(docs: DataFrame, items: list[tuple[str, str]], to: str, window: int, share: int) -> DataFrame:
    """``docs`` with their result, where one slice holds all items."""
    shared, name = session.share(docs.sparkSession, items), f"searches {uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held(name, lambda: Searches(shared.value, window))
        for batch in slices(batches, "text", keep=True):
            words = words_of(batch.column("text"))
            found = {n: (covered(starts, ends), len(set(names)), _digest(set(names))) for n, starts, ends, names in tables.hits(words)}
            struct = pa.StructArray.from_arrays(_columns(words.counts(), found, share), RESULT.names)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, to])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(to, RESULT)]))


def _hits(docs: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    """Hits of one slice of items, by row number, of rows that have any."""
    shared, name = session.share(docs.sparkSession, items), f"searches {uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held(name, lambda: Searches(shared.value, window))
        for batch in slices(batches, "text", keep=True):
            rows = batch.column("row").to_pylist()
            out = [(rows[n], starts.tolist(), ends.tolist(), names) for n, starts, ends, names in tables.hits(words_of(batch.column("text")))]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)], ["row", "starts", "ends", "items"])

    return docs.select("row", "text").mapInArrow(run, HITS)


def _counted(docs: DataFrame) -> DataFrame:
    """``(row, n_words)`` of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(words_of(batch.column("text")).counts(), pa.int64())], ["row", "n_words"])

    return docs.select("row", "text").mapInArrow(run, "row long, n_words long")


def _merged(counts: DataFrame, hits: DataFrame, share: int) -> DataFrame:
    """``(row, found)`` of all rows, from the hits of all slices; a row's hits are as many as its words and slices allow."""
    gathered = hits.groupBy("row").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            for place, (starts, ends, items) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("starts", "ends", "items")])):
                if starts:
                    found[place] = covered(np.array(starts), np.array(ends)), len(set(items)), _digest(set(items))
            struct = pa.StructArray.from_arrays(_columns(batch.column("n_words").to_numpy(), found, share), RESULT.names)
            yield pa.RecordBatch.from_arrays([batch.column("row"), struct], ["row", "found"])

    rows = counts.join(gathered, "row", "left")
    return rows.mapInArrow(run, T.StructType([T.StructField("row", T.LongType()), T.StructField("found", RESULT)]))


def _parts(benchmark: DataFrame, slice_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items in slices of about ``slice_bytes`` of text, one after the other; at least one, if without items."""
    items = only(benchmark, "item_id", "text").where("item_id is not null and text is not null")
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // slice_bytes))
    for number in range(count):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number) if count > 1 else items
        yield sorted((row["item_id"], row["text"]) for row in chosen.collect())


def _numbered(docs: DataFrame) -> DataFrame:
    return session.write_out(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")


def _found(docs: DataFrame, parts: Iterator[list[tuple[str, str]]], window: int, share: int) -> DataFrame:
    """``(row, found)`` for numbered documents, slice by slice."""
    hits = []
    for part in parts:
        hits.append(session.write_out(_hits(docs, part, window), "hits"))
    together = hits[0]
    for more in hits[1:]:
        together = together.union(more)
    return _merged(_counted(docs), together, share)


def _slices(benchmark: DataFrame, slice_bytes: int) -> tuple[list[tuple[str, str]], Iterator[list[tuple[str, str]]] | None]:
    """The only slice and nothing, or the first and all of them."""
    parts = _parts(benchmark, slice_bytes)
    first = next(parts)
    second = next(parts, None)
    if second is None:
        return first, None

    def every() -> Iterator[list[tuple[str, str]]]:
        yield first
        yield second
        yield from parts

    return first, every()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` per document."""
    configure_arrow(docs.sparkSession)
    docs = only(docs, "doc_id", "text")
    part, parts = _slices(benchmark, slice_bytes)
    if parts is None:
        return _once(docs, part, "found", window, share).select("doc_id", "found.*")
    rows = _numbered(docs)
    return rows.select("row", "doc_id").join(_found(rows, parts, window, share), "row").select("doc_id", "found.*")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    configure_arrow(docs.sparkSession)
    part, parts = _slices(benchmark, slice_bytes)
    if parts is None:
        name = fresh(docs, "found")
        return _once(docs, part, name, window, share).where(~F.col(f"`{name}`.contaminated")).drop(name)
    place, columns = fresh(docs, "row"), [f"`{c}`" for c in docs.columns]
    rows = session.write_out(docs.withColumn(place, F.monotonically_increasing_id()), "numbered")
    searched = rows.select(F.col(f"`{place}`").alias("row"), F.col("`text`").alias("text"))
    bad = _found(searched, parts, window, share).where("found.contaminated").select(F.col("row").alias(place))
    return rows.join(bad, place, "left_anti").select(*columns)
