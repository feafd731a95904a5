"""Arrow batches of texts as byte, word and n-gram arrays.

A batch is cut into slices of about :data:`SLICE_BYTES`, so memory in a task follows the slice (or one
document, if that is larger) and never the partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from brisa.session import configure

T = TypeVar("T")

SLICE_BYTES = 1 << 20
# Rows that Spark puts into one Arrow batch: long documents must not add up to hundreds of megabytes.
ARROW_ROWS = 500
ARROW_BYTES = 16 << 20


def configure_arrow(spark: SparkSession) -> SparkSession:
    """The session's settings, and small Arrow batches for texts of any length."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


_held: dict[str, object] = {}


def held(name: str, make: Callable[[], T]) -> T:
    """What tasks of one kind share in a worker; a task of another kind lets go of it, so workers do not add up what they have seen."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """Cut batches by the bytes of a text column; a longer text is a slice of its own.

    Unless told to ``keep`` it, what earlier tasks of the worker held goes first.
    """
    if not keep:
        _held.clear()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a slice, and where each begins and the last ends; null is empty."""
    array = pc.fill_null(column.cast(pa.binary()).cast(pa.large_binary()), b"")
    ends = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    if not ends[-1] - ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return data, ends - ends[0]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry table that is true for the bytes within the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Separators of words written [^\x20\x09-\x0D]+.
SPACES = byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20  # A-Z only

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD1342543DE82EF95)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(count: int, step: np.uint64 = _STEP) -> np.ndarray:
    """step ** 0, 1, 2 ... modulo 2 ** 64."""
    out = np.full(count, step, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of a slice: byte spans, the first word of each document, and 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES):
        self.data, self.offsets = data, offsets
        inside = ~separators[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True  # a document's first byte, and the end
        before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        after = np.concatenate([inside[1:], [False]]) if len(data) else inside
        self.starts = np.flatnonzero(inside & (~before | first[:-1]))
        self.ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)  # of each document; the last entry is the end
        self.inside = inside

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        gaps = np.diff(np.append(self.starts, len(self.data)))
        place = np.arange(self.starts[0], len(self.data)) - np.repeat(self.starts, gaps)
        place = np.minimum(place, lengths.max())  # past the word's end; its values are zeroed below
        values = _BYTE[self.data[self.starts[0] :]] * powers(int(lengths.max()) + 1)[place]
        values[~self.inside[self.starts[0] :]] = 0
        return mix(np.add.reduceat(values, self.starts - self.starts[0]) + lengths.astype(np.uint64))


def gram_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` words; runs over a document's end are the caller's to skip."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    count = len(words) - size + 1
    total = np.full(count, seed, np.uint64)
    for shift in range(size):
        total *= _GRAM
        total += words[shift : shift + count]
    return mix(total)


def lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column from arrays."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """Just the named columns, whatever else there is."""
    return df.select(*[df[f"`{c}`"] for c in columns])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
