"""Quality rules: base counts of whole texts, and a calibrated n-gram classifier for texts that pass them.

The classifier is a logistic regression on hashed word and character n-grams. It is fitted on a bounded sample of labelled
rows; a Platt scale fitted on rows that the regression has not seen turns its margins into probabilities.
Texts are counted and scored in Arrow batches, as arrays, against fixed thresholds.

Edge cases: a null or empty text has no words and fails the base rules. Labels other than 0 and 1, null labels and null ids
are not learned from; a document labelled both ways is not either. With no rows of one label, every text that passes the base
rules is kept. Repeated rows score alike. Other columns are kept by :func:`kept_documents`. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.llm.batches import Words, byte_class, configure_arrow, fresh, gram_hashes, mix, only, powers, slices, text_bytes
from brisa.session import share, write_out

# Labelled rows of each label to fit on, at most, and bytes of their n-grams; slots of the hash.
SAMPLE, SAMPLE_BYTES, LOG_SIZE = 2000, 64 << 20, 16
MIN_WORDS, REPEAT_PERCENT = 50, 50
# A text is kept if its probability of good quality is at least this.
KEEP = 0.5
WORD_GRAMS, CHAR_GRAMS = (1, 2), (2, 4)
_SYMBOLS = byte_class(*[(ord(c), ord(c)) for c in "#*$%&|<>"])


@dataclass
class Counts:
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray

    def failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > REPEAT_PERCENT * self.n_words)


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a value per byte (or word) over each text."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[offsets])


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    raw, out = data.tobytes(), []
    for first, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        lines = [line for line in raw[first:end].split(b"\n") if line and not line.isspace()]
        out.append(len(lines) - len(set(lines)))
    return np.array(out, np.int64)


def _repeated_words(words: Words) -> np.ndarray:
    """Words in windows of three that occur twice or more in their text; words are compared, not hashes."""
    total = len(words.starts)
    counts = words.counts()
    if total < 3:
        return np.zeros(len(counts), np.int64)
    raw, known = words.data.tobytes(), {}
    ids = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(words.starts.tolist(), words.ends.tolist())], np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    starts = np.flatnonzero(text[:-2] == text[2:])
    # Pairs of words get numbers, then a number and a word; texts are kept apart in the first key.
    scale = np.int64(len(known) + 1)
    _, pair = np.unique(text[starts] * scale + ids[starts], return_inverse=True)
    _, pair = np.unique(pair * scale + ids[starts + 1], return_inverse=True)
    _, window, times = np.unique(pair * scale + ids[starts + 2], return_inverse=True, return_counts=True)
    twice = starts[times[window] > 1]
    covered = np.zeros(total, bool)
    for shift in range(3):
        covered[twice + shift] = True
    return _per_text(covered, words.first)


def count(data: np.ndarray, offsets: np.ndarray, words: Words) -> Counts:
    begins = words.inside & ((data & 0xC0) != 0x80)  # a code point's first byte
    return Counts(
        words.counts(),
        _per_text(begins, offsets),
        _per_text(_SYMBOLS[data], offsets),
        _duplicate_lines(data, offsets, words.inside),
        _repeated_words(words),
    )


def _grams(data: np.ndarray, offsets: np.ndarray, words: Words, log_size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Hashed slots of n-grams, the text of each, and how many kinds there are before; n-grams never leave their text."""
    hashes = words.hashes()
    text_of_word = np.repeat(np.arange(len(offsets) - 1), words.counts())
    shift = np.uint64(64 - log_size)
    for size in WORD_GRAMS:
        grams = gram_hashes(hashes, size, seed=size)
        at = np.flatnonzero(text_of_word[: len(grams)] == text_of_word[size - 1 :][: len(grams)])
        yield (grams[at] >> shift).astype(np.int32), text_of_word[at], size
    text_of_byte = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for size in CHAR_GRAMS:
        if len(data) < size:
            continue
        length = len(data) - size + 1
        total = np.full(length, 1000 + size, np.uint64)
        for place, power in enumerate(powers(size + 1)[1:]):
            total += data[place : place + length] * power
        at = np.flatnonzero(text_of_byte[:length] == text_of_byte[size - 1 :])
        yield (mix(total[at]) >> shift).astype(np.int32), text_of_byte[at], size


@dataclass
class Model:
    weights: np.ndarray  # of slots, by kind of n-gram
    bias: float
    slope: float = 1.0  # Platt scale
    shift: float = 0.0

    def margins(self, data: np.ndarray, offsets: np.ndarray, words: Words, log_size: int) -> np.ndarray:
        """Mean weight of each kind's n-grams, summed over the kinds, per text."""
        texts = len(offsets) - 1
        out = np.full(texts, self.bias)
        for slots, text, _ in _grams(data, offsets, words, log_size):
            sums = np.bincount(text, self.weights[slots], texts)
            out += sums / np.maximum(np.bincount(text, minlength=texts), 1)
        return out

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _features(docs: DataFrame, log_size: int) -> DataFrame:
    """``(id, label, part, slots, values)``: each text's share of n-grams per slot; only of sampled rows, each id once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in slices(batches, "text"):
            batch = batch.filter(pa.array([i not in seen and not seen.add(i) for i in batch.column("id").to_pylist()], pa.bool_()))
            if not batch.num_rows:
                continue
            data, offsets = text_bytes(batch.column("text"))
            words = Words(data, offsets)
            texts = len(offsets) - 1
            keys, values = [], []
            for slots, text, _ in _grams(data, offsets, words, log_size):
                each = np.bincount(text, minlength=texts)
                key, times = np.unique((text.astype(np.int64) << log_size) | slots, return_counts=True)
                keys.append(key)
                values.append((times / each[key >> log_size]).astype(np.float32))
            key, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, values))
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            cuts = np.searchsorted(key >> log_size, np.arange(1, texts))
            slots = [s.astype("<i4").tobytes() for s in np.split(key & ((1 << log_size) - 1), cuts)]
            values_ = [v.astype("<f4").tobytes() for v in np.split(value, cuts)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in ("id", "label", "part")], pa.array(slots, pa.binary()), pa.array(values_, pa.binary())],
                ["id", "label", "part", "slots", "values"],
            )

    return docs.mapInArrow(run, "id string, label int, part int, slots binary, values binary")


def _descend(x: tuple[np.ndarray, np.ndarray, np.ndarray], y: np.ndarray, size: int, steps: int, ridge: float) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam steps over all rows; both labels weigh the same."""
    slots, values, row = x
    balance = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    weights, bias = np.zeros(size), 0.0
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        margin = np.bincount(row, weights[slots] * values, len(y)) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * balance
        slope = np.append(np.bincount(slots, error[row] * values, size) + ridge * weights, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = 0.5 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, bias


def _platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins of rows that were not fitted on (Newton steps)."""
    up, down = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    theta, x = np.array([1.0, 0.0]), np.stack([margins, np.ones_like(margins)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        theta = theta - np.linalg.solve(hessian, x @ (p - target) + 1e-3 * (theta - [1.0, 0.0]))
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, log_size: int = LOG_SIZE, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Learn from up to ``sample`` labelled documents of each label, chosen by a hash of their ids; a fifth of them calibrates.

    Of each label, as many as have ``sample_bytes`` of distinct n-grams together; one text has 2.5 MB of them at most.
    """
    clear = only(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
    clear = clear.agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other")
    order = F.xxhash64(F.col("doc_id").cast("string"))
    picked = [clear.where(F.col("label") == label).orderBy(order, "doc_id").limit(sample) for label in (0, 1)]
    chosen = picked[0].union(picked[1]).select("doc_id", F.col("label").cast("int").alias("label"), F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)).cast("int").alias("part"))
    # At most 2 * sample ids, and one text of each: the least by a hash. A repeated id, even a hot one, counts and costs like any other.
    texts = only(docs, "doc_id", "text").withColumn("hash", F.xxhash64("text"))
    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "part").agg(F.min("hash").alias("hash"))
    rows = texts.join(F.broadcast(one), ["doc_id", "hash"]).select(F.col("doc_id").cast("string").alias("id"), "text", "label", "part")
    features = write_out(_features(rows, log_size).dropDuplicates(["id"]), "features")
    # What comes to the driver does not follow the length of texts: rows in the order of the hash, up to the bound.
    upto = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    sizes = features.select("id", "label", F.sum(F.octet_length("slots") + F.octet_length("values")).over(upto).alias("upto"))
    found = features.join(F.broadcast(sizes.where(F.col("upto") <= sample_bytes).select("id")), "id").toArrow().to_pydict()
    # Rows come back in any order: sort them, so that sums and so the model do not depend on it.
    rows = sorted(zip(found["part"], found["label"], found["slots"], found["values"]))
    held = [[r for r in rows if (r[0] == 0) == test] for test in (False, True)]

    def matrix(part: list[tuple]) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        slots = [np.frombuffer(r[2], "<i4") for r in part]
        values = np.frombuffer(b"".join(r[3] for r in part), "<f4").astype(np.float64)
        x = np.concatenate(slots or [np.zeros(0, np.int32)]), values, np.repeat(np.arange(len(part)), [len(s) for s in slots])
        return x, np.array([r[1] for r in part], float)

    x, y = matrix(held[0])
    if not 0 < y.sum() < len(y):
        return None
    weights, bias = _descend(x, y, 1 << log_size, 60, 1e-6)
    model = Model(weights, bias)
    (slots, values, row), y = matrix(held[1])
    if 0 < y.sum() < len(y):
        model.slope, model.shift = _platt(np.bincount(row, weights[slots] * values, len(y)) + bias, y)
    return model


RESULT = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("probability", T.DoubleType()),
    ]
)


def judge(docs: DataFrame, model: Model | None, to: str, keep: float = KEEP, log_size: int = LOG_SIZE) -> DataFrame:
    """``docs`` with a struct column ``to`` of :data:`RESULT`."""
    configure_arrow(docs.sparkSession)
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            words = Words(data, offsets)
            counts = count(data, offsets, words)
            failed = counts.failed()
            model = shared.value
            chance = np.ones(len(failed)) if model is None else model.probability(model.margins(data, offsets, words, log_size))
            columns = [*[v for v in vars(counts).values()], failed, ~failed & (chance >= keep), chance]
            struct = pa.StructArray.from_arrays([pa.array(c) for c in columns], RESULT.names)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, to])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(to, RESULT)]))


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id`` and the columns of :data:`RESULT` per document."""
    return judge(only(docs, "doc_id", "text"), fit(docs, labels), "found", **options).select("doc_id", "found.*")


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    name = fresh(docs, "found")
    return judge(docs, fit(docs, labels), name, **options).where(F.col(f"`{name}`.kept")).drop(name)
