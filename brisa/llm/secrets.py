"""Secret scans: patterns over whole texts and, by a worklist, over everything that is encoded in them.

A layer is a text and the span of the document that each part of it stands for. The worklist starts with the document.
Each layer is searched; then every run in it that looks encoded (percent escapes, Unicode and hexadecimal escapes,
base64 or hexadecimal digits, and zlib or gzip data within those) is decoded and becomes a new layer, whatever its
characters. Escapes are edits over their layer, so the rest of the text keeps its place; anything within a run of
digits stands for the whole run. A match in a layer is reported with the span of the document that it stands for.

Base64 is decoded in both alphabets, over line breaks and from each of its first four characters, so what comes before the
data in the same run, such as a path, hides nothing. All patterns are ASCII: decoded bytes are searched one character for
each, and as UTF-16 (and UTF-32) of either order if they have a NUL, which any such match has.

No layer is left out. What data within a run unfolds to is worked on in pieces of ``PIECE`` bytes; matches, runs and compressed
data that a piece ends in go on in the next, so memory follows the document and the piece, not what is unpacked. Only a
caller that gives ``most`` bounds what each compressed part may unfold to; ``complete`` is false if that left something out.

Edge cases: a null or empty text has no secrets. A text that is one long match is one span. Repeated rows give equal
results. Other columns are kept by :func:`redact`. No rows give no rows.
"""

from __future__ import annotations

import binascii
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.llm.batches import configure_arrow, fresh, only, slices

PIECE = 4 << 20
KINDS = ("assign", "access", "hex")
ASSIGN, ACCESS, HEX = 12, 18, 16
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile(f"[0-9a-f]{{{HEX},}}")  # [0-9a-f]+ takes whole runs; shorter ones fail
PLACEHOLDER = "[SECRET]"

# Runs that may be encoded. The escapes are decoded one by one; an escaped escape sign is taken with all that follow it.
_PERCENT = re.compile(r"(?:%(?:25(?=25))*[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\(?:(?:u005[cC]|x5[cC])(?=u005[cC]|x5[cC]))*(?:u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2}))"
    r"|&(?:(?:#38;|#x26;)(?=#38;|#x26;))*(?:#x([0-9A-Fa-f]{1,6});|#([0-9]{1,7});)"
)
_UNFINISHED = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]?|\\(?:u005[cC]|x5[cC])*(?:[ux][0-9A-Fa-f]{0,3})?|&(?:#38;|#x26;)*(?:#x?[0-9A-Fa-f]{0,7})?)\Z")
_SHORT = re.compile(r"(?<=[^A-Za-z0-9+/_\s-])\s*[A-Za-z0-9+/_-]{1,31}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]{1,31}){0,7}\Z|(?<=[^A-Za-z0-9+/_-][^\S\r\n])[A-Za-z0-9+/_-]{1,31}\Z")
# A run of either base64 alphabet, over line breaks; possessive, so that words are passed once.
_BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{16}|[A-Za-z0-9+/_-]{1,15}[ \t]*\r?\n)"
    r"[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+={0,2}"
)
_DIGITS = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}")
_PACKED = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]")
_PLAIN = str.maketrans("-_", "+/", " \t\r\n=")
# Decoded bytes without any of these have no match and nothing encoded in them.
_WORTH = re.compile(
    rb"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{16}|%[0-9A-Fa-f]{2}|\\[ux]|&#|[A-Za-z0-9+/_-]{16}|\n|\x00|\x1f\x8b\x08|x[\x01\x5e\x9c\xda]"
)


def search(text: str) -> list[tuple[str, int, int]]:
    """Base matches ``(kind, start, end)`` of one layer."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


class Layer:
    """A text whose parts stand for spans of the document: from ``at[i]`` on, characters follow each other from ``low[i]``, or
    all stand for ``[low[i], high[i])`` if there is a high end."""

    def __init__(self, text: str, at: list[int], low: list[int], high: list[int | None]):
        self.text, self.at, self.low, self.high = text, at, low, high

    def span(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        low = self.low[i] if self.high[i] is not None else self.low[i] + start - self.at[i]
        return low, self.high[j] if self.high[j] is not None else self.low[j] + end - self.at[j]

    def edited(self, runs: list[tuple[int, int, str]]) -> Layer:
        """The layer with runs replaced; each new character stands for the whole of its run's part."""
        text, at, low, high, old, size, part = [], [], [], [], 0, 0, 0

        def keep(start: int, end: int) -> None:
            """Parts of this layer between two places."""
            nonlocal size, part
            while part + 1 < len(self.at) and self.at[part + 1] <= start:
                part += 1
            i = part
            while start < end:
                stop = min(end, self.at[i + 1]) if i + 1 < len(self.at) else end
                at.append(size)
                low.append(self.low[i] if self.high[i] is not None else self.low[i] + start - self.at[i])
                high.append(self.high[i])
                text.append(self.text[start:stop])
                size, start, i = size + stop - start, stop, i + 1

        for start, end, new in runs:
            keep(old, start)
            first, last = self.span(start, end)
            text.append(new)
            at.append(size)
            low.append(first)
            high.append(last)
            size, old = size + len(new), end
        keep(old, len(self.text))
        return Layer("".join(text), at, low, high)


def _escapes(text: str) -> list[tuple[int, int, str]]:
    """Unicode, hexadecimal and entity escapes with their characters; escapes that are no character stay."""
    out = []
    if "\\" in text or "&#" in text:
        for m in _ESCAPE.finditer(text):
            code = int(m[1] or m[2] or m[3], 16) if m[4] is None else int(m[4])
            if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000:
                out.append((*m.span(), chr(code)))
    return out


_ONE_PERCENT = re.compile(r"%((?:25(?=25))*)([0-9A-Fa-f]{2})")


def _percents(text: str) -> list[tuple[int, int, str]]:
    """Percent escapes, character by character of their UTF-8; bytes that are no UTF-8 stay."""
    out = []
    if "%" not in text:
        return out
    for run in _PERCENT.finditer(text):
        marks = list(_ONE_PERCENT.finditer(text, *run.span()))
        raw = bytes(int(m[2], 16) for m in marks)
        i = 0
        while i < len(raw):
            lead = raw[i]
            size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            try:
                out.append((marks[i].start(), marks[min(i + size, len(raw)) - 1].end(), raw[i : i + size].decode()))
            except UnicodeDecodeError:
                size = 1
            i += size
    return out


def _decoded(body: str, phase: int) -> bytes:
    """Bytes of base64 digits from one of the first four on, as far as they go."""
    part = body[phase:] if phase else body
    left = len(part) % 4
    if left == 1:
        part = part[:-1]
    return binascii.a2b_base64(part + "=" * (-len(part) % 4))


def _blocks(text: str) -> Iterator[tuple[int, int, bytes]]:
    """What runs of base64 or hexadecimal digits decode to, if there may be anything in it."""
    for run in _BASE64.finditer(text):
        body = run[0].translate(_PLAIN)
        if len(body) >= 16:
            for phase in range(4):
                raw = _decoded(body, phase)
                if _WORTH.search(raw):
                    yield run.start(), run.end(), raw
    for run in _DIGITS.finditer(text):
        for phase in range(2):
            raw = bytes.fromhex(run[0][phase : len(run[0]) - (len(run[0]) - phase) % 2])
            if _WORTH.search(raw):
                yield run.start(), run.end(), raw


class _Unpacker:
    """Compressed data on its way to a sink, a piece at a time."""

    def __init__(self, scan: Scan, sink: Sink):
        self.scan, self.sink, self.size = scan, sink, 0
        self.stream = zlib.decompressobj(47)

    def feed(self, raw: bytes | memoryview) -> bool:
        """Whether more may follow."""
        # A part at a time, as what is not consumed is copied.
        return all(self._part(raw[i : i + (PIECE >> 2)]) for i in range(0, len(raw), PIECE >> 2))

    def _part(self, raw: bytes | memoryview) -> bool:
        while True:
            try:
                new = self.stream.decompress(raw, PIECE)
            except zlib.error:
                return False  # what came out before is kept
            self.size += len(new)
            if self.scan.most is not None and self.size > self.scan.most:
                self.scan.complete = False
                return False
            self.sink.feed(new)
            raw = self.stream.unconsumed_tail
            if self.stream.eof or (not raw and len(new) < PIECE):
                return not self.stream.eof


class Sink:
    """Decoded bytes that all stand for one span of the document. Up to a piece is put on the worklist as a whole when it
    ends; more is worked on piece by piece."""

    def __init__(self, scan: Scan, span: tuple[int, int], wide: int = 0):
        self.scan, self.span, self.wide = scan, span, wide
        self.parts, self.size, self.begun = [], 0, False
        self.found, self.before, self.last, self.count = "", b"", b"", 0
        self.edits: list[Sink | None] = [None, None]
        self.wides: list[Sink] | None = None
        self.unpackers: list[_Unpacker] = []
        # Runs of base64 and hexadecimal digits that the last piece ended in: a sink and digits to come for each phase.
        self.runs: list[list[tuple[Sink, str]]] = [[], []]

    def feed(self, raw: bytes) -> None:
        self.parts.append(raw)
        self.size += len(raw)
        if self.size >= PIECE:
            self.flush()

    def flush(self) -> None:
        data = b"".join(self.parts)
        # A short run, line break or escape that the piece ends in is left for the next one.
        end = len(data.rstrip(b" \t\r\n"))
        for pattern in (_SHORT, _UNFINISHED):
            if m := pattern.search(data[max(0, end - 1024) : end].decode("latin-1")):
                end -= len(m[0])
                end = len(data[:end].rstrip(b" \t\r\n")) if pattern is _SHORT else end
        if end < len(data) // 2:
            end = len(data)
        self.parts, self.size, self.begun = [data[end:]], len(data) - end, True
        mark = len(self.scan.work)
        self.piece(data[:end], False)
        self.scan.drain(mark)

    def close(self) -> None:
        data = b"".join(self.parts)
        self.parts, self.size = [], 0
        if self.begun:
            self.piece(data, True)
        elif _WORTH.search(data):
            self.scan.add(data, self.span, self.wide)

    def piece(self, data: bytes, last: bool) -> None:
        """Search a piece and hand on what is encoded in it."""
        text, whole = data.decode("latin-1"), last and not self.begun
        self.look(text, whole)
        for i, find in enumerate((_percents, _escapes)):
            edits = find(text)
            if edits and self.edits[i] is None:
                self.edits[i] = Sink(self.scan, self.span)
                self.edits[i].feed(self.before)
            if self.edits[i] is not None:
                new = Layer(text, [0], [0], [None]).edited(edits).text if edits else text
                self.edits[i].feed(new.encode("latin-1", "replace"))
        if whole:
            for _, _, raw in _blocks(text):
                self.scan.add(raw, self.span)
        else:
            self.follow(0, _BASE64, text, last)
            self.follow(1, _DIGITS, text, last)
        self.unpack(data, whole)
        if self.wide < 2 and (self.wides or b"\0" in data):
            if self.wides is None:
                self.wides = [Sink(self.scan, self.span, self.wide + 1) for _ in range(4)]
            for i in (0, 1):  # pairs that begin at even places and those at odd ones
                raw = data[1:] if i and not self.count else self.last + data if (self.count - i) % 2 else data
                pairs = np.frombuffer(raw[: len(raw) // 2 * 2], np.uint8).reshape(-1, 2)
                for high in (0, 1):
                    self.wides[2 * i + high].feed(np.where(pairs[:, high] == 0, pairs[:, 1 - high], 255).astype(np.uint8).tobytes())
        self.before, self.last, self.count = data[-4096:], data[-1:] or self.last, self.count + len(data)
        if last:
            for sink in (*self.edits, *(self.wides or ())):
                if sink is not None:
                    sink.close()
            for unpacker in self.unpackers:
                unpacker.sink.close()

    def look(self, text: str, whole: bool) -> None:
        if not whole:
            # Only whether there is a match counts, so a run of spaces is like one and 64 characters hold any match's least.
            text = re.sub(" {2,}", " ", self.found + text)
        end = 0
        for kind, _, stop in search(text):
            self.scan.spans.add((kind, *self.span))
            end = max(end, stop) if stop < len(text) else end
        self.found = text[max(end, len(text) - 64) :]

    def follow(self, which: int, pattern: re.Pattern, text: str, last: bool) -> None:
        """Decode the runs of one piece of many; a run at its end stays open."""
        phases, unit = ((4, 4), (2, 2))[which]
        least = (16, 32)[which]
        start = 0
        if self.runs[which]:
            joined = re.compile(r"(?:[ \t]*+\r?\n[ \t]*+)?+[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+" if which == 0 else "[0-9A-Fa-f]+")
            more = joined.match(text)
            start = more.end() if more else 0
            self.extend(which, more[0] if more else "", unit, not more or last or start < len(text))
        runs = list(pattern.finditer(text, start))
        if which and not last and not (runs and runs[-1].end() == len(text)):
            runs += re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{1,31}\Z").finditer(text, max(start, len(text) - 32))
        for run in runs:
            body = run[0].translate(_PLAIN) if which == 0 else run[0]
            opened = run.end() == len(text) and not last
            if opened or len(body) >= least:
                self.runs[which] = [(Sink(self.scan, self.span), -phase) for phase in range(phases)]
                self.extend(which, run[0], unit, not opened)

    def extend(self, which: int, digits: str, unit: int, ends: bool) -> None:
        body = digits.translate(_PLAIN) if which == 0 else digits
        kept = []
        for sink, rest in self.runs[which]:
            if isinstance(rest, int):  # digits still to be skipped
                skip = min(-rest, len(body))
                part, rest = body[skip:], rest + skip
                if rest:
                    kept.append((sink, rest))
                    continue
            else:
                part = rest + body
            size = len(part) - len(part) % unit
            sink.feed(_decoded(part if ends else part[:size], 0) if which == 0 else bytes.fromhex(part[:size]))
            kept.append((sink, part[size:]))
        self.runs[which] = kept
        if ends:
            for sink, _ in kept:
                sink.close()
            self.runs[which] = []

    def unpack(self, data: bytes, whole: bool) -> None:
        if whole:
            for m in _PACKED.finditer(data):
                self.scan.work.append((data, self.span, m.start()))
            return
        going = []
        for unpacker in self.unpackers:
            if unpacker.feed(data):
                going.append(unpacker)
            else:
                unpacker.sink.close()
        joined = self.before[-2:] + data
        early = len(joined) - len(data)
        for m in _PACKED.finditer(joined):
            if m.end() > early:  # else it began in the last piece
                unpacker = _Unpacker(self.scan, Sink(self.scan, self.span))
                if unpacker.feed(memoryview(joined)[m.start() :]):
                    going.append(unpacker)
                else:
                    unpacker.sink.close()
        self.unpackers = going


class Scan:
    """The worklist of one document: layers over it, and decoded bytes or compressed data with their span."""

    def __init__(self, most: int | None):
        self.most, self.complete = most, True
        self.spans: set[tuple[str, int, int]] = set()
        self.seen: set[tuple] = set()
        self.work: list = []

    def add(self, raw: bytes, span: tuple[int, int], wide: int = 0) -> None:
        name = (hashlib.blake2b(raw, digest_size=16).digest(), span, wide)
        if name not in self.seen:
            self.seen.add(name)
            self.work.append((raw, span, -1 - wide))

    def layer(self, layer: Layer) -> None:
        text = layer.text
        for kind, start, end in search(text):
            self.spans.add((kind, *layer.span(start, end)))
        mark = len(self.work)
        for start, end, raw in _blocks(text):
            self.add(raw, layer.span(start, end))
            self.drain(mark)
        for find in (_percents, _escapes):
            if runs := find(text):
                inner = layer.edited(runs)
                name = (hashlib.blake2b(inner.text.encode(), digest_size=16).digest(), inner.span(0, len(inner.text)))
                if name not in self.seen:
                    self.seen.add(name)
                    self.work.append(inner)

    def drain(self, mark: int = 0) -> None:
        """Work on all that was added since the list had a length."""
        while len(self.work) > mark:
            item = self.work.pop()
            if isinstance(item, Layer):
                self.layer(item)
                continue
            raw, span, at = item
            sink = Sink(self, span, -1 - at if at < 0 else 0)
            if at < 0:
                sink.piece(raw, True)
            else:
                unpacker = _Unpacker(self, sink)
                unpacker.feed(memoryview(raw)[at:])
                sink.close()


def scan_text(text: str, most: int | None = None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], bool]:
    """Base spans, all spans (the base ones and those of decoded layers) and whether nothing was left packed."""
    base = search(text)
    scan = Scan(most)
    scan.work.append(Layer(text, [0], [0], [None]))
    scan.drain()
    order = lambda span: (span[1], KINDS.index(span[0]), span[2])
    return sorted(base, key=order), sorted(scan.spans, key=order), scan.complete


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of spans that touch or overlap replaced."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start > at or not out:
            out += [text[at:start], PLACEHOLDER]
        at = max(at, end)
    return "".join([*out, text[at:]])


RESULT = T.StructType(
    [
        *[T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS],
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("complete", T.BooleanType()),
    ]
)


def secrets(docs: DataFrame, most: int | None = None) -> DataFrame:
    """``doc_id`` and the columns of :data:`RESULT` per document."""
    configure_arrow(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for text in pc.fill_null(batch.column("text"), "").to_pylist():
                base, spans, complete = scan_text(text, most)
                counts = [sum(b[0] == kind for b in base) for kind in KINDS]
                rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), complete))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in zip(*rows)]], ["doc_id", *RESULT.names])

    kind = docs.schema["doc_id"].dataType
    return only(docs, "doc_id", "text").mapInArrow(run, T.StructType([T.StructField("doc_id", kind), *RESULT.fields]))


def redact(docs: DataFrame, most: int | None = None) -> DataFrame:
    """``docs`` with each secret in ``text``, encoded ones too, replaced; ``n_chars``, if there is one, follows the text."""
    configure_arrow(docs.sparkSession)
    name = fresh(docs, "redacted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            new = [None if text is None else redacted(text, scan_text(text, most)[1]) for text in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*batch.schema.names, name])

    out = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))
    changed = {"text": F.col(f"`{name}`")}
    if "n_chars" in docs.columns:
        same = F.col("text").eqNullSafe(F.col(f"`{name}`"))
        changed["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.length(F.col(f"`{name}`"))).cast(docs.schema["n_chars"].dataType)
    return out.select([changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])
