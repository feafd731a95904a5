"""Chat formatting: whole conversations rendered and encoded once, with a loss mask aligned by offsets.

A conversation is its turns, each ``<|im_start|>role``, a line feed, the text and ``<|im_end|>`` with a line feed. In texts and
roles every ``<|`` gets a backslash between (one more if there are some), which no control string has and which reading
back takes out again. The whole rendering is encoded once; turn spans and token spans are both sorted, so the tokens
of a turn are found by two binary searches. A token that reaches over a turn's edge is in the mask, and the loss span stops at the edge.

Edge cases: null texts and roles are empty; an empty assistant text has no loss. Turns are in the order of (turn, role,
text), null turns first; equal turns are all kept, in that order. Rows without a ``conv_id`` are one conversation. Other
columns are ignored. No rows give no rows. A conversation is one row of output, so it must fit a task, as a document must.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.batches import configure_arrow, only
from brisa.llm.tokens import encoder

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans of the texts to learn, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == LEARNED and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, text = part.partition("\n")
        turns.append((unescape_role(role), unescape(text.removesuffix(END))))
    return turns


def align(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens meet a span, and the stretches of text that these tokens have within the spans.

    ``offsets`` are the sorted (start, end) of tokens; both ends never fall.
    """
    mask, stretches = np.zeros(len(offsets), bool), []
    if not len(offsets):
        return mask, stretches
    starts, ends = offsets[:, 0], offsets[:, 1]
    for low, high in spans:
        first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
        mask[first:last] = True
        # Tokens of one turn follow each other; several that share a character have equal offsets.
        held = None
        for start, end in zip(np.maximum(starts[first:last], low).tolist(), np.minimum(ends[first:last], high).tolist()):
            if held and start <= held[1]:
                held[1] = max(held[1], end)
            else:
                held = [start, end]
                stretches.append(held)
    return mask, [tuple(s) for s in stretches]


FORMAT = "formatted string, ids array<int>, mask array<boolean>, loss_starts array<long>, loss_ends array<long>"


def format_chats(turns: DataFrame, tokenizer: str) -> DataFrame:
    """``conv_id`` and the columns of :data:`FORMAT` per conversation of ``turns(conv_id, turn, role, text)``."""
    configure_arrow(turns.sparkSession)
    rows = only(turns, "conv_id", "turn", "role", "text").select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("row")
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    names = ["formatted", "ids", "mask", "loss_starts", "loss_ends"]
    kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer).tokenizer
        for whole in batches:
            for start in range(0, whole.num_rows, 50):
                batch, out = whole.slice(start, 50), []
                for held in batch.column("rows").to_pylist():
                    text, spans = render([(r["role"], r["text"]) for r in held])
                    encoded = model.encode(text, add_special_tokens=False)
                    mask, stretches = align(np.array(encoded.offsets, np.int64).reshape(-1, 2), spans)
                    out.append((text, encoded.ids, mask.tolist(), [s for s, _ in stretches], [e for _, e in stretches]))
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]], ["conv_id", *names])

    return gathered.mapInArrow(run, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {FORMAT}")


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` from what was written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, starts, ends in zip(*[batch.column(c).to_pylist() for c in ("formatted", "loss_starts", "loss_ends")]):
                turns = parse(text)
                loss = "".join(unescape(text[a:b]) for a, b in zip(starts, ends))
                written = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append((len(turns), hashlib.sha256(written.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = zip(*out) if out else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
