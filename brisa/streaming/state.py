"""Keyed state of streams: hours of a series, indices of a day, the last run of a feed.

Each processor keeps one value per key, packed as an array, and clears it by a timer, so state is as large as what a
correction can still reach. Keys hold a stretch of time beside their name: no key collects a series for ever.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR_MS = 3_600_000
# The best delivery of an hour: what it is judged by, its value in millionths and as delivered, and whether it is plausible.
HOURS = np.dtype(
    [
        ("hour", "<i8"), ("touched", "<i8"), ("verified", "<i8"), ("has", "?"), ("last", "<f8"),
        ("millionths", "<i8"), ("number", "?"), ("raw", "<f8"), ("plausible", "?"),
    ]
)
ORDER = ("last", "has", "verified", "touched", "hour")  # the last one decides first


def packed(frames: Iterator[pd.DataFrame], kind: np.dtype) -> np.ndarray:
    """Rows of frames whose columns are those of ``kind``."""
    parts = []
    for frame in frames:
        part = np.empty(len(frame), kind)
        for name in kind.names:
            part[name] = frame[name].to_numpy()
        parts.append(part)
    return np.concatenate(parts) if parts else np.empty(0, kind)


def best_hours(rows: np.ndarray) -> np.ndarray:
    """The best row of each hour, by hour."""
    rows = rows[np.lexsort([rows[c] for c in ORDER])]
    return rows[np.append(rows["hour"][1:] != rows["hour"][:-1], True)] if len(rows) else rows


def sums(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each hour the sum and the count of plausible values in the ``width`` hours that end with it."""
    counts = rows["plausible"] & rows["number"]
    total = np.concatenate([[0], np.cumsum(np.where(counts, rows["millionths"], 0))])
    number = np.concatenate([[0], np.cumsum(counts)])
    first = np.searchsorted(rows["hour"], rows["hour"] - width, "right")
    upto = np.arange(1, len(rows) + 1)
    return total[upto] - total[first], number[upto] - number[first]


class HourMeans(StatefulProcessor):
    """Running means of a series over a chunk of its hours; keys are (series, chunk, width).

    The chunk's own hours start at ``chunk * chunk_hours``; earlier ones are history. With ``prompt``, the mean of every hour that a
    batch changes goes out at once and again whenever it changes; else each goes out once, by a timer, when the watermark has
    passed its hour. The state is cleared when the watermark has passed the chunk.
    """

    def __init__(self, chunk_hours: int, prompt: bool):
        self.chunk_hours, self.prompt = chunk_hours, prompt

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hours = handle.getValueState("hours", "rows binary, sent bigint, timer bigint")

    def _held(self) -> tuple[np.ndarray, int, int]:
        held = self.hours.get() if self.hours.exists() else None
        if held is None:
            return np.empty(0, HOURS), -(1 << 62), 1 << 62
        return np.frombuffer(held[0], HOURS), held[1], held[2]

    def _frame(self, key: tuple, rows: np.ndarray, width: int, wanted: np.ndarray) -> pd.DataFrame:
        total, number = sums(rows, width)
        chosen = rows[wanted]
        return pd.DataFrame(
            {
                "sampling_point_id": [key[0]] * len(chosen),
                "width": np.full(len(chosen), width, np.int32),
                "hour": chosen["hour"],
                "total": total[wanted],
                "number": number[wanted],
                "raw": chosen["raw"],
                "has": chosen["has"],
                "observed": chosen["plausible"],
            }
        )

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        old, sent, timer = self._held()
        now = best_hours(np.concatenate([old, packed(rows, HOURS)]))
        width, first = int(key[2]), int(key[1]) * self.chunk_hours
        own = now["hour"] >= first
        if self.prompt:
            due = (first + self.chunk_hours) * HOUR_MS + 1
            wanted = own & self._changed(old, now, width)
        else:
            pending = now["hour"][own & (now["hour"] > sent)]
            due = int(pending[0]) * HOUR_MS + 1 if len(pending) else (first + self.chunk_hours) * HOUR_MS + 1
            wanted = np.zeros(len(now), bool)
        if due < timer:
            self.handle.registerTimer(due)
            timer = due
        self.hours.update((now.tobytes(), sent, timer))
        if wanted.any():
            yield self._frame(key, now, width, wanted)

    @staticmethod
    def _changed(old: np.ndarray, now: np.ndarray, width: int) -> np.ndarray:
        """Which hours have another mean, value or state than before, or are new."""
        place = np.searchsorted(old["hour"], now["hour"])
        known = np.zeros(len(now), bool)
        inside = place < len(old)
        known[inside] = old["hour"][place[inside]] == now["hour"][inside]
        before, after = (np.rec.fromarrays([*sums(r, width), r["has"], r["raw"], r["plausible"]]) for r in (old, now))
        same = np.zeros(len(now), bool)
        same[known] = before[place[known]] == after[known]
        return ~same

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        rows, sent, _ = self._held()
        first, width, mark = int(key[1]) * self.chunk_hours, int(key[2]), timerValues.getCurrentWatermarkInMs()
        own = (rows["hour"] >= first) & (rows["hour"] > sent)
        closed = own & (rows["hour"] * HOUR_MS < mark)
        if not self.prompt and closed.any():
            yield self._frame(key, rows, width, closed)
            sent = int(rows["hour"][closed][-1])
        end = (first + self.chunk_hours) * HOUR_MS + 1
        if mark >= end:
            self.hours.clear()
            return
        pending = rows["hour"][own & ~closed]
        due = int(pending[0]) * HOUR_MS + 1 if len(pending) and not self.prompt else end
        self.handle.registerTimer(due)
        self.hours.update((rows.tobytes(), sent, due))

    def close(self) -> None:
        pass


MEANS = "sampling_point_id string, width int, hour bigint, total bigint, number bigint, raw double, has boolean, observed boolean"

# Hours of a day as last heard of; one that is not observed has been taken back.
DAY = np.dtype([("at", "<i8"), ("version", "<i8"), ("worst", "<f8"), ("observed", "?")])
DAY_MS = 24 * HOUR_MS


class DayWorst(StatefulProcessor):
    """The worst index of a day; keys are (day, station, pollutant). The state holds every hour, so that the worst can fall."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.day = handle.getValueState("day", "rows binary, worst double, observed boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.day.get() if self.day.exists() else None
        old = np.frombuffer(held[0], DAY) if held else np.empty(0, DAY)
        now = np.concatenate([old, packed(rows, DAY)])
        # Of equal versions the one that came last; the sort keeps the order of equals.
        now = now[np.lexsort([now["version"], now["at"]])]
        now = now[np.append(now["at"][1:] != now["at"][:-1], True)]
        observed = now["worst"][now["observed"]]
        worst, any_ = float(observed.max(initial=-np.inf)), bool(len(observed))
        if held is None:
            days = (key[0] - dt.date(1970, 1, 1)).days
            # A day's last hour can end on the next one.
            self.handle.registerTimer((days + 2) * DAY_MS)
        self.day.update((now.tobytes(), worst, any_))
        if (held is None and any_) or (held is not None and (held[1] != worst or held[2] != any_)):
            yield pd.DataFrame({"day": [key[0]], "station": [key[1]], "pollutant": [key[2]], "worst": [worst], "gone": [not any_]})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.day.clear()
        return iter(())

    def close(self) -> None:
        pass


class LastRun(StatefulProcessor):
    """Each run of a feed with what the run before found, and a row of its own where runs fail to come.

    Runs are expected to follow each other within ``patience_ms``. Where the watermark (or the clock, with ``by_clock``) passes
    that time after the last run, a ``silent`` row goes out once, and the next run counts as the first one after a gap.
    The state is the last run and what it found.
    """

    def __init__(self, keys: tuple[str, ...], patience_ms: int | None, by_clock: bool):
        self.keys, self.patience_ms, self.by_clock = keys, patience_ms, by_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint, found boolean, due bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.last.get() if self.last.exists() else None
        at, found, due = held if held else (None, None, None)
        runs = pd.concat(list(rows)).sort_values("at", kind="stable")
        out = []
        for time, now, failed in zip(runs["at"].tolist(), runs["file_found"].tolist(), runs["error_script"].tolist()):
            if at is not None and time < at:  # late: its own kinds, but it says nothing about what is newest
                out.append((time, now, failed, None, False))
                continue
            if due is not None and not self.by_clock and time > due * 1000:
                out.append((due * 1000, False, False, None, True))
                found = False
            out.append((time, now, failed, found, False))
            at, found = time, now
            due = None if self.patience_ms is None else time // 1000 + self.patience_ms
        if self.by_clock and self.patience_ms is not None:
            due = timerValues.getCurrentProcessingTimeInMs() + self.patience_ms
        if due is not None and (held is None or due != held[2]):
            if held is not None and held[2] is not None:
                self.handle.deleteTimer(held[2])
            self.handle.registerTimer(due)
        self.last.update((at, found, due))
        yield self._frame(key, out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        at, _, due = self.last.get()
        if due is not None and expiredTimerInfo.getExpiryTimeInMs() == due:
            self.last.update((at, False, None))
            yield self._frame(key, [(due * 1000, False, False, None, True)])

    def _frame(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["at", "file_found", "error_script", "previous_found", "silent"])
        for name, value in zip(self.keys, key):
            frame.insert(0, name, value)
        return frame.astype({c: "boolean" for c in ("file_found", "error_script", "previous_found")})

    def close(self) -> None:
        pass
