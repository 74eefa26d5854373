"""Alert de-duplication: a cool-down per sensor that any change of level overrides."""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.operators.latest import ARRIVAL
from isodose.operators.ordered import (
    SLICE,
    Sliced,
    chain_slices,
    column_list,
    fold_sorted,
    slice_hot_keys,
    summarise_slices,
)


def cooldown_mask(times, levels, cooldown_ms, last_ts=None, last_level=None, restarts=None, seeds=None):
    """(mask of emitted rows, last emitted time, last emitted level) of rows in order.

    A row is emitted if nothing was before it, if it is more than ``cooldown_ms`` after the
    last *emitted* row, or if its level differs from that row's.  ``restarts`` marks rows
    where the state is replaced by the (time, level) in ``seeds``.
    """
    keep = np.zeros(len(times), dtype=bool)
    for i, (ts, level) in enumerate(zip(times, levels)):
        if restarts is not None and restarts[i]:
            last_ts, last_level = seeds[0][i], seeds[1][i]
        if last_ts is None or level != last_level or ts - last_ts > cooldown_ms:
            keep[i] = True
            last_ts, last_level = ts, level
    return keep, last_ts, last_level


class _Run:
    """Pass 1 over a slice: its end state if nothing came before, and its last run of levels."""

    def __init__(self, cooldown_ms: int):
        self.cooldown_ms = cooldown_ms
        self.first = self.ts = self.level = self.peak = None
        self.mixed = False

    def add(self, ts: int, level: str) -> None:
        if level != self.level:
            self.mixed = self.first is not None
            self.first = self.first or level
            self.ts, self.level, self.peak = ts, level, ts
        elif ts > self.peak:
            self.peak = ts
            if ts - self.ts > self.cooldown_ms:
                self.ts = ts

    def result(self) -> dict:
        return {
            "_first": self.first, "_mixed": self.mixed, "_end_ts": self.ts,
            "_end_level": self.level, "_peak": self.peak,
        }


class _Chains:
    """Pass 2 over a slice of one level: where the chain of emissions from each start ends.

    Only a new maximum can be the first row beyond the cool-down.  The last emission before
    the slice lies at most one cool-down below the maximum of the run so far, so starts are
    the new maxima within one cool-down of it, and the first one after that.  Maxima are
    different whole milliseconds: their number is bounded by the rows of a slice, and that of
    the starts also by the milliseconds of the cool-down.
    """

    def __init__(self, cooldown_ms: int):
        self.cooldown_ms = cooldown_ms
        self.peaks = array("q")
        self.before = self.peak = None

    def add(self, ts: int, level: str, before: int) -> None:
        if self.peak is None:
            self.before = self.peak = before
        if ts > self.peak:
            self.peak = ts
            self.peaks.append(ts)

    def result(self) -> dict:
        peaks = np.frombuffer(self.peaks, np.int64) if self.peaks else np.zeros(0, np.int64)
        starts = np.searchsorted(peaks, (self.before or 0) + self.cooldown_ms, "right") + 1
        here = np.arange(len(peaks))
        after = np.searchsorted(peaks, peaks + self.cooldown_ms, "right")
        end = np.where(after < len(peaks), after, here)
        while not np.array_equal(further := end[end], end):
            end = further
        return {"_starts": peaks[:starts].tolist(), "_ends": peaks[end[:starts]].tolist()}


def _follow_peaks(slices: list[dict]) -> list[dict]:
    """Maximum of the run that is still open at the start of each slice, null if it ends there."""
    out, level, peak = [], None, None
    for row in slices:
        goes_on = level == row["_first"]
        out.append({"_before": peak if goes_on and not row["_mixed"] else None})
        if goes_on and not row["_mixed"]:
            peak = max(peak, row["_peak"])
        else:
            level, peak = row["_end_level"], row["_peak"]
    return out


def _follow_states(slices: list[dict], cooldown_ms: int) -> list[dict]:
    """Last emission before each slice."""
    out, ts, level = [], None, None
    for row in slices:
        out.append({"_ts": ts, "_level": level})
        if row["_before"] is None:
            ts, level = row["_end_ts"], row["_end_level"]
        elif row["_starts"]:
            start = bisect_right(row["_starts"], ts + cooldown_ms)
            if start < len(row["_starts"]):
                ts = row["_ends"][start]
    return out


def _hot_carry(sliced: Sliced, cooldown_ms: int) -> DataFrame | None:
    """Last emission (time, level) before each hot slice.

    Any change of level emits, so a slice that has one ends in a state of its own.  Only a
    slice that continues the level of the slice before depends on it, through the time of
    the last emission; for those a second pass finds the end of every possible chain.
    """
    if sliced.hot is None:
        return None
    runs = summarise_slices(
        sliced, sliced.hot, ["captured_at", "level"], partial(_Run, cooldown_ms),
        "_first string, _mixed boolean, _end_ts bigint, _end_level string, _peak bigint",
    ).persist()
    try:
        peaks = chain_slices(sliced, runs, _follow_peaks, "_before bigint")
        open_rows = sliced.hot.join(
            F.broadcast(peaks.filter("_before is not null")), sliced.group
        )
        chains = summarise_slices(
            sliced, open_rows, ["captured_at", "level", "_before"], partial(_Chains, cooldown_ms),
            "_starts array<bigint>, _ends array<bigint>",
        )
        joined = runs.join(peaks, sliced.group).join(chains, sliced.group, "left")
        carry = chain_slices(
            sliced, joined, partial(_follow_states, cooldown_ms=cooldown_ms),
            "_ts bigint, _level string",
        )
        # One short row per slice: keep the values, so nothing above runs a second time.
        return sliced.hot.sparkSession.createDataFrame(carry.collect(), carry.schema)
    finally:
        runs.unpersist()


def dedup_alerts(
    rows: DataFrame | Sliced,
    cooldown_ms: int = S.DEFAULTS.cooldown_ms,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Unsafe readings without repeats inside the cool-down (see :func:`cooldown_mask`)."""
    if isinstance(rows, Sliced):
        unsafe = F.col("level") != "safe"
        hot = None if rows.hot is None else rows.hot.filter(unsafe)
        sliced = Sliced(rows.rows.filter(unsafe), hot, rows.keys, rows.order)
    else:
        sliced = slice_hot_keys(rows.filter(F.col("level") != "safe"), ["sensor_key"], order)
    carried = sliced.with_carry(_hot_carry(sliced, cooldown_ms), _ts="bigint", _level="string")

    def step(batch, starts, state):
        seeds = (column_list(batch, "_ts"), column_list(batch, "_level"))
        keep, *state = cooldown_mask(
            column_list(batch, "captured_at"),
            column_list(batch, "level"),
            cooldown_ms,
            *(state or (None, None)),
            restarts=starts,
            seeds=seeds,
        )
        return batch.filter(pa.array(keep)), state

    return fold_sorted(sliced, carried, step, carried.schema).drop("_ts", "_level", SLICE)
