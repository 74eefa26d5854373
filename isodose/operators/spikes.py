"""Sudden jumps against the previous reading and against the sensor's moving average."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isodose import schemas as S
from isodose.functions.numeric import round_exact
from isodose.operators.latest import ARRIVAL
from isodose.operators.ordered import (
    SLICE,
    Sliced,
    chain_slices,
    column_list,
    fold_sorted,
    neighbour,
    slice_hot_keys,
    summarise_slices,
)


def ema_before(values, alpha, previous=None, average=None, restarts=None, seeds=None):
    """Previous value and moving average *before* each value, and the state after the last.

    The average starts with the first value and then moves by ``alpha`` towards each new
    one.  ``restarts`` marks values where the state is replaced by the pair in ``seeds``.
    """
    befores, averages = [], []
    stay = 1 - alpha
    for i, value in enumerate(values):
        if restarts is not None and restarts[i]:
            previous, average = seeds[0][i], seeds[1][i]
        befores.append(previous)
        averages.append(average)
        previous = value
        average = value if average is None else alpha * value + stay * average
    return befores, averages, previous, average


#: Rows after which two averages that started far apart have met, or all but met.
SETTLED = 1000


class _Bracket:
    """Pass 1 over a slice: where its average ends from no start, the least and the greatest start.

    A step is monotone in the average, also after rounding, so any other start ends between
    these two.  A slice of at most ``SETTLED`` rows keeps its values instead.
    """

    def __init__(self, alpha: float, bound: float):
        self.alpha, self.stay = alpha, 1 - alpha
        self.fresh, self.low, self.high = None, -bound, bound
        self.values, self.last = [], None

    def add(self, cpm: float) -> None:
        gain, stay = self.alpha * cpm, self.stay
        self.fresh = cpm if self.fresh is None else gain + stay * self.fresh
        self.low, self.high = gain + stay * self.low, gain + stay * self.high
        self.last = cpm
        if self.values is not None:
            self.values.append(cpm)
            if len(self.values) > SETTLED:
                self.values = None

    def result(self) -> dict:
        ends = {"_fresh": self.fresh, "_low": self.low, "_high": self.high}
        return {"_values": self.values, "_last": self.last, **ends}


class _Images:
    """Pass 2 over a slice whose ends differ: where each possible start ends."""

    def __init__(self, alpha: float):
        self.alpha, self.stay = alpha, 1 - alpha
        self.ends = None

    def add(self, cpm: float, starts: list[float]) -> None:
        gain, stay = self.alpha * cpm, self.stay
        self.ends = [gain + stay * a for a in (starts if self.ends is None else self.ends)]

    def result(self) -> dict:
        return {"_ends": self.ends}


def _doubles(low: float, high: float) -> list[float]:
    """All doubles from ``low`` to ``high``: a handful after ``SETTLED`` rows."""
    out = [low]
    while out[-1] < high:
        out.append(math.nextafter(out[-1], math.inf))
    return out


def _fold(values: list[float], alpha: float, average: float | None) -> float:
    return ema_before(values, alpha, None, average)[3]


def _possible_starts(slices: list[dict], alpha: float) -> list[dict]:
    """Averages that may stand at the start of each slice, null where that does not matter."""
    out, starts = [], [slices[0]["_seed_average"]]
    for row in slices:
        open_ = row["_values"] is None and row["_low"] < row["_high"] and starts != [None]
        out.append({"_starts": starts if open_ else None})
        if row["_values"] is not None:
            starts = sorted({_fold(row["_values"], alpha, a) for a in starts})
        else:
            starts = [row["_fresh"]] if starts == [None] else _doubles(row["_low"], row["_high"])
    return out


def _follow(slices: list[dict], alpha: float) -> list[dict]:
    """Previous value and average at the start of each slice."""
    previous, average, carried = slices[0]["_seed_previous"], slices[0]["_seed_average"], []
    for row in slices:
        carried.append({"_previous": previous, "_average": average})
        if row["_values"] is not None:
            average = _fold(row["_values"], alpha, average)
        elif average is None:
            average = row["_fresh"]
        elif row["_starts"] is not None:
            average = row["_ends"][row["_starts"].index(average)]
        else:
            average = row["_low"]
        previous = row["_last"]
    return carried


def _seeds(seed: DataFrame | None, df: DataFrame) -> DataFrame:
    """State that sensors bring along, or a table without any."""
    if seed is None:
        seed = df.sparkSession.createDataFrame([], "sensor_key string, previous_cpm double, average double")
    return seed.select("sensor_key", F.col("previous_cpm").alias("_seed_previous"), F.col("average").alias("_seed_average"))


def _hot_carry(sliced: Sliced, alpha: float, seed: DataFrame | None = None) -> DataFrame | None:
    """Previous value and average at the start of each hot slice, bit for bit those of one pass.

    Nearly always the average at the end of a slice no longer depends on where it started.  On
    constant readings a few neighbouring doubles remain; those are followed one by one.
    """
    if sliced.hot is None:
        return None
    largest = [sliced.hot.agg(F.max(F.abs("cpm")).alias("n"))]
    if seed is not None:
        largest.append(seed.agg(F.max(F.abs("average")).alias("n")))
    bound = 2 * max([row["n"] or 1.0 for df in largest for row in df.collect()])
    ends = "_values array<double>, _last double, _fresh double, _low double, _high double"
    brackets = summarise_slices(sliced, sliced.hot, ["cpm"], partial(_Bracket, alpha, bound), ends)
    brackets = brackets.join(_seeds(seed, brackets), "sensor_key", "left").persist()
    try:
        starts = chain_slices(sliced, brackets, partial(_possible_starts, alpha=alpha), "_starts array<double>")
        open_rows = sliced.hot.join(F.broadcast(starts.filter("_starts is not null")), sliced.group)
        images = summarise_slices(
            sliced, open_rows, ["cpm", "_starts"], partial(_Images, alpha), "_ends array<double>"
        )
        joined = brackets.join(starts, sliced.group).join(images, sliced.group, "left")
        carry = chain_slices(
            sliced, joined, partial(_follow, alpha=alpha), "_previous double, _average double"
        )
        # One short row per slice: keep the values, so nothing above runs a second time.
        return sliced.hot.sparkSession.createDataFrame(carry.collect(), carry.schema)
    finally:
        brackets.unpersist()


def with_moving_average(
    rows: DataFrame | Sliced,
    alpha: float = S.DEFAULTS.ema_alpha,
    order: Sequence[str] = ARRIVAL,
    seed: DataFrame | None = None,
) -> DataFrame:
    """Add ``previous_cpm`` and ``average_before``, both as they were before each row.

    ``seed(sensor_key, previous_cpm, average)`` is the state that sensors bring along.
    """
    sliced = rows if isinstance(rows, Sliced) else slice_hot_keys(rows, ["sensor_key"], order)
    carried = sliced.with_carry(_hot_carry(sliced, alpha, seed), _previous="double", _average="double")
    if seed is not None:
        names = [n for n in carried.columns if n not in ("_previous", "_average")]
        carried = carried.join(_seeds(seed, carried), "sensor_key", "left").select(
            *names, F.coalesce("_previous", "_seed_previous").alias("_previous"), F.coalesce("_average", "_seed_average").alias("_average")
        )
    added = [T.StructField(n, T.DoubleType()) for n in ("previous_cpm", "average_before")]
    schema = T.StructType(carried.schema.fields + added)

    def step(batch, starts, state):
        seeds = (column_list(batch, "_previous"), column_list(batch, "_average"))
        before, average, *state = ema_before(
            column_list(batch, "cpm"), alpha, *(state or (None, None)), restarts=starts, seeds=seeds
        )
        extra = [pa.array(before, pa.float64()), pa.array(average, pa.float64())]
        names = [*batch.schema.names, "previous_cpm", "average_before"]
        return pa.RecordBatch.from_arrays([*batch.columns, *extra], names=names), state

    folded = fold_sorted(sliced, carried, step, schema)
    return folded.drop("_previous", "_average", SLICE)


def average_after(alpha: float) -> Column:
    """The moving average including the row itself, from :func:`with_moving_average`."""
    average, cpm = F.col("average_before"), F.col("cpm")
    return F.when(average.isNull(), cpm).otherwise(F.lit(alpha) * cpm + F.lit(1 - alpha) * average)


def sensor_ema(
    rows: DataFrame | Sliced,
    alpha: float = S.DEFAULTS.ema_alpha,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Add ``ema``, the moving average of the sensor including the row itself."""
    return with_moving_average(rows, alpha, order).select("*", average_after(alpha).alias("ema"))


def _jump(cpm: Column, base: Column, ratio: float) -> Column:
    return F.coalesce((base > 0) & (cpm / base >= ratio), F.lit(False))


def point_spikes(
    rows: DataFrame | Sliced,
    ratio: float = S.DEFAULTS.jump_ratio,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Readings at least ``ratio`` times the previous reading of the sensor (no Python)."""
    sliced = rows if isinstance(rows, Sliced) else slice_hot_keys(rows, ["sensor_key"], order)
    paired = neighbour(sliced, "cpm", "previous_cpm", step=-1).drop(SLICE)
    return paired.filter(_jump(F.col("cpm"), F.col("previous_cpm"), ratio))


def rolling_spikes(
    rows: DataFrame | Sliced,
    ratio: float = S.DEFAULTS.average_ratio,
    alpha: float = S.DEFAULTS.ema_alpha,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Readings at least ``ratio`` times the moving average before them."""
    averaged = with_moving_average(rows, alpha, order)
    return averaged.filter(_jump(F.col("cpm"), F.col("average_before"), ratio))


def label_spikes(
    averaged: DataFrame,
    jump_ratio: float = S.DEFAULTS.jump_ratio,
    average_ratio: float = S.DEFAULTS.average_ratio,
) -> DataFrame:
    """Spike records from rows with ``previous_cpm`` and ``average_before``."""
    cpm, previous, average = F.col("cpm"), F.col("previous_cpm"), F.col("average_before")
    point, rolling = _jump(cpm, previous, jump_ratio), _jump(cpm, average, average_ratio)
    kind = (
        F.when(point & rolling, "point_and_average")
        .when(point, "point_to_point")
        .when(rolling, "rolling_average")
    )
    rest = [name for name in averaged.columns if name not in ("previous_cpm", "average_before")]
    return averaged.withColumn("spike_type", kind).filter(F.col("spike_type").isNotNull()).select(
        *rest,
        "spike_type",
        "previous_cpm",
        round_exact(average, 2).alias("rolling_avg_cpm"),
        F.when(previous != 0, round_exact(cpm / previous, 2)).alias("jump_ratio"),
    )


def spikes(
    rows: DataFrame | Sliced,
    jump_ratio: float = S.DEFAULTS.jump_ratio,
    average_ratio: float = S.DEFAULTS.average_ratio,
    alpha: float = S.DEFAULTS.ema_alpha,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Readings that jump against the previous reading, the moving average, or both."""
    return label_spikes(with_moving_average(rows, alpha, order), jump_ratio, average_ratio)
