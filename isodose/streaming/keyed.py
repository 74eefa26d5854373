"""Products per sensor on Spark's keyed state, with a time to live.

One stateful operator keeps one short value per sensor in the RocksDB store: what the newest
reading, the last alert and the moving average need.  Sensors are dealt over a fixed number of
pages; a batch reads and writes the pages of the sensors that are in it and no others.  Pages are
dealt over shards, and the operator is called once for each shard in a batch: a call for every
sensor costs as much as a thousand rows, and an access to the store as much as a hundred.  The time
to live follows each sensor's own silence: a reading that arrives more than the limit after the one
before starts afresh, in whatever batch it comes, so the result does not depend on how a stream is
cut.  A timer per shard removes values that no reading can reach any more; it changes no result.

Readings must not arrive behind the watermark (latest arrival less the lateness allowed): Spark
drops such rows of a stream with a time to live and counts them in the progress.
:mod:`isodose.streaming.late` keeps them.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from isodose.operators.alerts import cooldown_mask
from isodose.operators.latest import ARRIVAL
from isodose.operators.spikes import ema_before, label_spikes
from isodose.schemas import DEFAULTS, Settings
from isodose.streaming import pipeline

PRODUCTS = ("current", "alerts", "spikes")
#: Names with a leading underscore do not reach the operator.
_SEEN = "keyed_seen_us"
_SHARD = "keyed_shard"
#: Shards, and pages of each: a checkpoint holds for these numbers only.
SHARDS, PAGES = 1024, 64
#: A shard is searched for values past their time to live so many times per time to live at most.
_SWEEPS = 4
_MARKS = [
    T.StructField("is_current", T.BooleanType()),
    T.StructField("is_alert", T.BooleanType()),
    T.StructField("is_spike", T.BooleanType()),
    T.StructField("previous_cpm", T.DoubleType()),
    T.StructField("average_before", T.DoubleType()),
]
#: Value of a sensor: latest arrival and newest capture seen, time and level of the last alert,
#: last reading and moving average.
_UNKNOWN = (None,) * 6


def epochs(seen: np.ndarray, before: int | None, ttl_us: int | None) -> np.ndarray:
    """Number of fresh starts up to each row of one sensor; 0 goes on from what was before."""
    if ttl_us is None:
        return np.zeros(len(seen), np.int64)
    latest = np.maximum.accumulate(seen)
    earlier = np.r_[latest[0] if before is None else before, np.maximum(latest[:-1], before if before is not None else latest[0])]
    return np.cumsum(seen - earlier > ttl_us)


def _newest(times, restarts, seeds):
    """(mask of rows newer than all before, newest time after each row); see ``cooldown_mask``."""
    mask, after, newest = [], [], None
    for i, at in enumerate(times):
        if restarts[i]:
            newest = seeds[i]
        mask.append(newest is None or at > newest)
        newest = at if mask[-1] else newest
        after.append(newest)
    return mask, after


def _packed(sensors: dict[str, tuple]) -> str:
    """Values of a page as text; doubles come back bit for bit."""
    return json.dumps([[name, *state] for name, state in sensors.items()])


def _unpacked(text: str) -> dict[str, tuple]:
    return {name: tuple(state) for name, *state in json.loads(text)}


class SensorProducts(StatefulProcessor):
    """Marks each reading as newest, alert or spike of its sensor, for all sensors of a shard."""

    def __init__(self, settings: Settings, order: Sequence[str], ttl_us: int | None):
        self.settings, self.order, self.ttl_us = settings, list(order), ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # One text per page: a row of many columns brings its schema along at each access.
        self.state = handle.getMapState("pages", "page int", "sensors string")

    def _read(self, page: int) -> dict[str, tuple]:
        found = self.state.getValue((page,))
        return {} if found is None else _unpacked(found[0])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        frame = pd.concat(list(rows)).sort_values(["sensor_key", *self.order], kind="stable", ignore_index=True)
        names = frame["sensor_key"].to_numpy(object)
        starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
        lasts = np.r_[starts[1:], len(frame)] - 1
        page_of = [zlib.crc32((name or "").encode()) % PAGES for name in names[starts]]
        pages = {page: self._read(page) for page in sorted(set(page_of))}
        found = [pages[page].get(name, _UNKNOWN) for page, name in zip(page_of, names[starts], strict=True)]
        times = frame[_SEEN].to_numpy(np.int64)
        captured = frame["captured_at"].to_numpy(np.int64)
        cpm = frame["cpm"].tolist()

        # Stretches: rows of one sensor without a fresh start between them.  The first one goes on
        # from the sensor's state, unless it begins with a fresh start itself.
        parts = zip(np.split(times, starts[1:]), found, strict=True)
        epoch = np.concatenate([epochs(part, state[0], self.ttl_us) for part, state in parts])
        earlier = np.r_[0, epoch[:-1]]
        earlier[starts] = 0
        begins = epoch > earlier
        begins[starts] = True
        stretch = np.cumsum(begins) - 1
        seeds = [_UNKNOWN] * (stretch[-1] + 1)
        for i, state in zip(starts.tolist(), found, strict=True):
            if epoch[i] == 0:
                seeds[stretch[i]] = state
        _, newest, alert_at, alert_level, previous, average = zip(*(seeds[i] for i in stretch.tolist()), strict=True)

        restarts = begins.tolist()
        current, newest = _newest(captured.tolist(), restarts, newest)

        unsafe = np.flatnonzero((frame["level"] != "safe").to_numpy())
        levels = frame["level"].iloc[unsafe].tolist()
        kept, _, _ = cooldown_mask(
            captured[unsafe].tolist(), levels, self.settings.cooldown_ms,
            restarts=(np.diff(stretch[unsafe], prepend=-1) > 0).tolist(),
            seeds=([alert_at[i] for i in unsafe.tolist()], [alert_level[i] for i in unsafe.tolist()]),
        )
        alert = np.zeros(len(frame), bool)
        alert[unsafe] = kept
        last_alert = {
            stretch[i]: (captured[i].item(), levels[k]) for k, i in enumerate(unsafe.tolist()) if kept[k]
        }

        alpha = self.settings.ema_alpha
        befores, averages, _, _ = ema_before(cpm, alpha, restarts=restarts, seeds=(previous, average))
        frame["is_current"], frame["is_alert"] = current, alert
        frame["previous_cpm"], frame["average_before"] = np.array(befores, float), np.array(averages, float)
        frame["is_spike"] = self._jumps(frame, "previous_cpm", self.settings.jump_ratio) | self._jumps(
            frame, "average_before", self.settings.average_ratio
        )

        seen = np.maximum.reduceat(times, starts).tolist()
        for page, state, latest, i in zip(page_of, found, seen, lasts.tolist(), strict=True):
            latest = latest if state[0] is None else max(state[0], latest)
            at, level = last_alert.get(stretch[i], seeds[stretch[i]][2:4])
            # The average after the row: the step of ema_before.
            mean = cpm[i] if averages[i] is None else alpha * cpm[i] + (1 - alpha) * averages[i]
            pages[page][names[i]] = (latest, newest[i], at, level, cpm[i], mean)
        for page, sensors in pages.items():
            self.state.updateValue((page,), (_packed(sensors),))
        if self.ttl_us is not None and next(iter(self.handle.listTimers()), None) is None:
            self.handle.registerTimer(self._due(min(seen)))
        marked = frame[frame["is_current"] | frame["is_alert"] | frame["is_spike"]]
        if len(marked):
            yield marked

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """One timer per shard: it removes the values that are due, and waits for the next one to be."""
        now, left = timerValues.getCurrentWatermarkInMs(), []
        for page, (text,) in list(self.state.iterator()):
            sensors = _unpacked(text)
            waiting = {name: state for name, state in sensors.items() if self._due(state[0]) > now}
            left += [self._due(state[0]) for state in waiting.values()]
            if not waiting:
                self.state.removeKey(page)
            elif len(waiting) < len(sensors):
                self.state.updateValue(page, (_packed(waiting),))
        if left:
            self.handle.registerTimer(max(min(left), now + self.ttl_us // 1000 // _SWEEPS))
        return iter(())

    def _due(self, seen_us: int) -> int:
        """First millisecond in which every reading would start afresh anyway."""
        return (seen_us + self.ttl_us) // 1000 + 1

    @staticmethod
    def _jumps(frame: pd.DataFrame, base: str, ratio: float) -> np.ndarray:
        cpm, base = frame["cpm"].to_numpy(), frame[base].to_numpy()
        with np.errstate(divide="ignore", invalid="ignore"):
            return (base > 0) & (cpm / base >= ratio)


def keyed_products(
    enriched: DataFrame,
    settings: Settings = DEFAULTS,
    ttl_seconds: float | None = None,
    order: Sequence[str] = ARRIVAL,
    time_col: str = "arrival_ts",
) -> DataFrame:
    """Readings that are the newest of their sensor, an alert or a spike, each marked as such.

    ``enriched`` is a stream.  ``order`` must tell the rows of a sensor apart and begin with
    ``time_col``.  Rows of one shard are sorted inside a batch, in the memory of one task: limit
    what a trigger reads (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``, the control table of
    :mod:`isodose.sources.filelog`).
    """
    pipeline.use_state_store(enriched.sparkSession)
    ttl_us = None if ttl_seconds is None else int(ttl_seconds * 1_000_000)
    timed = enriched if ttl_us is None else enriched.withWatermark(time_col, settings.lateness)
    shard = F.pmod(F.xxhash64("sensor_key"), F.lit(SHARDS)).cast("int")
    timed = timed.withColumns({_SEEN: F.unix_micros(time_col), _SHARD: shard})
    if ttl_us is None:  # else it bears the watermark
        timed = timed.drop(time_col)
    schema = T.StructType([*(f for f in timed.schema.fields if f.name != _SHARD), *_MARKS])
    processor = SensorProducts(settings, [_SEEN if c == time_col else c for c in order], ttl_us)
    marked = timed.groupBy(_SHARD).transformWithStateInPandas(
        processor, schema, outputMode="Append", timeMode="None" if ttl_us is None else "EventTime"
    )
    # Through pandas a time of day may be ambiguous; the microseconds are not.
    columns = [*enriched.columns, *(mark.name for mark in _MARKS)]
    return marked.withColumn(time_col, F.timestamp_micros(_SEEN)).select(*columns)


def start_keyed(products: DataFrame, path: str, available_now: bool = False) -> StreamingQuery:
    """Write :func:`keyed_products` to files, exactly once."""
    return pipeline.start_parquet(products, path, available_now)


def read_keyed(spark: SparkSession, path: str, product: str, settings: Settings = DEFAULTS) -> DataFrame:
    """One product of what :func:`start_keyed` wrote so far."""
    marks = {"current": "is_current", "alerts": "is_alert", "spikes": "is_spike"}
    rows = spark.read.parquet(f"{path}/data").where(marks[product]).drop(*marks.values())
    if product == "spikes":
        return label_spikes(rows, settings.jump_ratio, settings.average_ratio)
    return rows.drop("previous_cpm", "average_before")
