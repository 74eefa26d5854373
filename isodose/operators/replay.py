"""Replaying stored readings: schedules, frames, and the marker cap of the map."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.functions.parse import utc_time
from isodose.operators.filters import check_speed
from isodose.operators.latest import first_per_key
from isodose.operators.ordered import SLICE, across, neighbour, slice_hot_keys, slice_totals


def newest_first(df: DataFrame, time_col: str = "uploaded_ts", ties: Sequence[str] = ()) -> DataFrame:
    """Rows in the order a newest-first replay reads them."""
    return df.orderBy(F.desc(time_col), *[F.desc(name) for name in ties])


def replay_schedule(
    raw: DataFrame,
    order: Sequence[str],
    speed: float = 0.001,
    max_sleep: float = 15.0,
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``delay_seconds`` before each row and its ``offset_seconds`` from the start.

    The delay is the gap to the last known upload time, times ``speed``, at most
    ``max_sleep``; gaps backwards and unknown times cost nothing.  The table is one global
    sequence, so it is cut into ordered slices: the last upload time and the sum of delays
    are carried from slice to slice.
    """
    check_speed(speed)
    limits = {} if max_rows is None else {"max_rows": max_rows}
    timed = raw.withColumn("_uploaded", utc_time(F.col("uploaded_time")))
    sliced = slice_hot_keys(timed, [], order, **limits)

    totals = slice_totals(sliced, _last=F.max_by("_uploaded", F.when(
        F.col("_uploaded").isNotNull(), F.struct(*order))))
    carry = totals and totals.select(
        SLICE,
        F.last("_last", ignorenulls=True).over(across(sliced, Window.unboundedPreceding, -1)).alias("_carry"),
    )
    base = F.coalesce(F.last("_uploaded", ignorenulls=True).over(sliced.before()), "_carry")
    gap = (F.unix_micros("_uploaded") - F.unix_micros(base)) / F.lit(1e6)
    delay = F.coalesce(F.least(F.greatest(gap, F.lit(0.0)) * speed, F.lit(max_sleep)), F.lit(0.0))
    paced = sliced.with_carry(carry, _carry="timestamp").withColumn(
        "delay_seconds", delay if speed > 0 else F.lit(0.0)
    )

    exact = F.col("delay_seconds").cast("decimal(24,9)")
    done = None
    if sliced.hot is not None:
        done = paced.groupBy(SLICE).agg(F.sum(exact).alias("_sum")).select(
            SLICE, F.sum("_sum").over(across(sliced, Window.unboundedPreceding, -1)).alias("_done")
        )
    running = F.sum(exact).over(sliced.window().rowsBetween(Window.unboundedPreceding, 0))
    rows = paced.drop("_carry")
    rows = rows.withColumn("_done", F.lit(None).cast("decimal(38,9)")) if done is None else rows.join(
        F.broadcast(done), SLICE, "left"
    )
    return rows.withColumn(
        "offset_seconds", (running + F.coalesce("_done", F.lit(0))).cast("double")
    ).drop("_uploaded", "_done", SLICE)


def replayable(readings: DataFrame, time_col: str = "ingested_at") -> DataFrame:
    """Rows that can be drawn (time and place known), in replay order."""
    return readings.filter(
        F.col(time_col).isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    ).orderBy(time_col)


def replay_frame(
    readings: DataFrame, at: datetime, time_col: str = "ingested_at", ties: Sequence[str] = ()
) -> DataFrame:
    """State of every sensor at virtual time ``at``: its last reading drawn so far."""
    drawn = readings.filter(F.col(time_col) <= F.lit(at))
    return first_per_key(
        drawn, ["sensor_key"], F.desc(time_col), *[F.desc(name) for name in ties]
    )


def frame_number(
    time_col: str, start: Column | datetime, frame_ms: int = 1000, speed: int = 1
) -> Column:
    """Frame in which a row first shows, when each frame advances ``frame_ms * speed``."""
    if speed not in S.REPLAY_SPEEDS:
        raise ValueError(f"speed must be one of {S.REPLAY_SPEEDS}")
    begin = F.unix_millis(start if isinstance(start, Column) else F.lit(start))
    passed = F.unix_millis(F.col(time_col)) - begin
    return F.ceil(passed / F.lit(float(frame_ms * speed)))


def replay_frames(
    readings: DataFrame,
    start: datetime,
    frame_ms: int = 1000,
    speed: int = 1,
    time_col: str = "ingested_at",
) -> DataFrame:
    """Per frame: rows that become visible and the sensors they belong to."""
    frame = frame_number(time_col, start, frame_ms, speed).alias("frame")
    return readings.groupBy(frame).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("sensor_key").alias("sensors")
    )


def replay_film(
    readings: DataFrame,
    start: datetime,
    frame_ms: int = 1000,
    speed: int = 1,
    key_every: int = 300,
    time_col: str = "ingested_at",
    ties: Sequence[str] = (),
    max_rows: int | None = None,
) -> DataFrame:
    """All frames of a replay in a form that can be entered anywhere: key frames and changes.

    Columns ``segment``, ``frame``, ``is_key`` and those of ``readings``.  A *change* is the last
    reading of a sensor that one frame newly shows.  A segment is ``key_every`` frames long and
    begins with a *key* row per sensor known by then: its last change before the segment, under
    that change's own frame number.  So a frame needs the rows of its own segment alone, and there
    is a row per change plus one per sensor and segment, not one per sensor and frame.  Everything
    up to ``start`` is frame 0; rows without a time are in no frame.  The last segment is that of
    the last change.
    """
    step = F.greatest(frame_number(time_col, start, frame_ms, speed), F.lit(0)).cast("bigint")
    framed = readings.filter(F.col(time_col).isNotNull()).withColumn("frame", step)
    changes = first_per_key(framed, ["sensor_key", "frame"], F.desc(time_col), *[F.desc(name) for name in ties])
    last = framed.agg(F.max("frame")).first()[0]
    if last is None:
        last = 0
    sliced = slice_hot_keys(changes, ["sensor_key"], ["frame"], **({} if max_rows is None else {"max_rows": max_rows}))
    shown = neighbour(sliced, "frame", "_until", step=1).drop(SLICE)

    def segment(frame: Column) -> Column:
        return F.floor(frame / F.lit(key_every)).cast("bigint")

    # A change is the state at the start of every segment after its own, up to the next change's.
    first, final = segment(F.col("frame")) + 1, segment(F.coalesce("_until", F.lit(last)))
    keys = F.when(first <= final, F.sequence(first, final)).otherwise(F.array().cast("array<bigint>"))
    parts = F.concat(F.array(F.struct(segment(F.col("frame")).alias("segment"), F.lit(False).alias("is_key"))),
                     F.transform(keys, lambda s: F.struct(s.alias("segment"), F.lit(True).alias("is_key"))))
    return shown.withColumn("_part", F.explode(parts)).select("_part.segment", "frame", "_part.is_key", *readings.columns)


def write_film(film: DataFrame, path: str) -> None:
    """Store a film with a folder per segment."""
    film.hint("rebalance", "segment").write.mode("overwrite").partitionBy("segment").parquet(path)


def film_frames(film: DataFrame, numbers: Sequence[int], key_every: int) -> DataFrame:
    """State of every sensor in each of the given frames, with the frame in ``number``.

    A frame reads the rows of its own segment; the segments are pruned on a stored film.
    """
    asked = film.sparkSession.createDataFrame([(n, n // key_every) for n in sorted(set(numbers))], "number long, _segment long")
    near = film.filter(F.col("segment").isin(sorted({n // key_every for n in numbers})))
    # As many rows as frames are asked for.
    shown = near.join(F.broadcast(asked), (F.col("segment") == F.col("_segment")) & (F.col("frame") <= F.col("number")))
    return first_per_key(shown, ["number", "sensor_key"], F.desc("frame")).drop("segment", "_segment", "frame", "is_key")


def sensor_cap(
    rows: DataFrame, cap: int = 2500, order: str = "arrival_ts", ties: str = "event_id"
) -> DataFrame:
    """The ``cap`` sensors seen first most recently, with their first appearance.

    A full map drops the sensor that has been on it longest; later readings do not renew a
    sensor's place.
    """
    first = rows.groupBy("sensor_key").agg(F.min(F.struct(order, ties)).alias("_first"))
    return (
        first.orderBy(F.desc("_first"))
        .limit(cap)
        .select("sensor_key", F.col(f"_first.{order}").alias("first_seen"))
    )
