"""Queries over stored readings and alerts, and over the live feeds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.operators import filters as Q


def newest(
    df: DataFrame, limit: int, time_col: str = "arrival_ts", ties: tuple[str, ...] = ()
) -> DataFrame:
    """The ``limit`` most recent rows, newest first (a top-k, never a full sort)."""
    return df.orderBy(F.desc(time_col), *[F.desc(name) for name in ties]).limit(limit)


def recent_alerts(
    alerts: DataFrame, limit: int = 20, kept: int = S.DEFAULTS.feed_size, **options
) -> DataFrame:
    """Latest alerts; the feed never holds more than ``kept``."""
    return newest(alerts, min(Q.check_limit(limit, 1, 500), kept), **options)


def recent_spikes(
    spikes: DataFrame, limit: int = 50, kept: int = S.DEFAULTS.feed_size, **options
) -> DataFrame:
    return newest(spikes, min(Q.check_limit(limit, 1, 500), kept), **options)


#: Feed sizes of the console: alerts, spikes, ticker entries, trend points.
CONSOLE_FEEDS = {"alerts": 20, "spikes": 10, "ticks": 50, "trend": 30}


def console_feed(df: DataFrame, feed: str, **options) -> DataFrame:
    return newest(df, CONSOLE_FEEDS[feed], **options)


def points(
    current: DataFrame, min_cpm: float | None = None, bbox: str | None = None, limit: int = 500
) -> DataFrame:
    """Current sensors above a value and inside a box, ordered by sensor key."""
    Q.check_limit(limit, 1, 1000)
    found = Q.within_bbox(Q.at_least(current, min_cpm), bbox)
    return found.orderBy("sensor_key").limit(limit)


def points_history(
    readings: DataFrame,
    start: datetime,
    end: datetime,
    limit: int = 2000,
    time_col: str = "ingested_at",
    ties: tuple[str, ...] = ("sensor_key",),
) -> DataFrame:
    """First ``limit`` readings ingested in [start, end], oldest first."""
    Q.check_limit(limit, 0, 5000)
    return Q.between(readings, start, end, time_col).orderBy(time_col, *ties).limit(limit)


def sensor_history(
    readings: DataFrame,
    sensor_key: str,
    as_of: datetime,
    hours: int = 24,
    time_col: str = "ingested_at",
) -> DataFrame:
    """All readings of one sensor in the last ``hours``, oldest first."""
    Q.check_limit(hours, 1, 48)
    mine = Q.one_sensor(readings, sensor_key)
    return Q.since(mine, as_of, hours, time_col).orderBy(time_col)


def alert_history(
    alerts: DataFrame, as_of: datetime, hours: int = 1, time_col: str = "ingested_at"
) -> DataFrame:
    """All alerts of the last ``hours``, newest first."""
    Q.check_limit(hours, 1, 24)
    return Q.since(alerts, as_of, hours, time_col).orderBy(F.desc(time_col))


def last_window(windows: DataFrame) -> DataFrame:
    """The rows of the most recent window: the single current value of stats or top-N."""
    return windows.orderBy(F.desc("window_end")).limit(1)


def last_top(top: DataFrame) -> DataFrame:
    """The current top-N, or an empty one while there is none yet."""
    empty = top.sparkSession.range(1).select(
        F.lit(0).alias("count"), F.array().cast(top.schema["hotspots"].dataType).alias("hotspots")
    )
    current = last_window(top).select("count", "hotspots", F.lit(0).alias("_rank"))
    return (
        current.unionByName(empty.withColumn("_rank", F.lit(1)))
        .orderBy("_rank")
        .limit(1)
        .drop("_rank")
    )
