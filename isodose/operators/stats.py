"""Windowed and overall statistics of readings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.functions.numeric import exact_avg, round_exact
from isodose.operators.filters import check_hours, since


def window_bounds(name: str = "window") -> list[Column]:
    return [F.col(f"{name}.start").alias("window_start"), F.col(f"{name}.end").alias("window_end")]


def global_stats(
    df: DataFrame, width: str = S.DEFAULTS.window, time_col: str = "arrival_ts"
) -> DataFrame:
    """Average, maximum, exact distinct sensors, alerts and readings per tumbling window.

    The distinct count makes Spark aggregate per (window, sensor) first, so even one window
    over all rows is spread by sensor before the last, tiny step.
    """
    return (
        df.groupBy(F.window(time_col, width))
        .agg(
            round_exact(exact_avg(F.col("cpm")), 2).alias("avg_cpm"),
            round_exact(F.greatest(F.max("cpm"), F.lit(0.0)), 2).alias("max_cpm"),
            F.count_distinct("sensor_key").alias("active_sensors"),
            F.count_if(F.col("level") != "safe").alias("alert_count"),
            F.count(F.lit(1)).alias("reading_count"),
        )
        .select(*window_bounds(), "avg_cpm", "max_cpm", "active_sensors", "alert_count", "reading_count")
    )


def stats_partials(df: DataFrame, width: str, time_col: str = "arrival_ts") -> DataFrame:
    """Mergeable partial statistics per window and sensor; see :func:`merge_stats`.

    A row per sensor keeps the distinct count exact, and no row grows with the sensors.
    """
    return (
        df.groupBy(F.window(time_col, width), "sensor_key")
        .agg(
            F.sum(F.col("cpm").cast("decimal(18,6)")).alias("total"),
            F.max("cpm").alias("max_cpm"),
            F.count_if(F.col("level") != "safe").alias("alert_count"),
            F.count(F.lit(1)).alias("reading_count"),
        )
        .select(*window_bounds(), "sensor_key", "total", "max_cpm", "alert_count", "reading_count")
    )


def merge_stats(partials: DataFrame, width: str) -> DataFrame:
    """Statistics per (wider) window from any number of partial statistics, exact like one pass.

    First per (window, sensor), so one wide window is still spread by sensor.
    """
    sums = [F.sum("total").alias("total"), F.max("max_cpm").alias("max_cpm")]
    sums += [F.sum("alert_count").alias("alert_count"), F.sum("reading_count").alias("reading_count")]
    per_sensor = partials.groupBy(F.window("window_start", width), "sensor_key").agg(*sums)
    return (
        per_sensor.groupBy("window")
        .agg(*sums, F.count("sensor_key").alias("active_sensors"))
        .select(
            *window_bounds(),
            round_exact(F.col("total").cast("double") / F.col("reading_count"), 2).alias("avg_cpm"),
            round_exact(F.greatest("max_cpm", F.lit(0.0)), 2).alias("max_cpm"),
            "active_sensors",
            "alert_count",
            "reading_count",
        )
    )


#: Logarithm of a sketch's buckets: 4096 of them, a standard error of about 1.6 % and some kilobytes.
SKETCH_LG = 12


def sketch_partials(df: DataFrame, width: str, time_col: str = "arrival_ts", lg_buckets: int = SKETCH_LG) -> DataFrame:
    """Partial statistics with a sketch of the sensors: one row per window, however many sensors.

    For :func:`merge_sketched`.  A sensor without a key counts as none.
    """
    return (
        df.groupBy(F.window(time_col, width))
        .agg(
            F.sum(F.col("cpm").cast("decimal(18,6)")).alias("total"),
            F.max("cpm").alias("max_cpm"),
            F.count_if(F.col("level") != "safe").alias("alert_count"),
            F.count(F.lit(1)).alias("reading_count"),
            F.hll_sketch_agg("sensor_key", F.lit(lg_buckets)).alias("sensors"),
        )
        .select(*window_bounds(), "total", "max_cpm", "alert_count", "reading_count", "sensors")
    )


def merge_sketched(partials: DataFrame, width: str) -> DataFrame:
    """Statistics per (wider) window from :func:`sketch_partials`: all exact but ``active_sensors``.

    Sketches of any sizes merge; the estimate's error is that of the smallest.
    """
    return (
        partials.groupBy(F.window("window_start", width))
        .agg(
            F.sum("total").alias("total"),
            F.max("max_cpm").alias("max_cpm"),
            F.sum("alert_count").alias("alert_count"),
            F.sum("reading_count").alias("reading_count"),
            F.hll_sketch_estimate(F.hll_union_agg("sensors", F.lit(True))).alias("active_sensors"),
        )
        .select(
            *window_bounds(),
            round_exact(F.col("total").cast("double") / F.col("reading_count"), 2).alias("avg_cpm"),
            round_exact(F.greatest("max_cpm", F.lit(0.0)), 2).alias("max_cpm"),
            "active_sensors",
            "alert_count",
            "reading_count",
        )
    )


def timeseries(
    readings: DataFrame, as_of: datetime, hours: int = 1, time_col: str = "ingested_at"
) -> DataFrame:
    """Average, maximum and count per time bucket of the last ``hours``, oldest first."""
    width = S.BUCKET_WIDTHS[check_hours(hours)]
    return bucketed(since(readings, as_of, hours, time_col), width, time_col).orderBy("bucket")


def bucketed(readings: DataFrame, width: str, time_col: str = "ingested_at") -> DataFrame:
    return (
        readings.groupBy(F.window(time_col, width))
        .agg(
            exact_avg(F.col("cpm")).alias("avg_cpm"),
            F.max("cpm").alias("max_cpm"),
            F.count(F.lit(1)).alias("reading_count"),
        )
        .select(F.col("window.start").alias("bucket"), "avg_cpm", "max_cpm", "reading_count")
    )


def bucket_width(hours: int) -> str:
    """Bucket width for a lookback; unlisted lookbacks use one hour."""
    return S.BUCKET_WIDTHS.get(hours, "1 hour")


def count_sensors(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("sensor_key").alias("sensors"))


def distinct_sensors(df: DataFrame) -> DataFrame:
    return df.select("sensor_key").distinct()


def extent(df: DataFrame) -> DataFrame:
    """South, west, north and east limits."""
    return df.agg(
        F.min("latitude").alias("s"),
        F.min("longitude").alias("w"),
        F.max("latitude").alias("n"),
        F.max("longitude").alias("e"),
    )


def time_bounds(df: DataFrame, at: Column | None = None, time_col: str = "ingested_at") -> DataFrame:
    """First and last time (epoch ms), and how far ``at`` (default: the end) has come in percent."""
    millis = F.unix_millis(F.col(time_col))
    bounds = df.agg(F.min(millis).alias("t0"), F.max(millis).alias("t1"))
    clock = F.col("t1") if at is None else F.unix_millis(at)
    share = 100 * (clock - F.col("t0")) / (F.col("t1") - F.col("t0"))
    progress = F.when(F.col("t1") > F.col("t0"), F.floor(share + 0.5)).otherwise(F.lit(0))
    return bounds.withColumn("progress", progress.cast("int"))


def ingest_rate(df: DataFrame, width: str = "1 minute", time_col: str = "arrival_ts") -> DataFrame:
    """Rows and rows per second for each arrival bucket."""
    return (
        df.groupBy(F.window(time_col, width))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.col("window.start").alias("bucket"),
            "rows",
            (
                F.col("rows")
                / (F.unix_seconds("window.end") - F.unix_seconds("window.start"))
            ).alias("rows_per_second"),
        )
    )


def sparkline(
    series: DataFrame,
    value: str = "avg_cpm",
    order: str = "bucket",
    points: int = 30,
    width: float = 268.0,
    height: float = 40.0,
) -> DataFrame:
    """Drawing positions of the last ``points`` values of a series; none for fewer than two.

    The cut to the last points is the feature (the panel keeps that many), and it bounds
    the rows that the unpartitioned windows below ever see.
    """
    recent = series.filter(F.col(value).isNotNull()).orderBy(F.desc(order)).limit(points)
    everything = Window.partitionBy(F.lit(0))
    low = F.min(value).over(everything)
    high = F.greatest(F.max(value).over(everything), low + 1)
    return (
        recent.select(
            order,
            value,
            (F.row_number().over(everything.orderBy(order)) - 1).alias("_index"),
            F.count(F.lit(1)).over(everything).alias("_count"),
            low.alias("_low"),
            high.alias("_high"),
        )
        .filter("_count >= 2")
        .select(
            order,
            value,
            round_exact(F.col("_index") / (F.col("_count") - 1) * width, 1).alias("x"),
            round_exact(
                F.lit(height) - (F.col(value) - F.col("_low")) / (F.col("_high") - F.col("_low")) * height, 1
            ).alias("y"),
        )
    )
