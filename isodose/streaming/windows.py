"""Windowed products of a stream, as chains of mergeable aggregations.

Windows default to arrival time.  A capture-time window only needs another ``time_col``
with its own watermark; rows behind the watermark are then dropped and show up in the
query progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.functions.geo import with_geohash
from isodose.functions.numeric import round_exact
from isodose.operators.heat import cell_aggregates, cell_columns, hotspot_struct
from isodose.operators.stats import window_bounds


def on_clock(df: DataFrame, time_col: str = "arrival_ts", lateness: str = S.DEFAULTS.lateness) -> DataFrame:
    """Declare the clock of the stream and how late its rows may be."""
    return df.withWatermark(time_col, lateness)


def global_stats(
    timed: DataFrame, width: str = S.DEFAULTS.window, time_col: str = "arrival_ts"
) -> DataFrame:
    """Streaming form of :func:`isodose.operators.stats.global_stats`, distinct count included.

    First per (window, sensor), then per window: state is one row per sensor of an open
    window, and the single row per window only sees those partial results.
    """
    per_sensor = timed.groupBy(F.window(time_col, width).alias("w"), "sensor_key").agg(
        F.sum(F.col("cpm").cast("decimal(18,6)")).alias("total"),
        F.max("cpm").alias("peak"),
        F.count_if(F.col("level") != "safe").alias("alerts"),
        F.count(F.lit(1)).alias("rows"),
    )
    return (
        per_sensor.groupBy(F.window(F.window_time("w"), width))
        .agg(
            F.sum("total").cast("double").alias("total"),
            F.max("peak").alias("peak"),
            F.count(F.lit(1)).alias("active_sensors"),
            F.sum("alerts").alias("alert_count"),
            F.sum("rows").alias("reading_count"),
        )
        .select(
            *window_bounds(),
            round_exact(F.col("total") / F.col("reading_count"), 2).alias("avg_cpm"),
            round_exact(F.greatest("peak", F.lit(0.0)), 2).alias("max_cpm"),
            "active_sensors",
            "alert_count",
            "reading_count",
        )
    )


def _cells(timed: DataFrame, width: str, precision: int, time_col: str) -> DataFrame:
    return (
        with_geohash(timed, precision)
        .groupBy(F.window(time_col, width), "geohash")
        .agg(*cell_aggregates())
    )


def heat_cells(
    timed: DataFrame,
    width: str = S.DEFAULTS.window,
    precision: int = S.DEFAULTS.geohash_precision,
    time_col: str = "arrival_ts",
) -> DataFrame:
    """Streaming form of :func:`isodose.operators.heat.heat_cells`."""
    return _cells(timed, width, precision, time_col).select(*window_bounds(), *cell_columns())


def top_hotspots(
    timed: DataFrame,
    n: int = S.DEFAULTS.top_n,
    width: str = S.DEFAULTS.window,
    precision: int = S.DEFAULTS.geohash_precision,
    time_col: str = "arrival_ts",
    shards: int | None = None,
) -> DataFrame:
    """Streaming form of the per-window ranking, over the cells of the same window.

    Cells are ranked in ``shards`` groups first and the group winners again.  By default there
    are so many groups that the possible cells of a group number a few thousand.
    """
    shards = shards or max(32, 32**precision // 4096)
    cells = _cells(timed, width, precision, time_col).select(
        F.window_time("window").alias("at"), *cell_columns()
    )
    cells = cells.withColumns({"city": F.lit(""), "country": F.lit("")})
    # Ascending order of (-max, geohash) is the ranking; safe cells are null and skipped.
    entry = F.when(
        F.col("level") != "safe",
        F.struct((-F.col("max_cpm")).alias("_order"), F.col("geohash").alias("_tie"),
                 hotspot_struct(F.lit(0)).alias("_cell")),
    )
    shard = F.pmod(F.xxhash64("geohash"), F.lit(shards)).alias("_shard")
    winners = (
        cells.groupBy(F.window("at", width).alias("w"), shard)
        .agg(F.slice(F.array_sort(F.collect_list(entry)), 1, n).alias("best"))
        .select(F.window_time("w").alias("at"), "best")
    )
    merged = winners.groupBy(F.window("at", width)).agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, n).alias("best")
    )
    ranked = F.transform(
        "best", lambda item, i: item["_cell"].withField("rank", (i + 1).cast("int"))
    )
    return merged.select(*window_bounds(), F.size("best").alias("count"), ranked.alias("hotspots"))
