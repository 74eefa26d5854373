"""Heat cells and the ranking of the most dangerous ones."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.functions.geo import with_geohash
from isodose.functions.levels import level_name, level_rank
from isodose.functions.numeric import exact_avg, round_exact
from isodose.operators.enrich import with_place
from isodose.operators.nearest import PlaceIndex
from isodose.operators.filters import alive
from isodose.operators.latest import first_per_key
from isodose.operators.stats import window_bounds

WINDOW = ["window_start", "window_end"]


def cell_aggregates() -> list[Column]:
    """What a window knows about a cell.  The centre is a function of the cell name."""
    return [
        F.max("cell_lat").alias("cell_lat"),
        F.max("cell_lon").alias("cell_lon"),
        exact_avg(F.col("cpm")).alias("avg_cpm"),
        F.max("cpm").alias("max_cpm"),
        F.count(F.lit(1)).alias("count"),
        F.max(level_rank(F.col("level"))).alias("_worst"),
    ]


def cell_columns() -> list[Column]:
    """Rounded output columns over :func:`cell_aggregates`."""
    return [
        F.col("geohash"),
        round_exact(F.col("cell_lat"), 5).alias("cell_lat"),
        round_exact(F.col("cell_lon"), 5).alias("cell_lon"),
        round_exact(F.col("avg_cpm"), 2).alias("avg_cpm"),
        round_exact(F.col("max_cpm"), 2).alias("max_cpm"),
        F.col("count"),
        level_name(F.col("_worst")).alias("level"),
    ]


def heat_cells(
    enriched: DataFrame,
    width: str = S.DEFAULTS.window,
    precision: int = S.DEFAULTS.geohash_precision,
    time_col: str = "arrival_ts",
) -> DataFrame:
    """Count, average, maximum and worst level per (window, geohash cell)."""
    located = enriched.select(F.col(time_col).alias("_at"), "latitude", "longitude", "cpm", "level")
    return (
        with_geohash(located, precision)
        .groupBy(F.window("_at", width), "geohash")
        .agg(*cell_aggregates())
        .select(*window_bounds(), *cell_columns())
    )


def with_cell_places(cells: DataFrame, places: DataFrame | PlaceIndex, countries: DataFrame | None = None) -> DataFrame:
    """Label cells with the place nearest to their centre, looked up once per cell."""
    return with_place(cells, places, countries, lat="cell_lat", lon="cell_lon")


def _with_text_columns(cells: DataFrame) -> DataFrame:
    missing = [name for name in ("city", "country") if name not in cells.columns]
    return cells.withColumns({name: F.lit("") for name in missing}) if missing else cells


def hotspot_struct(rank: Column) -> Column:
    return F.struct(
        rank.cast("int").alias("rank"),
        F.col("geohash"),
        F.col("city"),
        F.col("country"),
        F.col("cell_lat").alias("lat"),
        F.col("cell_lon").alias("lon"),
        F.col("max_cpm"),
        F.col("avg_cpm"),
        F.col("level"),
        F.col("count"),
    )


def top_hotspots(
    cells: DataFrame,
    n: int = S.DEFAULTS.top_n,
    places: DataFrame | PlaceIndex | None = None,
    countries: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` worst unsafe cells of each window as ``count, hotspots[]``.

    ``places`` names the cells that made it; otherwise they keep the names they have, if any.

    A window of safe cells only is reported with count 0.  Safe cells sort last, so the
    row-number limit (which Spark applies before the shuffle too) always leaves at least
    one row per window, and the list holds no more than ``n`` entries.
    """
    unsafe = F.col("level") != "safe"
    worst_first = Window.partitionBy(*WINDOW).orderBy(
        unsafe.desc(), F.desc("max_cpm"), F.asc("geohash")
    )
    ranked = (
        _with_text_columns(cells)
        .withColumn("_rank", F.row_number().over(worst_first))
        .filter(F.col("_rank") <= n)
    )
    if places is not None:
        ranked = with_cell_places(ranked, places, countries)
    listed = F.sort_array(F.collect_list(F.when(unsafe, hotspot_struct(F.col("_rank")))))
    return ranked.groupBy(*WINDOW).agg(listed.alias("hotspots")).select(
        *WINDOW, F.size("hotspots").alias("count"), "hotspots"
    )


def flat_hotspots(top: DataFrame) -> DataFrame:
    """One row per hotspot (one empty row for a window without any)."""
    listed = top.select(*WINDOW, F.col("count").alias("hotspots_in_window"), F.explode_outer("hotspots").alias("_h"))
    return listed.select(*WINDOW, "hotspots_in_window", "_h.*")


def active_cells(cells: DataFrame, sensors: DataFrame) -> DataFrame:
    """Cells that hold at least one of the given sensors; all cells if there is no sensor.

    ``sensors`` has a ``geohash`` column of the same precision.
    """
    hashes = sensors.select("geohash").filter("geohash is not null").distinct()
    if hashes.isEmpty():
        return cells
    return cells.join(hashes, "geohash", "left_semi")


def evicted_cells(cells: DataFrame, sensors: DataFrame) -> DataFrame:
    """Cells left after some sensors were evicted: a cell goes with its last sensor.

    ``sensors(geohash, kept)`` says for each sensor and cell whether the sensor stays.
    """
    lost = sensors.groupBy("geohash").agg(F.max("kept").alias("kept")).where("not kept")
    return cells.join(lost, "geohash", "left_anti")


def current_cells(cells: DataFrame, as_of: datetime, ttl_seconds: float = S.DEFAULTS.cell_ttl_seconds) -> DataFrame:
    """The last state of each cell, as long as it is younger than its time to live."""
    newest = first_per_key(cells, ["geohash"], F.desc("window_end"))
    return alive(newest, as_of, ttl_seconds, time_col="window_end")
