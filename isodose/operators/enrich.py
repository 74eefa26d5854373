"""Enrichment of clean readings: level, location key, cell, place, country, region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.functions import geo
from isodose.functions.levels import level_of
from isodose.operators.nearest import PlaceIndex, nearest_place
from isodose.operators.ordered import neighbour, slice_hot_keys

FAR_FUTURE = "9999-12-31 00:00:00"


def enrich(clean: DataFrame, threshold: float | Column = S.DEFAULTS.threshold) -> DataFrame:
    """Level and location key; the unit has done its work and is dropped."""
    return clean.drop("unit").withColumns(
        {
            "level": level_of(F.col("cpm"), threshold),
            "sensor_key": geo.sensor_key(F.col("latitude"), F.col("longitude")),
        }
    )


def threshold_intervals(changes: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``changes(effective_at, threshold)`` as half-open validity intervals."""
    limits = {} if max_rows is None else {"max_rows": max_rows}
    log = slice_hot_keys(changes, [], ["effective_at", "threshold"], **limits)
    ends = neighbour(log, "effective_at", "valid_until", step=+1)
    return ends.select(
        F.col("effective_at").alias("valid_from"),
        F.coalesce("valid_until", F.lit(FAR_FUTURE).cast("timestamp")).alias("valid_until"),
        F.col("threshold").cast("double").alias("threshold"),
    ).filter("valid_from < valid_until")


def with_threshold(
    df: DataFrame,
    changes: DataFrame,
    time_col: str = "arrival_ts",
    default: float = S.DEFAULTS.threshold,
    width_seconds: int = 3600,
) -> DataFrame:
    """Add the ``threshold`` in force when each row arrived (as-of join).

    Intervals are spread over the time buckets they cover, so this is an equi-join on the
    bucket with the exact bounds as a residual condition: no nested loop.  Catalyst
    broadcasts the intervals if their measured size allows it and shuffles otherwise,
    where adaptive execution splits a bucket with too many rows.  Only buckets between the
    first and the last change are materialised; later rows take the last threshold.
    """

    def bucket(moment: Column) -> Column:
        return F.floor(F.unix_seconds(moment) / width_seconds)

    last = changes.agg(
        F.max("effective_at").alias("at"),
        F.max_by(F.col("threshold").cast("double"), F.struct("effective_at", "threshold")).alias("t"),
    ).first()
    if last["at"] is None:
        return df.withColumn("threshold", F.lit(float(default)))
    spread = (
        threshold_intervals(changes)
        .filter(F.col("valid_from") < F.lit(last["at"]))
        .withColumn(
            "_bucket",
            F.explode(F.sequence(bucket(F.col("valid_from")), bucket(F.col("valid_until")))),
        )
        .withColumnRenamed("threshold", "_threshold")
    )
    moment = F.col(time_col)
    joined = df.withColumn("_at", bucket(moment)).join(
        spread,
        (F.col("_at") == F.col("_bucket"))
        & (moment >= F.col("valid_from"))
        & (moment < F.col("valid_until")),
        "left",
    )
    in_force = F.when(moment >= F.lit(last["at"]), F.lit(last["t"])).otherwise(F.col("_threshold"))
    return joined.select(
        *df.columns, F.coalesce(in_force, F.lit(float(default))).alias("threshold")
    )


def with_country_name(df: DataFrame, countries: DataFrame, code: str = "cc") -> DataFrame:
    """Add ``country`` from ``countries(cc, name)``; an unknown code stands for itself."""
    names = countries.select(F.col("cc").alias("_cc"), F.col("name").alias("_name"))
    joined = df.join(names, F.col(code) == F.col("_cc"), "left")
    return joined.select(
        *df.columns, F.coalesce("_name", F.col(code).cast("string"), F.lit("")).alias("country")
    )


def with_place(
    df: DataFrame,
    places: DataFrame | PlaceIndex,
    countries: DataFrame | None = None,
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Add ``city`` and ``country`` of the nearest of ``places(place_id, city, cc, lat, lon)``.

    The search runs once per distinct coordinate, not once per reading.
    """
    points = df.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    found = nearest_place(points, places, "_lat", "_lon").select("_lat", "_lon", "city", "cc")
    if countries is None:
        found = found.withColumn("country", F.col("cc").cast("string"))
    else:
        found = with_country_name(found, countries)
    keep = [name for name in df.columns if name not in ("city", "country")]
    joined = df.select(*keep).join(
        found, (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon")), "left"
    )
    return joined.select(
        *keep,
        F.coalesce(F.trim("city"), F.lit("")).alias("city"),
        F.coalesce("country", F.lit("")).alias("country"),
    )


def named_regions(df: DataFrame, world: bool = False) -> DataFrame:
    """The built-in region table (27 boxes, optionally the whole world)."""
    boxes = [*S.REGIONS]
    if world:
        boxes.append((S.WORLD, -90.0, -180.0, 90.0, 180.0))
    return df.sparkSession.createDataFrame(boxes, S.REGION)


def with_regions(
    df: DataFrame,
    regions: DataFrame | None = None,
    lat: str = "latitude",
    lon: str = "longitude",
    degrees: int = 10,
) -> DataFrame:
    """One row per reading and region that contains it, with the region's ``label``.

    Boxes are spread over a coarse grid, which makes the containment test an equi-join on
    the grid cell with the exact box as residual condition.
    """
    regions = named_regions(df) if regions is None else regions

    def cell(value: Column) -> Column:
        return F.floor(value / degrees)

    spread = regions.select(
        "label", "s", "w", "n", "e",
        F.explode(F.sequence(cell(F.col("s")), cell(F.col("n")))).alias("_row"),
    ).select(
        "*", F.explode(F.sequence(cell(F.col("w")), cell(F.col("e")))).alias("_column")
    )
    point_lat, point_lon = F.col(lat), F.col(lon)
    joined = df.join(
        spread,
        (cell(point_lat) == F.col("_row"))
        & (cell(point_lon) == F.col("_column"))
        & geo.in_box(point_lat, point_lon, F.col("s"), F.col("w"), F.col("n"), F.col("e")),
    )
    return joined.select(*df.columns, "label")


def in_region(df: DataFrame, label: str, regions: Sequence[tuple] = S.REGIONS) -> DataFrame:
    """Rows inside one named box; the world label keeps everything."""
    if label == S.WORLD:
        return df
    for name, s, w, n, e in regions:
        if name == label:
            return df.filter(geo.in_box(F.col("latitude"), F.col("longitude"), s, w, n, e))
    raise ValueError(f"unknown region {label!r}")
