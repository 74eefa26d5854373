"""Exact nearest place by great-circle distance, as joins down a tree of boxes.

Places sit on the unit sphere; each tree level cuts space into 4 x 4 x 4 smaller boxes
and keeps the tight bounds of the places inside.  A point walks down level by level with
the boxes that may still hold its nearest place: a box is dropped once its closest corner
is farther than the farthest corner of some other box.  That is exact everywhere,
including the poles and the date line, and never pairs a point with all places.

Every level is an equi-join on the box code.  Points keep their partitioning while
Catalyst can broadcast the level (it decides by size); a gazetteer too large for that
goes through shuffled joins, where adaptive execution splits crowded boxes.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isodose.functions.geo import chord_to_km, unit_sphere
from isodose.session import durable_dir

AXES = ("x", "y", "z")
#: 4**10 boxes per axis are 12 m wide: two index bits per level, twenty per axis.
MAX_DEPTH = 10
LEAF_PLACES = 32
#: Slack for rounding when bounds are compared; a spare box is harmless, a lost one is not.
_SLACK = 1e-12


def _box_code(depth: int | Column) -> Column:
    """Code of the box at ``depth`` that holds (x, y, z)."""
    side = F.lit(4**depth) if isinstance(depth, int) else F.pow(F.lit(4), depth).cast("bigint")

    def index(axis: str) -> Column:
        cut = F.floor((F.col(axis) + 1.0) * (side / F.lit(2.0)))
        return F.greatest(F.lit(0), F.least(side - 1, cut)).cast("bigint")

    return F.shiftleft(index("x"), 40) + F.shiftleft(index("y"), 20) + index("z")


def _square(value: Column) -> Column:
    return value * value


def _nearest_corner(low, high) -> Column:
    """Squared distance from (x, y, z) to the box, 0 inside."""
    parts = [
        _square(F.greatest(low(axis) - F.col(axis), F.col(axis) - high(axis), F.lit(0.0)))
        for axis in AXES
    ]
    return parts[0] + parts[1] + parts[2]


def _farthest_corner(low, high) -> Column:
    """Squared distance from (x, y, z) to the farthest point of the box."""
    parts = [
        _square(F.greatest(F.abs(F.col(axis) - low(axis)), F.abs(high(axis) - F.col(axis))))
        for axis in AXES
    ]
    return parts[0] + parts[1] + parts[2]


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.withColumns(dict(zip(AXES, unit_sphere(F.col(lat), F.col(lon)))))


def _boxes(places: DataFrame, depth: int) -> DataFrame:
    """Occupied boxes of one level with their tight bounds and their parent."""
    bounds = [agg(axis).alias(name + axis) for axis in AXES for agg, name in ((F.min, "lo_"), (F.max, "hi_"))]
    return places.groupBy(
        _box_code(depth).alias("_code"), _box_code(depth - 1).alias("_parent")
    ).agg(*bounds)


def _depth_for(places: DataFrame) -> int:
    """Smallest depth, from a first guess on, with at most ``LEAF_PLACES`` places in any box."""
    total = places.count()
    # On a surface each level has up to sixteen times the boxes of the one above.
    guess = max(1, math.ceil(math.log(max(total, 1) / LEAF_PLACES, 16)))
    # Several depths are tried in one pass; crowded gazetteers need more than one pass.
    while guess < MAX_DEPTH:
        last = min(MAX_DEPTH, guess + 2)
        tried = places.withColumn("_depth", F.explode(F.array(*map(F.lit, range(guess, last + 1)))))
        boxes = tried.groupBy("_depth", _box_code(F.col("_depth")).alias("_code")).count()
        fullest = dict(boxes.groupBy("_depth").agg(F.max("count")).collect())
        for depth in range(guess, last + 1):
            if (fullest.get(depth) or 0) <= LEAF_PLACES:
                return depth
        guess = last
    return MAX_DEPTH


class PlaceIndex:
    """The tree of boxes over a gazetteer ``(place_id, city, cc, lat, lon)``, built once.

    The places and, with ``shared``, the bounds of every level are kept, as tables below ``path`` or as
    checkpoints, and all searches read them; an index for a single search leaves the levels to it.
    """

    def __init__(self, places: DataFrame, path: str | None = None, shared: bool = True):
        durable_dir(places.sparkSession)
        known = places.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        # Places at the same spot are one candidate; the smallest id speaks for them.
        spots = known.groupBy(F.col("lat").alias("_plat"), F.col("lon").alias("_plon")).agg(
            F.min(F.struct("place_id", "city", "cc")).alias("_place")
        )
        self.spots = _kept(_on_sphere(spots, "_plat", "_plon"), path, "spots")
        self.depth = _depth_for(self.spots)
        # The first level has at most 64 boxes whatever the data, so it travels as a literal.
        self.roots = _boxes(self.spots, 1).select("_code", *_BOUNDS).collect()
        self._levels = {level: _boxes(self.spots, level) for level in range(2, self.depth + 1)}
        if shared and self._levels:
            tagged = [boxes.withColumn("level", F.lit(level)) for level, boxes in self._levels.items()]
            stored = _kept(reduce(DataFrame.unionByName, tagged), path, "levels", "level")
            self._levels = {level: stored.where(F.col("level") == level).drop("level") for level in self._levels}

    def boxes(self, level: int) -> DataFrame:
        """Occupied boxes of a level below the first, with bounds and parent."""
        return self._levels[level]

    def leaves(self) -> DataFrame:
        return self.spots.select(_box_code(self.depth).alias("_code"), "_place", *[F.col(axis).alias("p" + axis) for axis in AXES])


_BOUNDS = [prefix + axis for axis in AXES for prefix in ("lo_", "hi_")]


def _kept(df: DataFrame, path: str | None, name: str, *by: str) -> DataFrame:
    if path is None:
        return df.checkpoint()
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")


def nearest_place(points: DataFrame, places: DataFrame | PlaceIndex, lat: str, lon: str) -> DataFrame:
    """Add ``place_id, city, cc, distance_km`` of the nearest place to distinct points.

    ``places(place_id, city, cc, lat, lon)``, or the index of such a table, which several searches
    share; equally near places: smallest ``place_id``.  Points without coordinates are dropped, as
    are all points if there is no place.
    """
    point = [lat, lon]
    index = places if isinstance(places, PlaceIndex) else PlaceIndex(places, shared=False)
    roots = F.array(
        *[F.struct(*[F.lit(row[name]).alias(name) for name in ("_code", *_BOUNDS)]) for row in index.roots]
    )
    if not index.roots:
        return points.limit(0).selectExpr(
            "*", "cast(null as bigint) place_id", "cast(null as string) city",
            "cast(null as string) cc", "cast(null as double) distance_km",
        )

    def bound(measure, box: Column) -> Column:
        return measure(lambda axis: box["lo_" + axis], lambda axis: box["hi_" + axis])

    walk = _on_sphere(points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()), lat, lon)
    walk = walk.withColumn("_roots", roots)
    walk = walk.withColumn(
        "_reach", F.array_min(F.transform("_roots", lambda box: bound(_farthest_corner, box)))
    )
    walk = walk.select(
        *points.columns,
        *AXES,
        F.explode(
            F.transform(
                F.filter(
                    "_roots",
                    lambda box: bound(_nearest_corner, box) <= F.col("_reach") + _SLACK,
                ),
                lambda box: box["_code"],
            )
        ).alias("_box"),
    )
    for level in range(2, index.depth + 1):
        child = index.boxes(level)
        low, high = (lambda axis: F.col("lo_" + axis)), (lambda axis: F.col("hi_" + axis))
        walk = walk.join(child, F.col("_box") == F.col("_parent")).select(
            *points.columns,
            *AXES,
            F.col("_code").alias("_box"),
            _nearest_corner(low, high).alias("_near"),
            _farthest_corner(low, high).alias("_far"),
        )
        walk = (
            walk.withColumn("_reach", F.min("_far").over(Window.partitionBy(*point)))
            .filter(F.col("_near") <= F.col("_reach") + _SLACK)
            .drop("_near", "_far", "_reach")
        )
    chord = sum((_square(F.col("p" + axis) - F.col(axis)) for axis in AXES), F.lit(0.0))
    pairs = walk.join(index.leaves(), F.col("_box") == F.col("_code")).withColumn("_chord", chord)
    closest = Window.partitionBy(*point).orderBy("_chord", "_place.place_id")
    return (
        pairs.withColumn("_rank", F.row_number().over(closest))
        .filter("_rank = 1")
        .select(*points.columns, "_place.*", chord_to_km(F.col("_chord")).alias("distance_km"))
    )
