"""Latest state per sensor and what was newer than everything before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isodose.operators.ordered import SLICE, Sliced, across, slice_hot_keys, slice_totals

ARRIVAL = ("arrival_ts", "captured_at", "event_id")


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key.

    Spark turns the row-number filter into a group limit *before* the shuffle, so a key
    with a third of all rows sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_emissions(rows: DataFrame | Sliced, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Rows captured later than every row of their sensor that arrived before."""
    sliced = rows if isinstance(rows, Sliced) else slice_hot_keys(rows, ["sensor_key"], order)
    totals = slice_totals(sliced, _max=F.max("captured_at"))
    carry = totals and totals.select(
        *sliced.group, F.max("_max").over(across(sliced, Window.unboundedPreceding, -1)).alias("_carry")
    )
    seen = sliced.with_carry(carry, _carry="bigint").withColumn(
        "_seen", F.greatest(F.max("captured_at").over(sliced.before()), "_carry")
    )
    newer = F.col("_seen").isNull() | (F.col("captured_at") > F.col("_seen"))
    return seen.filter(newer).drop("_seen", "_carry", SLICE)


def latest_per_sensor(df: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The most recently captured row per sensor; the first to arrive wins a tie."""
    return first_per_key(df, ["sensor_key"], F.desc("captured_at"), *[F.asc(c) for c in order])


def all_sensors(
    readings: DataFrame, time_col: str = "ingested_at", ties: Sequence[str] = ()
) -> DataFrame:
    """Most recently ingested row of every sensor ever seen."""
    return first_per_key(
        readings, ["sensor_key"], F.desc(time_col), *[F.desc(name) for name in ties]
    )
