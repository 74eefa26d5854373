"""Message envelopes and the snapshot a new client receives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.functions.text import record_json
from isodose.operators.history import last_window


def envelope(product: DataFrame, channel: str) -> DataFrame:
    """One ``channel, data`` message per row, with the row as JSON in ``data``."""
    if channel not in S.CHANNELS:
        raise ValueError(f"unknown channel {channel!r}")
    return product.select(F.lit(channel).alias("channel"), record_json(product.columns).alias("data"))


def cell_envelopes(cells: DataFrame) -> DataFrame:
    """Heat-map messages; ``data`` always holds a ``cells`` list."""
    data = F.to_json(F.struct(F.array(F.struct(*cells.columns)).alias("cells")))
    return cells.select(F.lit("heatmap").alias("channel"), data.alias("data"))


def feed(**products: DataFrame) -> DataFrame:
    """All products as one feed of envelopes; argument names are channels."""
    parts = [
        cell_envelopes(df) if channel == "heatmap" else envelope(df, channel)
        for channel, df in products.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def snapshot(
    current: DataFrame, cells: DataFrame, stats: DataFrame, top: DataFrame, part_size: int = 1000
) -> DataFrame:
    """First messages for a new client: sensors, cells, current stats, current top-N.

    Sensors and cells are packed into messages of about ``part_size`` rows each (``part``
    numbers them), so no message grows with the number of sensors.  Together the parts of a
    channel are the whole state.  The part of a row follows from its key, and rows are sorted
    within a part, so equal states give equal messages.
    """

    def packed(df: DataFrame, channel: str, field: str, key: str) -> DataFrame:
        parts = F.greatest(F.lit(1), F.ceil(F.lit(df.count() / part_size))).cast("int")
        number = F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("long")
        rows = F.struct(key, *[name for name in df.columns if name != key])
        grouped = df.groupBy(F.pmod(number, parts).cast("int").alias("part")).agg(
            F.sort_array(F.collect_list(rows)).alias(field)
        )
        return grouped.select(
            F.lit(channel).alias("channel"), "part", F.to_json(F.struct(field)).alias("data")
        )

    def single(df: DataFrame, channel: str) -> DataFrame:
        latest = last_window(df).drop("window_start", "window_end")
        return envelope(latest, channel).select("channel", F.lit(0).alias("part"), "data")

    return (
        packed(current, "map", "points", "sensor_key")
        .unionByName(packed(cells, "heatmap", "cells", "geohash"))
        .unionByName(single(stats, "stats"))
        .unionByName(single(top, "top"))
    )
