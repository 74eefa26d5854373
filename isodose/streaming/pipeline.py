"""Stateless steps of a stream, and products as queries of their own.

The window products here keep state for a limited time: rows behind the watermark are dropped
and counted in the query progress.  :mod:`isodose.streaming.live` counts every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from isodose.functions.parse import parse_json
from isodose.operators.enrich import enrich
from isodose.operators.quality import clean_readings
from isodose.schemas import DEFAULTS, Settings
from isodose.session import STATE_STORE
from isodose.streaming import windows

SHARED_CLOCK = ("arrival_ts",)


def clean_stream(
    messages: DataFrame,
    settings: Settings = DEFAULTS,
    keep: tuple[str, ...] = SHARED_CLOCK,
    value: str = "value",
) -> DataFrame:
    """Parse and clean JSON messages (``value``): the input of :mod:`isodose.streaming.live`."""
    parsed = parse_json(messages, value, keep)
    return clean_readings(parsed, settings.earliest_ms, settings.latest_ms)


def enriched_stream(
    messages: DataFrame,
    settings: Settings = DEFAULTS,
    keep: tuple[str, ...] = SHARED_CLOCK,
    value: str = "value",
) -> DataFrame:
    """Parse, clean and enrich JSON messages (``value``); all of it stateless."""
    return enrich(clean_stream(messages, settings, keep, value), settings.threshold)


def window_streams(enriched: DataFrame, settings: Settings = DEFAULTS, time_col: str = "arrival_ts") -> dict[str, DataFrame]:
    """The three window products as queries of their own, each with its checkpoint."""
    timed = windows.on_clock(enriched, time_col, settings.lateness)
    width, precision = settings.window, settings.geohash_precision
    return {
        "stats": windows.global_stats(timed, width, time_col),
        "heatmap": windows.heat_cells(timed, width, precision, time_col),
        "top": windows.top_hotspots(timed, settings.top_n, width, precision, time_col),
    }


def start_parquet(stream: DataFrame, path: str, available_now: bool = False) -> StreamingQuery:
    """Write a stream to Parquet files (exactly once), with its checkpoint beside them."""
    use_state_store(stream.sparkSession)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}/_checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(f"{path}/data")


def use_state_store(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store, which also keeps large state off the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def settle(stream: DataFrame, path: str) -> DataFrame:
    """Process everything the source has now, then give the result as a table."""
    start_parquet(stream, path, available_now=True).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")
