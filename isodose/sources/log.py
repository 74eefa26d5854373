"""Message log (Kafka) source and sinks.

The connector is a Spark package of its own (``spark-sql-kafka``); nothing here loads
before a cluster that has it calls these functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from isodose.functions.text import record_json

# --- fixed values: topic of each product ---
TOPICS = {
    "raw": "radiation-raw",
    "clean": "radiation-clean",
    "alerts": "radiation-alerts",
    "current": "radiation-current",
    "stats": "radiation-stats",
    "config": "radiation-config",
    "spikes": "radiation-spikes",
    "heatmap": "radiation-heatmap",
    "top": "radiation-top",
}


def stream_log(
    spark: SparkSession,
    servers: str,
    topics: str | Sequence[str] = TOPICS["raw"],
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """``topic, key, value`` (text), ``arrival_ts``, ``partition``, ``offset`` of the records, from the earliest on.

    ``arrival_ts`` is the record time; set the topic to log-append time, so that a replay
    puts records into the same windows.  Partition and offset tell records of one moment apart:
    keep them as the last order columns of keyed products.  ``max_offsets`` per trigger limits
    the rate.
    """
    names = topics if isinstance(topics, str) else ",".join(topics)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", names)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrival_ts"),
        "partition",
        "offset",
    )


def as_messages(product: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """A product as log records: ``topic``, optional ``key``, JSON ``value``."""
    columns = [F.lit(topic).alias("topic"), record_json(product.columns).alias("value")]
    if key:
        columns.append(F.col(key).cast("string").alias("key"))
    return product.select(*columns)


def write_log(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """Writer for a stream of messages (at least once), still to be started."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )


def route(messages: DataFrame, schemas: Mapping[str, object]) -> dict[str, DataFrame]:
    """Split a multi-topic feed into one typed DataFrame per topic.

    ``schemas`` maps topic names to record schemas.  Text that is not a JSON object leaves
    all fields null, to be dropped by the validity rules of the product.
    """
    strict = {"allowSingleQuotes": "false"}
    return {
        topic: messages.filter(F.col("topic") == topic)
        .select(F.from_json("value", schema, strict).alias("_r"), "arrival_ts")
        .select("_r.*", "arrival_ts")
        for topic, schema in schemas.items()
    }
