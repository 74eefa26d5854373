"""Readings and dimensions derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isodose import Settings
from isodose.plans.live import enriched_readings
from isodose.sources import filelog, log
from isodose.sources.csv import raw_json

AS_OF = datetime(2024, 1, 31)
DAY_MS = 86_400_000
#: Alerts at 50 counts per minute; windows and cool-down sized for one event per few minutes.
SETTINGS = Settings(threshold=50.0, cooldown_ms=DAY_MS, window="1 day", geohash_precision=2)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

_TIME = "date_format(cast(ts as timestamp), 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
_RAW = {
    "captured_time": f"""case when event_id % 97 = 0 then ''
        when event_id % 73 = 0 then concat('2009', substr({_TIME}, 5)) else {_TIME} end""",
    "uploaded_time": _TIME,
    "latitude": """cast(case when event_id % 89 = 0 then 0.0D
        else ((user_id * 7919) % 17001) / cast(100 as double) - 85 end as string)""",
    "longitude": """cast(case when event_id % 89 = 0 then 0.0D
        else ((user_id * 104729) % 36000) / cast(100 as double) - 180 end as string)""",
    "value": """case when event_id % 83 = 0 then 'nan' when event_id % 79 = 0 then '10000'
        else cast(value as string) end""",
    "unit": "case when event_type = 'error' then 'usv' else ' CPM ' end",
    "device_id": "case when event_id % 3 = 0 then concat(' D', user_id) else '' end",
    "md5": "case when event_id % 7 = 0 then '' else md5(cast(event_id as string)) end",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_raw(events: DataFrame) -> DataFrame:
    """Raw text readings, one sensor per user, with deliberate bad rows."""
    return events.select(
        "event_id",
        "user_id",
        F.col("ts").cast("timestamp").alias("arrival_ts"),
        *[F.expr(sql).alias(name) for name, sql in _RAW.items()],
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(table(spark, sf_dir, "events"))


def messages(raw_rows: DataFrame) -> DataFrame:
    """The same readings as JSON messages with their arrival time."""
    return raw_rows.select("event_id", "arrival_ts", raw_json(raw_rows).alias("value"))


def enriched(spark: SparkSession, sf_dir: str, keep=("arrival_ts", "event_id")) -> DataFrame:
    return enriched_readings(raw(spark, sf_dir), SETTINGS, keep)


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched readings with made-up place names, some of them blank."""
    rows = enriched(spark, sf_dir, ("arrival_ts", "event_id", "user_id"))
    return rows.withColumns(
        {
            "city": F.expr("case when user_id % 3 = 0 then '' else concat('City ', user_id % 10) end"),
            "country": F.expr("case when user_id % 5 = 0 then '' else concat('Land ', user_id % 25) end"),
        }
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched readings with the ingestion time that history queries use."""
    return enriched(spark, sf_dir).withColumnRenamed("arrival_ts", "ingested_at")


def threshold_changes(spark: SparkSession) -> DataFrame:
    rows = [(datetime(2024, 1, 1), 50.0), (datetime(2024, 1, 10), 100.0), (datetime(2024, 1, 20), 30.0)]
    return spark.createDataFrame(rows, "effective_at timestamp, threshold double")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as place_id",
        "c_name as city",
        "cast(c_nationkey as string) as cc",
        "((c_custkey * 3571) % 17001) / cast(100 as double) - 85 as lat",
        "((c_custkey * 9973) % 36000) / cast(100 as double) - 180 as lon",
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").filter("n_nationkey <> 7").selectExpr(
        "cast(n_nationkey as string) as cc", "n_name as name"
    )


def event_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The events table as a stream of JSON messages, ten days to a micro-batch.

    Each part is one file written after the one before, which is the order the file source
    takes them in.
    """
    rows = raw(spark, sf_dir)
    for first, last in ((None, "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", None)):
        part = rows if first is None else rows.where(F.col("arrival_ts") >= first)
        part = part if last is None else part.where(F.col("arrival_ts") < last)
        messages(part).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(messages(rows).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def stream_threshold():
    """A threshold that changes between micro-batches."""
    limits = iter((50.0, 100.0, 30.0))
    return lambda: next(limits)


def event_log(spark: SparkSession, sf_dir: str, path: str) -> int:
    """The events as records of the raw topic, keyed by user and in order of time; how many."""
    # Put in order before the texts are made, so that only the events themselves are moved.
    ordered = table(spark, sf_dir, "events").repartitionByRange("ts").sortWithinPartitions("ts", "event_id")
    rows = as_raw(ordered)
    records = rows.select(
        F.lit(log.TOPICS["raw"]).alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        # The record brings its event along, which arrives in the text like any other field.
        F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('",'), F.substr(raw_json(rows), F.lit(2))).alias("value"),
        F.col("arrival_ts").alias("timestamp"),
    )
    filelog.append_log(records, path, partitions=3)
    return table(spark, sf_dir, "events").count()


def uneven_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Readings of three sources in four micro-batches: some rows come a part late, and one source
    is silent for a while."""
    rows = raw(spark, sf_dir).withColumn("source", F.concat(F.lit("s"), F.col("user_id") % 3))
    due = F.when(F.col("arrival_ts") < "2024-01-11", 0).when(F.col("arrival_ts") < "2024-01-21", 1).otherwise(2)
    silent = (F.col("source") == "s2") & (due == 1)
    part = F.when(silent, 2).otherwise(due + (F.col("event_id") % 11 == 3).cast("int"))
    sent = rows.select("event_id", "arrival_ts", "source", part.alias("part"), raw_json(rows).alias("value"))
    for number in range(4):
        sent.where(F.col("part") == number).drop("part").coalesce(1).write.mode("append").parquet(folder)
    schema = sent.drop("part").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
