"""History tables: date-partitioned Parquet with append, read and retention."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isodose import schemas as S
from isodose.functions.parse import from_epoch_ms
from isodose.functions.text import alert_text, display_name
from isodose.session import get_note, list_dir, move, put_note, remove

#: All history queries filter on ingestion time, so that is what folders are named after.
PARTITION = "ingested_date"


def as_readings(enriched: DataFrame, ingested: Column | str = "arrival_ts") -> DataFrame:
    """Rows of the ``readings`` table from enriched readings."""
    moment = F.col(ingested) if isinstance(ingested, str) else ingested
    return enriched.select(
        from_epoch_ms(F.col("captured_at")).alias("captured_at"),
        moment.alias("ingested_at"),
        "sensor_key",
        "city",
        "country",
        "latitude",
        "longitude",
        "cpm",
        "level",
    )


def as_alerts(alerts: DataFrame, ingested: Column | str = "arrival_ts") -> DataFrame:
    """Rows of the ``alerts`` table, with the text shown to people."""
    name = display_name(F.col("city"), F.col("country"), F.col("latitude"), F.col("longitude"))
    rows = as_readings(alerts, ingested)
    return rows.withColumn("alert_text", alert_text(F.col("level"), name))


#: Folder level below the date: the micro-batch that wrote the rows, -1 for bulk loads.
BATCH = "batch_id"
BULK = -1


def _dated(rows: DataFrame, batch_id: int) -> DataFrame:
    """Rows with their folders, in evenly sized pieces sorted by sensor.

    The rebalance hint lets adaptive execution split a date that holds most of the rows, and
    the order lets Parquet statistics skip row groups in single-sensor queries.
    """
    dated = rows.withColumns({PARTITION: F.to_date("ingested_at"), BATCH: F.lit(batch_id)})
    return dated.hint("rebalance", PARTITION).sortWithinPartitions(PARTITION, "sensor_key", "ingested_at")


def append(rows: DataFrame, path: str) -> None:
    """Append rows to a history table."""
    _dated(rows, BULK).write.mode("append").partitionBy(PARTITION, BATCH).parquet(path)


def overwrite_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent append of one micro-batch: a repeated batch replaces its own folders."""
    writer = _dated(rows, batch_id).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PARTITION, BATCH).parquet(path)


#: Where compactions that are not finished are noted, beside the date folders.
_NOTES = "_compactions"


def compact(spark: SparkSession, path: str, day: str) -> None:
    """Rewrite a closed date as one bulk part, without a folder per micro-batch.

    The new part is written out of sight, then a note is put down that names it and the folders it
    replaces.  From that moment :func:`read_readings` and :func:`read_alerts` follow the note, so
    rows are seen once whatever happens next; :func:`recover` finishes what was cut off.  Batches
    must not write to the date any more, least of all repeat themselves.
    """
    recover(spark, path)
    for _ in _compaction(spark, path, day):
        pass


def _compaction(spark: SparkSession, path: str, day: str) -> Iterator[None]:
    """The steps of :func:`compact`; each leaves the table readable."""
    folder = f"{path}/{PARTITION}={day}"
    old = [int(n.split("=")[1]) for n in list_dir(spark, folder) if n.startswith(f"{BATCH}=")]
    if not old:
        return
    # A number of its own, so that no reader takes the new part for one of the old.
    new = min(BULK, *old) - 1
    hidden = f"_part-{-new}"
    rows = spark.read.parquet(*(f"{folder}/{BATCH}={n}" for n in old))
    rows.hint("rebalance").sortWithinPartitions("sensor_key", "ingested_at").write.mode("overwrite").parquet(f"{folder}/{hidden}")
    yield
    put_note(spark, f"{path}/{_NOTES}/{day}", json.dumps({"old": old, "new": new, "hidden": hidden}))
    yield
    yield from _finish(spark, path, day)


def _finish(spark: SparkSession, path: str, day: str) -> Iterator[None]:
    """From the note on: old folders go, the new part comes into sight, the note goes."""
    note, folder = json.loads(get_note(spark, f"{path}/{_NOTES}/{day}")), f"{path}/{PARTITION}={day}"
    there = list_dir(spark, folder)
    if note["hidden"] in there:
        for number in note["old"]:
            remove(spark, f"{folder}/{BATCH}={number}")
            yield
        move(spark, f"{folder}/{note['hidden']}", f"{folder}/{BATCH}={note['new']}")
        yield
    remove(spark, f"{path}/{_NOTES}/{day}")
    yield


def recover(spark: SparkSession, path: str) -> None:
    """Finish compactions that were cut off behind their note; call it before writing starts."""
    for day in _noted(spark, path):
        for _ in _finish(spark, path, day):
            pass


def _noted(spark: SparkSession, path: str) -> list[str]:
    return [n for n in list_dir(spark, f"{path}/{_NOTES}") if not n.endswith(".part")]


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows, each once: compactions under way are read as if they were finished."""
    rows = spark.read.schema(_with_date(schema)).parquet(path)
    parts = []
    for day in _noted(spark, path):
        text = get_note(spark, f"{path}/{_NOTES}/{day}")
        note = json.loads(text) if text else None
        if note is None or note["hidden"] not in list_dir(spark, f"{path}/{PARTITION}={day}"):
            continue  # finished in between, or all but the note
        date = F.lit(day).cast("date")
        rows = rows.filter((F.col(PARTITION) != date) | ~F.col(BATCH).isin(note["old"]))
        part = spark.read.schema(schema).parquet(f"{path}/{PARTITION}={day}/{note['hidden']}")
        parts.append(part.withColumn(PARTITION, date).withColumn(BATCH, F.lit(note["new"])))
    return reduce(DataFrame.unionByName, parts, rows).drop(BATCH)


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, S.READINGS)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, S.ALERTS)


def _with_date(schema):
    return type(schema)([*schema.fields]).add(PARTITION, "date").add(BATCH, T.IntegerType())


def prune_since(df: DataFrame, as_of: datetime, hours: float) -> DataFrame:
    """Skip the folders that a lookback cannot reach (to be combined with the exact filter)."""
    first = (as_of - timedelta(hours=hours)).date()
    return df.filter(F.col(PARTITION) >= F.lit(first)) if PARTITION in df.columns else df


def drop_expired(spark: SparkSession, path: str, as_of: datetime, days: int = 10) -> list[str]:
    """Delete the date folders that lie wholly before the retention limit; returns their names.

    A metadata operation on whole folders, no data is read or rewritten.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = (as_of - timedelta(days=days)).date().isoformat()
    dropped = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{PARTITION}=") and name.split("=", 1)[1] < limit:
            files.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)
