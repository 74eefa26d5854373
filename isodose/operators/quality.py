"""Validity of readings: what is kept, what is rejected, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.functions.parse import is_blank_time, utc_time


def has_time() -> Column:
    return F.col("captured_at").isNotNull()


def plausible_time(low_ms: int = S.EARLIEST_MS, high_ms: int = S.LATEST_MS) -> Column:
    return F.col("captured_at").between(low_ms, high_ms)


def valid_reading() -> Column:
    """Counts per minute in (0, 10000) at a real place that is not the (0, 0) default."""
    lat, lon, cpm = F.col("latitude"), F.col("longitude"), F.col("cpm")
    return (
        (F.col("unit") == "cpm")
        & (cpm > 0)
        & (cpm < 10_000)
        & lat.between(-90, 90)
        & lon.between(-180, 180)
        & ~((lat == 0) & (lon == 0))
    )


def clean_readings(
    parsed: DataFrame, low_ms: int = S.EARLIEST_MS, high_ms: int = S.LATEST_MS
) -> DataFrame:
    """Parsed records that have a plausible time and a valid measurement."""
    return parsed.filter(has_time()).filter(plausible_time(low_ms, high_ms)).filter(valid_reading())


def reject_reason(low_ms: int = S.EARLIEST_MS, high_ms: int = S.LATEST_MS) -> Column:
    """First rule a parsed record breaks, null for a clean one.

    With the raw ``captured_time`` text at hand (column of that name), an unreadable time
    is told apart from a missing one.
    """
    lat, lon, cpm = F.col("latitude"), F.col("longitude"), F.col("cpm")
    return (
        F.when(~has_time(), "no_time")
        .when(~plausible_time(low_ms, high_ms), "time_out_of_range")
        .when(~F.coalesce(F.col("unit") == "cpm", F.lit(False)), "wrong_unit")
        .when(cpm.isNull(), "no_value")
        .when(~((cpm > 0) & (cpm < 10_000)), "value_out_of_range")
        .when(lat.isNull() | lon.isNull(), "no_position")
        .when(~(lat.between(-90, 90) & lon.between(-180, 180)), "position_out_of_range")
        .when((lat == 0) & (lon == 0), "null_island")
    )


def time_reject_reason(text: Column) -> Column:
    """Finer reason for a record without a time: ``missing_time`` or ``bad_time``."""
    return F.when(is_blank_time(text), "missing_time").when(utc_time(text).isNull(), "bad_time")


def split_rejects(parsed: DataFrame, **bounds: int) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with ``reject_reason``)."""
    judged = parsed.withColumn("reject_reason", reject_reason(**bounds))
    clean = judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return clean, judged.filter(F.col("reject_reason").isNotNull())


def count_rejects(parsed: DataFrame, **bounds: int) -> DataFrame:
    """Rows per outcome, ``clean`` included, in one pass."""
    outcome = F.coalesce(reject_reason(**bounds), F.lit("clean")).alias("outcome")
    return parsed.groupBy(outcome).agg(F.count(F.lit(1)).alias("rows"))


def raw_clean_dropped(parsed: DataFrame, **bounds: int) -> DataFrame:
    """One row: how many records came in, stayed, and were dropped."""
    kept = F.count_if(reject_reason(**bounds).isNull())
    rows = F.count(F.lit(1))
    return parsed.agg(rows.alias("raw"), kept.alias("clean"), (rows - kept).alias("dropped"))


def valid_enriched() -> Column:
    """Range rules of an enriched reading (also of alerts and spikes)."""
    return (
        F.col("captured_at").isNotNull()
        & F.col("latitude").between(-90, 90)
        & F.col("longitude").between(-180, 180)
        & (F.col("cpm") >= 0)
        & F.col("level").isin(*S.LEVELS)
        & (F.length("sensor_key") >= 1)
    )


def valid_cell() -> Column:
    return (
        F.col("geohash").isNotNull()
        & F.col("cell_lat").between(-90, 90)
        & F.col("cell_lon").between(-180, 180)
        & F.col("avg_cpm").isNotNull()
        & F.col("max_cpm").isNotNull()
        & F.col("count").isNotNull()
        & F.col("level").isin(*S.LEVELS)
    )


def split_valid(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that meet ``rule``, the others); an undecidable rule counts as broken."""
    passed = F.coalesce(rule, F.lit(False))
    return df.filter(passed), df.filter(~passed)
