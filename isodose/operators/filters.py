"""Row filters and argument checks used by the queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.functions.geo import in_box, parse_bbox


def not_safe(df: DataFrame) -> DataFrame:
    return df.filter(F.col("level") != "safe")


def at_least(df: DataFrame, min_cpm: float | None) -> DataFrame:
    """Rows with ``cpm >= min_cpm``; no filter for None."""
    if min_cpm is None:
        return df
    if min_cpm < 0:
        raise ValueError("min_cpm must not be negative")
    return df.filter(F.col("cpm") >= min_cpm)


def within_bbox(df: DataFrame, bbox: str | None) -> DataFrame:
    """Rows inside ``"w,s,e,n"``, edges included; no filter for None or ''."""
    if not bbox:
        return df
    return df.filter(in_box(F.col("latitude"), F.col("longitude"), *parse_bbox(bbox)))


def since(df: DataFrame, as_of: datetime, hours: float, time_col: str = "ingested_at") -> DataFrame:
    """Rows newer than ``hours`` before ``as_of`` (exclusive)."""
    return df.filter(F.col(time_col) > F.lit(as_of - timedelta(hours=hours)))


def between(
    df: DataFrame, start: datetime, end: datetime, time_col: str = "ingested_at"
) -> DataFrame:
    """Rows in [start, end]."""
    return df.filter(F.col(time_col).between(F.lit(start), F.lit(end)))


def one_sensor(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col("sensor_key") == key)


def alive(
    df: DataFrame, as_of: datetime, ttl_seconds: float, time_col: str = "ingested_at"
) -> DataFrame:
    """Rows last written less than ``ttl_seconds`` before ``as_of``."""
    return df.filter(F.col(time_col) > F.lit(as_of - timedelta(seconds=ttl_seconds)))


def retained(
    df: DataFrame, as_of: datetime, days: float = 10, time_col: str = "captured_ts"
) -> DataFrame:
    """Rows that the retention rule keeps."""
    return df.filter(F.col(time_col) >= F.lit(as_of - timedelta(days=days)))


def check_threshold(value: float) -> float:
    if not 0 <= value <= 10_000:
        raise ValueError("threshold must be between 0 and 10000")
    return float(value)


def check_speed(value: float) -> float:
    if not value >= 0:
        raise ValueError("speed must not be negative")
    return float(value)


def check_hours(value: int) -> int:
    if value not in S.BUCKET_WIDTHS:
        raise ValueError(f"hours must be one of {sorted(S.BUCKET_WIDTHS)}")
    return value


def check_limit(value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"limit must be between {low} and {high}")
    return value
