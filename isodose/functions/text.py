"""Names and texts shown to people, and JSON output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from isodose import schemas as S
from isodose.functions.numeric import fixed_decimals


def _filled(text: Column) -> Column:
    """Null instead of empty text."""
    return F.when(text != "", text)


def place_name(city: Column, country: Column) -> Column:
    """"city, country", either one alone, or null."""
    return _filled(F.concat_ws(", ", _filled(city), _filled(country)))


def display_name(city: Column, country: Column, lat: Column, lon: Column) -> Column:
    """Place name, else the coordinates with four decimals."""
    point = F.concat_ws(", ", fixed_decimals(lat, 4), fixed_decimals(lon, 4))
    return F.coalesce(place_name(city, country), point)


def sensor_label(city: Column, country: Column, sensor_key: Column) -> Column:
    """Place name, else the sensor key."""
    return F.coalesce(place_name(city, country), sensor_key)


def alert_text(level: Column, name: Column) -> Column:
    label = F.lit("Radiation")
    for known, text in S.ALERT_LABELS.items():
        label = F.when(level == known, F.lit(text)).otherwise(label)
    return F.concat(label, F.lit(" detected in "), name)


def record_json(columns: Sequence[str]) -> Column:
    """One JSON object per row, nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
