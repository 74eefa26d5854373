"""Record shapes, fixed values and tunables shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: the thirteen raw fields and the CSV headers they come from ---
RAW_HEADERS = {
    "captured_time": "Captured Time",
    "uploaded_time": "Uploaded Time",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "value": "Value",
    "unit": "Unit",
    "location_name": "Location Name",
    "device_id": "Device ID",
    "md5": "MD5Sum",
    "height": "Height",
    "surface": "Surface",
    "radiation": "Radiation",
    "loader_id": "Loader ID",
}
RAW_FIELDS = list(RAW_HEADERS)
#: The raw fields that the typed record is built from.
USED_FIELDS = ["captured_time", "uploaded_time", "latitude", "longitude", "value", "unit"]

# --- fixed values: severity levels by rank, alert labels, map intensities ---
LEVELS = ["safe", "warning", "elevated", "high"]
ALERT_LABELS = {
    "safe": "safe radiation",
    "warning": "Elevated radiation",
    "elevated": "High radiation",
    "high": "Dangerous radiation",
}
HEAT_INTENSITY = {"safe": 0.15, "warning": 0.4, "elevated": 0.7, "high": 1.0}
FIXED_CUTS = (50.0, 100.0, 300.0)

# --- fixed values: plausible capture times, 2011-01-01 and 2027-01-01 UTC ---
EARLIEST_MS = 1_293_840_000_000
LATEST_MS = 1_798_761_600_000

# --- fixed values: message channels and time-series bucket width per lookback ---
CHANNELS = ["map", "current", "alerts", "stats", "heatmap", "spikes", "top", "config"]
BUCKET_WIDTHS = {1: "5 minutes", 6: "30 minutes", 12: "1 hour", 24: "2 hours"}
REPLAY_SPEEDS = (1, 10, 60, 300)

# --- fixed values: named map regions as (label, south, west, north, east) ---
REGIONS = [
    ("Fukushima Region", 36.5, 139.0, 38.5, 141.5),
    ("East Asia", 24.0, 118.0, 46.0, 146.0),
    ("Europe", 35.0, -11.0, 71.0, 40.0),
    ("North America", 24.0, -125.0, 50.0, -66.0),
    ("Australia", -43.7, 113.3, -10.7, 153.6),
    ("Austria", 46.4, 9.5, 49.0, 17.2),
    ("Belgium", 49.5, 2.5, 51.5, 6.4),
    ("Brazil", -33.8, -73.9, 5.3, -34.8),
    ("Canada", 41.7, -141.0, 83.1, -52.6),
    ("China", 18.2, 73.5, 53.6, 134.8),
    ("Czech Republic", 48.6, 12.1, 51.1, 18.9),
    ("Denmark", 54.6, 8.1, 57.8, 15.2),
    ("Finland", 59.8, 20.0, 70.1, 31.6),
    ("France", 41.3, -5.1, 51.1, 9.6),
    ("Germany", 47.3, 5.9, 55.1, 15.0),
    ("Japan", 24.4, 122.9, 45.5, 145.8),
    ("South Korea", 33.1, 124.6, 38.6, 129.6),
    ("Netherlands", 50.8, 3.4, 53.5, 7.2),
    ("New Zealand", -46.6, 166.4, -34.4, 178.6),
    ("Norway", 57.9, 4.6, 71.2, 31.1),
    ("Poland", 49.0, 14.1, 54.9, 24.2),
    ("Russia", 41.2, 19.6, 81.9, 180.0),
    ("Sweden", 55.3, 11.1, 69.1, 24.2),
    ("Switzerland", 45.8, 6.0, 47.8, 10.5),
    ("Ukraine", 44.4, 22.1, 52.4, 40.2),
    ("United Kingdom", 49.9, -8.2, 60.9, 1.8),
    ("United States", 24.4, -125.0, 49.4, -66.9),
]
WORLD = "World (no filter)"


def _fields(spec: str) -> T.StructType:
    """``"name type, name type"`` as a StructType, without needing a session."""
    kinds = {
        "string": T.StringType(),
        "double": T.DoubleType(),
        "long": T.LongType(),
        "int": T.IntegerType(),
        "timestamp": T.TimestampType(),
    }
    pairs = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

READINGS = _fields(
    "captured_at timestamp, ingested_at timestamp, sensor_key string, city string, "
    "country string, latitude double, longitude double, cpm double, level string"
)
ALERTS = T.StructType(READINGS.fields + [T.StructField("alert_text", T.StringType())])
REGION = _fields("label string, s double, w double, n double, e double")


@dataclass(frozen=True)
class Settings:
    """Every tunable of the dataflow, with the defaults users start from."""

    threshold: float = 100.0
    cooldown_ms: int = 600_000
    jump_ratio: float = 2.5
    average_ratio: float = 2.5
    ema_alpha: float = 0.2
    geohash_precision: int = 5
    top_n: int = 10
    window: str = "30 seconds"
    sensor_ttl_seconds: int = 3600
    cell_ttl_seconds: int = 300
    feed_size: int = 200
    retention: str = "10 days"
    lateness: str = "120 seconds"
    earliest_ms: int = EARLIEST_MS
    latest_ms: int = LATEST_MS


DEFAULTS = Settings()
