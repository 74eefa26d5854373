"""The whole dataflow in batch form: raw rows in, every product out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from isodose.functions.parse import parse_columns, parse_json
from isodose.operators import alerts, enrich, heat, latest, spikes, stats
from isodose.operators.nearest import PlaceIndex
from isodose.operators.ordered import slice_hot_keys
from isodose.operators.quality import clean_readings
from isodose.schemas import DEFAULTS, Settings
from isodose.session import scratch_path


def enriched_readings(
    raw: DataFrame,
    settings: Settings = DEFAULTS,
    keep: tuple[str, ...] = ("arrival_ts", "event_id"),
    json: str | None = None,
    changes: DataFrame | None = None,
) -> DataFrame:
    """Parse, clean and enrich raw rows (text columns, or JSON in column ``json``).

    ``changes(effective_at, threshold)`` puts the threshold of the arrival time in force
    instead of the one in ``settings``.
    """
    parsed = parse_json(raw, json, keep) if json else parse_columns(raw, keep)
    clean = clean_readings(parsed, settings.earliest_ms, settings.latest_ms)
    if changes is None:
        return enrich.enrich(clean, settings.threshold)
    timed = enrich.with_threshold(clean, changes, default=settings.threshold)
    return enrich.enrich(timed, timed["threshold"]).drop("threshold")


@dataclass(frozen=True)
class Products:
    """The seven outputs of the dataflow."""

    clean: DataFrame
    current: DataFrame
    alerts: DataFrame
    spikes: DataFrame
    stats: DataFrame
    heatmap: DataFrame
    top: DataFrame


def _once(enriched: DataFrame) -> DataFrame:
    spark = enriched.sparkSession
    path = scratch_path(spark, "enriched")
    enriched.write.parquet(path)
    return spark.read.schema(enriched.schema).parquet(path)


def products(
    enriched: DataFrame,
    settings: Settings = DEFAULTS,
    places: DataFrame | PlaceIndex | None = None,
    countries: DataFrame | None = None,
) -> Products:
    """All products of enriched readings.

    The readings are parsed, named and written once, below the shared folder; everything else
    reads that table.  Busy sensors are looked for once and shared.
    """
    if places is not None:
        places = places if isinstance(places, PlaceIndex) else PlaceIndex(places)
        enriched = enrich.with_place(enriched, places, countries)
    enriched = _once(enriched)
    sliced = slice_hot_keys(enriched, ["sensor_key"], latest.ARRIVAL)
    cells = heat.heat_cells(enriched, settings.window, settings.geohash_precision)
    if places is not None:
        cells = heat.with_cell_places(cells, places, countries)
    return Products(
        clean=enriched,
        current=latest.latest_emissions(sliced),
        alerts=alerts.dedup_alerts(sliced, settings.cooldown_ms),
        spikes=spikes.spikes(
            sliced, settings.jump_ratio, settings.average_ratio, settings.ema_alpha
        ),
        stats=stats.global_stats(enriched, settings.window),
        heatmap=cells,
        top=heat.top_hotspots(cells, settings.top_n),
    )
