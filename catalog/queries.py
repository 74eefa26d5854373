"""Every operator as a query over the driver's tables.

Timestamps leave as epoch microseconds, so that no client time zone can change a value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import fixtures as X
from isodose.functions import geo, levels, parse, text
from isodose.functions.numeric import round_exact
from isodose.operators import (
    alerts,
    enrich,
    filters,
    heat,
    history,
    latest,
    nearest,
    quality,
    replay,
    spikes,
    stats,
)
from isodose.plans import feed
from isodose.session import scratch_path
from isodose.sources import csv, filelog, log, tables
from isodose.streaming import keyed, late, live, pipeline, progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SETTINGS = X.SETTINGS
KEY = ["event_id", "sensor_key", "captured_at"]


def query(fn: Query) -> Query:
    """Register a query under its own name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = fn(spark, sf_dir)
        moments = {
            field.name: F.unix_micros(F.col(field.name))
            for field in df.schema.fields
            if isinstance(field.dataType, T.TimestampType)
        }
        return df.withColumns(moments) if moments else df

    QUERIES[fn.__name__] = run
    return run


# ---------------------------------------------------------------- sources and sinks


@query
def csv_scan(spark, sf_dir):
    rows = X.raw(spark, sf_dir)
    path = scratch_path(spark, "csv")
    csv.write_csv(rows, path)
    # The second folder has its columns in the opposite order.
    other = scratch_path(spark, "csv")
    csv.write_csv(csv.read_csv(spark, path).where("md5 >= '8'"), other, csv.S.RAW_FIELDS[::-1])
    return csv.read_csv(spark, [path, other])


@query
def newest_first_capped(spark, sf_dir):
    rows = X.raw(spark, sf_dir).withColumn("uploaded_ts", parse.utc_time(F.col("uploaded_time")))
    return replay.newest_first(rows, ties=["event_id"]).limit(1000).select("event_id", "uploaded_ts")


@query
def raw_messages(spark, sf_dir):
    return X.messages(X.raw(spark, sf_dir)).select("event_id", "value")


@query
def csv_messages(spark, sf_dir):
    rows = X.raw(spark, sf_dir)
    absent = {n: F.lit("") for n in csv.S.RAW_FIELDS if n not in rows.columns}
    lines = rows.withColumns(absent).select("event_id", csv.raw_csv_line().alias("value"))
    return csv.from_csv_line(lines, keep=("event_id",)).select(
        "event_id", "captured_time", "latitude", "longitude", "value", "unit", "device_id", "md5"
    )


@query
def partition_keys(spark, sf_dir):
    return csv.with_partition_key(X.raw(spark, sf_dir)).select("event_id", "key")


@query
def readings_table(spark, sf_dir):
    path = scratch_path(spark, "readings")
    tables.append(tables.as_readings(X.named(spark, sf_dir)), path)
    stored = tables.read_readings(spark, path)
    recent = filters.since(tables.prune_since(stored, X.AS_OF, 240), X.AS_OF, 240)
    return recent.drop(tables.PARTITION)


@query
def alerts_table(spark, sf_dir):
    path = scratch_path(spark, "alerts")
    tables.append(tables.as_alerts(alerts.dedup_alerts(X.named(spark, sf_dir), SETTINGS.cooldown_ms)), path)
    return tables.read_alerts(spark, path).drop(tables.PARTITION)


@query
def compacted_readings(spark, sf_dir):
    """A history table with most dates compacted and one compaction cut off behind its note."""
    path = scratch_path(spark, "readings")
    rows = tables.as_readings(X.named(spark, sf_dir))
    for batch_id, first in enumerate(("2024-01-01", "2024-01-10", "2024-01-20")):
        last = ("2024-01-10", "2024-01-20", "2030-01-01")[batch_id]
        part = rows.where((F.col("ingested_at") >= first) & (F.col("ingested_at") < last))
        tables.overwrite_batch(part, path, batch_id)
    for day in ("2024-01-02", "2024-01-15"):
        tables.compact(spark, path, day)
    for _ in zip(range(3), tables._compaction(spark, path, "2024-01-21"), strict=False):
        pass
    return tables.read_readings(spark, path).drop(tables.PARTITION)


@query
def retained(spark, sf_dir):
    rows = X.enriched(spark, sf_dir).withColumn("captured_ts", parse.from_epoch_ms(F.col("captured_at")))
    return filters.retained(rows, X.AS_OF, days=10).select(*KEY)


@query
def feed_union(spark, sf_dir):
    rows = X.enriched(spark, sf_dir)
    columns = ["sensor_key", "captured_at", "level"]
    return feed.feed(
        current=latest.latest_per_sensor(rows).select(*columns),
        alerts=alerts.dedup_alerts(rows, SETTINGS.cooldown_ms).select(*columns),
        spikes=spikes.point_spikes(rows).select(*columns),
    )


@query
def snapshot_messages(spark, sf_dir):
    """All that a new client is sent first: points, cells, current statistics and the ranked list."""
    rows = X.enriched(spark, sf_dir)
    index, countries = nearest.PlaceIndex(X.places(spark, sf_dir)), X.countries(spark, sf_dir)
    alive = filters.alive(latest.latest_per_sensor(rows), X.AS_OF, 12 * SETTINGS.sensor_ttl_seconds, "arrival_ts")
    points = enrich.with_place(
        alive.select("sensor_key", "captured_at", "uploaded_at", "latitude", "longitude", "cpm", "level"), index, countries
    )
    cells = heat.heat_cells(rows, SETTINGS.window, SETTINGS.geohash_precision)
    shown = heat.with_cell_places(heat.current_cells(cells, X.AS_OF, SETTINGS.cell_ttl_seconds), index, countries)
    return feed.snapshot(
        points, shown.drop("window_start", "window_end"), stats.global_stats(rows, SETTINGS.window),
        heat.top_hotspots(cells, SETTINGS.top_n, index, countries), part_size=5,
    )


@query
def current_cells(spark, sf_dir):
    cells = heat.heat_cells(X.enriched(spark, sf_dir), SETTINGS.window, SETTINGS.geohash_precision)
    return heat.current_cells(cells, X.AS_OF, SETTINGS.cell_ttl_seconds)


@query
def valid_cells(spark, sf_dir):
    cells = heat.heat_cells(X.enriched(spark, sf_dir), SETTINGS.window, SETTINGS.geohash_precision)
    odd = cells.withColumns(
        {
            "level": F.expr("case when count % 3 = 2 then 'odd' else level end"),
            "cell_lat": F.expr("case when geohash < '9' then null else cell_lat end"),
        }
    )
    return quality.split_valid(odd, quality.valid_cell())[0].select("window_start", "geohash", "count", "level")


@query
def ingest_rate(spark, sf_dir):
    return stats.ingest_rate(X.raw(spark, sf_dir), "1 hour")


@query
def replay_schedule(spark, sf_dir):
    rows = X.raw(spark, sf_dir).select(
        "event_id", F.expr("case when event_id % 11 = 0 then null else uploaded_time end").alias("uploaded_time")
    )
    paced = replay.replay_schedule(rows, ["event_id"], speed=0.01, max_sleep=3.0)
    return paced.select(
        "event_id",
        round_exact(F.col("delay_seconds"), 4).alias("delay_seconds"),
        round_exact(F.col("offset_seconds"), 3).alias("offset_seconds"),
    )


# ---------------------------------------------------------------- parse, filter, enrich


@query
def parse_readings(spark, sf_dir):
    parsed = parse.parse_json(X.messages(X.raw(spark, sf_dir)), keep=("event_id",))
    return parsed.withColumn("captured_ts", parse.from_epoch_ms(F.col("captured_at")))


@query
def clean_readings(spark, sf_dir):
    parsed = parse.parse_columns(X.raw(spark, sf_dir), ("event_id",))
    return quality.clean_readings(parsed).drop("unit")


@query
def rejects_by_reason(spark, sf_dir):
    return quality.count_rejects(parse.parse_columns(X.raw(spark, sf_dir)))


@query
def rejected_readings(spark, sf_dir):
    parsed = parse.parse_columns(X.raw(spark, sf_dir), ("event_id",))
    return quality.split_rejects(parsed)[1].select("event_id", "reject_reason")


@query
def raw_clean_dropped(spark, sf_dir):
    return quality.raw_clean_dropped(parse.parse_columns(X.raw(spark, sf_dir)))


@query
def valid_readings(spark, sf_dir):
    rows = X.enriched(spark, sf_dir)
    odd = rows.withColumn("level", F.expr("case when event_id % 13 = 0 then 'odd' else level end"))
    return quality.split_valid(odd, quality.valid_enriched())[0].select(*KEY)


@query
def sensor_keys(spark, sf_dir):
    points = quality.clean_readings(parse.parse_columns(X.raw(spark, sf_dir)))
    key = geo.sensor_key(F.col("latitude"), F.col("longitude")).alias("sensor_key")
    return points.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("rows")).select("*", key)


@query
def geohash_cells(spark, sf_dir):
    rows = X.enriched(spark, sf_dir).select("event_id", "latitude", "longitude")
    return geo.with_geohash(rows, 5)


@query
def classify_levels(spark, sf_dir):
    return X.enriched(spark, sf_dir).select("event_id", "cpm", "level")


@query
def level_bands(spark, sf_dir):
    return X.enriched(spark, sf_dir).select("event_id", levels.level_band(F.col("cpm")).alias("level"))


@query
def levels_runtime_threshold(spark, sf_dir):
    parsed = parse.parse_columns(X.raw(spark, sf_dir), ("arrival_ts", "event_id"))
    timed = enrich.with_threshold(quality.clean_readings(parsed), X.threshold_changes(spark))
    return timed.select("event_id", "threshold", levels.level_of(F.col("cpm"), F.col("threshold")).alias("level"))


@query
def nearest_place(spark, sf_dir):
    points = quality.clean_readings(parse.parse_columns(X.raw(spark, sf_dir))).select("latitude", "longitude")
    found = enrich.nearest_place(points.distinct(), X.places(spark, sf_dir), "latitude", "longitude")
    return found.withColumn("distance_km", round_exact(F.col("distance_km"), 3))


@query
def reading_places(spark, sf_dir):
    rows = X.enriched(spark, sf_dir).select("event_id", "latitude", "longitude")
    return enrich.with_place(rows, X.places(spark, sf_dir), X.countries(spark, sf_dir))


@query
def cell_places(spark, sf_dir):
    cells = heat.heat_cells(X.enriched(spark, sf_dir), SETTINGS.window, 3)
    return heat.with_cell_places(
        cells.select("window_start", "geohash", "cell_lat", "cell_lon"),
        X.places(spark, sf_dir), X.countries(spark, sf_dir),
    )


@query
def country_names(spark, sf_dir):
    return enrich.with_country_name(X.places(spark, sf_dir).select("place_id", "cc"), X.countries(spark, sf_dir))


@query
def display_names(spark, sf_dir):
    city, country = F.col("city"), F.col("country")
    return X.named(spark, sf_dir).select(
        "event_id",
        text.display_name(city, country, F.col("latitude"), F.col("longitude")).alias("display_name"),
        text.sensor_label(city, country, F.col("sensor_key")).alias("label"),
    )


@query
def alert_texts(spark, sf_dir):
    name = text.display_name(F.col("city"), F.col("country"), F.col("latitude"), F.col("longitude"))
    return X.named(spark, sf_dir).select(
        "event_id", text.alert_text(F.col("level"), name).alias("alert_text")
    )


@query
def heat_intensity(spark, sf_dir):
    return X.enriched(spark, sf_dir).select(
        "event_id",
        levels.heat_intensity(F.col("level")).alias("intensity"),
        levels.marker_radius(F.col("cpm")).alias("radius"),
    )


@query
def region_tags(spark, sf_dir):
    return enrich.with_regions(X.enriched(spark, sf_dir).select("event_id", "latitude", "longitude"))


@query
def points_in_region(spark, sf_dir):
    return enrich.in_region(X.enriched(spark, sf_dir), "North America").select("event_id")


@query
def points_filtered(spark, sf_dir):
    current = latest.latest_per_sensor(X.enriched(spark, sf_dir))
    found = history.points(current, min_cpm=10, bbox="-100,-60,120,70", limit=500)
    return found.select("sensor_key", "latitude", "longitude", "cpm", "level")


@query
def unsafe_readings(spark, sf_dir):
    return filters.not_safe(X.enriched(spark, sf_dir)).select(*KEY, "level")


# ---------------------------------------------------------------- aggregates


@query
def global_stats(spark, sf_dir):
    return stats.global_stats(X.enriched(spark, sf_dir), "1 hour")


@query
def merged_stats(spark, sf_dir):
    partials = stats.stats_partials(X.enriched(spark, sf_dir), "1 hour")
    return stats.merge_stats(partials, "1 day")


@query
def merged_stats_sketched(spark, sf_dir):
    """Days from hourly sketches; the estimate is held against five standard errors of the exact count."""
    rows = X.enriched(spark, sf_dir)
    merged = stats.merge_sketched(stats.sketch_partials(rows, "1 hour"), "1 day")
    exact = stats.merge_stats(stats.stats_partials(rows, "1 hour"), "1 day").select("window_start", F.col("active_sensors").alias("sensors"))
    apart = F.abs(F.col("active_sensors") - F.col("sensors")) <= F.greatest(F.lit(1.0), 5 * 0.016 * F.col("sensors"))
    return merged.join(exact, "window_start").withColumn("close", apart).drop("active_sensors")


@query
def heatmap(spark, sf_dir):
    return heat.heat_cells(X.enriched(spark, sf_dir), SETTINGS.window, SETTINGS.geohash_precision)


@query
def top_hotspots(spark, sf_dir):
    cells = heat.heat_cells(X.enriched(spark, sf_dir), SETTINGS.window, SETTINGS.geohash_precision)
    return heat.flat_hotspots(heat.top_hotspots(cells, SETTINGS.top_n, X.places(spark, sf_dir), X.countries(spark, sf_dir)))


@query
def timeseries(spark, sf_dir):
    return stats.timeseries(X.readings(spark, sf_dir), X.AS_OF, 24)


@query
def current_stats(spark, sf_dir):
    return history.last_window(stats.global_stats(X.enriched(spark, sf_dir), "1 hour"))


@query
def current_top(spark, sf_dir):
    cells = heat.heat_cells(X.enriched(spark, sf_dir), SETTINGS.window, SETTINGS.geohash_precision)
    top = history.last_top(heat.top_hotspots(cells, SETTINGS.top_n))
    listed = top.select(F.col("count").alias("hotspots_in_window"), F.inline("hotspots"))
    return listed.select("hotspots_in_window", "rank", "geohash", "max_cpm", "level")


@query
def live_sensors(spark, sf_dir):
    return stats.count_sensors(filters.alive(X.readings(spark, sf_dir), X.AS_OF, 3600))


@query
def distinct_sensors(spark, sf_dir):
    return stats.distinct_sensors(X.enriched(spark, sf_dir))


@query
def extent(spark, sf_dir):
    return stats.extent(X.readings(spark, sf_dir))


@query
def replay_progress(spark, sf_dir):
    return stats.time_bounds(X.readings(spark, sf_dir), F.lit(datetime(2024, 1, 11)))


@query
def sparkline(spark, sf_dir):
    series = stats.bucketed(X.readings(spark, sf_dir), "2 hours")
    return stats.sparkline(series)


# ---------------------------------------------------------------- per sensor, in order


@query
def latest_emissions(spark, sf_dir):
    # Readings replayed newest first within a day: most of them are older than the last one.
    rows = X.enriched(spark, sf_dir).withColumn("turn", F.col("event_id") % 10)
    return latest.latest_emissions(rows, ["turn", "event_id"]).select(*KEY)


@query
def latest_per_sensor(spark, sf_dir):
    return latest.latest_per_sensor(X.enriched(spark, sf_dir)).select(*KEY, "cpm", "level")


@query
def alerts_dedup(spark, sf_dir):
    return alerts.dedup_alerts(X.enriched(spark, sf_dir), SETTINGS.cooldown_ms).select(*KEY, "level")


@query
def point_spikes(spark, sf_dir):
    return spikes.point_spikes(X.enriched(spark, sf_dir)).select(*KEY, "cpm", "previous_cpm")


@query
def sensor_ema(spark, sf_dir):
    rows = spikes.sensor_ema(X.enriched(spark, sf_dir))
    return rows.select("event_id", "sensor_key", round_exact(F.col("ema"), 6).alias("ema"))


@query
def rolling_spikes(spark, sf_dir):
    rows = spikes.rolling_spikes(X.enriched(spark, sf_dir))
    return rows.select(*KEY, "cpm", round_exact(F.col("average_before"), 2).alias("rolling_avg_cpm"))


@query
def spike_events(spark, sf_dir):
    rows = spikes.spikes(X.enriched(spark, sf_dir))
    return rows.select(*KEY, "cpm", "spike_type", "previous_cpm", "rolling_avg_cpm", "jump_ratio")


# ---------------------------------------------------------------- history and replay


@query
def recent_alerts(spark, sf_dir):
    rows = alerts.dedup_alerts(X.enriched(spark, sf_dir), SETTINGS.cooldown_ms)
    return history.recent_alerts(rows, 20, ties=("event_id",)).select(*KEY, "level")


@query
def recent_spikes(spark, sf_dir):
    rows = spikes.spikes(X.enriched(spark, sf_dir))
    return history.recent_spikes(rows, 50, ties=("event_id",)).select(*KEY, "spike_type")


@query
def console_ticks(spark, sf_dir):
    return history.console_feed(X.enriched(spark, sf_dir), "ticks", ties=("event_id",)).select(*KEY, "cpm", "level")


@query
def points_history(spark, sf_dir):
    start, end = datetime(2024, 1, 5), datetime(2024, 1, 20)
    rows = history.points_history(X.readings(spark, sf_dir), start, end, 2000, ties=("event_id",))
    return rows.select(*KEY, "ingested_at", "cpm", "level")


@query
def sensor_history(spark, sf_dir):
    # The sensor is the one with the smallest key, found by a one-row aggregate.
    rows = X.readings(spark, sf_dir)
    key = rows.agg(F.min("sensor_key")).first()[0] or ""
    return history.sensor_history(rows, key, datetime(2024, 1, 20), 48).select(*KEY, "ingested_at", "cpm", "level")


@query
def alert_history(spark, sf_dir):
    rows = alerts.dedup_alerts(X.enriched(spark, sf_dir), SETTINGS.cooldown_ms)
    recent = history.alert_history(rows, X.AS_OF, 24, time_col="arrival_ts")
    return recent.select(*KEY, "arrival_ts", "level")


@query
def all_sensors(spark, sf_dir):
    return latest.all_sensors(X.readings(spark, sf_dir), ties=["event_id"]).select(*KEY, "ingested_at", "cpm")


@query
def active_cells(spark, sf_dir):
    rows = X.enriched(spark, sf_dir)
    cells = heat.heat_cells(rows, SETTINGS.window, SETTINGS.geohash_precision)
    live = filters.alive(rows, X.AS_OF, 6 * 3600, time_col="arrival_ts")
    marked = geo.with_geohash(live, SETTINGS.geohash_precision)
    return heat.active_cells(cells, marked).select("window_start", "geohash", "count")


@query
def evicted_cells(spark, sf_dir):
    rows = X.enriched(spark, sf_dir)
    kept = replay.sensor_cap(rows, 60).select("sensor_key", F.lit(True).alias("stays"))
    spots = rows.select("sensor_key", "latitude", "longitude").distinct()
    located = geo.with_geohash(spots, SETTINGS.geohash_precision).select("sensor_key", "geohash").distinct()
    sensors = located.join(kept, "sensor_key", "left").select("geohash", F.coalesce("stays", F.lit(False)).alias("kept"))
    cells = heat.heat_cells(rows, SETTINGS.window, SETTINGS.geohash_precision)
    return heat.evicted_cells(cells, sensors).select("window_start", "geohash", "count")


@query
def replay_frame(spark, sf_dir):
    at = datetime(2024, 1, 15)
    return replay.replay_frame(X.readings(spark, sf_dir), at, ties=["event_id"]).select(*KEY, "cpm", "level")


@query
def replay_frames(spark, sf_dir):
    return replay.replay_frames(X.readings(spark, sf_dir), datetime(2024, 1, 1), frame_ms=60_000, speed=300)


def _film(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-hour frames, a key frame every 24, stored and read back."""
    path = scratch_path(spark, "film")
    film = replay.replay_film(X.readings(spark, sf_dir), datetime(2024, 1, 1), 60_000, 300, key_every=24, ties=["event_id"])
    replay.write_film(film, path)
    return spark.read.schema(film.schema).parquet(path)


@query
def replay_film(spark, sf_dir):
    return _film(spark, sf_dir).select("segment", "frame", "is_key", *KEY)


@query
def replay_film_frames(spark, sf_dir):
    """Every seventh frame, rebuilt from the stored film."""
    return replay.film_frames(_film(spark, sf_dir), range(0, 145, 7), key_every=24).select("number", *KEY, "cpm", "level")


@query
def replay_order(spark, sf_dir):
    rows = X.readings(spark, sf_dir).withColumn(
        "latitude", F.expr("case when event_id % 17 = 0 then null else latitude end")
    )
    return replay.replayable(rows).select("event_id", "ingested_at")


@query
def sensor_cap(spark, sf_dir):
    return replay.sensor_cap(X.enriched(spark, sf_dir), 100)


# ---------------------------------------------------------------- streams


def _live(spark: SparkSession, sf_dir: str, *products: str, **options) -> live.LiveTables:
    """The live tables after all micro-batches of the events."""
    path = scratch_path(spark, "live")
    messages = X.event_stream(spark, sf_dir, f"{path}/messages")
    clean = pipeline.clean_stream(messages, SETTINGS, ("arrival_ts", "event_id"))
    options.setdefault("places", X.places(spark, sf_dir))
    options.setdefault("countries", X.countries(spark, sf_dir))
    out = live.LiveTables(f"{path}/tables", SETTINGS, only=products, **options)
    live.start_live(clean, out, available_now=True).awaitTermination()
    return out


@query
def stream_clean(spark, sf_dir):
    return _live(spark, sf_dir, "clean").read(spark, "clean").select(*KEY, "cpm", "level", "city", "country")


@query
def stream_levels_runtime_threshold(spark, sf_dir):
    out = _live(spark, sf_dir, "clean", threshold=X.stream_threshold(), places=None)
    return out.read(spark, "clean").select("event_id", "level")


@query
def stream_latest(spark, sf_dir):
    out = _live(spark, sf_dir, "current", places=None)
    return out.read(spark, "current").select(*KEY, "cpm", "level")


@query
def stream_alerts(spark, sf_dir):
    return _live(spark, sf_dir, "alerts").read(spark, "alerts").select(*KEY, "level", "city", "country")


@query
def stream_spikes(spark, sf_dir):
    return _live(spark, sf_dir, "spikes", places=None).read(spark, "spikes").select(
        *KEY, "cpm", "spike_type", "previous_cpm", "rolling_avg_cpm", "jump_ratio"
    )


@query
def stream_global_stats(spark, sf_dir):
    return _live(spark, sf_dir, "stats", places=None).read(spark, "stats")


@query
def stream_merged_windows(spark, sf_dir):
    """The statistics of :func:`stream_global_stats`, with closed batches merged on the way."""
    return _live(spark, sf_dir, "stats", places=None, merge_every=1).read(spark, "stats")


@query
def stream_heatmap(spark, sf_dir):
    return _live(spark, sf_dir, "heatmap").read(spark, "heatmap")


@query
def stream_top_hotspots(spark, sf_dir):
    return heat.flat_hotspots(_live(spark, sf_dir, "heatmap").read(spark, "top"))


@query
def stream_readings_table(spark, sf_dir):
    path = scratch_path(spark, "stream-readings")
    _live(spark, sf_dir, readings_path=path)
    return tables.read_readings(spark, path).drop(tables.PARTITION)


@query
def stream_alerts_table(spark, sf_dir):
    path = scratch_path(spark, "stream-alerts")
    _live(spark, sf_dir, alerts_path=path)
    return tables.read_alerts(spark, path).drop(tables.PARTITION)


@query
def retention_drop(spark, sf_dir):
    path = scratch_path(spark, "stream-readings")
    _live(spark, sf_dir, readings_path=path, places=None)
    tables.drop_expired(spark, path, X.AS_OF, days=10)
    return tables.read_readings(spark, path).select("sensor_key", "captured_at", "ingested_at", "cpm")


# ---------------------------------------------------------------- keyed state, message log

TTL_SECONDS = 86_400.0


def _keyed(spark: SparkSession, sf_dir: str) -> str:
    """Where the marked readings are after all micro-batches; sensors silent for a day start afresh."""
    path = scratch_path(spark, "keyed")
    messages = X.event_stream(spark, sf_dir, f"{path}/messages")
    rows = pipeline.enriched_stream(messages, SETTINGS, ("arrival_ts", "event_id"))
    marked = keyed.keyed_products(rows, SETTINGS, TTL_SECONDS)
    keyed.start_keyed(marked, f"{path}/out", available_now=True).awaitTermination()
    return f"{path}/out"


@query
def stream_keyed_products(spark, sf_dir):
    path = _keyed(spark, sf_dir)
    parts = [
        keyed.read_keyed(spark, path, name, SETTINGS).select(F.lit(name).alias("product"), *KEY, "level")
        for name in ("current", "alerts")
    ]
    return parts[0].unionByName(parts[1])


@query
def stream_keyed_spikes(spark, sf_dir):
    return keyed.read_keyed(spark, _keyed(spark, sf_dir), "spikes", SETTINGS).select(
        *KEY, "cpm", "spike_type", "previous_cpm", "rolling_avg_cpm", "jump_ratio"
    )


def _drain(query) -> None:
    """Run a stream until it has read all there is."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


@query
def log_records(spark, sf_dir):
    path = scratch_path(spark, "log")
    X.event_log(spark, sf_dir, path)
    return filelog.read_log(spark, path, [log.TOPICS["raw"]]).select("topic", "key", "arrival_ts", F.md5("value").alias("value_md5"))


@query
def log_fan_out(spark, sf_dir):
    """Raw topic to a topic per product and back, a quarter of the records at a time."""
    path = scratch_path(spark, "log")
    limit = X.event_log(spark, sf_dir, path) // 4 + 1
    for name in ("clean", "alerts"):
        checkpoint = f"{path}/_checkpoints/{name}"
        feed_ = filelog.stream_log(spark, path, [log.TOPICS["raw"]], checkpoint, max_offsets=limit)
        numbered = feed_.withColumn("event_id", F.get_json_object("value", "$.event_id").cast("long"))
        rows = pipeline.enriched_stream(numbered, SETTINGS, ("arrival_ts", "event_id"))
        if name == "alerts":
            rows = keyed.keyed_products(rows, SETTINGS).where("is_alert")
        messages = log.as_messages(rows.select(*KEY, "level"), log.TOPICS[name], key="sensor_key")
        _drain(filelog.write_log(messages, path, checkpoint, name).start())
    topics = [log.TOPICS["clean"], log.TOPICS["alerts"]]
    record = "event_id long, sensor_key string, captured_at long, level string"
    typed = log.route(filelog.read_log(spark, path, topics), dict.fromkeys(topics, record))
    return typed[topics[0]].select(F.lit("clean").alias("product"), *KEY, "level").unionByName(
        typed[topics[1]].select(F.lit("alerts").alias("product"), *KEY, "level")
    )


@query
def log_paced(spark, sf_dir):
    """A replay whose clock and rate change between runs: what has been read after ten and after 25 days."""
    path = scratch_path(spark, "log")
    limit = X.event_log(spark, sf_dir, path) // 5 + 1
    checkpoint, control = f"{path}/_checkpoints/paced", f"{path}/_control/rate.json"
    first, begun = datetime(2024, 1, 1), datetime(2030, 1, 1)
    stages = []
    for turn, (hours, speed, most) in enumerate(((1, 240.0, limit), (2, 300.0, None))):
        now = filelog.due_until(first, begun, begun + timedelta(hours=hours), speed)
        filelog.set_rate(control, most, now.replace(tzinfo=UTC))
        rows = filelog.stream_log(spark, path, [log.TOPICS["raw"]], checkpoint, control)
        out = rows.select("key", "arrival_ts").writeStream.format("parquet").option("checkpointLocation", checkpoint)
        _drain(out.start(f"{path}/_out"))
        read = spark.read.schema("key string, arrival_ts timestamp").parquet(f"{path}/_out")
        # Written, as the next turn adds files to the folder.
        place = f"{path}/_turns/{turn}"
        read.groupBy("key").agg(F.count(F.lit(1)).alias("records"), F.max("arrival_ts").alias("latest")).write.parquet(place)
        stages.append(spark.read.parquet(place).withColumn("turn", F.lit(turn)))
    return stages[0].unionByName(stages[1])


# ---------------------------------------------------------------- late rows, sources of different pace


def _ledger(spark: SparkSession, sf_dir: str) -> late.WindowLedger:
    path = scratch_path(spark, "ledger")
    messages = X.uneven_stream(spark, sf_dir, f"{path}/messages")
    rows = pipeline.enriched_stream(messages, SETTINGS, ("arrival_ts", "event_id", "source"))
    ledger = late.WindowLedger(f"{path}/out", SETTINGS, lateness_seconds=86_400.0, idle_seconds=5 * 86_400.0)
    late.start_windows(rows, ledger, available_now=True).awaitTermination()
    return ledger


@query
def late_rows(spark, sf_dir):
    return _ledger(spark, sf_dir).read_late(spark).select("event_id", "batch_id", "source", round_exact(F.col("late_seconds"), 3).alias("late_seconds"))


@query
def late_windows(spark, sf_dir):
    return _ledger(spark, sf_dir).read(spark)


@query
def stream_progress(spark, sf_dir):
    """Rows of each trigger as the progress table has them."""
    path = scratch_path(spark, "progress")
    messages = X.event_stream(spark, sf_dir, f"{path}/messages")
    listener = progress.ProgressLog(spark, f"{path}/progress", every=2)
    spark.streams.addListener(listener)
    try:
        out = pipeline.start_parquet(pipeline.enriched_stream(messages, SETTINGS), f"{path}/out", available_now=True)
        out.awaitTermination()
        listener.wait_ended(str(out.runId))
    finally:
        spark.streams.removeListener(listener)
    told = progress.read_progress(spark, f"{path}/progress").where((F.col("run_id") == str(out.runId)) & (F.col("rows") > 0))
    return told.select("batch_id", "rows", "late_rows")
