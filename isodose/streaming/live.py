"""All live products of a stream, from one reading of its source.

Each micro-batch is enriched once and written to a table; the products are then made from that
table by the batch operators, so a busy sensor is sliced here as it is in batch.  What a sensor
leaves behind for the next batch is a small row in a state table.  Window products are kept as
partial results per batch and merged on reading: sums, maxima and distinct sensors merge
exactly, so a row counts in its window however late it arrives.  Every table has a folder per
batch, which a repeated batch replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from isodose.functions.geo import with_geohash
from isodose.functions.levels import level_rank
from isodose.functions.numeric import round_exact
from isodose.operators import alerts, enrich, heat, latest, spikes
from isodose.operators.nearest import PlaceIndex
from isodose.operators.stats import merge_stats, stats_partials, window_bounds
from isodose.schemas import DEFAULTS, Settings
from isodose.session import get_note, list_dir, put_note, remove
from isodose.sources import tables

KEYED = ("current", "alerts", "spikes")
WINDOWED = ("stats", "heatmap")
PRODUCTS = ("clean", *KEYED, *WINDOWED)


@dataclass
class LiveTables:
    """Writer (``foreachBatch``) and reader of the product tables below ``path``.

    ``threshold`` is asked at the start of every new batch, so a change takes effect without a
    restart, while a repeated batch keeps the one it had.  ``places`` and ``countries`` name each new sensor once.  A sensor silent for
    ``ttl_seconds`` of arrival time starts afresh.  ``readings_path`` and ``alerts_path`` are
    history tables to keep up to date.  With ``merge_every``, the partial results of closed batches are
    merged into one part each time so many batches are through, so reading does not depend on how
    many there were.  ``order`` must identify a row within its sensor; a
    message log adds its partition and offset.
    """

    path: str
    settings: Settings = DEFAULTS
    threshold: Callable[[], float] | None = None
    places: DataFrame | PlaceIndex | None = None
    countries: DataFrame | None = None
    order: Sequence[str] = latest.ARRIVAL
    only: Sequence[str] = PRODUCTS
    ttl_seconds: float | None = None
    readings_path: str | None = None
    alerts_path: str | None = None
    time_col: str = "arrival_ts"
    merge_every: int | None = None

    # ------------------------------------------------------------ writing

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Write all tables of one batch of clean rows."""
        rows = enrich.enrich(batch, self._limit(batch.sparkSession, batch_id))
        if self.places is not None:
            rows = self._named(self._store(rows, "unnamed", batch_id), batch_id)
        rows = self._store(rows, "clean", batch_id)
        if "current" in self.only:
            self._current(rows, batch_id)
        if "alerts" in self.only or self.alerts_path:
            self._alerts(rows, batch_id)
        if "spikes" in self.only:
            self._spikes(rows, batch_id)
        if "stats" in self.only:
            self._store(stats_partials(rows, self.settings.window, self.time_col), "stats", batch_id)
        if "heatmap" in self.only:
            self._store(self._cell_partials(rows), "heatmap", batch_id)
        if self.readings_path:
            tables.overwrite_batch(tables.as_readings(_with_names(rows)), self.readings_path, batch_id)
        self._forget(rows.sparkSession, batch_id)
        if self.merge_every and batch_id and batch_id % self.merge_every == 0:
            self.merge(rows.sparkSession, batch_id - 2)

    def _limit(self, spark: SparkSession, batch_id: int) -> float:
        """The threshold of a batch, asked once and noted: a repeated batch gets the same levels."""
        if self.threshold is None:
            return self.settings.threshold
        place = f"{self.path}/_thresholds/{batch_id}"
        noted = get_note(spark, place)
        if noted is None:
            noted = repr(float(self.threshold()))
            put_note(spark, place, noted)
        return float(noted)

    def _store(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        """Write a batch's part of a table; what follows reads it back."""
        path = f"{self.path}/{name}/batch_id={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Drop what no later or repeated batch reads: older state, rows before they had names."""
        for name in ("unnamed", "unknown"):
            remove(spark, f"{self.path}/{name}/batch_id={batch_id}")
        for name in ("places", *KEYED):
            remove(spark, f"{self.path}/state-{name}/batch_id={batch_id - 2}")
        remove(spark, f"{self.path}/_thresholds/{batch_id - 2}")

    def _state(self, rows: DataFrame, name: str, batch_id: int, ddl: str) -> DataFrame:
        """What sensors left behind up to the batch before; expired ones have left nothing."""
        spark = rows.sparkSession
        if batch_id == 0:
            return spark.createDataFrame([], ddl)
        old = spark.read.schema(ddl).parquet(f"{self.path}/state-{name}/batch_id={batch_id - 1}")
        if self.ttl_seconds is not None:
            now = rows.agg(F.max(self.time_col)).first()[0]
            if now is not None:
                old = old.where(F.unix_micros("seen") > F.unix_micros(F.lit(now)) - int(self.ttl_seconds * 1e6))
        return old

    def _keep(self, new: DataFrame, old: DataFrame, name: str, batch_id: int) -> None:
        """State after the batch: new rows replace old ones of the same sensor."""
        kept = old.join(new.select("sensor_key"), "sensor_key", "left_anti")
        self._store(kept.unionByName(new), f"state-{name}", batch_id)

    def _named(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Add city and country; sensors without a name yet are looked up once."""
        ddl = "sensor_key string, city string, country string"
        known = rows.sparkSession.createDataFrame([], ddl)
        if batch_id:
            known = rows.sparkSession.read.schema(ddl).parquet(f"{self.path}/state-places/batch_id={batch_id - 1}")
        new = (
            rows.join(known, "sensor_key", "left_anti")
            .groupBy("sensor_key")
            .agg(F.min_by("latitude", F.struct(*self.order)).alias("latitude"), F.min_by("longitude", F.struct(*self.order)).alias("longitude"))
        )
        new = self._store(new, "unknown", batch_id)
        if not new.isEmpty():
            found = enrich.with_place(new, self._index(), self.countries).select("sensor_key", "city", "country")
            known = known.unionByName(found)
        names = self._store(known, "state-places", batch_id)
        return rows.join(names, "sensor_key", "left")

    def _index(self) -> PlaceIndex:
        """The gazetteer's tree, built at the first search and shared by all batches and readers."""
        if not isinstance(self.places, PlaceIndex):
            self.places = PlaceIndex(self.places)
        return self.places

    def _after_state(self, rows: DataFrame, old: DataFrame, *columns: str) -> DataFrame:
        """Rows, led by each sensor's state as a row of its own that comes first."""
        first = old.select("sensor_key", *columns, F.lit(0).alias("_turn"))
        return rows.withColumn("_turn", F.lit(1)).unionByName(first, allowMissingColumns=True)

    def _current(self, rows: DataFrame, batch_id: int) -> None:
        old = self._state(rows, "current", batch_id, "sensor_key string, captured_at long, seen timestamp")
        both = self._after_state(rows, old, "captured_at")
        newer = latest.latest_emissions(both, ("_turn", *self.order)).where("_turn = 1").drop("_turn")
        self._store(newer, "current", batch_id)
        seen = rows.select("sensor_key", "captured_at", F.col(self.time_col).alias("seen")).unionByName(old)
        after = seen.groupBy("sensor_key").agg(F.max("captured_at").alias("captured_at"), F.max("seen").alias("seen"))
        self._store(after, "state-current", batch_id)

    def _alerts(self, rows: DataFrame, batch_id: int) -> None:
        ddl = "sensor_key string, captured_at long, level string, seen timestamp"
        old = self._state(rows, "alerts", batch_id, ddl)
        both = self._after_state(rows.where("level <> 'safe'"), old, "captured_at", "level")
        emitted = alerts.dedup_alerts(both, self.settings.cooldown_ms, ("_turn", *self.order)).where("_turn = 1")
        emitted = self._store(emitted.drop("_turn"), "alerts", batch_id)
        state = F.struct("captured_at", "level", F.col(self.time_col).alias("seen"))
        last = emitted.groupBy("sensor_key").agg(F.max_by(state, F.struct(*self.order)).alias("s")).select("sensor_key", "s.*")
        self._keep(last, old, "alerts", batch_id)
        if self.alerts_path:
            tables.overwrite_batch(tables.as_alerts(_with_names(emitted)), self.alerts_path, batch_id)

    def _spikes(self, rows: DataFrame, batch_id: int) -> None:
        ddl = "sensor_key string, previous_cpm double, average double, seen timestamp"
        old = self._state(rows, "spikes", batch_id, ddl)
        alpha = self.settings.ema_alpha
        averaged = spikes.with_moving_average(rows, alpha, self.order, seed=old).persist()
        try:
            found = spikes.label_spikes(averaged, self.settings.jump_ratio, self.settings.average_ratio)
            self._store(found, "spikes", batch_id)
            state = F.struct(
                F.col("cpm").alias("previous_cpm"), spikes.average_after(alpha).alias("average"), F.col(self.time_col).alias("seen")
            )
            last = averaged.groupBy("sensor_key").agg(F.max_by(state, F.struct(*self.order)).alias("s")).select("sensor_key", "s.*")
            self._keep(last, old, "spikes", batch_id)
        finally:
            averaged.unpersist()

    def _cell_partials(self, rows: DataFrame) -> DataFrame:
        located = with_geohash(rows.select(self.time_col, "latitude", "longitude", "cpm", "level"), self.settings.geohash_precision)
        return located.groupBy(F.window(self.time_col, self.settings.window), "geohash").agg(*_cell_sums())

    # ------------------------------------------------------------ merging

    def merge(self, spark: SparkSession, last: int) -> None:
        """Merge the partial results of all batches up to ``last`` into one part per product.

        ``last`` must lie behind every batch that may still be repeated: the one before the batch
        that is being written is safe.  Safe to be cut off anywhere and to be called again.
        """
        for product in WINDOWED:
            if product in self.only:
                for _ in self._merging(spark, product, last):
                    pass

    def _merging(self, spark: SparkSession, product: str, last: int) -> Iterator[None]:
        """The steps of a merge: a new part, the pointer that readers follow, then the old ones go."""
        before, parts = self._merged(spark, product), f"{self.path}/merged-{product}"
        if last > before:
            # The new part has a fresh name: one that was cut off earlier is never taken for it.
            name = f"part-{last}-{uuid.uuid4().hex[:8]}"
            self._fold(product, self._partials(spark, product, last)).write.parquet(f"{parts}/{name}")
            yield
            put_note(spark, f"{parts}/_pointers/{last:012d}", name)
            yield
        pointers = self._pointers(spark, product)
        for old in pointers[:-1]:
            remove(spark, f"{parts}/_pointers/{old}")
            yield
        if not pointers:
            return
        kept = get_note(spark, f"{parts}/_pointers/{pointers[-1]}")
        for part in list_dir(spark, parts):
            if part.startswith("part-") and part != kept:
                remove(spark, f"{parts}/{part}")
                yield
        for folder in list_dir(spark, f"{self.path}/{product}"):
            if folder.startswith("batch_id=") and int(folder.split("=")[1]) <= int(pointers[-1]):
                remove(spark, f"{self.path}/{product}/{folder}")
                yield

    def _pointers(self, spark: SparkSession, product: str) -> list[str]:
        return [n for n in list_dir(spark, f"{self.path}/merged-{product}/_pointers") if n.isdigit()]

    def _merged(self, spark: SparkSession, product: str) -> int:
        """The last batch that is in the merged part; -1 if there is none."""
        pointers = self._pointers(spark, product)
        return int(pointers[-1]) if pointers else -1

    def _fold(self, product: str, partials: DataFrame) -> DataFrame:
        """Partial results of the same kind, one row per key."""
        if product == "stats":
            sums = [F.sum("total").cast("decimal(38,6)").alias("total"), F.max("max_cpm").alias("max_cpm")]
            sums += [F.sum(n).alias(n) for n in ("alert_count", "reading_count")]
            return partials.groupBy("window_start", "window_end", "sensor_key").agg(*sums)
        maxima = [F.max(n).alias(n) for n in ("cell_lat", "cell_lon", "max_cpm", "_worst")]
        sums = [F.sum("total").cast("decimal(38,6)").alias("total"), F.sum("rows").alias("rows")]
        return partials.groupBy("window", "geohash").agg(*maxima, *sums)

    def _partials(self, spark: SparkSession, product: str, last: int | None = None) -> DataFrame:
        """Partial results of all batches (up to ``last``): the merged part and the batches behind it."""
        before, parts = self._merged(spark, product), f"{self.path}/merged-{product}"
        folders = [n for n in list_dir(spark, f"{self.path}/{product}") if n.startswith("batch_id=")]
        numbers = sorted(n for n in (int(f.split("=")[1]) for f in folders) if n > before and (last is None or n <= last))
        found = [f"{self.path}/{product}/batch_id={n}" for n in numbers]
        total = F.col("total").cast("decimal(38,6)")
        frames = [spark.read.parquet(*found).withColumn("total", total)] if found else []
        if before >= 0:
            frames.append(spark.read.parquet(f"{parts}/{get_note(spark, f'{parts}/_pointers/{before:012d}')}").withColumn("total", total))
        return reduce(DataFrame.unionByName, frames)

    # ------------------------------------------------------------ reading

    def read(self, spark: SparkSession, product: str) -> DataFrame:
        """A product as it stands: ``top`` is ranked from the cells, windows include open ones."""
        if product == "top":
            cells = merge_cell_partials(self._partials(spark, "heatmap"))
            return heat.top_hotspots(cells, self.settings.top_n, None if self.places is None else self._index(), self.countries)
        if product == "stats":
            return merge_stats(self._partials(spark, "stats"), self.settings.window)
        if product == "heatmap":
            cells = merge_cell_partials(self._partials(spark, "heatmap"))
            return cells if self.places is None else heat.with_cell_places(cells, self._index(), self.countries)
        return spark.read.parquet(f"{self.path}/{product}").drop("batch_id")


def _with_names(rows: DataFrame) -> DataFrame:
    missing = {name: F.lit("") for name in ("city", "country") if name not in rows.columns}
    return rows.withColumns(missing) if missing else rows


def _cell_sums() -> list[Column]:
    return [
        F.max("cell_lat").alias("cell_lat"),
        F.max("cell_lon").alias("cell_lon"),
        F.sum(F.col("cpm").cast("decimal(18,6)")).alias("total"),
        F.max("cpm").alias("max_cpm"),
        F.count(F.lit(1)).alias("rows"),
        F.max(level_rank(F.col("level"))).alias("_worst"),
    ]


def merge_cell_partials(partials: DataFrame) -> DataFrame:
    """Heat cells from partial results per (window, cell)."""
    merged = partials.groupBy("window", "geohash").agg(
        F.max("cell_lat").alias("cell_lat"),
        F.max("cell_lon").alias("cell_lon"),
        (F.sum("total").cast("double") / F.sum("rows")).alias("avg_cpm"),
        F.max("max_cpm").alias("max_cpm"),
        F.sum("rows").alias("count"),
        F.max("_worst").alias("_worst"),
    )
    return merged.select(*window_bounds(), *heat.cell_columns())


def start_live(clean: DataFrame, live: LiveTables, available_now: bool = False) -> StreamingQuery:
    """Keep the tables up to date from a stream of clean rows: one query, one reading of the source."""
    writer = clean.writeStream.foreachBatch(live.write).option("checkpointLocation", f"{live.path}/_checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def progress(query: StreamingQuery) -> list[dict]:
    """Rows and rows per second of the recent batches, and rows dropped behind a watermark."""
    out = []
    for report in query.recentProgress:
        dropped = sum(op["numRowsDroppedByWatermark"] for op in report["stateOperators"])
        out.append(
            {
                "batch_id": report["batchId"],
                "rows": report["numInputRows"],
                "rows_per_second": report["processedRowsPerSecond"],
                "dropped": dropped,
            }
        )
    return out
