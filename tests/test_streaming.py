"""Streams give what the batch operators give, over several micro-batches and a restart."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from isodose.operators import alerts, heat, latest, spikes, stats
from isodose.plans.live import enriched_readings
from isodose.schemas import Settings
from isodose.sources import csv, log, tables
from isodose.streaming import live, pipeline, windows

START = datetime(2024, 1, 1)
SETTINGS = Settings(threshold=50.0, cooldown_ms=20_000, geohash_precision=3, top_n=3)
ORDER = ("arrival_ts", "captured_at")
LINE = "arrival_ts timestamp, value string"


def messages(seed=1, size=600):
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        arrival = START + timedelta(seconds=i)
        captured = arrival - timedelta(seconds=rng.randrange(0, 60), milliseconds=i)
        place = rng.randrange(6)
        record = {
            "captured_time": captured.strftime("%Y-%m-%d %H:%M:%S.%f"), "uploaded_time": "",
            "latitude": str(10.0 * place - 20), "longitude": str(7.5 * place), "unit": rng.choice(["cpm"] * 9 + ["usv"]),
            "value": str(round(rng.uniform(1, 260), 2)),
        }
        rows.append((arrival, json.dumps(record)))
    return rows


def feed(spark, folder, rows, parts):
    """Write rows as JSON files that the file source picks up one per micro-batch."""
    for k in range(parts):
        chunk = rows[k * len(rows) // parts:(k + 1) * len(rows) // parts]
        df = spark.createDataFrame(chunk, LINE).coalesce(1)
        df.write.mode("append").json(folder)


def source(spark, folder):
    return spark.readStream.schema(LINE).option("maxFilesPerTrigger", 1).json(folder)


@pytest.fixture(scope="module")
def rows():
    # A message far in the future moves the watermark past every window of the others.
    last = (START + timedelta(hours=2), messages(size=1)[0][1])
    return [*messages(), last]


@pytest.fixture(scope="module")
def batch(spark, rows):
    df = spark.createDataFrame(rows, LINE)
    return enriched_readings(df, SETTINGS, ("arrival_ts",), json="value").persist()


EXPECTED = {
    "clean": lambda b: b,
    "current": lambda b: latest.latest_emissions(b, ORDER),
    "alerts": lambda b: alerts.dedup_alerts(b, SETTINGS.cooldown_ms, ORDER),
    "spikes": lambda b: spikes.spikes(b, order=ORDER),
    "stats": lambda b: stats.global_stats(b, SETTINGS.window),
    "heatmap": lambda b: heat.heat_cells(b, SETTINGS.window, SETTINGS.geohash_precision),
    "top": lambda b: heat.top_hotspots(heat.heat_cells(b, SETTINGS.window, SETTINGS.geohash_precision), SETTINGS.top_n),
}


def as_set(df):
    return {tuple(map(str, row)) for row in df.select(*sorted(df.columns)).collect()}


def run_live(spark, inbox, tables_):
    stream = pipeline.clean_stream(source(spark, inbox), SETTINGS)
    query = live.start_live(stream, tables_, available_now=True)
    query.awaitTermination()
    return query


@pytest.fixture(scope="module")
def live_tables(spark, rows, tmp_path_factory):
    """All products after four micro-batches in two runs; the second goes on from the first."""
    base = tmp_path_factory.mktemp("live")
    out = live.LiveTables(str(base / "out"), SETTINGS, order=ORDER)
    half = len(rows) // 2
    for part in (rows[:half], rows[half:]):
        feed(spark, str(base / "in"), part, 2)
        run_live(spark, str(base / "in"), out)
    return out


@pytest.mark.parametrize("product", EXPECTED)
def test_live_equals_batch(spark, live_tables, batch, product):
    got, want = live_tables.read(spark, product), EXPECTED[product](batch)
    assert want.count() > 0
    assert as_set(got) == as_set(want)


def test_repeated_batch_changes_nothing(spark, tmp_path, batch):
    clean = batch.drop("level", "sensor_key")
    limits = iter([50.0, 50.0, 10.0])
    out = live.LiveTables(str(tmp_path / "out"), SETTINGS, threshold=lambda: next(limits), order=ORDER)
    cut = F.lit(START + timedelta(seconds=300))
    out.write(clean.where(F.col("arrival_ts") < cut), 0)
    out.write(clean.where(F.col("arrival_ts") >= cut), 1)
    before = {p: as_set(out.read(spark, p)) for p in ("alerts", "spikes", "stats")}
    assert before["alerts"] == as_set(EXPECTED["alerts"](batch))
    # The same batch again, though the threshold has changed since: it keeps the one it had.
    out.write(clean.where(F.col("arrival_ts") >= cut), 1)
    assert {p: as_set(out.read(spark, p)) for p in before} == before
    assert out.read(spark, "clean").count() == clean.count()
    assert next(limits) == 10.0  # not asked a third time


def _tables_of(spark, path, batch, cuts, **options):
    """The window products after the batch was written in so many pieces."""
    out = live.LiveTables(str(path), SETTINGS, order=ORDER, only=("stats", "heatmap"), **options)
    clean = batch.drop("level", "sensor_key")
    step = 600 // cuts
    for k in range(cuts):
        low, high = (F.lit(START + timedelta(seconds=s)) for s in (k * step, (k + 1) * step if k < cuts - 1 else 10**6))
        out.write(clean.where((F.col("arrival_ts") >= low) & (F.col("arrival_ts") < high)), k)
    return out


def test_merged_parts_read_the_same(spark, tmp_path, batch):
    out = _tables_of(spark, tmp_path, batch, 6, merge_every=2)
    for product in ("stats", "heatmap", "top"):
        assert as_set(out.read(spark, product)) == as_set(EXPECTED[product](batch)), product
    # Batches 0 to 2 are in one part; the others are still apart.
    assert sorted(p.name for p in (tmp_path / "stats").iterdir()) == ["batch_id=3", "batch_id=4", "batch_id=5"]
    assert len([p for p in (tmp_path / "merged-stats").iterdir() if p.name.startswith("part")]) == 1
    out.merge(spark, 5)
    out.merge(spark, 5)
    assert not list((tmp_path / "stats").iterdir())
    assert as_set(out.read(spark, "stats")) == as_set(EXPECTED["stats"](batch))


@pytest.mark.parametrize("done", range(8))
def test_merge_cut_off_anywhere(spark, tmp_path, batch, done):
    """After any number of steps of a second merge the readers see every row once."""
    out = _tables_of(spark, tmp_path, batch, 4)
    out.merge(spark, 0)
    steps = out._merging(spark, "stats", 2)
    made = sum(1 for _ in zip(range(done), steps, strict=False))
    assert made == min(done, 6)  # part, pointer, old pointer, old part, two batches
    want = as_set(EXPECTED["stats"](batch))
    assert as_set(out.read(spark, "stats")) == want
    out.merge(spark, 2)
    assert as_set(out.read(spark, "stats")) == want
    assert [p.name for p in (tmp_path / "stats").iterdir()] == ["batch_id=3"]
    assert len([p for p in (tmp_path / "merged-stats").iterdir() if p.name.startswith("part")]) == 1


READY = "arrival_ts timestamp, captured_at long, latitude double, longitude double, cpm double, unit string"


def clean_rows(spark, *rows):
    """(arrival second, capture second, value) of one sensor."""
    data = [(START + timedelta(seconds=a), c * 1000, 10.0, 20.0, v, "cpm") for a, c, v in rows]
    return spark.createDataFrame(data, READY)


def test_rows_that_arrive_late_are_counted(spark, tmp_path):
    out = live.LiveTables(str(tmp_path / "out"), SETTINGS, order=ORDER, only=("stats", "heatmap"))
    out.write(clean_rows(spark, (600, 0, 5.0), (601, 1, 5.0)), 0)
    out.write(clean_rows(spark, (10, 2, 5.0), (11, 3, 7.0), (602, 4, 5.0)), 1)
    out.write(clean_rows(spark, (5000, 5, 5.0)), 2)
    counted = {r.window_start: r.reading_count for r in out.read(spark, "stats").collect()}
    assert counted == {START: 2, START + timedelta(seconds=600): 3, START + timedelta(seconds=4980): 1}
    assert sum(r["count"] for r in out.read(spark, "heatmap").collect()) == 6


def test_expired_sensor_starts_afresh(spark, tmp_path):
    for ttl, fresh in ((3600, True), (None, False)):
        out = live.LiveTables(str(tmp_path / f"out-{ttl}"), SETTINGS, order=ORDER, ttl_seconds=ttl)
        out.write(clean_rows(spark, (0, 100, 60.0), (1, 101, 20.0)), 0)
        # Captured before the first rows and at their level: only a fresh sensor reports it.
        out.write(clean_rows(spark, (4000, 99, 60.0)), 1)
        late = F.col("captured_at") == 99_000
        assert (out.read(spark, "current").where(late).count() == 1) is fresh
        assert (out.read(spark, "alerts").where(late).count() == 1) is fresh
        assert (out.read(spark, "spikes").where(late).count() == 0) is fresh  # 60 after 20 jumps


def test_history_tables(spark, tmp_path):
    readings, notes = str(tmp_path / "readings"), str(tmp_path / "alerts")
    out = live.LiveTables(str(tmp_path / "out"), SETTINGS, order=ORDER, only=(), readings_path=readings, alerts_path=notes)
    out.write(clean_rows(spark, *((i, i, 190.0) for i in range(15))), 0)
    out.write(clean_rows(spark, *((i + 20, i + 15, 190.0) for i in range(20)), (30 * 86_400, 40, 1.0)), 1)
    out.write(clean_rows(spark, *((i + 20, i + 15, 190.0) for i in range(20)), (30 * 86_400, 40, 1.0)), 1)
    stored = tables.read_readings(spark, readings)
    assert stored.count() == 36
    told = tables.read_alerts(spark, notes)
    assert told.count() == 2  # one at once, one after the cool-down of 20 s
    assert {r.alert_text for r in told.collect()} == {"Dangerous radiation detected in 10.0000, 20.0000"}
    tables.append(stored.drop(tables.PARTITION), readings)
    assert tables.read_readings(spark, readings).count() == 72
    tables.compact(spark, readings, "2024-01-01")
    assert tables.read_readings(spark, readings).count() == 72
    dropped = tables.drop_expired(spark, readings, START + timedelta(days=20), days=10)
    assert dropped == ["ingested_date=2024-01-01"]
    assert tables.read_readings(spark, readings).count() == 2


@pytest.mark.parametrize("done", range(7))
def test_compaction_cut_off_anywhere(spark, tmp_path, done):
    """After any number of steps a reader sees every row once, and the rest can be made up for."""
    path = str(tmp_path / "readings")
    out = live.LiveTables(str(tmp_path / "out"), SETTINGS, order=ORDER, only=(), readings_path=path)
    out.write(clean_rows(spark, *((i, i, 190.0) for i in range(5))), 0)
    out.write(clean_rows(spark, *((i + 20, i + 15, 190.0) for i in range(7)), (86_400, 40, 1.0)), 1)
    want = as_set(tables.read_readings(spark, path))
    assert len(want) == 13
    steps = tables._compaction(spark, path, "2024-01-01")
    made = sum(1 for _ in zip(range(done), steps, strict=False))
    assert made == min(done, 6)  # part, note, two old folders, rename, note
    assert as_set(tables.read_readings(spark, path)) == want
    out.write(clean_rows(spark, (40, 60, 190.0)), 2)  # a later batch still reaches the date
    assert tables.read_readings(spark, path).count() == 14
    tables.recover(spark, path)
    assert tables.read_readings(spark, path).count() == 14 and not tables._noted(spark, path)
    tables.compact(spark, path, "2024-01-01")
    assert tables.read_readings(spark, path).count() == 14
    assert [p.name for p in (tmp_path / "readings" / "ingested_date=2024-01-01").iterdir() if p.is_dir() and p.name.startswith("batch")] in (
        ["batch_id=-2"], ["batch_id=-3"],
    )
    tables.compact(spark, path, "1999-01-01")  # nothing there
    assert as_set(tables.read_readings(spark, path)) > want


def test_names_are_looked_up_once_per_sensor(spark, tmp_path):
    places = spark.createDataFrame([(1, "Here", "X", 10.0, 20.0), (2, "There", "Y", -10.0, 20.0)], "place_id long, city string, cc string, lat double, lon double")
    out = live.LiveTables(str(tmp_path / "out"), SETTINGS, places=places, order=ORDER)
    for batch_id in (0, 1):
        out.write(clean_rows(spark, (batch_id, batch_id, 60.0 + batch_id)), batch_id)
    assert {(r.city, r.country) for r in out.read(spark, "clean").collect()} == {("Here", "X")}
    assert {(r.city, r.country) for r in out.read(spark, "heatmap").collect()} == {("Here", "X")}
    assert out.read(spark, "top").first().hotspots[0].city == "Here"
    assert spark.read.parquet(str(tmp_path / "out" / "state-places" / "batch_id=1")).count() == 1


def test_progress(spark, tmp_path):
    inbox = str(tmp_path / "in")
    feed(spark, inbox, messages(size=60), 2)
    out = live.LiveTables(str(tmp_path / "out"), SETTINGS, order=ORDER, only=("clean",))
    query = run_live(spark, inbox, out)
    assert [r["rows"] for r in live.progress(query) if r["rows"]] == [30, 30]
    assert all(r["dropped"] == 0 for r in live.progress(query))


@pytest.mark.parametrize("product", ["stats", "heatmap", "top"])
def test_window_queries(spark, tmp_path, rows, batch, product):
    """With a watermark the windows that are closed come out the same."""
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    half = len(rows) // 2
    got = None
    for part in (rows[:half], rows[half:]):
        feed(spark, inbox, part, 2)
        stream = pipeline.enriched_stream(source(spark, inbox), SETTINGS)
        got = pipeline.settle(pipeline.window_streams(stream, SETTINGS)[product], out)
    want = EXPECTED[product](batch).filter(F.col("window_end") < F.lit(START + timedelta(hours=1)))
    assert want.count() > 0
    assert as_set(got) == as_set(want)


def test_capture_time_windows_drop_late_rows(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    captured = "captured_ts timestamp, cpm double, level string, sensor_key string"

    def write(*seconds):
        data = [(START + timedelta(seconds=s), 5.0, "safe", "K") for s in seconds]
        spark.createDataFrame(data, captured).coalesce(1).write.mode("append").json(inbox)

    def run():
        stream = spark.readStream.schema(captured).option("maxFilesPerTrigger", 1).json(inbox)
        timed = windows.on_clock(stream, "captured_ts", "120 seconds")
        return pipeline.settle(windows.global_stats(timed, "30 seconds", "captured_ts"), out)

    write(0, 1)
    run()
    write(1000)
    run()
    write(2, 1001)
    write(5000)
    rows = {r.window_start: r.reading_count for r in run().collect()}
    assert rows[START] == 2
    assert rows[START + timedelta(seconds=990)] == 2


def test_csv_stream(spark, tmp_path):
    inbox = str(tmp_path / "csv")
    rows = spark.createDataFrame([("2024-01-01 00:00:00", "1.0", "2.0", "9", "cpm")],
                                 "captured_time string, latitude string, longitude string, value string, unit string")
    csv.write_csv(rows, inbox)
    got = pipeline.settle(csv.stream_csv(spark, inbox, max_files=1), str(tmp_path / "out"))
    assert got.first().value == "9" and os.path.isdir(tmp_path / "out" / "data")


def test_log_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        log.stream_log(spark, "localhost:9092", ["a", "b"], max_offsets=10)
