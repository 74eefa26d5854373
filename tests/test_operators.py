"""Operators on hand-made rows: places, regions, windows, history, sources."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from isodose.operators import enrich, filters, heat, history, latest, nearest, replay, stats
from isodose.plans import feed, live
from isodose.schemas import Settings
from isodose.sources import csv, log, tables

START = datetime(2024, 1, 1)


def great_circle(a, b):
    (p, q), (r, s) = (tuple(map(math.radians, x)) for x in (a, b))
    h = math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((s - q) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(h)))


def gazetteer(kind, rng):
    if kind == "even":
        return [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(2000)]
    if kind == "one city":
        return [(35 + rng.gauss(0, 0.01), 139 + rng.gauss(0, 0.01)) for _ in range(3000)]
    if kind == "date line":
        return [(rng.uniform(-5, 5), rng.choice([-1, 1]) * (180 - rng.random())) for _ in range(300)]
    return [(89.9, 0.0), (-89.9, 10.0), (0.0, 0.0)]


@pytest.mark.parametrize("kind", ["even", "one city", "date line", "three"])
def test_nearest_place(spark, kind):
    rng = random.Random(kind)
    spots = gazetteer(kind, rng)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(120)]
    points += [(90.0, 5.0), (-90.0, 5.0), (0.0, 180.0), (0.0, -180.0), (35.001, 139.001)]
    places = [(i, f"city {i}", "XX", lat, lon) for i, (lat, lon) in enumerate(spots)]
    # Copies of the first place with larger ids must not win.
    places += [(10_000 + i, "copy", "XX", *spots[0]) for i in range(100)]
    found = nearest.nearest_place(
        spark.createDataFrame(points, "lat double, lon double"),
        spark.createDataFrame(places, "place_id long, city string, cc string, lat double, lon double"),
        "lat", "lon",
    ).collect()
    assert len(found) == len(points)
    for row in found:
        best = min(great_circle((row.lat, row.lon), spot) for spot in spots)
        mine = great_circle((row.lat, row.lon), spots[row.place_id])
        assert mine == pytest.approx(best, abs=1e-6)
        assert row.distance_km == pytest.approx(best, abs=1e-5)


def test_no_places(spark):
    points = spark.createDataFrame([(1.0, 2.0)], "latitude double, longitude double")
    none = spark.createDataFrame([], "place_id long, city string, cc string, lat double, lon double")
    row = enrich.with_place(points, none).first()
    assert (row.city, row.country) == ("", "")


def test_regions_overlap_edges_and_none(spark):
    points = [(37.0, 140.0), (38.5, 141.5), (0.0, 0.0), (-43.7, 113.3)]
    df = spark.createDataFrame(points, "latitude double, longitude double")
    tags = {}
    for row in enrich.with_regions(df).collect():
        tags.setdefault((row.latitude, row.longitude), set()).add(row.label)
    assert tags[points[0]] == {"Fukushima Region", "East Asia", "Japan"}
    assert "Fukushima Region" in tags[points[1]]
    assert points[2] not in tags
    assert tags[points[3]] == {"Australia"}
    world = enrich.with_regions(df, enrich.named_regions(df, world=True))
    assert world.filter("label like 'World%'").count() == 4
    assert enrich.in_region(df, "World (no filter)").count() == 4
    with pytest.raises(ValueError):
        enrich.in_region(df, "Atlantis")


def cells(spark, rows):
    ddl = (
        "window_start timestamp, window_end timestamp, geohash string, cell_lat double, cell_lon double, "
        "avg_cpm double, max_cpm double, count long, level string"
    )
    end = timedelta(seconds=30)
    return spark.createDataFrame([(w, w + end, g, 1.0, 2.0, m, m, 1, level) for w, g, m, level in rows], ddl)


def test_top_hotspots_ties_and_safe_windows(spark):
    later = START + timedelta(minutes=1)
    rows = [(START, f"g{i:02}", float(i // 2), "high") for i in range(30)] + [(later, "s1", 5.0, "safe")]
    rows += [(START, "zz", 999.0, "safe")]
    top = {r.window_start: r for r in heat.top_hotspots(cells(spark, rows), 10).collect()}
    assert top[later]["count"] == 0 and top[later].hotspots == []
    best = top[START].hotspots
    assert [h.rank for h in best] == list(range(1, 11))
    assert [h.geohash for h in best[:4]] == ["g28", "g29", "g26", "g27"]
    current = history.last_top(heat.top_hotspots(cells(spark, rows), 10)).first()
    assert current["count"] == 0
    empty = history.last_top(heat.top_hotspots(cells(spark, []), 10)).first()
    assert (empty["count"], empty.hotspots) == (0, [])


READING = "event_id long, sensor_key string, arrival_ts timestamp, captured_at long, cpm double, level string"


def test_latest_ties_and_stats(spark):
    rows = [
        (0, "A", START, 100, 1.0, "safe"),
        (1, "A", START + timedelta(seconds=1), 100, 2.0, "high"),
        (2, "A", START + timedelta(seconds=31), 50, 3.0, "safe"),
        (3, "B", START + timedelta(seconds=2), 7, 4.005, "warning"),
    ]
    df = spark.createDataFrame(rows, READING)
    assert {r.event_id for r in latest.latest_per_sensor(df).collect()} == {0, 3}
    first, second = stats.global_stats(df).orderBy("window_start").collect()
    assert (first.avg_cpm, first.max_cpm, first.active_sensors, first.alert_count, first.reading_count) == (
        2.33, 4.0, 2, 2, 3,
    )
    assert second.reading_count == 1
    merged = stats.merge_stats(stats.stats_partials(df, "30 seconds"), "1 minute").first()
    assert (merged.avg_cpm, merged.active_sensors, merged.reading_count) == (2.5, 2, 4)


def test_active_and_evicted_cells(spark):
    board = cells(spark, [(START, "a", 1.0, "safe"), (START, "b", 1.0, "safe"), (START, "c", 1.0, "safe")])
    sensors = spark.createDataFrame([("a", False), ("b", False), ("b", True)], "geohash string, kept boolean")
    stay = spark.createDataFrame([("b",)], "geohash string")
    none = spark.createDataFrame([], "geohash string")
    assert {r.geohash for r in heat.active_cells(board, stay).collect()} == {"b"}
    assert heat.active_cells(board, none).count() == 3
    assert {r.geohash for r in heat.evicted_cells(board, sensors).collect()} == {"b", "c"}


def test_sparkline_and_progress(spark):
    series = spark.createDataFrame([(i, float(v)) for i, v in enumerate([3, 3, 3])], "bucket int, avg_cpm double")
    flat = stats.sparkline(series).orderBy("bucket").collect()
    assert [(r.x, r.y) for r in flat] == [(0.0, 40.0), (134.0, 40.0), (268.0, 40.0)]
    assert stats.sparkline(series.limit(1)).count() == 0
    still = spark.createDataFrame([(START,)], "ingested_at timestamp")
    assert stats.time_bounds(still).first().progress == 0


def test_argument_checks(spark):
    df = spark.createDataFrame([(START, 1.0)], "ingested_at timestamp, cpm double")
    for call in (
        lambda: filters.check_threshold(10_001), lambda: filters.check_threshold(-1),
        lambda: filters.check_speed(-0.1), lambda: filters.check_hours(2),
        lambda: filters.at_least(df, -1), lambda: history.recent_alerts(df, 501),
        lambda: history.points(df, limit=1001), lambda: stats.timeseries(df, START, 3),
        lambda: replay.frame_number("ingested_at", START, speed=2),
        lambda: feed.envelope(df, "nowhere"),
    ):
        with pytest.raises(ValueError):
            call()
    assert filters.check_threshold(0) == 0 and filters.check_speed(0) == 0
    assert stats.bucket_width(48) == "1 hour" and stats.bucket_width(6) == "30 minutes"


def test_limits_and_lookback_edges(spark):
    rows = [(i, START + timedelta(minutes=i)) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, arrival_ts timestamp")
    assert history.recent_alerts(df, 500).count() == 200
    assert [r.event_id for r in history.console_feed(df, "spikes").collect()] == list(range(299, 289, -1))
    end = START + timedelta(minutes=120)
    assert filters.since(df, end, 1, "arrival_ts").agg(F.min("event_id")).first()[0] == 61
    assert filters.between(df, START, end, "arrival_ts").count() == 121
    assert filters.alive(df, end, 60, "arrival_ts").agg(F.min("event_id")).first()[0] == 120
    assert filters.retained(df, START + timedelta(days=10), 10, "arrival_ts").count() == 300


def test_csv_quirks(spark, tmp_path):
    header = ",".join(csv.S.RAW_HEADERS.values())
    text = (
        f"{header}\n"
        '2024-01-01 00:00:00,u,1.0,2.0,30,cpm,"Iwaki, ""Joban""",dev,m,h,s,r,l\n'
        "\n"
        "2024-01-01 00:00:01,u,1.0,2.0,31,cpm\n"
    ).encode() + b"2024-01-01 00:00:02,u,1.0,2.0,32,cpm,caf\xff,d,m,h,s,r,l\n"
    path = tmp_path / "in.csv"
    path.write_bytes(text)
    rows = sorted(csv.read_csv(spark, str(path)).collect())
    assert len(rows) == 3
    assert rows[0].location_name == 'Iwaki, "Joban"'
    assert (rows[1].device_id, rows[1].loader_id) == ("", "")
    assert rows[2].location_name.startswith("caf") and len(rows[2].location_name) == 4
    assert csv.read_csv(spark, str(path), max_rows=2).count() == 2


def test_partition_keys(spark):
    rows = [
        (" 12 ", "1", "2", "m"), ("", "35.12345", "139.00005", "m"), ("", "35", "-0.00001", "m"),
        ("", "", "2", " m "), ("", "x", "2", ""),
    ]
    df = spark.createDataFrame(rows, "device_id string, latitude string, longitude string, md5 string")
    keys = [r.key for r in csv.with_partition_key(df).collect()]
    assert keys == ["dev:12", f"geo:{round(35.12345, 4)},{round(139.00005, 4)}", "geo:35.0,-0.0", "m", None]


def test_history_tables(spark, tmp_path):
    rows = [
        (i, "A" if i % 2 else "B", "", "", 1.0, 2.0, 5.0, "high", START + timedelta(days=i), 1_704_067_200_000)
        for i in range(20)
    ]
    ddl = (
        "event_id long, sensor_key string, city string, country string, latitude double, longitude double, "
        "cpm double, level string, arrival_ts timestamp, captured_at long"
    )
    df = spark.createDataFrame(rows, ddl)
    path = str(tmp_path / "readings")
    tables.append(tables.as_readings(df), path)
    tables.append(tables.as_readings(df), path)
    stored = tables.read_readings(spark, path)
    assert stored.count() == 40
    as_of = START + timedelta(days=20)
    recent = tables.prune_since(stored, as_of, 48)
    assert "PartitionFilters: [isnotnull(ingested_date" in recent._jdf.queryExecution().executedPlan().toString()
    assert len(tables.drop_expired(spark, path, as_of, 10)) == 10
    assert tables.read_readings(spark, path).count() == 20
    alerts = tables.as_alerts(df).first()
    assert alerts.alert_text == "Dangerous radiation detected in 1.0000, 2.0000"


def test_feed_and_snapshot(spark):
    current = spark.createDataFrame([(f"K{i}", 1.0) for i in range(25)], "sensor_key string, cpm double")
    board = cells(spark, [(START, "a", 1.0, "high")])
    shown = board.drop("window_start", "window_end")
    figures = spark.createDataFrame([(START, START, 1.5)], "window_start timestamp, window_end timestamp, avg_cpm double")
    first = feed.snapshot(current, shown, figures, heat.top_hotspots(board), part_size=10).collect()
    assert {r.channel for r in first} == {"map", "heatmap", "stats", "top"}
    assert sum(r.data.count('"sensor_key"') for r in first if r.channel == "map") == 25
    messages = feed.feed(current=current, heatmap=shown).collect()
    assert [r.data for r in messages if r.channel == "heatmap"][0].startswith('{"cells":[{"geohash":"a"')
    records = log.as_messages(current, log.TOPICS["current"], key="sensor_key").first()
    assert (records.topic, records.key) == ("radiation-current", "K0")


def test_routing_by_topic(spark):
    rows = [("a", '{"x": 1}', START), ("b", '{"y": "t"}', START), ("a", "junk", START)]
    df = spark.createDataFrame(rows, "topic string, value string, arrival_ts timestamp")
    parts = log.route(df, {"a": "x long", "b": "y string"})
    assert sorted(r.x or 0 for r in parts["a"].collect()) == [0, 1]
    assert parts["b"].first().y == "t"


def test_all_products_with_places(spark):
    rows = [
        (i, START + timedelta(seconds=i), f"2024-01-01 00:00:{i:02}", "2024-01-01 00:00:00", "35.0", "139.0", str(40 + 60 * (i % 4)), "cpm")
        for i in range(40)
    ]
    ddl = (
        "event_id long, arrival_ts timestamp, captured_time string, uploaded_time string, latitude string, "
        "longitude string, value string, unit string"
    )
    places = spark.createDataFrame([(1, "Tokyo", "JP", 35.7, 139.7)], "place_id long, city string, cc string, lat double, lon double")
    names = spark.createDataFrame([("JP", "Japan")], "cc string, name string")
    changes = spark.createDataFrame([(START + timedelta(seconds=20), 50.0)], "effective_at timestamp, threshold double")
    readings = live.enriched_readings(spark.createDataFrame(rows, ddl), Settings(), changes=changes)
    out = live.products(readings, Settings(), places, names)
    # All seven read the one table that was written.
    folders = {name.rpartition("/")[0] for df in vars(out).values() for name in df.inputFiles()}
    assert len(folders) == 1 and "enriched" in folders.pop()
    assert out.clean.filter("city = 'Tokyo' and country = 'Japan'").count() == 40
    assert out.current.count() == 40
    assert out.stats.count() == 2 and out.heatmap.count() == 2
    assert out.top.agg(F.sum("count")).first()[0] == 2
    assert out.alerts.filter("cpm = 100 and event_id < 20 and level = 'warning'").count() > 0
    assert out.alerts.filter("cpm = 100 and event_id >= 20 and level = 'elevated'").count() > 0
    assert out.spikes.filter("jump_ratio = 2.5").count() == 10


def test_one_index_for_many_searches(spark, tmp_path, monkeypatch):
    rng = random.Random(12)
    spots = [(i, f"c{i}", "X", *spot) for i, spot in enumerate(gazetteer("one city", rng) + gazetteer("even", rng))]
    places = spark.createDataFrame(spots, "place_id long, city string, cc string, lat double, lon double")
    index = nearest.PlaceIndex(places, str(tmp_path / "index"))
    points = spark.createDataFrame([(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)], "lat double, lon double")
    want = {tuple(r) for r in nearest.nearest_place(points, places, "lat", "lon").collect()}
    monkeypatch.setattr(nearest, "_depth_for", None)  # nothing is built again
    for _ in range(2):
        assert {tuple(r) for r in nearest.nearest_place(points, index, "lat", "lon").collect()} == want
    assert sorted(p.name for p in (tmp_path / "index").iterdir()) == ["levels", "spots"]


def test_only_winners_are_named(spark):
    moment = datetime(2024, 1, 1)
    rows = [(moment, moment + timedelta(1), f"g{i}", float(i), float(i), 60.0 + i, 60.0 + i, 1, "warning") for i in range(30)]
    cells = spark.createDataFrame(
        rows, "window_start timestamp, window_end timestamp, geohash string, cell_lat double, cell_lon double, avg_cpm double, max_cpm double, count long, level string"
    )
    places = spark.createDataFrame([(1, "South", "S", 0.0, 0.0), (2, "North", "N", 29.0, 29.0)], "place_id long, city string, cc string, lat double, lon double")
    late = heat.top_hotspots(cells, 20, places).first()
    early = heat.top_hotspots(heat.with_cell_places(cells, places), 20).first()
    assert late == early and {h.city for h in late.hotspots} == {"North", "South"}


@pytest.mark.parametrize("max_rows", [None, 10])
def test_any_frame_of_a_film_is_the_frame(spark, tmp_path, max_rows):
    rng = random.Random(21)
    begin = datetime(2024, 1, 1)
    rows = [(i, "hot" if rng.random() < 0.4 else f"s{rng.randrange(12)}", begin + timedelta(seconds=rng.randrange(-50, 900)), float(i)) for i in range(300)]
    rows += [(900, "s1", None, 1.0), (901, "late", begin + timedelta(seconds=899), 2.0)]
    readings = spark.createDataFrame(rows, "event_id long, sensor_key string, ingested_at timestamp, cpm double")
    film = replay.replay_film(readings, begin, 1000, 10, key_every=7, ties=["event_id"], max_rows=max_rows)
    replay.write_film(film, str(tmp_path / "film"))
    stored = spark.read.parquet(str(tmp_path / "film"))
    numbers = [*range(0, 96)]
    got = replay.film_frames(stored, numbers, key_every=7)
    by_frame = {n: set() for n in numbers}
    for row in got.collect():
        by_frame[row["number"]].add((row["sensor_key"], row["event_id"], row["cpm"]))
    for n in (0, 1, 6, 7, 8, 13, 14, 50, 69, 70, 89, 90, 95):
        at = begin + timedelta(seconds=10 * n)
        want = {(r["sensor_key"], r["event_id"], r["cpm"]) for r in replay.replay_frame(readings, at, ties=["event_id"]).collect()}
        # Beyond the last segment there is nothing: it ends with the last change.
        assert by_frame[n] == (want if n // 7 <= 90 // 7 else set()), n
    changes = stored.where("not is_key")
    assert changes.count() == readings.where("ingested_at is not null").selectExpr(
        "sensor_key", "greatest(0, ceil((unix_millis(ingested_at) - unix_millis(timestamp '2024-01-01')) / 10000)) f"
    ).distinct().count()
    # One key row per sensor and segment at most.
    assert stored.where("is_key").groupBy("segment", "sensor_key").count().where("count > 1").count() == 0


def test_film_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "event_id long, sensor_key string, ingested_at timestamp, cpm double")
    film = replay.replay_film(none, datetime(2024, 1, 1), ties=["event_id"])
    assert film.collect() == [] and replay.film_frames(film, [0, 5], 300).collect() == []
