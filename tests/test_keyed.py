"""Keyed state with a time to live: the same rows however a stream is cut, and small state."""

import json
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_streaming import LINE, ORDER, SETTINGS, START, as_set, feed, source

from isodose.operators import alerts, latest, spikes
from isodose.plans.live import enriched_readings
from isodose.streaming import keyed, pipeline

TTL = 40


def messages(size=400):
    """Six sensors with pauses of their own, one reading a second."""
    rng = np.random.default_rng(8)
    rows, second = [], 0
    for i in range(size):
        second += int(rng.choice([1, 1, 1, 2, 30]))
        place = int(rng.integers(6))
        record = {
            "captured_time": (START + timedelta(seconds=second - int(rng.integers(0, 50)), milliseconds=i)).strftime("%Y-%m-%d %H:%M:%S.%f"),
            "uploaded_time": "", "latitude": str(10.0 * place - 20), "longitude": str(7.5 * place), "unit": "cpm",
            "value": str(round(float(rng.uniform(1, 260)), 2)),
        }
        rows.append((START + timedelta(seconds=second), json.dumps(record)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return messages()


@pytest.fixture(scope="module")
def expected(spark, rows):
    """The batch operators, with every stretch between silences as a sensor of its own."""
    df = enriched_readings(spark.createDataFrame(rows, LINE), SETTINGS, ("arrival_ts",), json="value")
    before = F.lag("arrival_ts").over(keyed_window())
    gap = F.unix_micros("arrival_ts") - F.unix_micros(before) > TTL * 1_000_000
    stretch = F.sum(F.coalesce(gap, F.lit(False)).cast("int")).over(keyed_window())
    split = df.withColumn("name", F.col("sensor_key")).withColumn("sensor_key", F.concat_ws("#", "sensor_key", stretch))

    def back(df):
        return df.withColumn("sensor_key", F.col("name")).drop("name")

    out = {
        "current": back(latest.latest_emissions(split, ORDER)),
        "alerts": back(alerts.dedup_alerts(split, SETTINGS.cooldown_ms, ORDER)),
        "spikes": back(spikes.spikes(split, order=ORDER)),
    }
    assert split.select("sensor_key").distinct().count() > 30
    return {name: as_set(df) for name, df in out.items()}


def keyed_window():
    from pyspark.sql import Window

    return Window.partitionBy("sensor_key").orderBy(*ORDER)


def run(spark, inbox, out, ttl=TTL):
    stream = pipeline.enriched_stream(source(spark, inbox), SETTINGS)
    query = keyed.start_keyed(keyed.keyed_products(stream, SETTINGS, ttl, ORDER), out, available_now=True)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("cuts", [1, 3, 20])
def test_any_cut_gives_the_same(spark, tmp_path, rows, expected, cuts):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, inbox, rows, cuts)
    run(spark, inbox, out)
    for product in keyed.PRODUCTS:
        assert as_set(keyed.read_keyed(spark, out, product, SETTINGS)) == expected[product], product


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path, rows, expected):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    third = len(rows) // 3
    for part in (rows[:third], rows[third : 2 * third], rows[2 * third :]):
        feed(spark, inbox, part, 2)
        run(spark, inbox, out)
    for product in keyed.PRODUCTS:
        assert as_set(keyed.read_keyed(spark, out, product, SETTINGS)) == expected[product], product


def test_without_a_limit_nothing_is_forgotten(spark, tmp_path, rows):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, inbox, rows, 3)
    run(spark, inbox, out, ttl=None)
    df = enriched_readings(spark.createDataFrame(rows, LINE), SETTINGS, ("arrival_ts",), json="value")
    assert as_set(keyed.read_keyed(spark, out, "alerts", SETTINGS)) == as_set(alerts.dedup_alerts(df, SETTINGS.cooldown_ms, ORDER))
    assert as_set(keyed.read_keyed(spark, out, "current", SETTINGS)) == as_set(latest.latest_emissions(df, ORDER))
    assert as_set(keyed.read_keyed(spark, out, "spikes", SETTINGS)) == as_set(spikes.spikes(df, order=ORDER))


def message(place, second):
    moment = (START + timedelta(seconds=second)).strftime("%Y-%m-%d %H:%M:%S.%f")
    record = {"captured_time": moment, "uploaded_time": "", "latitude": str(place), "longitude": "1.0", "unit": "cpm", "value": "60"}
    return START + timedelta(seconds=second), json.dumps(record)


def test_state_follows_the_traffic(spark, tmp_path):
    """A batch touches its own sensors only, and silent sensors leave the store."""
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, inbox, [message(p, 1) for p in range(60)], 1)
    for step in range(6):  # two of them go on
        feed(spark, inbox, [message(p, 100 + 100 * step) for p in range(2)], 1)
    query = run(spark, inbox, out)
    progress = [(p["numInputRows"], p["stateOperators"][0]) for p in query.recentProgress if p["numInputRows"]]
    assert [n for n, _ in progress] == [60] + [2] * 6
    assert progress[0][1]["numRowsUpdated"] >= 60
    # Updates and removals together: two sensors, their timers, and once all that fell silent.
    busy = [op["numRowsUpdated"] for _, op in progress[1:]]
    assert max(busy[-3:]) <= 8
    held = [op["numRowsTotal"] for _, op in progress]
    assert held[-1] < held[0] / 4
    assert keyed.read_keyed(spark, out, "alerts", SETTINGS).count() == 60 + 2 * 6


def test_epochs():
    s = 1_000_000
    assert keyed.epochs(np.array([1, 2, 50, 91, 90, 131]) * s, None, 40 * s).tolist() == [0, 0, 1, 2, 2, 2]
    assert keyed.epochs(np.array([41, 42]) * s, 1 * s, 40 * s).tolist() == [0, 0]
    assert keyed.epochs(np.array([42, 43]) * s, 1 * s, 40 * s).tolist() == [1, 1]
    assert keyed.epochs(np.array([5, 900]) * s, 1, None).tolist() == [0, 0]


class Store:
    """State and timers of one shard, with a count of accesses."""

    def __init__(self):
        self.held, self.timers, self.accesses = {}, [], 0

    def getMapState(self, *_):  # noqa: N802
        return self

    def getValue(self, key):  # noqa: N802
        self.accesses += 1
        return self.held.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.accesses += 1
        self.held[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.held[key]

    def iterator(self):
        return iter(self.held.items())

    def listTimers(self):  # noqa: N802
        return iter(self.timers)

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.now


def shard(rng, names, second, size):
    frame = pd.DataFrame({"sensor_key": rng.choice(names, size), "captured_at": rng.integers(0, 500, size) * 1000})
    frame["keyed_seen_us"] = np.sort(rng.integers(second, second + 100, size)) * 1_000_000 + np.arange(size)
    frame["cpm"] = rng.uniform(1, 200, size)
    frame["level"] = np.select([frame["cpm"] > 150, frame["cpm"] > 50], ["high", "warning"], "safe")
    return frame


def marked(frames, ttl_us, store):
    operator = keyed.SensorProducts(SETTINGS, ["keyed_seen_us"], ttl_us)
    operator.init(store)
    found = [part for frame in frames for part in operator.handleInputRows((0,), iter([frame[:70], frame[70:]]), store)]
    rows = pd.concat(found).sort_values("keyed_seen_us", ignore_index=True)
    assert rows[["is_current", "is_alert", "is_spike"]].any(axis=1).all()
    return rows


@pytest.mark.parametrize("ttl_us", [None, 40_000_000])
def test_sensors_of_a_shard_share_calls_and_accesses(ttl_us):
    """All at once or each sensor by itself: the same rows; the store is asked once for each page."""
    rng = np.random.default_rng(3)
    names = np.array([f"S{i}" for i in range(300)])
    frames = [shard(rng, names, 100 * i, 900) for i in range(3)]
    store = Store()
    together = marked(frames, ttl_us, store)
    assert store.accesses <= 2 * keyed.PAGES * len(frames)
    alone = [marked([f[f["sensor_key"] == n] for f in frames if (f["sensor_key"] == n).any()], ttl_us, Store()) for n in names]
    alone = pd.concat(alone).sort_values("keyed_seen_us", ignore_index=True)
    assert len(alone) > 500
    pd.testing.assert_frame_equal(together, alone, check_exact=True)


def test_sweep_removes_what_is_due():
    """Values past their time leave with the next timer of the shard; the others stay and have one timer."""
    store, operator = Store(), keyed.SensorProducts(SETTINGS, ["keyed_seen_us"], 40_000_000)
    operator.init(store)
    frame = pd.DataFrame({"sensor_key": ["a", "b", None], "captured_at": [1, 2, 3], "cpm": [60.0] * 3, "level": ["high"] * 3})
    frame["keyed_seen_us"] = [1_000_000, 30_000_000, 31_000_000]
    assert len(next(operator.handleInputRows((0,), iter([frame]), store))) == 3
    assert store.timers == [41_001]
    store.now = 50_000
    list(operator.handleExpiredTimer((0,), store, None))
    assert {name for (text,) in store.held.values() for name in keyed._unpacked(text)} == {"b", None}
    assert store.timers == [41_001, 70_001]
    store.now = 80_000
    list(operator.handleExpiredTimer((0,), store, None))
    assert store.held == {} and len(store.timers) == 2
