"""Operators that need arrival order, with every key cut into slices, against plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from isodose.operators import alerts, enrich, latest, ordered, replay, spikes
from isodose.operators.alerts import cooldown_mask

COOLDOWN = 600_000
START = datetime(2024, 1, 1)


def make_rows(seed, sensors=("A", "B", "C"), size=900, spread=90_000, levels=("warning", "elevated"), hot=0.6):
    """Rows in arrival order; the first sensor gets most of them, some arrive late."""
    rng = random.Random(seed)
    rows, clock = [], 1_700_000_000_000
    level = levels[0]
    for i in range(size):
        clock += rng.randrange(1, spread)
        late = rng.randrange(0, 2_000_000) if rng.random() < 0.1 else 0
        if rng.random() < 0.03:
            level = rng.choice(levels)
        sensor = sensors[0] if rng.random() < hot else rng.choice(sensors)
        # Arrival times repeat, as in a bulk upload: only event_id tells rows apart.
        arrival = START + timedelta(seconds=i // 50)
        rows.append((i, sensor, arrival, clock - late, round(rng.uniform(1, 300), 2), level))
    return rows


COLUMNS = "event_id long, sensor_key string, arrival_ts timestamp, captured_at long, cpm double, level string"
ORDER = ["arrival_ts", "event_id"]


def by_sensor(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1], []).append(row)
    return groups


@pytest.fixture(params=[10, 60, 10_000], ids=["tiny slices", "hot key only", "no slices"])
def max_rows(request, monkeypatch):
    original = ordered.slice_hot_keys

    def sliced(df, keys, order, max_rows=request.param):
        # One shuffle task's even share would hide the slicing in a small table.
        return original(df, keys, order, max_rows)

    for module in (alerts, latest, spikes, enrich, replay):
        monkeypatch.setattr(module, "slice_hot_keys", sliced)
    monkeypatch.setattr(ordered, "parallelism", lambda spark: 64)
    return request.param


def test_slices_are_bounded_and_ordered(spark):
    rows = make_rows(1)
    sliced = ordered.slice_hot_keys(spark.createDataFrame(rows, COLUMNS), ["sensor_key"], ORDER, 50)
    assert sliced.hot is not None
    found = sliced.rows.collect()
    assert len(found) == len(rows)
    last = {}
    for row in sorted(found, key=lambda r: (r.sensor_key, r.arrival_ts, r.event_id)):
        assert row[ordered.SLICE] >= last.get(row.sensor_key, -1)
        last[row.sensor_key] = row[ordered.SLICE]
    assert last["A"] >= 2


def test_even_share_keeps_keys_whole(spark):
    sliced = ordered.slice_hot_keys(spark.createDataFrame(make_rows(2), COLUMNS), ["sensor_key"], ORDER)
    assert sliced.hot is None


@pytest.mark.parametrize("seed", [3, 4])
def test_latest_emissions(spark, max_rows, seed):
    rows = make_rows(seed)
    want = set()
    for mine in by_sensor(rows).values():
        newest = None
        for row in mine:
            if newest is None or row[3] > newest:
                newest = row[3]
                want.add(row[0])
    got = latest.latest_emissions(spark.createDataFrame(rows, COLUMNS), ORDER)
    assert {r.event_id for r in got.collect()} == want


SHAPES = {
    "mixed": dict(),
    "one level": dict(levels=("high",)),
    "one level, regular": dict(levels=("high",), spread=2),
    "sparse": dict(levels=("high", "warning"), spread=1_500_000),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("seed", [5, 6])
def test_dedup_alerts(spark, max_rows, seed, shape):
    rows = make_rows(seed, **SHAPES[shape])
    rows = [(*r[:5], "safe" if r[0] % 7 == 0 else r[5]) for r in rows]
    want = set()
    for mine in by_sensor(rows).values():
        last_ts = last_level = None
        for row in mine:
            if row[5] == "safe":
                continue
            if last_ts is None or row[3] - last_ts > COOLDOWN or row[5] != last_level:
                last_ts, last_level = row[3], row[5]
                want.add(row[0])
    got = alerts.dedup_alerts(spark.createDataFrame(rows, COLUMNS), COOLDOWN, ORDER)
    assert {r.event_id for r in got.collect()} == want


@pytest.mark.parametrize("spacing", [1, 50, 700_000])
def test_chains_of_a_dense_slice(spacing):
    """400 000 rows of one level, with a cool-down that spans up to all of them."""
    cooldown, before = 20_000_000, 1_000_000
    times = [before + 1 + spacing * i for i in range(400_000)]
    chains = alerts._Chains(cooldown)
    for ts in times:
        chains.add(ts, "high", before)
    found = chains.result()
    assert len(found["_starts"]) <= min(len(times), cooldown + 1)
    for last in (before - cooldown // 3, before - 1, before):
        _, want, _ = cooldown_mask(times, ["high"] * len(times), cooldown, last, "high")
        row = {"_before": before, "_first": "high", "_end_ts": None, "_end_level": "high", **found}
        state = [{"_before": None, "_end_ts": last, "_end_level": "high"}, row, {**row, "_starts": []}]
        assert alerts._follow_states(state, cooldown)[2]["_ts"] == want


def test_cooldown_edges():
    minute = 60_000
    levels = ["warning"] * 4
    keep, *_ = cooldown_mask([0, 10 * minute, 10 * minute + 1, 5], levels, 10 * minute)
    assert keep.tolist() == [True, False, True, False]
    keep, *_ = cooldown_mask([0, 1, 2], ["warning", "high", "warning"], 10 * minute)
    assert keep.tolist() == [True, True, True]


@pytest.mark.parametrize("seed", [7, 8])
def test_moving_average_and_spikes(spark, max_rows, seed):
    rows = make_rows(seed)
    want = {}
    for mine in by_sensor(rows).values():
        previous = average = None
        for row in mine:
            want[row[0]] = (previous, average)
            previous = row[4]
            average = row[4] if average is None else 0.2 * row[4] + 0.8 * average
    df = spark.createDataFrame(rows, COLUMNS)
    for row in spikes.with_moving_average(df, order=ORDER).collect():
        previous, average = want[row.event_id]
        assert row.previous_cpm == previous
        assert row.average_before == average
    cpm = {r[0]: r[4] for r in rows}
    point = {i for i, (p, _) in want.items() if p is not None and cpm[i] / p >= 2.5}
    rolling = {i for i, (_, a) in want.items() if a is not None and cpm[i] / a >= 2.5}
    assert {r.event_id for r in spikes.point_spikes(df, order=ORDER).collect()} == point
    assert {r.event_id for r in spikes.rolling_spikes(df, order=ORDER).collect()} == rolling
    kinds = {r.event_id: r.spike_type for r in spikes.spikes(df, order=ORDER).collect()}
    assert set(kinds) == point | rolling
    assert {i for i, kind in kinds.items() if kind == "point_and_average"} == point & rolling
    assert {i for i, kind in kinds.items() if kind == "rolling_average"} == rolling - point


@pytest.mark.parametrize("size", [60, 2000])
@pytest.mark.parametrize("kind", ["random", "constant", "two values"])
def test_moving_average_whatever_the_slices(spark, monkeypatch, kind, size):
    monkeypatch.setattr(ordered, "parallelism", lambda spark: 64)
    rng = random.Random(size)
    make = {"random": lambda: rng.uniform(1, 300), "constant": lambda: 35.0, "two values": lambda: rng.choice([0.1, 9999.9])}[kind]
    # A varied beginning leaves different averages before the constant readings.
    values = [rng.uniform(1, 50) for _ in range(700)] + [make() for _ in range(6300)]
    rows = [(i, "A", START + timedelta(seconds=i), i, v, "safe") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, COLUMNS)
    sliced = ordered.slice_hot_keys(df, ["sensor_key"], ORDER, size)
    assert sliced.hot is not None
    got = {r.event_id: (r.previous_cpm, r.average_before) for r in spikes.with_moving_average(sliced).collect()}
    before, averages, *_ = spikes.ema_before(values, 0.2)
    assert got == dict(enumerate(zip(before, averages, strict=True)))


def test_first_row_never_spikes_and_ratio_is_inclusive(spark):
    rows = [(0, "A", START, 0, 4.0, "safe"), (1, "A", START, 1, 10.0, "safe"), (2, "B", START, 2, 999.0, "high")]
    got = spikes.spikes(spark.createDataFrame(rows, COLUMNS), order=ORDER).collect()
    assert [(r.event_id, r.spike_type, r.jump_ratio) for r in got] == [(1, "point_and_average", 2.5)]


def test_neighbour_in_both_directions(spark, max_rows):
    rows = make_rows(9)
    sliced = enrich.slice_hot_keys(spark.createDataFrame(rows, COLUMNS), ["sensor_key"], ORDER)
    for step in (-1, 1):
        got = {r.event_id: r.other for r in ordered.neighbour(sliced, "event_id", "other", step).collect()}
        for mine in by_sensor(rows).values():
            ids = [r[0] for r in mine]
            shifted = [None, *ids[:-1]] if step < 0 else [*ids[1:], None]
            assert [got[i] for i in ids] == shifted


def test_replay_schedule(spark, max_rows):
    rng = random.Random(10)
    rows, clock = [], START
    for i in range(500):
        clock += timedelta(milliseconds=rng.randrange(-500, 4000))
        text = "" if rng.random() < 0.1 else clock.strftime("%Y-%m-%d %H:%M:%S.%f")
        rows.append((i, text))
    last, total, want = None, 0.0, {}
    for i, text in rows:
        moment = datetime.strptime(text, "%Y-%m-%d %H:%M:%S.%f") if text else None
        delay = 0.0
        if last and moment:
            delay = min(max((moment - last).total_seconds(), 0) * 0.5, 1.5)
        last = moment or last
        total += delay
        want[i] = (delay, total)
    df = spark.createDataFrame(rows, "event_id long, uploaded_time string")
    for row in replay.replay_schedule(df, ["event_id"], 0.5, 1.5).collect():
        assert (row.delay_seconds, row.offset_seconds) == pytest.approx(want[row.event_id], abs=1e-6)
    still = replay.replay_schedule(df, ["event_id"], 0).agg(F.max("offset_seconds")).first()[0]
    assert still == 0


def test_threshold_intervals(spark, max_rows):
    changes = [(START + timedelta(hours=i), float(i)) for i in range(200)]
    df = spark.createDataFrame(changes, "effective_at timestamp, threshold double")
    got = {r.threshold: (r.valid_from, r.valid_until) for r in enrich.threshold_intervals(df).collect()}
    assert len(got) == 200
    assert all(got[float(i)][1] == got[float(i + 1)][0] for i in range(199))
    arrivals = [(i, START + timedelta(minutes=37 * i - 90)) for i in range(400)]
    rows = spark.createDataFrame(arrivals, "event_id long, arrival_ts timestamp")
    for row in enrich.with_threshold(rows, df, default=-1.0).collect():
        passed = (row.arrival_ts - START) // timedelta(hours=1)
        assert row.threshold == (-1.0 if passed < 0 else min(passed, 199))
