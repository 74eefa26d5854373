"""The message log in files: offsets, fan-out, restarts, rates that change, repeated commits."""

import json
import os
import random
import shutil
import time
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_streaming import SETTINGS, START, as_set, messages

from isodose.operators import alerts
from isodose.plans.live import enriched_readings
from isodose.sources import filelog, log
from isodose.sources.filelog import Log, Staged, _Options
from isodose.streaming import keyed, pipeline

ROWS = "topic string, key string, value string, timestamp timestamp"


def fill(spark, path, rows, topic="t", partitions=4, parts=3):
    df = spark.createDataFrame([(topic, k, v, t) for k, v, t in rows], ROWS)
    filelog.append_log(df.repartition(parts), path, partitions)


def plain(n, start=0):
    return [(f"k{i % 7}", f"v{i}", START + timedelta(seconds=i)) for i in range(start, start + n)]


def test_offsets_are_dense_and_keys_stay_together(spark, tmp_path):
    path = str(tmp_path / "log")
    fill(spark, path, plain(200))
    fill(spark, path, plain(100, 200))
    rows = filelog.read_log(spark, path).collect()
    assert sorted(r["value"] for r in rows) == sorted(f"v{i}" for i in range(300))
    by_partition, of_key = {}, {}
    for r in rows:
        by_partition.setdefault(r["partition"], []).append(r["offset"])
        of_key.setdefault(r["key"], set()).add(r["partition"])
    assert all(sorted(o) == list(range(len(o))) for o in by_partition.values())
    assert len(by_partition) > 1 and all(len(p) == 1 for p in of_key.values())
    assert {r["value"]: r["arrival_ts"] for r in rows}["v17"] == START + timedelta(seconds=17)
    assert [Log(path).end("t", p) for p in sorted(by_partition)] == [len(by_partition[p]) for p in sorted(by_partition)]


def test_nothing_there_yet(spark, tmp_path):
    path = str(tmp_path / "log")
    assert filelog.read_log(spark, path).collect() == []
    fill(spark, path, [(None, None, None), (None, "", None), ("k", "é漢", None)])
    got = filelog.read_log(spark, path)
    assert as_set(got.select("key", "value")) == {("None", "None"), ("None", ""), ("k", "é漢")}
    assert got.where("arrival_ts is null").count() == 0  # the moment of writing


def test_allowance():
    rng = random.Random(1)
    for _ in range(500):
        room = {str(i): rng.choice([0, 1, rng.randrange(50)]) for i in range(rng.randrange(1, 8))}
        limit = rng.choice([None, rng.randrange(80)])
        taken = filelog.allowance(room, limit)
        assert sum(taken.values()) == min(sum(room.values()), sum(room.values()) if limit is None else limit)
        assert all(0 <= taken[k] <= room[k] for k in room)
        if limit is not None and limit >= sum(map(bool, room.values())):
            assert all(taken[k] for k in room if room[k])


def start(stream, out, checkpoint):
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(out)


def values(spark, out):
    return sorted(r["value"] for r in spark.read.parquet(out).select("value").collect())


def test_rate_changes_while_running(spark, tmp_path):
    path, out, checkpoint, control = (str(tmp_path / n) for n in ("log", "out", "check", "rate.json"))
    fill(spark, path, plain(400), partitions=3)
    filelog.set_rate(control, max_offsets=10)
    query = start(filelog.stream_log(spark, path, ["t"], checkpoint, control), out, checkpoint)
    try:
        while len([p for p in query.recentProgress if p["numInputRows"]]) < 3:
            time.sleep(0.1)
        filelog.set_rate(control, max_offsets=0)  # hold it
        time.sleep(2)
        held = sum(p["numInputRows"] for p in query.recentProgress)
        time.sleep(1)
        assert sum(p["numInputRows"] for p in query.recentProgress) == held < 400
        filelog.set_rate(control, max_offsets=150)
        query.processAllAvailable()
    finally:
        query.stop()
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sizes[:3] == [10, 10, 10] and 150 in sizes and max(sizes) == 150
    assert values(spark, out) == sorted(f"v{i}" for i in range(400))


def test_rows_that_are_not_due_wait(spark, tmp_path):
    path, out, checkpoint, control = (str(tmp_path / n) for n in ("log", "out", "check", "rate.json"))
    for part in range(4):  # in order of time
        fill(spark, path, plain(50, 50 * part), partitions=2, parts=1)
    stream = filelog.stream_log(spark, path, ["t"], checkpoint, control)
    begun = datetime(2030, 1, 1, tzinfo=UTC)
    for passed, speed, want in ((0, 60, 1), (1, 60, 61), (2, 60, 121), (2, 300, 200)):
        now = filelog.due_until(START.replace(tzinfo=UTC), begun, begun + timedelta(seconds=passed), speed)
        filelog.set_rate(control, until=now)
        query = start(stream, out, checkpoint)
        query.processAllAvailable()
        query.stop()
        assert len(values(spark, out)) == want
    assert values(spark, out) == sorted(f"v{i}" for i in range(200))


def test_limited_stream_needs_a_checkpoint(spark, tmp_path):
    with pytest.raises(ValueError, match="checkpoint"):
        filelog.stream_log(spark, str(tmp_path), max_offsets=5)


def test_restart_loses_and_doubles_nothing(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "check"))
    fill(spark, path, plain(90))
    for turn in range(3):
        query = start(filelog.stream_log(spark, path, ["t"], checkpoint, max_offsets=7), out, checkpoint)
        while len([p for p in query.recentProgress if p["numInputRows"]]) < 2:
            time.sleep(0.05)
        query.stop()  # wherever it stands
        fill(spark, path, plain(10, 90 + 10 * turn))
    query = start(filelog.stream_log(spark, path, ["t"], checkpoint, max_offsets=50), out, checkpoint)
    query.processAllAvailable()
    query.stop()
    assert values(spark, out) == sorted(f"v{i}" for i in range(120))


@pytest.mark.parametrize("lost", ["all", "progress"])
def test_lost_notes(spark, tmp_path, lost):
    path, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "check"))
    fill(spark, path, plain(30))
    for again in range(2):
        query = start(filelog.stream_log(spark, path, ["t"], checkpoint), f"{out}-{again}" if lost == "all" else out, checkpoint)
        query.processAllAvailable()
        query.stop()
        if lost == "all":
            shutil.rmtree(checkpoint)
    got = values(spark, f"{out}-1") if lost == "all" else values(spark, out)
    assert got == sorted(f"v{i}" for i in range(30))


def test_tasks_share_the_records(spark, tmp_path, monkeypatch):
    """Small segments are read together, large ones by several tasks, in order and without what is skipped."""
    path = str(tmp_path / "log")
    writer = filelog.LogWriter(_Options({"path": path, "partitions": "2"}))
    for first in range(0, 300, 10):
        rows = [{"topic": "t", "key": k, "value": v, "timestamp": t} for k, v, t in plain(10, first)]
        writer.stage = str(first)
        writer.commit([writer.write(iter([pa.RecordBatch.from_pylist(rows)]))])
    segments = [s for p in Log(path).partitions("t") for s in Log(path).segments("t", p)]
    assert len(segments) > 40
    reader = filelog.LogReader(_Options({"path": path}))
    assert len(reader.partitions()) == 1
    whole = [r for share in reader.partitions() for b in reader.read(share) for r in b.to_pylist()]
    assert sorted(r["value"] for r in whole) == sorted(f"v{i}" for i in range(300))
    assert [(r["partition"], r["offset"]) for r in whole] == [(s.partition, s.first + i) for s in segments for i in range(s.count)]
    monkeypatch.setattr(filelog, "_LEAST", 7)
    monkeypatch.setattr(filelog, "_TASKS", 40)
    shares = reader.partitions()
    assert len(shares) == 38  # of 8 records
    assert [r for share in shares for b in reader.read(share) for r in b.to_pylist()] == whole


def test_row_groups_do_not_follow_the_batches(tmp_path, monkeypatch):
    """A segment's row groups are of a size, and those before the first record asked for are not read."""
    path = str(tmp_path / "log")
    writer = filelog.LogWriter(_Options({"path": path, "partitions": "1"}))
    monkeypatch.setattr(filelog, "_BATCH", 100)
    rows = [{"topic": "t", "key": None, "value": v, "timestamp": t} for _, v, t in plain(1000)]
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 10]) for i in range(0, 1000, 10)]
    writer.commit([writer.write(iter(batches))])
    (segment,) = Log(path).segments("t", 0)
    assert [pq.ParquetFile(segment.path).metadata.row_group(i).num_rows for i in range(10)] == [100] * 10
    for skip, take in ((0, 1000), (0, 1), (99, 2), (100, 100), (555, 333), (999, 1)):
        read = list(filelog._read(path, filelog.Share([filelog.Stretch(segment, skip, take)])))
        assert [r["value"] for b in read for r in b.to_pylist()] == [f"v{i}" for i in range(skip, skip + take)]
        assert [r["offset"] for b in read for r in b.to_pylist()] == list(range(skip, skip + take))


# Publishing


class Crash(Exception):
    pass


def stage(path, writer, rows):
    """What tasks of one attempt at a batch would hand over."""
    out = filelog.LogStreamWriter(_Options({"path": path, "writer": writer, "partitions": "2"}))
    parts = []
    for half in (rows[::2], rows[1::2]):
        batch = pa.RecordBatch.from_pylist([{"topic": "t", "key": k, "value": v, "timestamp": t} for k, v, t in half])
        parts.append(out.write(iter([batch])))
    return out, parts


@pytest.mark.parametrize("step", range(8))
def test_a_commit_cut_off_anywhere_is_finished_by_the_next(spark, tmp_path, monkeypatch, step):
    """Every file operation of a commit fails once; the repeated batch then appears once."""
    path = str(tmp_path / "log")
    writer, first = stage(path, "w", plain(20))
    writer.commit(first, 0)
    writer, second = stage(path, "w", plain(20, 20))
    calls = 0
    real = {n: getattr(filelog.fs.LocalFileSystem, n) for n in ("move", "delete_dir")}

    class Failing(filelog.fs.LocalFileSystem):
        def __getattribute__(self, name):
            if name in real:
                nonlocal calls
                calls += 1
                if calls == step + 1:
                    raise Crash
            return super().__getattribute__(name)

    monkeypatch.setattr(filelog, "_open", lambda p: (Failing(), p))
    crashed = False
    try:
        writer.commit(second, 1)
    except Crash:
        crashed = True
    monkeypatch.undo()
    assert crashed == (calls > step)
    again, repeated = stage(path, "w", plain(20, 20))  # the batch runs again
    again.commit(repeated, 1)
    rows = filelog.read_log(spark, path).collect()
    assert sorted(r["value"] for r in rows) == sorted(f"v{i}" for i in range(40))
    assert sorted(r["offset"] for r in rows if r["partition"] == 0) == list(range(sum(r["partition"] == 0 for r in rows)))
    assert not os.path.exists(f"{path}/_staging/w") or not os.listdir(f"{path}/_staging/w")


def test_failed_attempts_leave_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    writer, parts = stage(path, "w", plain(8))
    writer.abort(parts, 0)
    assert filelog.read_log(spark, path).collect() == []
    writer, parts = stage(path, "w", plain(8))
    writer.commit([parts[0], None, Staged([])], 0)
    assert filelog.read_log(spark, path).count() == 4


# The dataflow from log to log


def test_fan_out(spark, tmp_path):
    """Raw topic in, a topic per product out, in several runs; a reader takes the products apart."""
    path = str(tmp_path / "log")
    sent = messages()
    for part in (sent[:300], sent[300:]):
        rows = spark.createDataFrame([(log.TOPICS["raw"], None, v, t) for t, v in part], ROWS)
        filelog.append_log(rows.coalesce(1), path, partitions=1)  # in order of arrival
        for name in ("clean", "alerts"):
            checkpoint = str(tmp_path / f"check-{name}")
            raw = filelog.stream_log(spark, path, [log.TOPICS["raw"]], checkpoint, max_offsets=150)
            rows = pipeline.enriched_stream(raw, SETTINGS, ("arrival_ts",))
            if name == "alerts":
                rows = keyed.keyed_products(rows, SETTINGS, None, ("arrival_ts", "captured_at")).where("is_alert")
            out = log.as_messages(rows.select("captured_at", "sensor_key", "cpm", "level"), log.TOPICS[name], key="sensor_key")
            query = filelog.write_log(out, path, checkpoint, name).start()
            query.processAllAvailable()
            query.stop()
    want = enriched_readings(spark.createDataFrame(sent, "arrival_ts timestamp, value string"), SETTINGS, ("arrival_ts",), json="value")
    columns = ["captured_at", "sensor_key", "cpm", "level"]
    feed = filelog.read_log(spark, path, [log.TOPICS["clean"], log.TOPICS["alerts"]])
    schema = "captured_at long, sensor_key string, cpm double, level string"
    typed = log.route(feed, {log.TOPICS["clean"]: schema, log.TOPICS["alerts"]: schema})
    assert as_set(typed[log.TOPICS["clean"]].select(*columns)) == as_set(want.select(*columns))
    assert typed[log.TOPICS["clean"]].count() == want.count()
    expected = alerts.dedup_alerts(want, SETTINGS.cooldown_ms, ("arrival_ts", "captured_at"))
    assert as_set(typed[log.TOPICS["alerts"]].select(*columns)) == as_set(expected.select(*columns))


def test_route_on_a_stream_of_several_topics(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    for topic in ("a", "b"):
        fill(spark, path, [("k", json.dumps({"n": i, "from": topic}), None) for i in range(5)], topic)
    fill(spark, path, [("k", json.dumps({"n": 99}), None)], "not asked for")
    feed = filelog.stream_log(spark, path, ["a", "b"])
    typed = log.route(feed, {"a": "n long, from string", "b": "n long"})
    for topic, want in (("a", {(str(i), "a") for i in range(5)}), ("b", {(str(i),) for i in range(5)})):
        rows = pipeline.settle(typed[topic].drop("arrival_ts"), f"{out}-{topic}")
        assert {tuple(map(str, r)) for r in rows.collect()} == want
    assert feed.select(F.col("arrival_ts")).isStreaming
