"""Late rows are kept, silent sources do not hold windows back, and every batch is parted once."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import START

from isodose.schemas import Settings
from isodose.streaming import late, pipeline, windows

SETTINGS = Settings(window="10 seconds")
ROWS = "arrival_ts timestamp, source string, sensor_key string, cpm double, level string"


def rows(spark, *seconds):
    """(source, seconds) pairs."""
    data = [(None if s is None else START + timedelta(seconds=s), name, "K", 5.0, "safe") for name, s in seconds]
    return spark.createDataFrame(data, ROWS)


def second(us):
    return None if us is None else us / 1e6 - START.timestamp()


def counts(df):
    return {int((r.window_start - START).total_seconds()): r.reading_count for r in df.collect()}


def late_seconds(spark, ledger):
    return sorted((r.batch_id, r.late_seconds) for r in ledger.read_late(spark).collect())


def test_rows_behind_the_watermark_go_to_their_table(spark, tmp_path):
    ledger = late.WindowLedger(str(tmp_path), SETTINGS, lateness_seconds=5)
    ledger.write(rows(spark, ("a", 0), ("a", 3), ("a", 26)), 0)  # watermark 21 from here on
    ledger.write(rows(spark, ("a", 9), ("a", 11), ("a", 20), ("a", 27), ("a", None)), 1)  # 9 and 11 late
    ledger.write(rows(spark, ("a", 19), ("a", 45)), 2)
    assert counts(ledger.read(spark)) == {0: 2, 20: 3, 40: 1}
    assert late_seconds(spark, ledger) == [(1, 10.0), (1, 12.0), (2, 3.0)]
    assert counts(ledger.read(spark, 0)) == {0: 2}
    assert counts(ledger.read(spark, 2)) == {0: 2, 20: 3}  # watermark 40
    # The same batch again, as after a crash, parts its rows as before.
    ledger.write(rows(spark, ("a", 9), ("a", 11), ("a", 20), ("a", 27), ("a", None)), 1)
    ledger.write(rows(spark, ("a", 19), ("a", 45)), 2)
    assert counts(ledger.read(spark)) == {0: 2, 20: 3, 40: 1}
    assert late_seconds(spark, ledger) == [(1, 10.0), (1, 12.0), (2, 3.0)]


@pytest.mark.parametrize(
    "policy, idle, closed, lost",
    [
        ("min", None, {}, 0),  # the silent source holds all windows open
        ("min", 30, {0: 2, 10: 1, 20: 1, 30: 1, 40: 1, 50: 1}, 2),  # once it is too far behind it does not count
        ("max", None, {0: 2, 10: 1, 20: 1, 30: 1, 40: 1, 50: 1}, 2),
    ],
)
def test_silent_source(spark, tmp_path, policy, idle, closed, lost):
    ledger = late.WindowLedger(str(tmp_path), SETTINGS, policy=policy, idle_seconds=idle)
    ledger.write(rows(spark, ("slow", 1), ("fast", 5)), 0)
    for batch_id, at in enumerate((15, 25, 35, 45, 55, 65), start=1):
        ledger.write(rows(spark, ("fast", at)), batch_id)
    before = counts(ledger.read(spark, 6))
    assert before == closed
    ledger.write(rows(spark, ("slow", 3), ("slow", 33), ("fast", 66)), 7)
    assert ledger.read_late(spark).count() == lost
    assert sum(counts(ledger.read(spark)).values()) + lost == 2 + 6 + 3
    after = ledger.watermark_after(spark, 7)
    ledger.write(rows(spark, ("slow", 67)), 8)
    assert ledger.watermark_after(spark, 8) >= after  # a source that catches up does not turn it back


def test_expected_source_counts_before_it_sends(spark, tmp_path):
    plain = late.WindowLedger(str(tmp_path / "a"), SETTINGS)
    waiting = late.WindowLedger(str(tmp_path / "b"), SETTINGS, expected=("b",))
    patient = late.WindowLedger(str(tmp_path / "c"), SETTINGS, expected=("b",), idle_seconds=20)
    for ledger, marks in ((plain, [12, 40]), (waiting, [2, 2]), (patient, [2, 40])):
        ledger.write(rows(spark, ("a", 2), ("a", 12)), 0)
        ledger.write(rows(spark, ("a", 40)), 1)
        assert [second(ledger.watermark_after(spark, n)) for n in (0, 1)] == marks


def test_watermark():
    assert late.watermark({}, "min", 0, None, 7) == 7
    assert late.watermark({"a": 10, "b": 4}, "min", 1, None, None) == 3
    assert late.watermark({"a": 10, "b": 4}, "max", 1, None, None) == 9
    assert late.watermark({"a": 10, "b": 4}, "min", 0, 6, None) == 4
    assert late.watermark({"a": 10, "b": 3}, "min", 0, 6, None) == 10
    assert late.watermark({"a": 10, "b": 8}, "min", 0, 6, 9) == 9


def test_empty_batches_and_unknown_policy(spark, tmp_path):
    ledger = late.WindowLedger(str(tmp_path), SETTINGS)
    ledger.write(rows(spark), 0)
    ledger.write(rows(spark, (None, 5)), 1)
    assert counts(ledger.read(spark)) == {0: 1} and ledger.read_late(spark).count() == 0
    for call in (lambda: late.WindowLedger("x", policy="mean"), lambda: late.on_own_clocks({}, "1 second", "mean")):
        with pytest.raises(ValueError, match="policy"):
            call()


def stream(spark, folder, name, *seconds):
    rows(spark, *((name, s) for s in seconds)).drop("source").coalesce(1).write.mode("append").parquet(folder)
    schema = rows(spark).drop("source").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_with_a_restart(spark, tmp_path):
    """Window rows and late rows together are the input, over several runs."""
    ledger = late.WindowLedger(str(tmp_path / "out"), SETTINGS, source_col="sensor_key")
    sent = 0
    for part in ((0, 5, 30), (2, 31, 60), (29, 61), (100, 3)):
        feed = stream(spark, str(tmp_path / "in"), "a", *part)
        late.start_windows(feed, ledger, available_now=True).awaitTermination()
        sent += len(part)
        assert sum(counts(ledger.read(spark)).values()) + ledger.read_late(spark).count() == sent
    assert [b for b, _ in late_seconds(spark, ledger)] == [1, 2, 3]


@pytest.mark.parametrize("policy, closed", [("min", {}), ("max", {0: 3, 10: 1})])
def test_spark_policies(spark, tmp_path, policy, closed):
    """Spark's own windows over two streams, one of them silent after its first rows."""
    out, got = str(tmp_path / "out"), None
    fast, slow = str(tmp_path / "fast"), str(tmp_path / "slow")
    stream(spark, slow, "slow", 1, 2)
    try:
        for at in (5, 15, 25, 26):
            feeds = {"fast": stream(spark, fast, "fast", at), "slow": spark.readStream.schema(rows(spark).drop("source").schema).parquet(slow)}
            merged = late.on_own_clocks(feeds, "0 seconds", policy)
            got = pipeline.settle(windows.global_stats(merged, SETTINGS.window), out)
        assert counts(got) == closed
        assert merged.where(F.col("source") == "slow").isStreaming
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
