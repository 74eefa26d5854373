"""Progress rows of streams, and sketches of distinct sensors."""

from datetime import timedelta

from pyspark.sql import functions as F
from test_streaming import SETTINGS, START, feed, messages, source

from isodose.operators import stats
from isodose.streaming import pipeline, progress


def test_every_trigger_is_written(spark, tmp_path):
    inbox, path = str(tmp_path / "in"), str(tmp_path / "progress")
    log = progress.ProgressLog(spark, path, every=2)
    spark.streams.addListener(log)
    runs = []
    try:
        for part in (messages(size=300), messages(seed=2, size=100)):
            feed(spark, inbox, part, 5)
            query = pipeline.start_parquet(pipeline.enriched_stream(source(spark, inbox), SETTINGS), str(tmp_path / "out"), available_now=True)
            query.awaitTermination()
            assert log.wait_ended(str(query.runId))
            runs.append(query)
        stateful = pipeline.window_streams(pipeline.enriched_stream(source(spark, inbox), SETTINGS), SETTINGS)["stats"]
        query = pipeline.start_parquet(stateful, str(tmp_path / "windows"), available_now=True)
        query.awaitTermination()
        assert log.wait_ended(str(query.runId))
    finally:
        spark.streams.removeListener(log)
    rows = progress.read_progress(spark, path)
    for run, want in zip(runs, ([60] * 5, [20] * 5), strict=True):
        mine = rows.where((F.col("run_id") == str(run.runId)) & (F.col("rows") > 0)).orderBy("batch_id").collect()
        assert [r["rows"] for r in mine] == want
        assert [r["batch_id"] for r in mine] == list(range(mine[0]["batch_id"], mine[0]["batch_id"] + 5))
        assert all(r["duration_ms"] > 0 and r["late_rows"] == 0 and "logOffset" in r["end_offsets"] for r in mine)
    assert len({r["query_id"] for r in rows.where(F.col("run_id").isin([str(r.runId) for r in runs])).collect()}) == 1
    held = rows.where(F.col("run_id") == str(query.runId)).agg(F.max("state_rows"), F.max("watermark")).first()
    assert held[0] > 0 and held[1] is not None
    assert not log.wait_ended("no such run", timeout=0.01)


def test_sketched_windows(spark):
    """40 000 sensors: exact sums, an estimate within its error, and a row per window."""
    df = spark.range(40_000).select(
        (F.lit(START) + F.make_dt_interval(secs=F.col("id") % 7200)).alias("arrival_ts"),
        F.concat(F.lit("s"), F.col("id")).alias("sensor_key"),
        (F.col("id") % 90 + 1).cast("double").alias("cpm"),
        F.when(F.col("id") % 10 == 0, "high").otherwise("safe").alias("level"),
    )
    exact = stats.merge_stats(stats.stats_partials(df, "1 hour"), "1 day").first()
    for lg, error in ((12, 0.016), (8, 0.065)):
        partials = stats.sketch_partials(df, "1 hour", lg_buckets=lg)
        assert partials.count() == 2
        got = stats.merge_sketched(partials.unionByName(partials.limit(0)), "1 day").first()
        assert (got.avg_cpm, got.max_cpm, got.alert_count, got.reading_count) == (
            exact.avg_cpm, exact.max_cpm, exact.alert_count, exact.reading_count,
        )
        assert abs(got.active_sensors - 40_000) <= 4 * error * 40_000
    coarse = stats.sketch_partials(df, "1 hour", lg_buckets=8).unionByName(stats.sketch_partials(df, "1 hour", lg_buckets=12))
    assert abs(stats.merge_sketched(coarse, "1 day").first().active_sensors - 40_000) <= 4 * 0.065 * 40_000
    assert exact.window_end - exact.window_start == timedelta(days=1)
    none = df.limit(0)
    assert stats.merge_sketched(stats.sketch_partials(none, "1 hour"), "1 day").collect() == []
