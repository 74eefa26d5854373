"""Windows over sources of different pace, with the rows that come too late kept.

Spark's own windows drop rows behind the watermark and only count them.  Here each micro-batch is
parted by the watermark in force before it: rows whose window is still open go into partial results,
rows whose window is closed go to a table of their own, with how late they were.  Nothing is lost:
window rows and late rows together are the input.

The watermark follows one clock per source.  With policy ``min`` it is that of the slowest source, so
no source's rows become late because another is ahead; a source that has fallen silent would hold all
windows open, so one that is ``idle_seconds`` behind the fastest does not count until it catches up.
With policy ``max`` the fastest source closes windows for all, and rows of slower ones may be late.
Both depend on the rows alone, so a repeated batch parts them as before.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from isodose.operators.stats import merge_stats, stats_partials
from isodose.schemas import DEFAULTS, Settings
from isodose.session import get_note, put_note, remove

POLICIES = ("min", "max")


def watermark(clocks: dict[str, int], policy: str, lateness_us: int, idle_us: int | None, before: int | None) -> int | None:
    """The watermark from each source's latest time (microseconds); it never goes back."""
    if not clocks:
        return before
    fastest = max(clocks.values())
    counted = [t for t in clocks.values() if idle_us is None or t >= fastest - idle_us]
    now = (fastest if policy == "max" else min(counted)) - lateness_us
    return now if before is None else max(before, now)


@dataclass
class WindowLedger:
    """Writer (``foreachBatch``) and reader of the windows and of the late rows below ``path``.

    ``source_col`` names the source of a row (a null is a source too); there must be few of them, as
    one short note of each is kept per batch.  A source named in ``expected`` counts from the stream's
    earliest time on, before it has sent anything.  Rows without a time are in no window.
    """

    path: str
    settings: Settings = DEFAULTS
    lateness_seconds: float = 0.0
    policy: str = "min"
    idle_seconds: float | None = None
    time_col: str = "arrival_ts"
    source_col: str = "source"
    expected: Sequence[str] = ()

    def __post_init__(self) -> None:
        if self.policy not in POLICIES:
            raise ValueError(f"policy must be one of {POLICIES}")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Part one batch by the watermark before it; the next one's follows from its rows."""
        spark = batch.sparkSession
        clocks, limit, origin = self._before(spark, batch_id)
        width = self.settings.window
        ends = F.unix_micros(F.window(self.time_col, width)["end"])
        late = F.lit(False) if limit is None else F.coalesce(ends <= F.lit(limit), F.lit(False))
        marked = self._store(batch.where(F.col(self.time_col).isNotNull()).withColumn("_late", late), "rows", batch_id)
        self._store(stats_partials(marked.where("not _late"), width, self.time_col), "windows", batch_id)
        behind = (F.lit(limit).cast("long") - F.unix_micros(self.time_col)) / F.lit(1e6)
        self._store(marked.where("_late").drop("_late").withColumn("late_seconds", behind), "late", batch_id)
        source = F.coalesce(F.col(self.source_col).cast("string"), F.lit(""))
        at = F.unix_micros(self.time_col)
        for row in marked.groupBy(source.alias("name")).agg(F.max(at).alias("last"), F.min(at).alias("first")).collect():
            clocks[row["name"]] = max(row["last"], clocks.get(row["name"], row["last"]))
            origin = row["first"] if origin is None else min(origin, row["first"])
        idle = None if self.idle_seconds is None else int(self.idle_seconds * 1e6)
        all_clocks = clocks if origin is None else dict.fromkeys(self.expected, origin) | clocks
        after = watermark(all_clocks, self.policy, int(self.lateness_seconds * 1e6), idle, limit)
        remove(spark, f"{self.path}/rows/batch_id={batch_id}")
        put_note(spark, self._note(batch_id), json.dumps({"clocks": clocks, "watermark": after, "origin": origin}))

    def _note(self, batch_id: int) -> str:
        return f"{self.path}/_clocks/{batch_id}"

    def _before(self, spark: SparkSession, batch_id: int) -> tuple[dict[str, int], int | None, int | None]:
        text = get_note(spark, self._note(batch_id - 1)) if batch_id else None
        note = json.loads(text) if text else {"clocks": {}, "watermark": None, "origin": None}
        return note["clocks"], note["watermark"], note["origin"]

    def _store(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        path = f"{self.path}/{name}/batch_id={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def watermark_after(self, spark: SparkSession, batch_id: int) -> int | None:
        """Microseconds; windows that end by then are closed."""
        return self._before(spark, batch_id + 1)[1]

    def read(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        """Statistics of the windows: all, or those closed after a batch."""
        out = merge_stats(spark.read.parquet(f"{self.path}/windows").drop("batch_id"), self.settings.window)
        if batch_id is None:
            return out
        return out.where(F.unix_micros("window_end") <= F.lit(self.watermark_after(spark, batch_id)).cast("long"))

    def read_late(self, spark: SparkSession) -> DataFrame:
        """Rows whose window was closed when they came, with ``late_seconds`` and ``batch_id``."""
        return spark.read.parquet(f"{self.path}/late")


def start_windows(rows: DataFrame, ledger: WindowLedger, available_now: bool = False) -> StreamingQuery:
    """Keep the windows of a stream of enriched rows up to date."""
    writer = rows.writeStream.foreachBatch(ledger.write).option("checkpointLocation", f"{ledger.path}/_checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def on_own_clocks(streams: dict[str, DataFrame], lateness: str, policy: str = "min", time_col: str = "arrival_ts") -> DataFrame:
    """Several streams as one for Spark's own windows, each with a watermark of its own.

    The policy says which of them is in force and holds for the session's queries from now on;
    Spark knows no idle sources, so a silent one holds back all windows under ``min``.  Columns are
    those of the first stream and ``source``.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    parts = [df.withColumn("source", F.lit(name)).withWatermark(time_col, lateness) for name, df in streams.items()]
    parts[0].sparkSession.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
