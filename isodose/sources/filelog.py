"""A message log in shared files, as a Spark data source and sink (``filelog``).

A topic has partitions, a partition has segments: immutable Parquet files named after their first
offset and number of records, so offsets are known from names alone.  The readers deal stretches of
segments over tasks in shares of like size; how much a trigger may read is asked anew each time from
a control record, which a running query follows at once.  The stream writer publishes a batch as a
whole: tasks write staged segments, the commit notes which segment gets which offsets and then moves
them, so a batch that is repeated, or was cut off between any two steps, appears exactly once.

Records of a partition keep the order of the
tasks that wrote them.  One query at a time may write to a topic.  Segments must be renamed atomically by the file system.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter

FORMAT = "filelog"
SCHEMA = "topic string, partition int, offset long, key string, value string, timestamp timestamp"
_RECORD = pa.schema([("key", pa.string()), ("value", pa.string()), ("timestamp", pa.timestamp("us", "UTC"))])
#: Rows handed to Spark at a time, and kept per segment before they are written.
_BATCH = 10_000
#: Bytes kept per segment before they are written.
_KEPT = 4 << 20
#: Records that one task reads, at most and, if there are as many, at least; and tasks between these.
_MOST, _LEAST, _TASKS = 200_000, 10_000, 32
#: Commit notes kept per writer; only the last batch is ever repeated.
_NOTES = 16


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _put(files: fs.FileSystem, path: str, content: dict) -> None:
    """Write a small file as a whole or not at all."""
    part = f"{path}.{uuid.uuid4().hex}"
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(part) as out:
        out.write(json.dumps(content).encode())
    files.move(part, path)


def _get(files: fs.FileSystem, path: str) -> dict | None:
    if files.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(path) as data:
        return json.loads(data.read())


@dataclass(frozen=True)
class Segment:
    topic: str
    partition: int
    first: int
    count: int
    path: str

    @property
    def end(self) -> int:
        return self.first + self.count


class Log:
    """The files of a log."""

    def __init__(self, path: str):
        self.files, self.path = _open(path)

    def _names(self, *below: str) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector("/".join([self.path, *below]), allow_not_found=True))
        return sorted(i.base_name for i in found if not i.base_name.startswith(("_", ".")))

    def topics(self) -> list[str]:
        return self._names()

    def partitions(self, topic: str) -> list[int]:
        return sorted(int(n) for n in self._names(topic))

    def segments(self, topic: str, partition: int, start: int = 0) -> list[Segment]:
        """In order of offsets; those that end at or before ``start`` are left out."""
        out = []
        for name in self._names(topic, str(partition)):
            first, count = map(int, name.removesuffix(".parquet").split("-"))
            if first + count > start:
                out.append(Segment(topic, partition, first, count, f"{self.path}/{topic}/{partition}/{name}"))
        return out

    def end(self, topic: str, partition: int) -> int:
        names = self._names(topic, str(partition))
        return sum(map(int, names[-1].removesuffix(".parquet").split("-"))) if names else 0

    def place(self, topic: str, partition: int, first: int, count: int) -> str:
        return f"{self.path}/{topic}/{partition}/{first:020d}-{count:010d}.parquet"


# ------------------------------------------------------------------ reading


@dataclass(frozen=True)
class Stretch:
    """Records ``skip .. skip + take - 1`` of a segment."""

    segment: Segment
    skip: int
    take: int


class Share(InputPartition):
    """What one task reads, in this order."""

    def __init__(self, stretches: list[Stretch]):
        self.stretches = stretches


def _shares(stretches: Sequence[Stretch]) -> list[Share]:
    """Stretches cut and put together to shares of like size, without a change of order."""
    total = sum(s.take for s in stretches)
    size = min(_MOST, max(_LEAST, -(-total // _TASKS)))
    out: list[list[Stretch]] = []
    room = 0
    for s in stretches:
        skip, left = s.skip, s.take
        while left:
            if not room:
                out.append([])
                room = size
            take = min(left, room)
            out[-1].append(Stretch(s.segment, skip, take))
            skip, left, room = skip + take, left - take, room - take
    return [Share(part) for part in out]


def _read(path: str, share: Share | None) -> Iterator[pa.RecordBatch]:
    if share is None:  # Spark's stand-in for no partitions at all
        return
    files, _ = _open(path)
    for part in share.stretches:
        yield from _read_stretch(files, part)


def _read_stretch(files: fs.FileSystem, part: Stretch) -> Iterator[pa.RecordBatch]:
    segment, left = part.segment, part.take
    with files.open_input_file(segment.path) as data:
        file = pq.ParquetFile(data)
        ends = np.cumsum([file.metadata.row_group(i).num_rows for i in range(file.num_row_groups)])
        groups = np.flatnonzero((ends > part.skip) & (np.r_[0, ends[:-1]] < part.skip + part.take)).tolist()
        at = int(ends[groups[0] - 1]) if groups and groups[0] else 0
        for batch in file.iter_batches(_BATCH, groups):
            skip = max(0, part.skip - at)
            rows = batch.slice(skip, min(left, max(0, batch.num_rows - skip)))
            if rows.num_rows:
                first = segment.first + at + skip
                n = rows.num_rows
                yield pa.record_batch(
                    [
                        pa.repeat(segment.topic, n),
                        pa.repeat(pa.scalar(segment.partition, pa.int32()), n),
                        pa.array(np.arange(first, first + n)),
                        *rows.columns,
                    ],
                    names=["topic", "partition", "offset", "key", "value", "timestamp"],
                )
                left -= n
            at += batch.num_rows
            if not left:
                return


class _Options:
    def __init__(self, options: Mapping[str, str]):
        # Option names arrive in lower case.
        self.path = options["path"]
        self.topics = [t for t in options.get("topics", "").split(",") if t]
        self.limit = int(options["maxoffsetspertrigger"]) if options.get("maxoffsetspertrigger") else None
        self.control, self.progress = options.get("control"), options.get("progress")
        self.partitions = int(options.get("partitions", "4"))
        self.writer = options.get("writer", "batch")


class LogReader(DataSourceReader):
    """Everything that is in the log."""

    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> Sequence[Share]:
        log = Log(self.options.path)
        topics = self.options.topics or log.topics()
        return _shares([Stretch(s, 0, s.count) for t in topics for p in log.partitions(t) for s in log.segments(t, p)])

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return _read(self.options.path, partition)


def allowance(room: Mapping[str, int], limit: int | None) -> dict[str, int]:
    """Records to take of each partition: all, or the limit shared in proportion to what there is.

    Every partition with records gets one at least, so none waits for ever; the largest remainders
    get what rounding leaves over.
    """
    total = sum(room.values())
    if limit is None or total <= limit:
        return dict(room)
    waiting = [k for k, n in room.items() if n]
    if limit < len(waiting):
        # The fullest first, by name among equals: over several triggers all have their turn.
        chosen = set(sorted(waiting, key=lambda k: (-room[k], k))[:limit])
        return {k: int(k in chosen) for k in room}
    out = {k: int(bool(n)) for k, n in room.items()}
    spare, rest = limit - len(waiting), total - len(waiting)
    shares = {k: (room[k] - 1) * spare for k in waiting}
    for k in waiting:
        out[k] += shares[k] // rest
    left = limit - sum(out.values())
    for k in sorted(waiting, key=lambda k: (-(shares[k] % rest), k))[:left]:
        out[k] += 1
    return out


class LogStreamReader(DataSourceStreamReader):
    """New records since the trigger before, as many as the control record allows.

    Spark does not tell the reader where a restarted query stands, so the end of each planned batch
    is noted in a progress file beside the query's checkpoint before the batch runs.
    """

    def __init__(self, options: _Options):
        self.options = options
        self._cursor: dict[str, int] | None = None

    def _progress(self) -> dict[str, int]:
        if self._cursor is None:
            saved = _get(*_open(self.options.progress)) if self.options.progress else None
            self._cursor = saved or {}
        return self._cursor

    def _control(self) -> dict:
        return (_get(*_open(self.options.control)) if self.options.control else None) or {}

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        log, cursor, control = Log(self.options.path), self._progress(), self._control()
        until = datetime.fromisoformat(control["until"]) if control.get("until") else None
        room, start = {}, {}
        for topic in self.options.topics or log.topics():
            for partition in log.partitions(topic):
                name = f"{topic}/{partition}"
                start[name] = cursor.get(name, 0)
                end = log.end(topic, partition) if until is None else self._due(log, topic, partition, start[name], until)
                room[name] = max(0, end - start[name])
        taken = allowance(room, control.get("max_offsets", self.options.limit))
        return cursor | {name: start[name] + taken[name] for name in start}

    def _due(self, log: Log, topic: str, partition: int, start: int, until: datetime) -> int:
        """End of the records that are due: a partition's records are in order of time."""
        limit, end = pa.scalar(until.astimezone(UTC), _RECORD.field("timestamp").type), start
        for segment in log.segments(topic, partition, start):
            with log.files.open_input_file(segment.path) as data:
                times = pq.read_table(data, columns=["timestamp"])["timestamp"]
            due = pc.sum(pc.less_equal(times, limit)).as_py() or 0
            end = max(end, segment.first + due)
            if due < segment.count:
                break
        return end

    def partitions(self, start: dict, end: dict) -> Sequence[Share]:
        log, out = Log(self.options.path), []
        for name in sorted(end):
            topic, partition = name.rsplit("/", 1)
            first, last = start.get(name, 0), end[name]
            for s in log.segments(topic, int(partition), first):
                skip, stop = max(0, first - s.first), min(s.count, last - s.first)
                if stop > skip:
                    out.append(Stretch(s, skip, stop - skip))
        self._cursor = dict(end)
        if self.options.progress:
            files, path = _open(self.options.progress)
            _put(files, path, self._cursor)
        return _shares(out)

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return _read(self.options.path, partition)

    def commit(self, end: dict) -> None:
        pass


# ------------------------------------------------------------------ writing


@dataclass
class Staged(WriterCommitMessage):
    """What one task wrote: (topic, partition, records, staged file)."""

    parts: list[tuple[str, int, int, str]]


class _Staging:
    """A segment as it is written: rows are kept until they make a row group."""

    def __init__(self, files: fs.FileSystem, path: str):
        self.path, self.count = path, 0
        # Values hardly ever repeat.
        self.file = pq.ParquetWriter(path, _RECORD, filesystem=files, use_dictionary=["key"])
        self.kept: list[pa.Table] = []

    def add(self, rows: pa.Table) -> None:
        self.kept.append(rows)
        self.count += rows.num_rows
        if sum(t.num_rows for t in self.kept) >= _BATCH or sum(t.nbytes for t in self.kept) >= _KEPT:
            self.flush()

    def flush(self) -> None:
        if self.kept:
            self.file.write_table(pa.concat_tables(self.kept).combine_chunks())
            self.kept = []


def _dealt(rows: pa.Table, partitions: int) -> Iterator[tuple[tuple[str, int], pa.Table]]:
    """The rows of each topic and partition; a partition follows from the key, or the value if there is none."""
    text = pc.coalesce(rows["key"], rows["value"], pa.scalar("")).combine_chunks().dictionary_encode()
    topic = rows["topic"].combine_chunks().dictionary_encode("encode")
    hashes = np.array([zlib.crc32(t.encode()) % partitions for t in text.dictionary.to_pylist()], np.int64)
    place = topic.indices.to_numpy() * partitions + hashes[text.indices.to_numpy()]
    names = topic.dictionary.to_pylist()
    for code in np.unique(place).tolist():
        mine = rows.filter(pa.array(place == code))
        yield (names[code // partitions], code % partitions), mine


class _Writer:
    def __init__(self, options: _Options):
        self.options = options
        self.stage = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        log, n = Log(self.options.path), self.options.partitions
        folder = f"{log.path}/_staging/{self.options.writer}/{self.stage}"
        log.files.create_dir(folder, recursive=True)
        open_: dict[tuple[str, int], _Staging] = {}
        try:
            for batch in iterator:
                for target, rows in _dealt(_records(batch), n):
                    if target not in open_:
                        open_[target] = _Staging(log.files, f"{folder}/{uuid.uuid4().hex}.parquet")
                    open_[target].add(rows.select(_RECORD.names))
            for out in open_.values():
                out.flush()
        finally:
            for out in open_.values():
                out.file.close()
        return Staged([(t, p, open_[t, p].count, open_[t, p].path) for t, p in sorted(open_)])

    def _publish(self, messages: list, batch_id: int | str) -> None:
        log = Log(self.options.path)
        note = f"{log.path}/_commits/{self.options.writer}/{batch_id}.json"
        plan = _get(log.files, note)
        if plan is None:
            ends: dict[tuple[str, int], int] = {}
            moves = []
            for topic, partition, count, path in (p for m in messages if m is not None for p in m.parts):
                first = ends.get((topic, partition))
                first = log.end(topic, partition) if first is None else first
                ends[topic, partition] = first + count
                moves.append((path, log.place(topic, partition, first, count)))
            plan = {"moves": moves}
            _put(log.files, note, plan)
        for source, target in plan["moves"]:
            if log.files.get_file_info(source).type != fs.FileType.NotFound:
                log.files.create_dir(target.rsplit("/", 1)[0], recursive=True)
                log.files.move(source, target)
        self._drop(log)
        if isinstance(batch_id, int) and batch_id >= _NOTES:
            old = f"{log.path}/_commits/{self.options.writer}/{batch_id - _NOTES}.json"
            if log.files.get_file_info(old).type != fs.FileType.NotFound:
                log.files.delete_file(old)

    def _drop(self, log: Log, folder: str | None = None) -> None:
        """Staged files that no note names: of attempts that failed or were repeated."""
        folder = folder or f"{log.path}/_staging/{self.options.writer}/{self.stage}"
        if log.files.get_file_info(folder).type != fs.FileType.NotFound:
            log.files.delete_dir(folder)


def _records(batch: pa.RecordBatch) -> pa.Table:
    """Columns of a log record from any columns that have at least ``topic`` and ``value``."""
    n, names = batch.num_rows, batch.schema.names
    now = pa.scalar(datetime.now(UTC), _RECORD.field("timestamp").type)
    times = batch.column("timestamp").cast(now.type) if "timestamp" in names else pa.nulls(n, now.type)
    key = batch.column("key").cast(pa.string()) if "key" in names else pa.nulls(n, pa.string())
    return pa.table(
        {
            "topic": batch.column("topic").cast(pa.string()),
            "key": key,
            "value": batch.column("value").cast(pa.string()),
            "timestamp": pc.fill_null(times, now),
        }
    )


class LogWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self._publish(messages, self.stage)

    def abort(self, messages: list) -> None:
        self._drop(Log(self.options.path))


class LogStreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        self._publish(messages, batchId)
        # Also what earlier runs of this query left behind when they were cut off.
        log = Log(self.options.path)
        self._drop(log, f"{log.path}/_staging/{self.options.writer}")

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self._drop(Log(self.options.path))


class FileLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(_Options(self.options))

    def streamReader(self, schema) -> LogStreamReader:  # noqa: N802
        return LogStreamReader(_Options(self.options))

    def writer(self, schema, overwrite: bool) -> LogWriter:
        return LogWriter(_Options(self.options))

    def streamWriter(self, schema, overwrite: bool) -> LogStreamWriter:  # noqa: N802
        return LogStreamWriter(_Options(self.options))


# ------------------------------------------------------------------ use


def register(spark: SparkSession) -> None:
    """Make ``format("filelog")`` known to a session."""
    spark.dataSource.register(FileLog)


def _as_feed(rows: DataFrame) -> DataFrame:
    return rows.select("topic", "key", "value", F.col("timestamp").alias("arrival_ts"), "partition", "offset")


def read_log(spark: SparkSession, path: str, topics: Sequence[str] = ()) -> DataFrame:
    """All records of the topics (default: of all), with the columns of a live feed."""
    register(spark)
    return _as_feed(spark.read.format(FORMAT).option("topics", ",".join(topics)).load(path))


def stream_log(
    spark: SparkSession,
    path: str,
    topics: Sequence[str] = (),
    checkpoint: str | None = None,
    control: str | None = None,
    max_offsets: int | None = None,
) -> DataFrame:
    """The records as a stream: ``topic``, ``key``, ``value``, ``arrival_ts``, ``partition``, ``offset``.

    ``checkpoint`` is the folder of the query that reads them: the reader's progress lies there
    too, so both are kept or dropped together; a query without a limit needs none.  ``control`` is
    a file written by :func:`set_rate`; ``max_offsets`` holds until that names a limit.
    """
    if checkpoint is None and (control or max_offsets):
        raise ValueError("a limited stream needs the folder of its query's checkpoint")
    register(spark)
    reader = spark.readStream.format(FORMAT).option("topics", ",".join(topics))
    options = {
        "control": control,
        "progress": f"{checkpoint}/filelog-progress.json" if checkpoint else None,
        "maxOffsetsPerTrigger": max_offsets,
    }
    return _as_feed(reader.options(**{k: v for k, v in options.items() if v is not None}).load(path))


def append_log(messages: DataFrame, path: str, partitions: int = 4) -> None:
    """Add the rows of a batch (``topic``, ``value``, optional ``key`` and ``timestamp``) to the log."""
    register(messages.sparkSession)
    messages.write.format(FORMAT).mode("append").option("partitions", partitions).save(path)


def write_log(messages: DataFrame, path: str, checkpoint: str, writer: str, partitions: int = 4) -> DataStreamWriter:
    """Writer for a stream of such rows, still to be started.  ``writer`` names the query for good."""
    register(messages.sparkSession)
    out = messages.writeStream.format(FORMAT).option("path", path).option("partitions", partitions)
    return out.option("writer", writer).option("checkpointLocation", checkpoint)


def set_rate(path: str, max_offsets: int | None = None, until: datetime | None = None) -> None:
    """What triggers may read from now on: so many records, and none after a moment of record time.

    Running queries follow at their next trigger.  ``until`` is the clock of a replay: see
    :func:`due_until`.
    """
    files, place = _open(path)
    content = {"max_offsets": max_offsets, "until": until.astimezone(UTC).isoformat() if until else None}
    _put(files, place, {k: v for k, v in content.items() if v is not None})


def due_until(first: datetime, started: datetime, now: datetime, speed: float) -> datetime:
    """Record time a replay has reached: ``speed`` times as fast as the records came in."""
    return first + (now - started) * speed
