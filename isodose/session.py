"""Session helpers: sensible defaults and the place for durable intermediates."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "isodose", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides any setting."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Call sites for error messages cost several calls into the JVM per expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def durable_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session that
    names none gets a temporary folder; a cluster without one is an error, since
    a machine-local folder is lost together with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and context._jsc.sc().getCheckpointDir().isDefined():
        named = context._jsc.sc().getCheckpointDir().get()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="isodose-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below :func:`durable_dir`."""
    return os.path.join(durable_dir(spark), f"{name}-{os.urandom(8).hex()}")


def parallelism(spark: SparkSession) -> int:
    """How many tasks a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def put_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file as a whole or not at all; one that is there is replaced."""
    jvm = spark.sparkContext._jvm
    place, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{os.urandom(6).hex()}.part")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(place, False)
    files.rename(part, place)


def get_note(spark: SparkSession, path: str) -> str | None:
    """The text of such a file, or None."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.rename(path(source), path(target)):
        raise OSError(f"cannot rename {source} to {target}")
