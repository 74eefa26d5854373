"""CSV exports of raw measurements, and the raw message forms made from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isodose import schemas as S
from isodose.functions.numeric import fixed_decimals
from isodose.functions.parse import number, strip

_HEADER_SCHEMA = T.StructType([T.StructField(h, T.StringType()) for h in S.RAW_HEADERS.values()])
_TEXT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "encoding": "UTF-8", **_TEXT}


def _named(df: DataFrame) -> DataFrame:
    """Raw field names instead of headers; what a short row or a header lacks is empty text."""
    there = {column.strip().lower(): column for column in df.columns}

    def field(header: str) -> Column:
        column = there.get(header.lower())
        return F.lit("") if column is None else F.coalesce(F.col(f"`{column}`"), F.lit(""))

    return df.select(*[field(header).alias(name) for name, header in S.RAW_HEADERS.items()])


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files of a path by their header line; of each file only the first line is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found: dict[str, list[str]] = {}
    for name in sorted(spark.read.text(path).inputFiles()):
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = place.getFileSystem(conf).open(place)
        codec = codecs.getCodec(place)
        lines = jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        )
        found.setdefault(lines.readLine() or "", []).append(name)
        lines.close()
    return found


def read_csv(spark: SparkSession, path: str, max_rows: int = 0) -> DataFrame:
    """The thirteen raw text fields of one or many CSV files.

    Columns are found by the header of each file, in any order; headers that are not known are
    left out, missing ones are empty.  Undecodable bytes become replacement characters, blank
    lines are skipped; ``max_rows`` > 0 is the ingest cap.
    """
    parts = [
        _named(spark.read.options(**_OPTIONS).csv(files)) for _, files in sorted(_headers(spark, path).items())
    ]
    raw = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], S.RAW)
    return raw.limit(max_rows) if max_rows > 0 else raw


def write_csv(raw: DataFrame, path: str, fields: Sequence[str] = S.RAW_FIELDS) -> None:
    """Raw text fields as CSV files under the standard headers; absent fields stay empty."""
    present = set(raw.columns)
    columns = [
        (F.coalesce(F.col(name), F.lit("")) if name in present else F.lit("")).alias(S.RAW_HEADERS[name]) for name in fields
    ]
    raw.select(*columns).write.options(header="true", emptyValue="", **_TEXT).csv(path)


def stream_csv(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """CSV files as they appear in a folder; ``max_files`` per trigger limits the rate.

    A stream has one schema: a file with another header than the standard one is an error.
    """
    reader = spark.readStream.schema(_HEADER_SCHEMA).options(enforceSchema="false", **_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _named(reader.csv(path))


def raw_json(raw: DataFrame) -> Column:
    """The raw message: a JSON object with all thirteen text fields, absent ones empty."""
    present = set(raw.columns)
    fields = [
        (F.coalesce(F.col(name), F.lit("")) if name in present else F.lit("")).alias(name)
        for name in S.RAW_FIELDS
    ]
    return F.to_json(F.struct(*fields))


def raw_csv_line() -> Column:
    """The alternative raw message: the row as one CSV line in header order."""
    fields = [F.coalesce(F.col(name), F.lit("")).alias(name) for name in S.RAW_FIELDS]
    return F.to_csv(F.struct(*fields), {"emptyValue": "", **_TEXT})


def from_csv_line(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw text fields back from :func:`raw_csv_line` messages."""
    ddl = ", ".join(f"{name} string" for name in S.RAW_FIELDS)
    line = F.from_csv(F.col(value).cast("string"), F.lit(ddl), _TEXT)
    record = df.select(*keep, line.alias("_r"))
    return record.select(
        *keep, *[F.coalesce(F.col(f"_r.{n}"), F.lit("")).alias(n) for n in S.RAW_FIELDS]
    )


def _short_number(value: Column) -> Column:
    """A coordinate rounded to four decimals, without trailing zeros but with one decimal."""
    text = F.regexp_replace(fixed_decimals(value, 4), r"0{1,3}$", "")
    return F.when(F.abs(value) < 1e10, text).otherwise(value.cast("string"))


def with_partition_key(raw: DataFrame, name: str = "key") -> DataFrame:
    """Add the key that keeps the rows of one source together: device, place, checksum, or null.

    Coordinates are parsed in a projection of their own, since the key uses them repeatedly.
    """

    def field(column: str) -> Column:
        return strip(F.coalesce(F.col(column), F.lit(""))) if column in raw.columns else F.lit("")

    device, checksum = field("device_id"), field("md5")
    lat, lon = F.col("_lat"), F.col("_lon")
    place = F.concat(F.lit("geo:"), _short_number(lat), F.lit(","), _short_number(lon))
    key = (
        F.when(device != "", F.concat(F.lit("dev:"), device))
        .when(lat.isNotNull() & lon.isNotNull(), place)
        .when(checksum != "", checksum)
    )
    parsed = raw.select(
        "*", number(field("latitude")).alias("_lat"), number(field("longitude")).alias("_lon")
    )
    return parsed.select(*raw.columns, key.alias(name))
