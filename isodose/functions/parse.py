"""Text to typed values: lenient numbers, UTC times, units, and the JSON record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isodose import schemas as S

_BLANK = " \t\n\r\x0b\x0c"
#: Accepted number spellings: digits with single underscores, point, exponent, infinity.
NUMBER = (
    r"^[+-]?(((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?)"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
)
#: Accepted times; what passes is then read by the fast cast instead of a date formatter.
TIME = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?$"


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(text, F.lit(_BLANK))


def number(text: Column) -> Column:
    """Double, or null for anything that is not a number (NaN included)."""
    clean = strip(text)
    return F.when(clean.rlike(NUMBER), F.replace(clean, F.lit("_"), F.lit("")).try_cast("double"))


def is_blank_time(text: Column) -> Column:
    """Missing time: null, empty, or one of the usual spellings of "none"."""
    return F.coalesce(F.lower(strip(text)).isin("", "nat", "nan", "none"), F.lit(True))


def utc_time(text: Column) -> Column:
    """UTC timestamp with zero to six fraction digits; null if blank or malformed."""
    clean = strip(text)
    return F.when(clean.rlike(TIME), F.concat(clean, F.lit("Z")).try_cast("timestamp"))


def epoch_ms(moment: Column) -> Column:
    """Whole milliseconds since the epoch; finer digits are cut."""
    return F.unix_millis(moment)


def from_epoch_ms(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def unit_name(text: Column) -> Column:
    return F.lower(strip(F.coalesce(text, F.lit(""))))


def typed_columns(raw: str | None = None) -> dict[str, Column]:
    """The parsed record from the raw text fields (optionally inside struct ``raw``)."""

    def field(name: str) -> Column:
        return F.col(f"{raw}.{name}" if raw else name)

    return {
        "captured_at": epoch_ms(utc_time(field("captured_time"))),
        "uploaded_at": field("uploaded_time"),
        "latitude": number(field("latitude")),
        "longitude": number(field("longitude")),
        "cpm": number(field("value")),
        "unit": unit_name(field("unit")),
    }


def _computed_once(keep: tuple[str, ...], typed: dict[str, Column]) -> list[Column]:
    """Select list that evaluates the typed fields once per row.

    As plain columns they would be copied into every later filter that Catalyst pushes
    below this projection, and a time would be parsed four times per row.  A one-row
    ``stack`` is a generator, which such filters stay above; filters on ``keep`` still pass.
    """
    fields = F.stack(F.lit(1), *typed.values()).alias(*typed)
    return [*[F.col(name) for name in keep], fields]


def parse_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed record from raw text columns; ``keep`` names columns to carry along."""
    return df.select(*_computed_once(keep, typed_columns()))


def parse_json(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed record from JSON text.  Text that is no JSON object gives nulls throughout.

    Only the fields in use are in the requested schema, so the JSON parser skips the rest.
    """
    fields = ", ".join(f"{name} string" for name in S.USED_FIELDS)
    record = F.from_json(F.col(value).cast("string"), fields, {"allowSingleQuotes": "false"})
    return df.select(*keep, record.alias("_record")).select(
        *_computed_once(keep, typed_columns("_record"))
    )
