"""Fill-in-the-middle rewriting of documents.

Repeated-capture matching: one ``regex`` fullmatch of ``(unit)*`` keeps every repetition of the
group, so ``match.ends(1)`` holds the end of every unit: its length is the number of units, and
the two cuts are two of its items.  Which units are cut and which form is written follow from a
hash of the document's id, so a document always gets the same form.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches

#: A unit is a line with its line end; the last one may lack it.
_LINES = regex.compile(r"([^\n]*\n|[^\n]+)*")
#: Sentinels in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Longer texts are matched in pieces of about so many characters, each ending with a line: the
#: matcher keeps its own note of every repetition.
PIECE = 1 << 20
BATCH = 2000


def unit_ends(text: str, piece: int = PIECE) -> list[int]:
    """Where each unit ends, in code points."""
    if len(text) <= piece:
        return _LINES.fullmatch(text).ends(1)
    ends, start = [], 0
    while start < len(text):
        cut = text.rfind("\n", start, start + piece) + 1 or text.find("\n", start + piece) + 1 or len(text)
        ends += [start + e for e in _LINES.fullmatch(text[start:cut]).ends(1)]
        start = cut
    return ends


def rewrite(text: str, draws: tuple[int, int, int, int], rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, characters of prefix and middle, and the text in that form."""
    ends = unit_ends(text)
    n = len(ends)
    if not n or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or draws[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted(d % (n + 1) for d in draws[:2])
    a, b = (ends[x - 1] if x else 0 for x in (a, b))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < spm_rate:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _rewrite_batches(rate: int, spm_rate: int, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, BATCH):
        draws = zip(*(frame.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)
        rows = [rewrite(t or "", d, rate, spm_rate) for t, d in zip(frame.column(1).to_pylist(), draws, strict=True)]
        n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ([],) * 5
        yield pa.record_batch(
            [
                frame.column(0),
                pa.array(n, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.string()),
            ],
            names=["ident", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def draw(ident: Column, seed: int, number: int) -> Column:
    """The ``number``-th (from 0) 8-digit group of the hash of seed and id, as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("long")


def transform(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50
) -> DataFrame:
    """Per row: id, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` percent of the texts are rewritten, ``spm_rate`` percent of these with the suffix in
    front.  A text that is null or empty, or holds a sentinel, stays plain (null: empty output,
    no units), with null lengths.  A null id is hashed as the empty text; rows alike in id and
    text get the same result.  Very long texts are rewritten whole.  Other columns are not looked
    at; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"), *(draw(F.col(ident), seed, i).alias(f"h{i}") for i in range(4))
    )
    kind = rows.schema["ident"].dataType.simpleString()
    schema = f"ident {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(partial(_rewrite_batches, rate, spm_rate), schema).withColumnRenamed("ident", ident)


def restored(output: Column, form: Column) -> Column:
    """The original text of a row, from its output and form alone.

    A rewritten text holds no sentinel of its own and no sentinel overlaps another, so the first
    one found is the one that was written.
    """
    size = len(PREFIX)

    def parts(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(size + 1))
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(one) + F.lit(size + 1))
        two = F.substring_index(rest, third, 1)
        return one, two, F.substr(rest, F.length(two) + F.lit(size + 1))

    p, s, m = parts(PREFIX, SUFFIX, MIDDLE)
    suffix, prefix, middle = parts(SUFFIX, PREFIX, MIDDLE)
    return F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
