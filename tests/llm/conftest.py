import random

import pytest
from pyspark.sql import functions as F

SYLLABLES = "an er in on re the st ou tion ly ed ha".split()
CLASHES = "ident text_ host name row n codes tokens block bucket size prob part order cell u v node root content times taken score".split()


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


def edited(rng: random.Random, text: str, edits: int) -> str:
    out = text.split(" ")
    for _ in range(edits):
        out[rng.randrange(len(out))] = "".join(rng.choices(SYLLABLES, k=4))
    return " ".join(out)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) rows, with columns whose names clash."""

    def make(rows):
        df = spark.createDataFrame(
            [(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long"
        )
        return df.select("*", *(F.lit(None).cast("string").alias(c) for c in CLASHES))

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties."""
    rng = random.Random(5)
    plain = " ".join(words(rng, 80))
    long_ = " ".join(words(rng, 30_000))
    return [
        (1, plain, "en", "a"),
        (1, plain, "en", "a"),
        (2, plain, None, None),
        (3, None, "en", "a"),
        (4, "", "en", "b"),
        (None, " ".join(words(rng, 60)), "de", "b"),
        (None, None, None, None),
        (5, " \n\t \r\n", "de", "b"),
        (6, long_, "fr", None),
        (7, "1234 !!!    x \0 é漢😀 <|endoftext|> ▁▁ a  b", "fr", "c"),
        (8, "same " * 400, "en", "c"),
        (9, "One\nTwo\none\nOne", "en", "a"),
    ]
