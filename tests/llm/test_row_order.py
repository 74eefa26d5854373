"""Every pass over a block may see its rows in another order: the results must not change."""

import random
from collections import Counter

import pytest
from conftest import edited, words
from pyspark.sql import functions as F

from isodose.llm import backoff_lm, exchange, fm_dedup, ngram_join
from isodose.llm.common import held_out


class Restless:
    """Rows that are dealt anew, and so arrive in another order, each time they are grouped."""

    def __init__(self, rows):
        self.rows, self.times = rows, 0

    def __getattr__(self, name):
        return getattr(self.rows, name)

    def groupBy(self, *columns):  # noqa: N802
        self.times += 1
        return self.rows.repartition(3 + 2 * self.times, F.rand(self.times)).groupBy(*columns)


@pytest.fixture
def restless(monkeypatch):
    seen = []

    def run(rows, *args, **options):
        seen.append(Restless(rows))
        return exchange.ask_and_answer(seen[-1], *args, **options)

    for module in (fm_dedup, ngram_join, backoff_lm):
        monkeypatch.setattr(module, "ask_and_answer", run)
    return seen


@pytest.fixture(scope="module")
def shared_rows(edge_rows):
    rng = random.Random(29)
    passages = [" ".join(words(rng, n)) for n in (36, 50, 90)]
    rows = list(edge_rows)
    for i in range(150):
        own = " ".join(words(rng, rng.randint(20, 90)))
        rows.append((600 + i, rng.choice([own, f"{own} {rng.choice(passages)} {' '.join(words(rng, 9))}"]), "en", "a"))
        if i % 9 == 0:
            rows.append((900 + i, edited(rng, rows[-1][1], 1), "en", "a"))
    return rows


OPERATORS = {
    "passages": lambda docs: fm_dedup.deduplicate(docs),
    "passages, split": lambda docs: fm_dedup.deduplicate(docs, split=1),
    "passages, texts": lambda docs: fm_dedup.deduplicate(docs, whole_text=True, keep=("source",)),
    "links": lambda docs: ngram_join.link_classes(docs, width=3, percent=60).select("doc_id", "n_shingles", "component_id"),
    "scores": lambda docs: backoff_lm.score(docs, held_out(F.col("doc_id"), 10, 0)).select("doc_id", "n_known", F.round("score", 6)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_order_of_rows(spark, make_docs, shared_rows, restless, monkeypatch, name):
    operator = OPERATORS[name]
    got = Counter(map(tuple, operator(make_docs(shared_rows)).collect()))
    assert restless and all(r.times > 1 for r in restless)
    monkeypatch.undo()
    assert got == Counter(map(tuple, operator(make_docs(shared_rows)).collect()))
