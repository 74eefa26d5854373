"""The pipeline, stage by stage, against the brute-force versions of its operators."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import pytest
from conftest import edited, words
from test_corpus import brute_join, brute_passages, brute_rules

from isodose.llm import cube_mix, line_rules
from isodose.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(edge_rows):
    rng = random.Random(77)
    rows = [r for r in edge_rows if r[0] is not None]
    passage = " ".join(words(rng, 60))
    banner = " ".join(words(rng, 10))
    for i in range(160):
        lines = [" ".join(words(rng, rng.randint(10, 40))) for _ in range(rng.randint(2, 6))]
        if i % 3 == 0:
            lines.insert(1, banner)
        if i % 8 == 0:
            lines.append(f"{' '.join(words(rng, 5))} {passage} {' '.join(words(rng, 5))}")
        rows.append((100 + i, "\n".join(lines), "en", rng.choice("abc")))
    for i in range(30):
        rows.append((1000 + i, edited(rng, rows[20 + i % 7][1], rng.choice([0, 1, 2])), "en", "d"))
    return rows


def listed(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


def test_stages(spark, make_docs, corpus, tmp_path):
    docs = make_docs(corpus).select(*COLUMNS)
    before = listed(docs)
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialise(stage(spark, docs, ""), "test-stage")
        if place < 4:
            assert docs.columns == COLUMNS
            after = listed(docs)
            assert all(n == (None if t is None else len(t)) for _, t, _, _, n in after)
        if place == 0:
            judged = brute_rules(before, line_rules.MAX_DOCS, line_rules.MAX_SHARE, line_rules.MIN_LEFT)
            assert Counter((d, t) for d, t, *_ in after) == Counter((w[0], w[-1]) for w in judged if w[-2])
        elif place == 1:
            kept = {d for d, _, c in brute_join(before, 5, 80) if d == c}
            assert Counter(d for d, *_ in after) == Counter(kept)
            assert set(after) <= set(before) and len(after) < len(before)
        elif place == 2:
            want = Counter((d, digest) for d, _, _, digest in brute_passages(before, 35))
            assert Counter((d, hashlib.sha256(b" ".join(t.encode().split())).hexdigest()) for d, t, *_ in after) == want
            assert after != before
        elif place == 3:
            times = Counter(after)
            assert set(times) <= set(before) and max(times.values()) <= 2
            sizes, taken, docs_of = Counter(), Counter(), Counter(r[3] for r in before)
            for rows, sums in ((before, sizes), (after, taken)):
                for _, text, _, source, _ in rows:
                    sums[source] += len(text.split())
            order = sorted(docs_of, key=lambda s: (s is None, s or ""))
            weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(order))]
            wanted = dict(zip(order, cube_mix.targets([sizes[s] for s in order], weights, 1.5, 2.0), strict=True))
            assert all(taken[s] == pytest.approx(wanted[s], rel=0.02) for s in order if docs_of[s] > 20)
        if place < 4:
            before = after
    last = docs.collect()
    assert Counter(r["doc_id"] for r in last) == Counter(r[0] for r in before)
    assert all(r["round_trip"] for r in last)


def test_run_over_the_smallest_table(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r["round_trip"] for r in rows)


def test_empty_documents(spark, make_docs):
    docs = make_docs([]).select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, ""), "test-stage")
        assert docs.count() == 0
