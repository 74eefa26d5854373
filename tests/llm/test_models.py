"""Ranking, language model and language identification: held-out accuracy and brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest import words
from pyspark.sql import functions as F

from isodose.llm import backoff_lm, bradley_terry, cross_parse, queries
from isodose.llm.common import held_out


def test_ranking_on_held_out_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = queries.op1_bradley_terry(spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert sum(g > b for g in good for b in bad) >= 0.98 * len(good) * len(bad)


def test_ranking_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    labels = F.when(F.col("doc_id") == 8, 0).when(F.col("doc_id") == 6, 1).when(F.col("doc_id") == 1, 1).when(F.col("doc_id") == 4, 7)
    ranker = bradley_terry.fit(docs.withColumn("quality", labels))
    rows = bradley_terry.score(docs, ranker).collect()
    assert len(rows) == len(edge_rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] == 3} == {r["score"] for r in rows if r["doc_id"] == 4}  # null as empty
    one_class = bradley_terry.fit(docs.withColumn("quality", F.lit(1)))
    assert {r["predicted"] for r in bradley_terry.score(docs, one_class).collect()} == {1}
    empty = make_docs([]).withColumn("quality", F.lit(1))
    assert bradley_terry.score(make_docs([]), bradley_terry.fit(empty)).collect() == []


def test_equal_texts_score_alike_at_any_place():
    rng = random.Random(41)
    x = np.array([bradley_terry.features(" ".join(words(rng, rng.randint(0, 60))).encode()) for _ in range(23)])
    weights = [rng.uniform(-1, 1) for _ in x[0]]
    ranker = bradley_terry.Ranker([rng.uniform(0, 0.5) for _ in x[0]], [rng.uniform(0.1, 0.4) for _ in x[0]], weights, 0.1, 1.0)
    alone = [ranker.score(x[i : i + 1])[0] for i in range(len(x))]
    for start in range(len(x)):
        for end in range(start + 1, len(x) + 1):
            assert ranker.score(x[start:end]).tolist() == alone[start:end]


def brute_lm(rows, order, strength):
    """Scores by the recursive definition."""
    counts = [Counter() for _ in range(order + 1)]
    states = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [[w.decode() for w in (t or "").translate(lower).encode().split()] + [None] for _, t, _ in rows]
    for (_, _, out), row in zip(rows, tokens, strict=True):
        if not out:
            line = ["<begin>", *row]
            for n in range(1, order + 1):
                for i in range(len(line) - n + 1):
                    gram = tuple(line[i : i + n])
                    if gram != ("<begin>",):
                        counts[n][gram] += 1
            states["<begin>",] += 1
    total = sum(counts[1].values())
    unknown = (sum(c == 1 for c in counts[1].values()) + 0.5) / (total + 1)

    def prob(gram):
        if len(gram) == 1:
            return (1 - unknown) * counts[1][gram] / max(total, 1) if counts[1][gram] else unknown
        state = states[gram[:-1]] or counts[len(gram) - 1][gram[:-1]]
        return (counts[len(gram)][gram] + strength * prob(gram[1:])) / (state + strength)

    out = []
    for row in tokens:
        line = ["<begin>", *row]
        score = sum(math.log10(prob(tuple(line[max(0, i - order + 1) : i + 1]))) for i in range(1, len(line)))
        base = sum(math.log10((counts[1][w,] + 0.1) / (total + 0.1 * (len(counts[1]) + 1))) for w in row)
        out.append((len(row), sum(counts[1][w,] > 0 for w in row), total, base, score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_automaton_against_definition(spark, make_docs, edge_rows, order):
    rng = random.Random(order)
    rows = [r for r in edge_rows if r[0] != 6] + [(100 + i, " ".join(words(rng, rng.randint(0, 40))), None, None) for i in range(30)]
    docs = make_docs(rows)
    out = held_out(F.col("doc_id"), 10, 0)
    flags = dict(docs.select("doc_id", out).distinct().collect())
    got = backoff_lm.score(docs, out, order=order, strength=3.0).collect()
    want = brute_lm([(r[0], r[1], flags[r[0]]) for r in rows], order, 3.0)
    key = lambda r: (r[0], round(r[3], 6))
    got = sorted((tuple(r[c] for c in ("n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in got), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:3] == b[:3]
        assert a[3:] == pytest.approx(b[3:], rel=1e-9)


def test_model_beats_base_on_held_out(spark, sf_dir):
    row = queries.op3_backoff_automaton(spark, sf_dir).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert row["s"] > 0.8 * row["b"]


def test_lm_without_training_or_rows(spark, make_docs):
    docs = make_docs([(1, "a b", None, None)])
    row = backoff_lm.score(docs, F.lit(True)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert backoff_lm.score(make_docs([]), F.lit(True)).collect() == []


def test_suffix_automaton_holds_all_substrings():
    text = "\nabcbc\nbca\n"
    automaton = cross_parse.suffix_automaton(text)
    held = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}

    def accepts(part):
        state = 0
        for char in part:
            state = automaton.get(state << 21 | ord(char))
            if state is None:
                return False
        return True

    assert all(map(accepts, held))
    assert not accepts("cc") and not accepts("ab\n")

    def brute(word):
        rest, phrases = f"\n{word}\n", 0
        while rest:
            size = max((n for n in range(1, len(rest) + 1) if rest[:n] in held), default=1)
            rest, phrases = rest[size:], phrases + 1
        return phrases

    for word in ("abc", "bca", "xyz", "cab", "abcxbc", "", "cbcbc"):
        assert cross_parse.count_phrases(automaton, word) == brute(word)


def test_language_on_held_out(spark, sf_dir):
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = queries.op10_cross_parsing(spark, sf_dir).join(langs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_language_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    model = cross_parse.fit(docs, "text", "lang")
    assert [name for name, _ in model] == ["de", "en", "fr"]
    rows = cross_parse.identify(docs, model).collect()
    assert len(rows) == len(edge_rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (3, 4, 5))
    assert by_id[6]["lang_pred"] == "fr" and by_id[1]["lang_pred"] == "en"
    assert {r["lang_pred"] for r in cross_parse.identify(docs, ()).collect()} == {"und"}
    assert cross_parse.identify(make_docs([]), cross_parse.fit(make_docs([]), "text", "lang")).collect() == []


def test_long_runs_are_parsed_whole():
    """A run of letters counts with all its characters and phrases, not by its beginning."""
    model = (("aa", "\nab\n"), ("bb", "\ncd\n"))
    parser = cross_parse.CrossParser(model)
    run = "ab" * 32_500 + "cd" * 100_000
    phrases = [cross_parse.count_phrases(suffixes, run) for suffixes in parser._automata]
    assert max(phrases) > 65_535
    assert parser.rates(run) == pytest.approx([n * b / (len(run) + 2) for n, b in zip(phrases, parser.bits, strict=True)])
    assert parser.predict(run)[0] == "bb" and parser.predict(run[:65_000])[0] == "aa"
