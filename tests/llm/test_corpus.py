"""Line rules, similarity joins, passage removal and mixing against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import CLASHES, edited, words
from pyspark.sql import functions as F

from isodose.llm import cube_mix, fm_dedup, itq_neardup, line_rules, ngram_join
from isodose.llm.components import components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def split(text):
    return (text or "").encode().split()


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# Line rules


def brute_rules(rows, max_docs, max_share, min_left):
    def lines(text):
        return [line for line in (text or "").encode().split(b"\n") if line.split()]

    def norm(line):
        return line.translate(LOWER).split()

    marks = [min((hashlib.md5(b" ".join(norm(x)[:5])).hexdigest() for x in lines(r[1])), default=None) for r in rows]
    holders, hosts = defaultdict(set), defaultdict(set)
    for r, mark in zip(rows, marks, strict=True):
        hosts[r[3]].add(mark) if mark else None
        for line in lines(r[1]):
            holders[r[3], b" ".join(norm(line))].add(mark)
    out = []
    for r in rows:
        w = split(r[1])
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for k in range(3)}
        common = [
            x for x in lines(r[1]) if len(h := holders[r[3], b" ".join(norm(x))]) > max_docs and len(h) > max_share * len(hosts[r[3]])
        ]
        gone = sum(len(x.split()) for x in common)
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        own = lines(r[1])
        clean = "\n".join(x for x in (r[1] or "").split("\n") if x.encode() not in common)
        out.append(
            (
                r[0],
                len(w),
                sum(len(x.decode()) for x in w),
                sum(c in "#*$%&|<>" for c in r[1] or ""),
                len(own) - len(set(own)),
                len(covered),
                gone,
                failed,
                not failed and gone <= (1 - min_left) * len(w),
                clean,
            )
        )
    return out


@pytest.fixture(scope="module")
def rule_rows(edge_rows):
    rng = random.Random(8)
    banners = ["Subscribe now to our | weekly news", "All   RIGHTS reserved # by the owner of it"]
    banners += [" ".join(words(rng, 12)) for _ in range(5)]
    rows = list(edge_rows)
    for i in range(60):
        body = [" ".join(words(rng, rng.choice([4, 15, 30]))) for _ in range(rng.randint(1, 5))]
        extra = [x.lower() if i % 2 else x for x in banners if rng.random() < 0.7] * rng.choice([1, 1, 1, 3])
        rows.append((200 + i, "\n".join(body[:1] + extra + body[1:]), "en", rng.choice(["a", "b", None])))
    copy = "\n".join(" ".join(words(rng, 20)) for _ in range(4))
    rows += [(400 + i, edited(rng, copy, 1) if i % 2 else copy, "en", "a") for i in range(40)]
    return rows


def test_rules_against_brute_force(spark, make_docs, rule_rows):
    limits = {"max_docs": 6, "max_share": 0.1, "min_left": 0.4}
    want = brute_rules(rule_rows, **limits)
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words n_removed base_failed kept".split()
    docs = make_docs(rule_rows)
    got = [tuple(r[n] for n in names) for r in line_rules.verdicts(docs, **limits).collect()]
    assert sorted(got, key=repr) == sorted((w[:-1] for w in want), key=repr)
    assert any(not w[-2] and not w[-3] for w in want) and any(w[6] for w in want if w[-2])
    cleaned = line_rules.clean(docs, **limits)
    assert cleaned.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in cleaned.collect()), key=repr) == sorted(((w[0], w[-1]) for w in want if w[-2]), key=repr)
    # Copies and near copies do not make their own lines boilerplate.
    assert all(w[-2] for w in want if w[0] and w[0] >= 400)


def test_rules_empty_table(make_docs):
    assert line_rules.verdicts(make_docs([])).collect() == []
    assert line_rules.clean(make_docs([])).collect() == []


# N-gram join


def brute_join(rows, width, percent):
    sets = []
    for r in rows:
        w = [x.translate(LOWER) for x in split(r[1])]
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    links = []
    for j in range(len(rows)):
        for i in range(j):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                links.append((i, j))
    root = roots(len(rows), links)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root[i]].append(r[0])
    return [(r[0], len(sets[i]), min(least[root[i]], default=None) if sets[i] else r[0]) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def copy_rows(edge_rows):
    """Groups of copies from two to over a hundred, among texts that share a passage."""
    rng = random.Random(21)
    rows = list(edge_rows)
    shared = " ".join(words(rng, 25))
    for group, size in enumerate([2, 3, 5, 9, 140]):
        base = " ".join(words(rng, rng.choice([12, 60, 90])))
        rows += [(1000 * (group + 1) + i, edited(rng, base, rng.choice([0, 0, 1, 1, 2, 4])), "en", "a") for i in range(size)]
    rows += [(9000 + i, " ".join(words(rng, rng.randint(0, 12)) + [shared] + words(rng, rng.randint(0, 12))), "en", "b") for i in range(90)]
    rows += [(9500 + i, rng.choice(["short TEXT", "Short text", "a", "a b", "a b c"]), "en", "b") for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_join_against_brute_force(spark, make_docs, copy_rows, width, percent):
    got = ngram_join.link_classes(make_docs(copy_rows), width, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_join(copy_rows, width, percent), key=repr)


def test_keep_one(spark, make_docs, copy_rows):
    docs = make_docs(copy_rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = {(d, c) for d, n, c in brute_join(copy_rows, 5, 80) if d is not None and (n == 0 or d == c)}
    got = Counter(r["doc_id"] for r in kept.collect())
    assert {d for d in got if d is not None} == {d for d, _ in want}
    assert got[1] == 1  # a repeated row is a copy
    assert ngram_join.keep_one(make_docs([])).collect() == []


def test_signatures_meet():
    """Any two linked sets share a signature, whatever the classes of their tokens."""
    rng = np.random.default_rng(4)
    for _ in range(400):
        n = int(rng.integers(1, 120))
        universe = np.unique(rng.integers(0, 1 << 62, n + 30).astype(np.uint64))
        kind = rng.choice([1, 2], len(universe), p=[(p := rng.random()), 1 - p]).astype(np.uint8)
        base = rng.choice(len(universe), min(n, len(universe)), replace=False)
        other = base.copy()
        for _ in range(int(rng.integers(0, n // 10 + 1))):
            other[rng.integers(len(other))] = rng.integers(len(universe))
        a, b = np.unique(base), np.unique(other)
        common = len(np.intersect1d(a, b))
        for percent in (80, 90):
            if 100 * common >= percent * (len(a) + len(b) - common):
                x, y = (ngram_join.signatures(universe[s], kind[s], percent) for s in (a, b))
                assert len(np.intersect1d(x, y))


def test_tile_links_connect_exactly():
    rng = np.random.default_rng(6)
    for percent in (80, 90):
        base = np.arange(60, dtype=np.int64)
        sets = [np.unique(np.where(rng.random(60) < 0.04, rng.integers(100, 10_000, 60), base)) for _ in range(50)]
        sets += [np.arange(500, 500 + k) for k in range(1, 8)]
        links = [
            (i, j)
            for j in range(len(sets))
            for i in range(j)
            if 100 * (c := len(np.intersect1d(sets[i], sets[j]))) >= percent * (len(sets[i]) + len(sets[j]) - c)
        ]
        forest = ngram_join.tile_links(sets, percent)
        assert roots(len(sets), forest) == roots(len(sets), links)


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 260)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    root = roots(300, links)
    assert got == {x: root[x] for link in links if link[0] != link[1] for x in link}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# Passages


def brute_passages(rows, length):
    held = Counter()
    for r in rows:
        w = split(r[1])
        held.update(tuple(w[i : i + length]) for i in range(len(w) - length + 1))
    out = []
    for r in rows:
        w = split(r[1])
        gone = {i + k for i in range(len(w) - length + 1) if held[tuple(w[i : i + length])] > 1 for k in range(length)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def passage_rows(edge_rows):
    rng = random.Random(13)
    passages = [" ".join(words(rng, n)) for n in (20, 35, 36, 70, 200)]
    rows = list(edge_rows)
    for i in range(80):
        parts = [" ".join(words(rng, rng.randint(0, 50)))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(passages), " ".join(words(rng, rng.randint(0, 50)))]
        rows.append((500 + i, rng.choice([" ", "\n", "\t "]).join(parts), "en", "a"))
    return rows


@pytest.mark.parametrize("limit", [1, fm_dedup.SPLIT])
def test_passages_against_brute_force(spark, make_docs, passage_rows, limit):
    got = fm_dedup.deduplicate(make_docs(passage_rows), split=limit).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_passages(passage_rows, 35), key=repr)


def test_cut_keeps_the_rest(spark, make_docs, passage_rows):
    docs = make_docs(passage_rows)
    cut = fm_dedup.cut_repeats(docs)
    assert cut.columns == docs.columns
    want = Counter((d, digest) for d, _, _, digest in brute_passages(passage_rows, 35))
    rows = cut.collect()
    assert Counter((r["doc_id"], hashlib.sha256(b" ".join(split(r["text"]))).hexdigest()) for r in rows) == want
    untouched = {(d, t) for (d, t, *_), (_, _, gone, _) in zip(passage_rows, brute_passages(passage_rows, 35), strict=True) if not gone}
    assert untouched <= {(r["doc_id"], r["text"]) for r in rows}
    assert fm_dedup.cut_repeats(make_docs([])).collect() == []


def test_index_counts_patterns():
    rng = np.random.default_rng(9)
    for _ in range(30):
        lengths = rng.integers(1, 30, 12)
        symbols = rng.integers(1, rng.integers(2, 9), lengths.sum())
        weights = rng.integers(1, 4, 12)
        index = fm_dedup.FMIndex(symbols, lengths, weights)
        rows = np.split(symbols, np.cumsum(lengths)[:-1])
        for _ in range(20):
            source = rows[rng.integers(12)]
            a = rng.integers(len(source))
            pattern = source[a : a + rng.integers(1, 6)].tolist()
            low, high = np.array([0]), np.array([index.size])
            for symbol in reversed(pattern):
                low, high = index.extend(np.array([symbol]), low, high)
            want = sum(
                int(w) for row, w in zip(rows, weights, strict=True) for i in range(len(row)) if row[i : i + len(pattern)].tolist() == pattern
            )
            assert index.weight(low, high)[0] == want


# Embeddings


def brute_links(rows):
    good = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 32]
    matrix = np.array([rows[i][1] for i in good], float)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    linked = np.triu(matrix @ matrix.T >= 0.9, 1)
    return [(good[i], good[j]) for i, j in np.argwhere(linked)]


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(17)
    rows = [(i, rng.standard_normal(32).tolist()) for i in range(300)]
    for i in range(60):  # partners at cosines from 0.9 to 1
        v = np.array(rows[i][1])
        noise = rng.standard_normal(32)
        noise -= noise @ v / (v @ v) * v
        c = rng.uniform(0.905, 0.999)
        rows.append((1000 + i, (c * v / np.linalg.norm(v) + (1 - c * c) ** 0.5 * noise / np.linalg.norm(noise)).tolist()))
    hub = rng.standard_normal(32)
    rows += [(2000 + i, (hub + 0.05 * rng.standard_normal(32)).tolist()) for i in range(120)]
    rows += [(3000 + i, rows[5][1]) for i in range(40)]
    bad = [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0] * 5]
    rows += [(4000 + i, v) for i, v in enumerate(bad)] + [(None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *(F.lit(1).alias(c) for c in CLASHES))
    got = {r["vec_id"]: r for r in itq_neardup.link_classes(df).collect()}
    assert len(got) == len(rows)
    links = brute_links(rows)
    degree = Counter(x for link in links for x in link)
    found = sum(r["n_links"] for r in got.values())
    assert 0.9 * 2 * len(links) <= found <= 2 * len(links)  # recall
    assert all(got[rows[i][0]]["n_links"] <= degree[i] for i in range(len(rows)))
    root = roots(len(rows), links)
    near = [i for i in range(len(rows)) if rows[i][0] is not None and (rows[i][0] >= 2000 or rows[i][0] == 5)]
    assert all(got[rows[i][0]]["component_id"] == rows[root[i]][0] for i in near)
    assert all(got[4000 + i]["n_links"] == 0 and got[4000 + i]["kept"] for i in range(len(bad)))
    assert not got[None]["kept"]
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values() if r["vec_id"] is not None)


def test_vectors_empty(spark):
    assert itq_neardup.link_classes(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


# Mixing


def test_targets():
    def plain(sizes, weights, share, most):
        """Resharing step by step."""
        want, left, open_ = {}, share * sum(sizes), set(range(len(sizes)))
        while open_:
            part = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
            over = {i for i in open_ if part[i] > most * sizes[i]}
            if not over:
                return want | part
            for i in over:
                want[i] = most * sizes[i]
                left -= want[i]
            open_ -= over
        return want

    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 1000) for _ in range(rng.randint(1, 9))]
        weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
        want = plain(sizes, weights, 1.5, 2.0)
        assert cube_mix.targets(sizes, weights, 1.5, 2.0) == pytest.approx([want[i] for i in range(len(sizes))])
    assert cube_mix.targets([], [], 1.5, 2.0) == [] and cube_mix.targets([0, 0], [5.0, 2.0], 1.5, 2.0) == [0.0, 0.0]


def test_flight_keeps_totals():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 50, 2000):
        prob, size = np.full(n, 0.37), rng.integers(1, rng.choice([2, 500]), n)
        out = cube_mix.flight(prob, size, np.random.default_rng(n))
        assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
        assert out.sum() == pytest.approx(prob.sum(), abs=1e-6) and out @ size == pytest.approx(prob @ size, rel=1e-9, abs=1e-4)


def test_flight_keeps_expectation():
    size = np.array([3, 5, 8, 13, 21, 34])
    mean = np.mean([cube_mix.flight(np.full(6, 0.4), size, np.random.default_rng(k)) for k in range(4000)], axis=0)
    assert mean == pytest.approx([0.4] * 6, abs=0.03)


def test_mix(spark, make_docs, edge_rows):
    rng = random.Random(31)
    rows = list(edge_rows) + [(100 + i, " ".join(words(rng, rng.randint(1, 120))), "en", rng.choice("abcdef")) for i in range(900)]
    docs = make_docs(rows)
    plan = cube_mix.plan(docs, group=60).collect()  # several rounds of flight
    assert len(plan) == len(rows)
    assert all(r["taken"] == r["times"] * r["size"] and 0 <= r["times"] <= 2 for r in plan)
    by_source = defaultdict(list)
    for r in plan:
        by_source[r["source"]].append(r)
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in by_source[s]) for s in order]
    want = cube_mix.targets(sizes, [(5.0, 2.0, 1.0)[i % 3] for i in range(len(order))], 1.5, 2.0)
    for s, size, target in zip(order, sizes, want, strict=True):
        assert {r["source_size"] for r in by_source[s]} == {size}
        assert [r["target"] for r in by_source[s]] == pytest.approx([target] * len(by_source[s]))
        if len(by_source[s]) > 50:
            assert sum(r["taken"] for r in by_source[s]) == pytest.approx(target, rel=0.01)
    again = cube_mix.plan(docs.repartition(3), group=60).collect()
    key = lambda p: Counter((r["doc_id"], r["source"], r["content"], r["taken"]) for r in p)
    assert key(again) == key(plan)
    mixed = cube_mix.mix(docs, group=60)
    assert mixed.columns == docs.columns
    want_rows = Counter()
    for r in plan:
        want_rows[r["doc_id"], r["source"]] += r["times"]
    assert Counter((r["doc_id"], r["source"]) for r in mixed.collect()) == +want_rows


def test_mix_lands_each_source_by_itself(make_docs):
    """A source's landing has its dozen documents, whatever the other sources hold."""
    rng = random.Random(37)
    rows = [(i, " ".join(words(rng, rng.randint(30, 90))), "en", s) for i, s in enumerate("s" * 40 + "m" * 100 + "l" * 400)]

    def taken(sources):
        # With so large a share every source is to give 1.5 times its words, alone or not.
        plan = cube_mix.plan(make_docs([r for r in rows if r[3] in sources]), share=99.0, most=1.5, group=60).collect()
        return {s: Counter({r["doc_id"]: r["taken"] for r in plan if r["source"] == s}) for s in sources}, plan

    together, plan = taken("sml")
    assert all(together[s] == taken(s)[0][s] for s in "sm")
    for s in "sml":  # of some 4000 choices one comes within a word
        target = next(r["target"] for r in plan if r["source"] == s)
        assert abs(sum(together[s].values()) - target) <= 1


def test_mix_empty(make_docs):
    assert cube_mix.plan(make_docs([])).collect() == [] and cube_mix.mix(make_docs([])).collect() == []
