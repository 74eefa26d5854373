"""Fill-in-the-middle and multiset fingerprints against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from conftest import words
from pyspark.sql import functions as F

from isodose.llm import fill_middle, multiset_hash
from isodose.llm.multiset_hash import fingerprints, paragraphs


def units(text):
    out, line = [], ""
    for c in text:
        line += c
        if c == "\n":
            out.append(line)
            line = ""
    return out + [line] if line else out


def brute_form(ident, text, rate, spm_rate):
    digest = hashlib.sha256(f"7:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    text = text or ""
    u = units(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return ident, len(u), "plain", None, None, text
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = ("".join(x) for x in (u[:a], u[a:b], u[b:]))
    if h[3] % 100 < spm_rate:
        return ident, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return ident, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


FORM_EDGES = [
    (10, "\n\n\n"),
    (11, "a<P>b\nc"),
    (12, "a<S\n>b<M\n"),
    (13, "<\nP>\n<S\n>\n<"),
    (14, "é\r\n漢😀\x0b x\n"),
    (15, "no line end"),
    (16, "<M>"),
    (17, "\n" * 3000),
    (18, "line\n" * 5000 + "end"),
]


def rows_of(edge_rows):
    rng = random.Random(1)
    many = [(100 + i, "\n".join(" ".join(words(rng, rng.randint(0, 9))) for _ in range(rng.randint(1, 12))), "en", "a") for i in range(150)]
    return edge_rows + [(i, t, "en", "a") for i, t in FORM_EDGES] + many


@pytest.mark.parametrize("rate, spm_rate", [(100, 50), (60, 0), (60, 100), (0, 50)])
def test_forms(spark, make_docs, edge_rows, rate, spm_rate):
    rows = rows_of(edge_rows)
    out = fill_middle.transform(make_docs(rows), rate=rate, spm_rate=spm_rate)
    got = out.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r[:6]) for r in got), key=repr) == sorted((brute_form(r[0], r[1], rate, spm_rate) for r in rows), key=repr)
    assert sorted(((r["doc_id"], r["back"]) for r in got), key=repr) == sorted(((r[0], r[1] or "") for r in rows), key=repr)


def test_long_texts_are_matched_in_pieces():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choices("ab\n", weights=(3, 2, rng.choice((1, 4))), k=rng.randint(0, 60)))
        ends = np.cumsum([len(u) for u in units(text)]).tolist()
        for piece in (1, 2, 5, 100):
            assert fill_middle.unit_ends(text, piece) == ends


def test_no_rows(spark, make_docs):
    assert fill_middle.transform(make_docs([(1, "a", "b", "c")]).limit(0)).collect() == []
    assert multiset_hash.fingerprint(make_docs([(1, "a", "b", "c")]).limit(0)).collect() == []
    assert multiset_hash.compare_edits(make_docs([(1, "a", "b", "c")]).limit(0)).collect() == []


# Fingerprints


def sketch_text(text):
    return fingerprints([paragraphs(text)]).text()[0]


def brute_lanes(text):
    """The sums of one document, one paragraph after the other."""
    import xxhash

    from isodose.llm.common import mix

    exact, lanes = [0] * 8, [0] * 256
    for p in (text or "").encode().split(b"\n") if text else []:
        digest = hashlib.blake2b(p, digest_size=64).digest()
        for i in range(8):
            exact[i] = (exact[i] + int.from_bytes(digest[8 * i : 8 * i + 8], "little")) % 2**64
        w = [np.array([xxhash.xxh64_intdigest(x)], np.uint64) for x in p.split()]
        runs = [w[i : i + 3] for i in range(max(1, len(w) - 2))] if w else []
        for run in runs:
            h = run[0]
            for x in run[1:]:
                h = mix(h, x)
            if len(run) < 3:
                h = mix(h, np.array([len(run)], np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
            lanes[int(h[0]) & 255] += 1 if int(h[0]) >> 32 & 1 else -1
    return exact, [x % 2**32 for x in lanes]


def test_lanes_are_sums_over_paragraphs(edge_rows):
    texts = [r[1] or "" for r in edge_rows] + [t for _, t in FORM_EDGES]
    got = fingerprints([paragraphs(t) for t in texts])
    for i, text in enumerate(texts):
        exact, lanes = brute_lanes(text)
        assert got.exact[i].tolist() == exact
        assert got.lanes[i].tolist() == lanes
        assert got.paragraphs[i] == (len(text.split("\n")) if text else 0)


def test_order_does_not_matter_and_paragraphs_come_and_go():
    rng = random.Random(4)
    lines = [" ".join(words(rng, rng.randint(0, 20))) for _ in range(40)]
    shuffled = lines[:]
    rng.shuffle(shuffled)
    whole, other = fingerprints([lines]), fingerprints([shuffled])
    assert whole.text() == other.text() and whole.likeness(other).tolist() == [1.0]
    part = whole - fingerprints([lines[:7]])
    assert part.text() == fingerprints([lines[7:]]).text()
    assert (part + fingerprints([lines[:7]])).text() == whole.text()
    assert multiset_hash.merged([fingerprints([[x]]) for x in lines]).text() == whole.text()
    texts = {"", "\n", "a", "a\n", "\na", "a b", "a  b", "b a", "a\na", "a\n\n"}
    assert len({sketch_text(t) for t in texts}) == len(texts) - 1  # "a\n" and "\na" are the same paragraphs
    assert sketch_text("a\n") == sketch_text("\na")


def test_likeness_follows_the_shared_shingles():
    rng = random.Random(6)
    errors = []
    for share in (0.0, 0.2, 0.5, 0.8, 0.95):
        for size in (12, 60, 400, 3000):
            a = [" ".join(words(rng, 10)) for _ in range(max(1, size // 10))]
            b = [x if rng.random() < share else " ".join(words(rng, 10)) for x in a]
            sets = [{tuple(w[i : i + 3]) for p in x for w in [p.split()] for i in range(len(w) - 2)} for x in (a, b)]
            true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
            errors.append(abs(float(fingerprints([a]).likeness(fingerprints([b]))[0]) - true))
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.05
    same = "same " * 100_000
    near = fingerprints([[same]]).likeness(fingerprints([[same + "other words here"]]))
    assert near[0] > 0.99  # counts beyond 16 bits do not wrap


def brute_edits(rows, key):
    ordered = sorted(rows, key=key)
    out = []
    for i, (ident, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        own, new, nxt = (fingerprints([paragraphs(t)]) for t in (text, edited, after))
        near = float(own.likeness(new)[0]), float(own.likeness(nxt)[0])
        out.append((ident, len(text), edited, own.text()[0], new.text()[0], *near))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_edits(spark, make_docs, edge_rows, ranges):
    rows = rows_of(edge_rows)
    rows += [(77, "alike\nalike too", "en", "a")] * 60 + [(None, "alike", "en", "a")] * 60  # hot: repeated rows
    docs = make_docs(rows)
    hashes = {t: h for t, h in docs.select("text", F.xxhash64("text")).collect()}
    want = brute_edits([r[:2] for r in rows], lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    got = multiset_hash.compare_edits(docs.repartition(6), ranges=ranges).collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_single_document_follows_itself(spark, make_docs):
    got = multiset_hash.compare_edits(make_docs([(1, "abcdefgh", "en", "a")])).collect()
    assert [(r["edited"], r["near_next"]) for r in got] == [("abcdefab", 1.0)]


def test_fingerprints_of_documents(spark, make_docs, edge_rows):
    got = multiset_hash.fingerprint(make_docs(edge_rows)).collect()
    want = [(r[0], len(paragraphs(r[1] or "")), sketch_text(r[1] or "")) for r in edge_rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
