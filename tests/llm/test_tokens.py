"""Prefix token counts and the piece codec, against the libraries of the vocabularies."""

import random

import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from isodose.llm import piece_codec, prefix_tokens
from isodose.llm.bpe import Borders, HashTable

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = st.sampled_from(
    ["a", "the", " ", "  ", "   ", "\n", "\r", "\t", "é", "漢", "😀", "▁", "1", "'s", "'", "re", "<s>", "<0x41>", "<|endoftext|>", "\0", "*/", "Становништво", "\x85", "!!", "aaaa"]
)


@pytest.fixture(scope="module")
def counter():
    return prefix_tokens.PrefixCounter(BYTES)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def codec():
    return piece_codec.PieceCodec(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_counts_are_the_librarys(counter, tokenizer, text):
    assert counter.counts([text]) == [len(tokenizer.encode(text, add_special_tokens=False).ids)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdefghinorst", min_size=1, max_size=24))
def test_every_prefix_of_a_word(counter, tokenizer, word):
    counts = counter.prefix_counts(word)
    assert counts.tolist() == [len(tokenizer.encode(word[:i], add_special_tokens=False).ids) for i in range(len(word) + 1)]
    assert counter.table(word.encode()) == counts.tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join), st.integers(0, 6))
def test_fit_is_within_budget(counter, text, budget):
    size = counter.fit(text, budget)
    raw = text.encode()
    raw[:size].decode()  # whole characters
    assert counter.prefix_counts(text)[size] <= budget or size == 0
    if counter.counts([text])[0] <= budget:
        assert size == len(raw)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=14).map("".join), max_size=4))
def test_pieces_are_the_librarys(codec, library, texts):
    rows = codec.encode(texts)
    assert [r.tolist() for r in rows] == library.encode(texts)
    assert codec.decode(rows) == [library.decode(library.encode(t)) for t in texts]


def test_borders_scalar_and_many():
    # 0 a, 1 b, 2 ab, 3 aa, 4 aab
    import numpy as np

    borders = Borders(np.array([-1, -1, 0, 1, 2]), np.array([-1, -1, 0, 0, 3]), np.array([-1, -1, 1, 0, 1]))
    pairs = [(a, b) for a in range(5) for b in range(5)]
    many = borders.hold(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    assert many.tolist() == [borders.holds(a, b) for a, b in pairs]
    assert not borders.holds(0, 1) and borders.holds(1, 0) and not borders.holds(3, 1) and borders.holds(0, 2)


def test_hash_table():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 3000))
    table = HashTable(13)
    table.fill(keys, np.arange(len(keys), dtype=np.int32))
    assert table.find(keys).tolist() == list(range(len(keys)))
    assert set(table.find(keys + (1 << 41)).tolist()) == {-1}


def test_token_counts_edges(spark, make_docs, edge_rows, tokenizer):
    got = prefix_tokens.token_counts(make_docs(edge_rows), BYTES, 1024).collect()
    want = sorted(
        ((r[0], len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in edge_rows), key=repr
    )
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=repr) == want
    assert all(r["fit_bytes"] == r["n_bytes"] for r in got if r["n_tokens"] <= 1024)
    assert prefix_tokens.token_counts(make_docs([]), BYTES, 10).collect() == []


def test_codec_edges(spark, make_docs, edge_rows, library):
    docs = make_docs(edge_rows)
    encoded = piece_codec.encode(docs, PIECES)
    rows = encoded.collect()
    assert sorted((r["doc_id"], r["ids"]) for r in rows if r["doc_id"]) == sorted(
        (r[0], library.encode(r[1] or "")) for r in edge_rows if r[0]
    )
    back = {(r["doc_id"], r["text"]) for r in piece_codec.decode(encoded, PIECES).collect()}
    assert back == {(r[0], (r[1] or "").replace("▁", " ")) for r in edge_rows}
    summary = piece_codec.summarise(docs, PIECES).collect()
    assert len(summary) == len(edge_rows) and all(r["round_trip"] for r in summary)
    assert piece_codec.summarise(make_docs([]), PIECES).collect() == []


def test_long_word_without_breaks(codec, library, counter, tokenizer):
    text = "".join(random.Random(3).choices("abc", k=20_000))
    assert codec.encode([text])[0].tolist() == library.encode(text)
    assert counter.counts([text]) == [len(tokenizer.encode(text, add_special_tokens=False).ids)]
