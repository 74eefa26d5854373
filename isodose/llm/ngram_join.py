"""Similarity join of documents on word n-gram sets (Jaccard), by token-combination prefixes.

A document's n-grams are its tokens.  Tokens are ordered by class: those no other document
holds, rare ones, frequent ones.  If two sets link, each lacks at most ``miss`` of the other's
tokens, so any part of a set that survives ``miss`` deletions has something in common with the
partner.  A prefix is extended until that holds:

* a token of the first class survives nowhere: it counts, and is not indexed;
* a rare token is indexed alone;
* frequent tokens are dealt into ``PARTS`` classes by hash and indexed in pairs of one class: a
  class with c of them loses its last pair only after c - 1 deletions, so it counts c - 1.

Signatures that few documents share give candidate pairs.  Documents that share frequent
signatures form clusters, which are compared in tiles of bounded size, without a row per pair.
Sets are compared exactly; equal sets are compared once, as one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_list, block_of, blocks_for, materialise, mix, pick, starts_of, text_bytes, word_ids
from .components import components
from .exchange import ask_and_answer, pack, unpack

#: A token in more distinct sets than this is frequent.
FREQUENT = 32
#: Classes of frequent tokens.
PARTS = 64
#: Signatures with more holders than this are compared by clusters, not by pairs.
FEW = 64
#: Documents and tokens per side of a tile.
TILE_DOCS, TILE_TOKENS = 1200, 1_000_000

_ALONE = np.uint64(0xA10EA10EA10EA10F)


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Sorted distinct codes of the ``width``-word shingles of each text, lower-cased; a shorter
    text is one shingle, one without words none."""
    words, ids, lengths = word_ids(texts, lower=True)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))[ids]
    code = np.zeros(len(hashes), np.uint64)
    size = len(hashes) - width + 1
    if size > 0:
        full = np.full(size, np.uint64(width))
        for k in range(width):
            full = mix(full, hashes[k : size + k])
        code[:size] = full
    at = starts_of(lengths)
    out = []
    for start, n in zip(at, lengths, strict=False):
        if n >= width:
            out.append(np.unique(code[start : start + n - width + 1]))
        elif n:
            short = np.full(1, np.uint64(n))
            for h in hashes[start : start + n]:
                short = mix(short, np.full(1, h))
            out.append(short)
        else:
            out.append(code[:0])
    return out


def _block_sets(width: int, table: pa.Table) -> tuple[list[np.ndarray], list[str], dict[str, int]]:
    """Sets and set names of a block's rows, and the first row of each distinct set."""
    sets = shingle_sets(binary_list(table["text"]), width)
    names = [xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets]
    first: dict[str, int] = {}
    for i, (name, tokens) in enumerate(zip(names, sets, strict=True)):
        if len(tokens):
            first.setdefault(name, i)
    return sets, names, first


def _tokens(sets: list[np.ndarray], first: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    parts = [sets[i] for i in first.values()]
    return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def signatures(tokens: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """Codes under which a set is indexed; ``classes``: 0 held by no other set, 1 rare, 2 frequent."""
    n = len(tokens)
    need = n - -(-percent * n // 100) + 1
    alone = int((classes == 0).sum())
    if alone >= need:
        return tokens[:0]
    rare = tokens[classes == 1][: need - alone]
    need -= alone + len(rare)
    if need <= 0:
        return rare
    common = tokens[classes == 2]
    part = (common % np.uint64(PARTS)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    nth = np.empty(len(part), np.int64)
    sorted_part = part[order]
    begin = np.flatnonzero(np.r_[True, sorted_part[1:] != sorted_part[:-1]]) if len(part) else np.zeros(0, np.int64)
    nth[order] = np.arange(len(part)) - np.repeat(begin, np.diff(np.r_[begin, len(part)]))
    gained = np.cumsum(nth > 0)
    enough = int(np.searchsorted(gained, need)) + 1
    used = min(enough, len(common))
    pairs = []
    for k in np.unique(part[:used]):
        mine = common[:used][part[:used] == k]
        if len(mine) > 1:
            left, right = np.triu_indices(len(mine), 1)
            pairs.append(mix(mine[left], mine[right]))
    out = [rare, *pairs]
    if not len(gained) or gained[-1] < need:
        # The whole set is too small for pairs alone: such sets also meet by the plain prefix.
        plain = np.concatenate([rare, common])[: n - -(-percent * n // 100) + 1 - alone]
        out.append(mix(plain, np.full(len(plain), _ALONE)))
    return np.unique(np.concatenate(out))


def _index(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: ident, content, n, name of its set; on the block's first row of a set that may
    link with another also the set and its signatures."""
    volume = text_bytes(docs)
    blocks = blocks_for(docs.sparkSession, volume)
    bits = max(8, (blocks - 1).bit_length())
    shift, low = np.uint64(64 - bits), np.uint64(32 - bits)

    def split(tokens):
        return np.searchsorted(tokens >> shift, np.arange((1 << bits) + 1, dtype=np.uint64))

    def ask(table):
        sets, _, first = _block_sets(width, table)
        tokens, counts = _tokens(sets, first)
        at = split(tokens)
        keys, held = (tokens >> low).astype(np.uint32), np.minimum(counts, 255).astype(np.uint8)
        return [pack(keys[a:b], held[a:b]) if b > a else b"" for a, b in zip(at, at[1:], strict=False)]

    def answer(notes):
        opened = [unpack(note, np.uint32, np.uint8) for note in notes]
        keys = np.concatenate([k for k, _ in opened])
        held = np.concatenate([h for _, h in opened]).astype(np.int64)
        _, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse.reshape(-1), held)
        kind = ((total > 1).astype(np.uint8) + (total > FREQUENT).astype(np.uint8))[inverse.reshape(-1)]
        at = starts_of(np.array([len(k) for k, _ in opened]))
        return [kind[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]

    def finish(table, answers):
        sets, names, first = _block_sets(width, table)
        tokens, _ = _tokens(sets, first)
        classes = np.frombuffer(b"".join(answers), np.uint8)
        found: list = [None] * len(sets)
        kept: list = [None] * len(sets)
        for i in first.values():
            codes = signatures(sets[i], classes[np.searchsorted(tokens, sets[i])], percent)
            if len(codes):
                found[i], kept[i] = codes.view(np.int64), sets[i].view(np.int64)
        return pa.table(
            [
                table["ident"],
                table["content"],
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([name if len(s) else None for name, s in zip(names, sets, strict=True)], pa.string()),
                pa.array(found, pa.list_(pa.int64())),
                pa.array(kept, pa.list_(pa.int64())),
            ],
            names=["ident", "content", "n", "name", "codes", "tokens"],
        )

    rows = docs.withColumn("block", block_of(blocks, "ident", "text"))
    kind = rows.schema["ident"].dataType.simpleString()
    return ask_and_answer(
        rows, [(ask, answer)], finish, 1 << bits, f"ident {kind}, content long, n long, name string, codes array<long>, tokens array<long>"
    )


def tile_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of all links among a tile's sets, from exact intersection sizes."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    inverse = inverse.reshape(-1)
    shared = counts[inverse] > 1
    renumber = np.cumsum(counts > 1) - 1
    column, row = renumber[inverse[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    step = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [start, start + step])
        dense = np.zeros((len(sets), step), np.float32)
        dense[row[a:b], column[a:b] - start] = 1
        both += dense @ dense.T
    common = np.rint(both).astype(np.int64)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    unseen, forest = np.ones(len(sets), bool), []
    for root in range(len(sets)):
        open_ = [root] if unseen[root] else []
        unseen[root] = False
        while open_:
            i = open_.pop()
            new = np.flatnonzero(linked[i] & unseen).tolist()
            unseen[new] = False
            forest += [(i, j) for j in new]
            open_ += new
    return forest


def _tile(percent: int):
    def compare(key, table):
        names = table["name"].to_pylist()
        tokens = table["tokens"].combine_chunks()
        values, at = tokens.values.to_numpy(), tokens.offsets.to_numpy()
        found = tile_links([values[a:b] for a, b in zip(at, at[1:], strict=False)], percent) if len(names) > 1 else []
        return pa.table(
            [pa.array([names[i] for i, _ in found], pa.string()), pa.array([names[j] for _, j in found], pa.string())], names=["u", "v"]
        )

    return compare


def link_classes(docs: DataFrame, width: int, percent: int, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``content`` (hash of the text), ``n_shingles``, ``component_id``.

    Texts link when ``100 * intersection >= percent * union`` of their shingle sets; a component
    is named by the smallest id reachable.  Texts that are null or without words have no shingles
    and are components of their own.  Rows without an id count as texts but name nothing: their
    component is null unless another member has an id.  Repeated rows stay.  Other columns are not
    looked at; no link is lost to a cap, long texts are compared whole.
    """
    rows = pick(docs, ident=ident, text=text).select("ident", F.xxhash64("text").alias("content"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    index = materialise(_index(rows, width, percent), "ngram-index")

    sets = index.where("codes is not null").groupBy("name").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("codes").alias("codes"))
    sets = materialise(sets, "ngram-sets")
    postings = sets.select("name", "n", F.explode("codes").alias("code"))
    heads = postings.groupBy("code").agg(F.count(F.lit(1)).alias("holders"), F.min("name").alias("head")).where("holders > 1")
    postings = materialise(postings.join(heads, "code"), "ngram-postings")

    few = postings.where(F.col("holders") <= FEW).select("code", "name", "n")
    other = few.select("code", F.col("name").alias("name2"), F.col("n").alias("n2"))
    pairs = (
        few.join(other, "code")
        .where("name < name2")
        .where((100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")))
        .select("name", "name2")
        .distinct()
    )
    token_sets = sets.select("name", "tokens")
    second = token_sets.select(F.col("name").alias("name2"), F.col("tokens").alias("tokens2"))
    common = F.size(F.array_intersect("tokens", "tokens2"))
    near = (
        pairs.join(token_sets, "name")
        .join(second, "name2")
        .where(100 * common >= percent * (F.size("tokens") + F.size("tokens2") - common))
        .select(F.col("name").alias("u"), F.col("name2").alias("v"))
    )

    shared = postings.where(F.col("holders") > FEW)
    clusters = components(shared.select(F.col("name").alias("u"), F.col("head").alias("v")))
    sized = clusters.join(sets.select("name", "n", "tokens"), clusters["node"] == F.col("name"))
    tiles = (
        sized.groupBy("root")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("volume"))
        .select("root", F.greatest(F.ceil(F.col("docs") / TILE_DOCS), F.ceil(F.col("volume") / TILE_TOKENS)).cast("int").alias("sides"))
    )
    side = F.pmod(F.xxhash64("name", F.lit(3)), F.col("sides")).cast("int")
    placed = sized.join(tiles, "root").withColumn("side", side)
    # A tile holds two sides of a cluster; every two sides meet in one tile, one side alone in its own.
    tiled = placed.select("root", "name", "tokens", "side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("with")).select(
        "root", F.least("side", "with").alias("a"), F.greatest("side", "with").alias("b"), "name", "tokens"
    )
    dense = tiled.groupBy("root", "a", "b").applyInArrow(_tile(percent), "u string, v string")

    joined = components(near.union(dense)).withColumnsRenamed({"node": "name"})
    named = index.where("name is not null").groupBy("name").agg(F.min("ident").alias("least"))
    roots = named.join(joined, "name", "left").withColumn("root", F.coalesce("root", "name"))
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    of_name = roots.join(ids, "root").select("name", "component_id")
    return (
        index.select("ident", "content", "n", "name")
        .join(of_name, "name", "left")
        .select(
            F.col("ident").alias(ident),
            "content",
            F.col("n").alias("n_shingles"),
            F.when(F.col("name").isNull(), F.col("ident")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, all columns: the one whose id names it.

    Rows repeated with that id and an equal text are reduced to one.  Documents without words and
    those without an id have nothing to be compared by and stay.
    """
    judged = link_classes(docs, width, percent, ident, text)
    lost = judged.where(
        F.col("component_id").isNotNull() & F.col(ident).isNotNull() & (F.col("n_shingles") > 0) & (F.col(ident) != F.col("component_id"))
    )
    again = judged.where((F.col(ident) == F.col("component_id")) & (F.col("n_shingles") > 0)).groupBy(ident, "content").count().where("count > 1")
    key = F.xxhash64(text)
    gone = lost.select(F.col(ident).alias("_ident"), F.col("content").alias("_content")).distinct()
    rows = docs.withColumn("_key", key)
    kept = rows.join(gone, (rows["_key"] == gone["_content"]) & (rows[ident] == gone["_ident"]), "left_anti")
    twice = again.select(F.col(ident).alias("_ident"), F.col("content").alias("_content"))
    match = (F.col("_key") == F.col("_content")) & (F.col(ident) == F.col("_ident"))
    single = kept.join(twice, match, "left_anti")
    several = kept.join(twice, match, "left_semi").dropDuplicates([ident, "_key"])
    return single.unionByName(several).select(*docs.columns)
