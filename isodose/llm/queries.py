"""Registered queries of the corpus operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff_lm, bradley_terry, cross_parse, cube_mix, fill_middle, fm_dedup, itq_neardup, line_rules, lloyd_shards, multiset_hash, ngram_join, piece_codec, prefix_tokens
from .common import held_out

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, installed with Python on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    out = held_out(F.col("doc_id"), 5, 0)
    ranker = bradley_terry.fit(docs.where(~out).join(labels, "doc_id"))
    return bradley_terry.score(docs, ranker).select("doc_id", out.alias("held_out"), "score", "predicted")


def op2_suffix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.summarise(table(spark, sf_dir, "documents"), vocabulary(PIECE_MODEL))


def op3_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return backoff_lm.score(docs, held_out(F.col("doc_id"), 10, 0))


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = ngram_join.link_classes(table(spark, sf_dir, "documents"), width=3, percent=90)
    return classes.select("doc_id", "n_shingles", "component_id")


def op6_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.deduplicate(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_iterative_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_neardup.link_classes(table(spark, sf_dir, "embeddings"))


def op8_cube_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube_mix.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix_tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), 1024)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "fit_bytes")


def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = cross_parse.fit(docs.where(~out), "text", "lang")
    return cross_parse.identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op11_dimension_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lloyd_shards.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5)
    return out.withColumn("centroid_sha256", F.sha2("centroid", 256)).drop("centroid")


def op12_repeated_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.transform(table(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = multiset_hash.compare_edits(table(spark, sf_dir, "documents"))
    return out.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bradley_terry,
        op2_suffix_pieces,
        op3_backoff_automaton,
        op4_line_frequency,
        op5_ngram_join,
        op6_fm_index,
        op7_iterative_quantisation,
        op8_cube_sampling,
        op9_prefix_tokens,
        op10_cross_parsing,
        op11_dimension_lloyd,
        op12_repeated_capture,
        op13_multiset_hash,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Smallest id reachable over ``links`` (a, b) among ``nodes`` (id); a small table is assumed.
_REACH = """
both_ways as (select a, b from links union select b, a from links),
reach(id, other) as (
    select id, id from nodes
    union
    select reach.id, both_ways.b from reach join both_ways on reach.other = both_ways.a
),
least as (select id, min(other) as component_id from reach group by id)"""

def _lloyd_sql(k: int, rounds: int, scale: int, seed: int, dims: int) -> str:
    """Lloyd's rounds written out: one pair of steps after the other."""
    parts = [
        f"""points as materialized (
    select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
    from embeddings where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
c0 as materialized (
    select row_number() over (order by sha256('{seed}:' || coalesce(cast(vec_id as varchar), '')), v) - 1 as cluster, v
    from points qualify cluster < {k}
)"""
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} as materialized (
    select rid, arg_min(cluster, (d, cluster)) as cluster, min(d) as distance from (
        select rid, cluster, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
        from points p cross join c{i} c
    ) group by rid
)""")
        if i < rounds:
            parts.append(f"""m{i} as materialized (
    select cluster, list(((s - ((s % n) + n) % n) // n)::bigint order by dim) as v from (
        select cluster, dim, sum(x) as s, count(*) as n
        from (select cluster, unnest(v) as x, unnest(generate_series(1, {dims})) as dim from points join a{i} using (rid)) group by cluster, dim
    ) group by cluster
),
c{i + 1} as materialized (select cluster, coalesce(m{i}.v, c{i}.v) as v from c{i} left join m{i} using (cluster))""")
    return f"""
with {", ".join(parts)}
select vec_id, cast(cluster as integer) as cluster, distance,
    cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia,
    sha256(array_to_string(c{rounds}.v, ',')) as centroid_sha256
from a{rounds} join points using (rid) join c{rounds} using (cluster)"""


ORACLES: dict[str, str] = {
    "op4_line_frequency": f"""
with docs as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as text, coalesce(source, chr(1)) as site from documents
),
words as (select rid, unnest(regexp_extract_all(text, '{_WORD}')) as word, generate_subscripts(regexp_extract_all(text, '{_WORD}'), 1) as place from docs),
sizes as (select rid, count(*) as n_words, sum(length(word)) as word_chars from words group by rid),
windows as (
    select rid, place, word, lead(word) over w as second, lead(word, 2) over w as third
    from words window w as (partition by rid order by place)
),
twice as (
    select rid, unnest(list(place)) as place from windows where third is not null
    group by rid, word, second, third having count(*) > 1
),
covered as (
    select rid, count(distinct place + step) as n_repeat_words from twice, (values (0), (1), (2)) steps(step) group by rid
),
lines as (
    select rid, site, line, norm from (
        select rid, site, line, regexp_extract_all(translate(line, '{_UPPER}', '{_LOWER}'), '{_WORD}') as norm
        from (select rid, site, unnest(string_split(text, chr(10))) as line from docs)
    ) where len(norm) > 0
),
line_counts as (select rid, count(*) - count(distinct line) as n_dup_lines, min(md5(array_to_string(norm[1:5], ' '))) as mark from lines group by rid),
site_docs as (select site, count(distinct mark) as n from lines join line_counts using (rid) group by site),
common as (
    select site, norm from (
        select site, norm, count(distinct mark) as holders from lines join line_counts using (rid) group by site, norm
    ) join site_docs using (site) where holders > {line_rules.MAX_DOCS} and holders > {line_rules.MAX_SHARE} * n
),
lost as (select rid, sum(len(norm)) as n_removed from lines join common using (site, norm) group by rid),
judged as (
    select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_removed, 0) as n_removed
    from docs left join sizes using (rid) left join covered using (rid) left join line_counts using (rid) left join lost using (rid)
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
    cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_removed <= {1 - line_rules.MIN_LEFT} * n_words as kept
from judged""",
    "op5_ngram_join": f"""
with recursive docs as (
    select doc_id as id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') as words from documents
),
nodes as (select id from docs),
shingles as (
    select distinct id, array_to_string(words[place:place + 2], ' ') as shingle
    from (select id, words, unnest(generate_series(1, greatest(len(words) - 2, 1))) as place from docs where len(words) > 0)
),
sizes as (select id, count(*) as n from shingles group by id),
shared as (
    select x.id as a, y.id as b, count(*) as common from shingles x join shingles y on x.shingle = y.shingle and x.id < y.id group by 1, 2
),
links as (
    select a, b from shared join sizes p on p.id = a join sizes q on q.id = b where 100 * common >= 90 * (p.n + q.n - common)
),
{_REACH}
select id as doc_id, coalesce(n, 0) as n_shingles, component_id from least left join sizes using (id)""",
    "op6_fm_index": f"""
with docs as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as words from documents),
starts as (select rid, words, unnest(generate_series(1, len(words) - 34)) as place from docs where len(words) >= 35),
windows as (select rid, place, md5(array_to_string(words[place:place + 34], ' ')) as content from starts),
repeated as (
    select rid, unnest(list(place)) as place from windows
    where content in (select content from windows group by content having count(*) > 1) group by rid
),
gone as (select distinct rid, place + step as place from repeated, (select unnest(generate_series(0, 34)) as step)),
words as (select rid, unnest(words) as word, unnest(generate_series(1, len(words))) as place from docs where len(words) > 0),
kept as (
    select rid, string_agg(word, ' ' order by place) as text, count(*) as n from words anti join gone using (rid, place) group by rid
)
select doc_id, cast(len(words) as bigint) as n_words, cast(len(words) - coalesce(n, 0) as bigint) as n_removed,
    sha256(coalesce(kept.text, '')) as kept_sha256
from docs left join kept using (rid)""",
    "op7_iterative_quantisation": f"""
with recursive vectors as (select vec_id as id, cast(embedding as double[]) as v from embeddings),
usable as (
    select id, v, sqrt(list_dot_product(v, v)) as size from vectors
    where v is not null and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and list_dot_product(v, v) > 0
),
nodes as (select id from vectors),
links as (
    select x.id as a, y.id as b from usable x join usable y on x.id < y.id and list_dot_product(x.v, y.v) / (x.size * y.size) >= 0.9
),
{_REACH},
degrees as (select id, count(*) as n from (select a as id from links union all select b from links) group by id)
select id as vec_id, coalesce(n, 0) as n_links, component_id, id = component_id as kept from least left join degrees using (id)""",
    "op11_dimension_lloyd": _lloyd_sql(40, 5, 256, 2, 64),
    "op12_repeated_capture": r"""
with docs as (
    select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units
    from documents
),
draws as (
    select *, len(units) as n, ('0x' || h[1:8])::ubigint % (len(units) + 1) as a, ('0x' || h[9:16])::ubigint % (len(units) + 1) as b,
        ('0x' || h[17:24])::ubigint % 100 as h3, ('0x' || h[25:32])::ubigint % 100 as h4
    from docs
),
parts as (
    select doc_id, text, n,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 >= 100 then 'plain'
            when h4 < 50 then 'spm' else 'psm' end as form,
        coalesce(array_to_string(units[1:least(a, b)], ''), '') as p,
        coalesce(array_to_string(units[least(a, b) + 1:greatest(a, b)], ''), '') as m,
        coalesce(array_to_string(units[greatest(a, b) + 1:n], ''), '') as s
    from draws
)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(p) end as prefix_chars,
    case when form <> 'plain' then length(m) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(text) as restored_sha256
from parts""",
}
