"""Mixing sources to target weights by balanced sampling (cube method).

Targets: sources share a budget of words by weight, none above a multiple of its size; what is
above is shared again.  A source that is to give ``f`` times its words repeats every document
``floor(f)`` times and includes it once more with probability ``f - floor(f)``.  These
probabilities are balanced on two totals, documents and words: the flight moves them along the
null-space of the constraints until at most two per group of documents are still fractional.
Groups of bounded size run side by side and hold a few documents back; what is open meets in
further rounds until one group of the source is left; its landing tries all choices for the last
few documents.  A source lands in the round that finds it in one group, whatever the others hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, binary_list, materialise, pick

#: Documents per group of the flight; bounds a task's rows whatever a source holds.
GROUP = 4000
#: The most sources a mix may have: one short row of each is planned on the driver.
MAX_SOURCES = 100_000
#: Documents of a source that stay open for the landing, besides the two the flight leaves.
LANDING = 10
_EPS = 1e-9


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Words wanted per source: ``share`` of all words by weight, at most ``most`` times the own size."""
    caps = [most * s for s in sizes]
    want = [0.0] * len(sizes)
    rest, open_ = share * sum(sizes), [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        weight = sum(weights[i] for i in open_)
        above = [i for i in open_ if rest * weights[i] / weight > caps[i]]
        if not above:
            for i in open_:
                want[i] = rest * weights[i] / weight
            break
        for i in above:
            want[i] = caps[i]
        rest -= sum(caps[i] for i in above)
        open_ = [i for i in open_ if i not in set(above)]
    return want


def flight(prob: np.ndarray, size: np.ndarray, coins: np.random.Generator) -> np.ndarray:
    """Move probabilities to 0 or 1, keeping the totals of documents and words; at most two stay open.

    Three open documents span a direction that changes neither total; they move along it, one way
    or the other with the odds that keep each one's expectation, until one of them is settled.
    """
    prob = prob.copy()
    hand: list[int] = []
    draws = coins.random(len(prob) + 3).tolist()
    p, s = prob.tolist(), size.tolist()
    turn = 0
    for new in range(len(p)):
        if not _EPS < p[new] < 1 - _EPS:
            continue
        hand.append(new)
        if len(hand) < 3:
            continue
        i, j, k = hand
        u = (s[k] - s[j], s[i] - s[k], s[j] - s[i])
        if u == (0, 0, 0):
            u = (1, -1, 0)
        up = min(((1 - p[x]) / d if d > 0 else p[x] / -d) for x, d in zip(hand, u, strict=True) if d)
        down = min((p[x] / d if d > 0 else (1 - p[x]) / -d) for x, d in zip(hand, u, strict=True) if d)
        step = up if draws[turn] * (up + down) < down else -down
        turn += 1
        for x, d in zip(hand, u, strict=True):
            p[x] += step * d
        hand.sort(key=lambda x: abs(p[x] - 0.5))
        p[hand[-1]] = float(round(p[hand[-1]]))  # the one that reached its bound, without rounding errors
        hand = sorted(x for x in hand if _EPS < p[x] < 1 - _EPS)
    return np.array(p)


def landing(prob: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Settle the last open documents: of all choices the one that misses the word total least."""
    open_ = np.flatnonzero((prob > _EPS) & (prob < 1 - _EPS))
    out = np.round(prob)
    if len(open_):
        choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
        words = np.abs((choices - prob[open_]) @ size[open_].astype(float))
        docs = np.abs((choices - prob[open_]).sum(1))
        out[open_] = choices[np.lexsort((docs, np.round(words, 6)))[0]]
    return out


def _fly(most: int):
    def run(group):
        groups = int(group["groups"].iloc[0])
        last = groups == 1
        group = group.drop(columns=["part", "groups"]).sort_values(["order", "size"], kind="stable")
        coins = np.random.default_rng([int(group["order"].iloc[0]) & 0xFFFFFFFF, len(group)])
        size = group["size"].to_numpy(np.int64)
        prob = group["prob"].to_numpy(float)
        # An eighth of a group at most: so there are fewer groups in each round.
        held = LANDING if last else min(-(-LANDING // groups), most // 8)
        flying = len(prob) - held
        if flying > 0:
            prob = np.concatenate([flight(prob[:flying], size[:flying], coins), prob[flying:]])
        if last:
            prob = landing(prob, size)
        return group.assign(prob=prob)

    return run


def _sizes(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, 5000):
        counts = [len(t.split()) if t else 0 for t in binary_list(frame.column(3))]
        yield pa.record_batch(
            [*(frame.column(i) for i in range(3)), pa.array(counts, pa.int64())],
            names=["ident", "source", "content", "size"],
        )


def plan(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    source: str = "source",
    cycle: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    group: int = GROUP,
) -> DataFrame:
    """Per row: id, source, ``content`` (hash of the text), ``size``, ``source_size``, ``target``, ``times``, ``taken``.

    Sources by code point, null last, weigh ``cycle`` repeating.  ``times`` is how often the mix
    repeats the document.  Null and empty texts have size 0 and need no balancing; sources without words get target 0 and give nothing.  Repeated rows are
    documents of their own, but those alike in id and text fly in one group.  The same table gives
    the same mix: order, groups and coins come from content.
    """
    spark = docs.sparkSession
    rows = pick(docs, ident=ident, source=source, text=text).select(
        "ident", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("content"), F.col("text").cast("string").alias("text")
    )
    kind = rows.schema["ident"].dataType.simpleString()
    sized = rows.mapInArrow(_sizes, f"ident {kind}, source string, content long, size long")
    sized = materialise(sized.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")

    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    known = totals.limit(MAX_SOURCES + 1).collect()
    if len(known) > MAX_SOURCES:
        raise ValueError(f"a mix has at most {MAX_SOURCES} sources")
    known.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))
    sizes = [r["source_size"] for r in known]
    wanted = targets(sizes, [cycle[i % len(cycle)] for i in range(len(known))], share, most)
    plans = []
    for place, (row, want) in enumerate(zip(known, wanted, strict=True)):
        times = want / row["source_size"] if row["source_size"] else 0.0
        whole = int(times + _EPS)
        part = max(0.0, times - whole)
        plans.append((row["source"], place, row["source_size"], float(want), whole, part if part > _EPS else 0.0, row["docs"]))
    table = F.broadcast(
        spark.createDataFrame(
            plans, "source string, place int, source_size long, target double, whole int, prob double, docs long"
        )
    )  # one row per source, at most MAX_SOURCES
    joined = sized.withColumnRenamed("source", "_source").join(table, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    rows = joined.withColumn("order", F.xxhash64("ident", "content", F.lit(5)))

    decided = None
    schema = "row long, place int, order long, size long, prob double"
    open_ = rows.where("prob > 0 and size > 0").select("row", "place", "order", "size", "prob")
    for turn in count():
        # Every source is cut into groups of about ``group`` documents by their own hash.
        counts = open_.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / group).alias("groups"))
        rounds = counts.agg(F.max("groups").alias("n")).first()["n"]
        if not rounds:
            break
        dealt = open_.join(F.broadcast(counts), "place").withColumn(
            "part", F.pmod(F.xxhash64("order", F.lit(turn)), F.col("groups"))
        )  # counts: one row per source, at most MAX_SOURCES
        flown = dealt.groupBy("place", "part").applyInPandas(_fly(group), schema)
        flown = materialise(flown, "mix-flight")
        still = (F.col("prob") > _EPS) & (F.col("prob") < 1 - _EPS)
        done = flown.where(~still).select("row", F.round("prob").cast("int").alias("more"))
        decided = done if decided is None else decided.unionByName(done)
        if rounds == 1:
            break
        open_ = flown.where(still)
    if decided is None:
        times = rows.withColumn("times", F.col("whole"))
    else:
        times = rows.join(decided, "row", "left").withColumn("times", F.col("whole") + F.coalesce("more", F.lit(0)))
    return times.select(
        F.col("ident").alias(ident),
        F.col("source").alias(source),
        "content",
        "size",
        "source_size",
        "target",
        "times",
        (F.col("times") * F.col("size")).cast("long").alias("taken"),
        "row",
    )


def mix(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", **options: object) -> DataFrame:
    """The mix itself: every row as often as the plan repeats it, all columns.

    Rows alike in id, source and text share the repeats that were planned for them together.
    """
    per_key = (
        plan(docs, ident, text, source, **options)
        .groupBy(F.col(ident).alias("_ident"), F.col(source).alias("_source"), F.col("content").alias("_content"))
        .agg(F.sum("times").alias("_times"), F.count(F.lit(1)).alias("_rows"))
        .where("_times > 0")
    )
    rows = docs.withColumn("_key", F.xxhash64(text))
    joined = rows.join(
        per_key,
        (rows["_key"] == per_key["_content"])
        & rows[ident].eqNullSafe(per_key["_ident"])
        & rows[source].cast("string").eqNullSafe(per_key["_source"]),
    )
    single = joined.where("_rows = 1").withColumn("_n", F.col("_times"))
    # Of rows alike in all that the plan looks at, the first ones take one repeat more.
    place = F.row_number().over(Window.partitionBy("_ident", "_source", "_content").orderBy("_key"))
    several = joined.where("_rows > 1").withColumn(
        "_n", F.floor(F.col("_times") / F.col("_rows")) + (place <= F.col("_times") % F.col("_rows")).cast("long")
    )
    return (
        single.unionByName(several)
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))))
        .select(*docs.columns)
    )
