"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sources get word targets by weight, capped at ``cap`` times their size. A
source's documents lie in permuted blocks (by hash; about the square root of
its documents per block, and as many blocks). A target is met by whole passes
over the source and one partial pass: blocks in permuted order until the
target, the last one document by document, and then the one addition or swap
of documents that comes closest. So each source has an exact quota of block draws. A tree splits
the quotas among output shards: every node hands half of its shards their
share of the draws, the sources of which follow the multivariate
hypergeometric law; the leaves' quotas cut each source's permuted draws into
disjoint ranges. Within a shard the documents are in hash order. The number of
shards follows from the words that are drawn.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import numbered, rows_of, small, text_or_empty, written

WEIGHTS = (5.0, 2.0, 1.0)
#: Drawn words that make a shard (about 32 MB of text); draws of blocks that a shard has on average, at least.
SHARD_WORDS, SHARD_DRAWS = 4_000_000, 4
SPEC = "place int, source string, source_size long, target double, blocks long, whole int, rest double"


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> list[float]:
    """Word targets for sources in order: ``share`` of all words by repeating weights, none above ``cap`` times its size.

    What a cap cuts off goes to the uncapped sources by weight, until no target is above its cap.
    """
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, open_ = share * sum(sizes), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        left = total - sum(cap * sizes[i] for i in range(len(sizes)) if i not in open_)
        weight = sum(w[i] for i in open_)
        for i in open_:
            out[i] = left * w[i] / weight
        over = {i for i in open_ if out[i] > cap * sizes[i]}
        for i in over:
            out[i] = cap * sizes[i]
        if not over:
            break
        open_ -= over
    return out


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Draws of each source in each shard (sources x shards): rows sum to the quotas, columns are even."""
    out = np.zeros((len(quotas), shards), np.int64)

    def split(lo: int, hi: int, q: np.ndarray) -> None:
        if hi - lo == 1:
            out[:, lo] = q
            return
        mid, total = (lo + hi) // 2, int(q.sum())
        draws = total * (mid - lo) // (hi - lo)
        left = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(q, draws, method="marginals")
        split(lo, mid, left)
        split(mid, hi, q - left)

    if len(quotas):
        split(0, shards, np.asarray(quotas, np.int64))
    return out


def document_sizes(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, source, size) for every row; size counts the runs of characters other than ASCII white space."""
    words = F.regexp_count(text_or_empty(), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return numbered(docs, "rid", F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    words.alias("size"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
        shards: int | None = None, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan) of the mix of ``docs`` (doc_id, source, text).

    sizes: one row per document (rid, doc_id, source, size, source_size,
    target). plan: one row per drawn copy (rid, doc_id, copy, shard, key): shard it
    goes to and its place there. Null text has size 0; a null source is one
    of its own, last; null and repeated doc_ids are documents of their own;
    other columns are not read; an empty table gives empty frames. ``shards``
    follow from the drawn words if not given, and from the draws of blocks,
    of which each needs some (see :func:`parts_of` for the texts). Sources
    without words have target 0 and are not drawn. The choice depends on
    doc_id, size and ``seed`` (ties: place in the table), so reruns agree.

    Eager: document sizes are written, and one row per source comes to
    the driver. No window holds more than about the square root of a source's
    documents; the final choice of one document (or swap) per source is a
    minimum with partial aggregation.
    """
    spark = docs.sparkSession
    sizes = written(document_sizes(docs))
    stats = sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).orderBy(
        F.col("source").asc_nulls_last()).collect()
    goal = targets([r["size"] for r in stats], weights, share, cap)
    spec = []
    for i, (r, t) in enumerate(zip(stats, goal)):
        whole = int(t // r["size"]) if r["size"] else 0
        spec.append((i, r["source"], r["size"], float(t), math.isqrt(r["n"]) + 1, whole, float(t - whole * r["size"])))
    spec_df = spark.createDataFrame(spec, SPEC)
    placed = sizes.join(small(spec_df, len(spec)), sizes["source"].eqNullSafe(spec_df["source"])).drop(spec_df["source"])

    own = F.coalesce("doc_id", "rid")
    # rows of a repeated id also go by their place (a null adds nothing to a hash), so that they spread over the blocks
    again = written(sizes.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select(
        F.col("doc_id").alias("again")))
    place_of = F.when(F.col("again").isNotNull(), F.col("rid"))
    mixed = (placed.join(again, F.col("doc_id") == F.col("again"), "left")
             .withColumn("hash", F.xxhash64(F.lit(seed), own, "size", place_of)).drop("again").withColumn("block", F.pmod("hash", "blocks")))
    # ---- blocks in permuted order, pass by pass; the pass after the whole ones is partial
    by_pass = Window.partitionBy("place", "pass").orderBy(F.xxhash64(F.lit(seed), "place", "pass", "block"), "block")
    blocks = (mixed.where("target > 0").groupBy("place", "block", "whole", "rest").agg(F.sum("size").alias("words"))
              .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("whole"))))
              .withColumn("nth", F.row_number().over(by_pass) - 1)
              .withColumn("before", F.sum("words").over(by_pass.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")))
    full = F.col("pass") < F.col("whole")
    drawn = written(blocks.where(full | (F.col("before") < F.col("rest"))).select(
        "place", "block", "pass", "nth",
        F.when(~full & (F.col("before") + F.col("words") > F.col("rest")), F.col("rest") - F.col("before")).alias("gap")))
    per_pass = {(r["place"], r["pass"]): r["n"] for r in drawn.groupBy("place", "pass").agg(F.count("*").alias("n")).collect()}
    first_draw, quotas = [], []
    for i, *_, whole, _ in spec:
        done = 0
        for p in range(whole + 1):
            first_draw.append((i, p, done))
            done += per_pass.get((i, p), 0)
        quotas.append(done)
    shards = shards or max(1, min(math.ceil(sum(goal) / SHARD_WORDS), sum(quotas) // SHARD_DRAWS))
    ends = np.cumsum(split_quotas(quotas, shards, seed), axis=1)
    shard_ends = spark.createDataFrame([(i, p, d, ends[i].tolist()) for i, p, d in first_draw],
                                       "place int, pass int, first long, ends array<long>")
    # ---- documents of the drawn blocks; of a block the target cuts, only those before the cut
    cells = drawn.join(shard_ends, ["place", "pass"]).select(
        "place", "block", "pass", "gap",
        F.expr("size(filter(ends, e -> e <= first + nth))").alias("shard"))
    rows = mixed.select("rid", "doc_id", "place", "block", "hash", "size", "rest", "whole").join(cells, ["place", "block"])
    by_hash = Window.partitionBy("place").orderBy("hash", "rid").rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.where(F.col("gap").isNotNull()).withColumn("upto", F.sum("size").over(by_hash)).withColumn(
        "over", F.col("upto") > F.col("gap")).where("upto - size <= gap")
    names = ["rid", "doc_id", "place", "pass", "whole", "size", "shard", "hash", "over"]
    near = written(rows.where(F.col("gap").isNull()).withColumn("over", F.lit(False)).select(*names).unionByName(
        cut.select(*names)))
    # ---- nearer to the target: one document more, or the first that goes over it instead of one that is in
    partial = near.where(~F.col("over") & (F.col("pass") == F.col("whole")))
    first_over = near.where("over").groupBy("place").agg(F.min(F.struct("size", "rid", "doc_id", "hash")).alias("next"))
    got = partial.groupBy("place").agg(F.sum("size").alias("got")).join(first_over, "place", "full")
    have = {r["place"]: r for r in got.collect()}  # one row per source, as stats
    ends_at = [(i, float(rest - ((have[i]["got"] or 0) if i in have else 0)), have[i]["next"] if i in have else None)
               for i, *_, t, _, _, rest in spec if t > 0]
    short = small(spark.createDataFrame(ends_at, "at int, short double, next struct<size:long,rid:long,doc_id:long,hash:long>"),
                  len(ends_at))
    who = F.struct("rid", "doc_id", "hash").alias("who")
    more = mixed.join(partial.select("rid"), "rid", "left_anti").join(short, F.col("place") == F.col("at")).select(
        "place", "whole", "short", F.abs(F.col("size") - F.col("short")).alias("off"), who, F.lit(None).cast("long").alias("gone"))
    swap = partial.join(short, F.col("place") == F.col("at")).where(F.col("next").isNotNull()).select(
        "place", "whole", "short", F.abs(F.col("next.size") - F.col("size") - F.col("short")).alias("off"),
        F.struct("next.rid", "next.doc_id", "next.hash").alias("who"), F.col("rid").alias("gone"))
    best = written(more.unionByName(swap).where("off < short").groupBy("place").agg(
        F.min(F.struct("off", "who", "gone", "whole")).alias("m")))
    plan = near.where(~F.col("over")).join(
        best.select(F.col("m.gone").alias("rid"), F.col("m.whole").alias("pass")), ["rid", "pass"], "left_anti")
    key = F.xxhash64(F.lit(seed), "hash", "copy").alias("key")
    plan = plan.select("rid", "doc_id", F.col("pass").alias("copy"), "shard", "hash").unionByName(best.select(
        "m.who.rid", "m.who.doc_id", F.col("m.whole").alias("copy"), F.pmod("m.who.hash", F.lit(shards)).cast("int").alias("shard"),
        "m.who.hash"))
    return (placed.select("rid", "doc_id", "source", "size", "source_size", "target"),
            plan.select("rid", "doc_id", "copy", "shard", key))


def taken(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document: the words the mix takes of it, repeats counted."""
    copies = plan.groupBy("rid").agg(F.count("*").alias("copies"))
    return sizes.join(copies, "rid", "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("copies", F.lit(0))).alias("taken"))


def parts_of(plan: DataFrame, sizes: DataFrame) -> tuple[int, int]:
    """(shards, slices): the shards of a plan, and the slices by ``key`` that bring each to about ``SHARD_WORDS``."""
    words = sizes.groupBy("source").agg(F.max("target").alias("target")).agg(F.sum("target")).first()[0] or 0.0
    shards = (plan.agg(F.max("shard")).first()[0] or 0) + 1
    return shards, max(1, math.ceil(words / SHARD_WORDS / shards))


def mixed_documents(docs: DataFrame, plan: DataFrame, parts: tuple[int, int]) -> DataFrame:
    """The drawn copies with all columns of ``docs`` (a table as read), shard by shard in hash order.

    Every slice of a shard is a partition of its own (``parts`` as
    :func:`parts_of` gives them), so no two shards meet in one task and the
    size of a task does not grow with the input.
    """
    shards, slices = parts
    found = rows_of(docs, plan, "shard", "key")
    # keys are spread evenly over 64 bits: the upper ones tell the slice
    slice_ = F.least(F.floor((F.col("key").cast("double") / 2.0 ** 64 + 0.5) * slices), F.lit(slices - 1))
    return (found.repartitionById(shards * slices, (F.col("shard") * slices + slice_).cast("int"))
            .sortWithinPartitions("shard", "key", "rid").select("doc.*"))
