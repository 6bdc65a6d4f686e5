"""Exact deduplication by deterministic block naming, in DataFrame functions only.

Texts are normalised and cut into blocks of fixed size. The distinct blocks
are ordered by (64-bit hash, content), and a block's name is its hash with
its rank among the contents of that hash: equal names mean equal contents,
by comparison, not by trust in the hash. Then the names of adjacent blocks
are paired and the pairs named the same way, again and again, until each
document has one name: its identity, free of collisions. (The number of
blocks joins the last pair, so that texts of different length differ.)

Contents travel once, to be compared; names and pairs are small. Where all
contents of a level have hashes of their own (the usual case, checked over
all of them), every rank is 0 and naming needs no join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import numbered, text_or_empty, written

BLOCK = 4096
_hash = F.xxhash64


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _hashed(parts: Column) -> Column:
    return F.transform(parts, lambda p: F.struct(_hash(p).alias("h"), F.lit(0).alias("r")))


def _ranks_of(cells: DataFrame, shared: DataFrame) -> DataFrame:
    """Of (h, part): rank of every part whose hash is in ``shared`` among the parts of that hash, as (h, part, r)."""
    return cells.join(shared, "h", "left_semi").distinct().selectExpr(
        "h", "part", "cast(dense_rank() over (partition by h order by part) - 1 as int) as r")


def _ranked(rows: DataFrame, clashes: DataFrame) -> DataFrame:
    """Name every part of the lists ``parts`` with the ranks of ``clashes``: rows (rid, names)."""
    cells = rows.select("rid", F.posexplode("parts").alias("pos", "part")).withColumn("h", _hash("part"))
    named = cells.join(clashes, ["h", "part"], "left").select(
        "rid", "pos", F.struct("h", F.coalesce("r", F.lit(0)).alias("r")).alias("name"))
    return named.groupBy("rid").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "name"))),
                                                lambda c: c["name"]).alias("names"))


def _level(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Rows (rid, keep..., parts) to (rid, keep..., names)."""
    cells = rows.select(F.explode("parts").alias("part")).select(_hash("part").alias("h"), "part")
    shared = written(cells.distinct().groupBy("h").count().where("count > 1").select("h"))  # hashes of two contents
    plain = rows.select("rid", *keep, _hashed(F.col("parts")).alias("names"))
    if shared.isEmpty():
        return plain
    rows = written(rows)  # read twice below, and its numbers must stay
    return rows.select("rid", *keep).join(_ranked(rows, _ranks_of(cells, shared)), "rid")


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(rid, doc_id, identity, text_sha256) per row of ``docs``; equal identities mean equal normalised texts.

    Eager: runs one job over the texts and one per level of names (their
    number is the logarithm of the longest document's block count).
    """
    norm = normalised(text_or_empty())
    base = numbered(docs, "rid", F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"))
    blocks = F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block), F.lit(0)))
    now = written(_level(base.select("rid", "doc_id", F.sha2("norm", 256).alias("text_sha256"),
                                         blocks.alias("parts")), ["doc_id", "text_sha256"]))
    now = now.withColumn("n", F.size("names"))
    longest = now.agg(F.max("n")).first()[0] or 1
    n = F.size("names")
    halves = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / 2).cast("int")),
        lambda i: F.struct(F.get("names", 2 * i).alias("left"), F.get("names", 2 * i + 1).alias("right")))
    done = now.where("n = 1")
    while longest > 1:  # documents of one name have reached their identity
        open_ = now.where(F.size("names") > 1).select("rid", "doc_id", "text_sha256", "n", halves.alias("parts"))
        longest = (longest + 1) // 2
        now = written(_level(open_, ["doc_id", "text_sha256", "n"]))
        done = done.unionByName(now.where(F.size("names") == 1))
    return done.select("rid", "doc_id", F.struct("n", F.get("names", F.lit(0)).alias("name")).alias("identity"),
                       "text_sha256")


def exact_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(rid, doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (doc_id, text).

    Of equal normalised texts the row of smallest doc_id stays. Null text is
    empty. A null doc_id sorts last: such a row stays only if its group has
    no other id, and keep_id is then null. Rows repeated with the same id and
    text count in group_size, and exactly one of them stays. Other columns are
    not read; an empty table gives no rows. A hot group is pre-aggregated per
    task, and its rows join one small record each, which AQE can split.
    """
    ids = identities(docs, block)
    first = ids.groupBy("identity").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"),
        F.count("*").alias("group_size"))
    return ids.join(first, "identity").select(
        "rid", "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"), "text_sha256")
