"""Corpus pipeline: documents to token digests in five stages, each one operator.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written
as Parquet and read again as the next stage's documents. Every stage works
on all rows its predecessor kept; all but the last return the columns of
documents. A stage that drops rows finds them by their place in the table
that it read, so null and repeated doc_ids are handled row by row.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import exact, language, mixing, simhash, trie_bpe
from usagelens.llm.common import rows_of, text_or_empty
from usagelens.llm.queries import tokenizer
from usagelens.session import checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language (``und``: null text, no letter) go; the rest stay as they are."""
    guess = language.predictions(text_or_empty(), language.learn(docs))
    return docs.select(F.struct("*").alias("doc"), guess.alias("p")).where(
        F.col("p.lang_pred") != language.UNDETERMINED).select("doc.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal normalised texts the row of smallest doc_id stays."""
    return rows_of(docs, exact.exact_groups(docs).where("kept")).select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (3-word shingles, 3 bits): one document of each component stays."""
    return rows_of(docs, simhash.simhash_groups(docs, words=3, distance=3).where("kept")).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a row per drawn copy, shard by shard; documents that are not drawn go, others may come twice."""
    sizes, plan = mixing.mix(docs)
    return mixing.mixed_documents(docs, plan, mixing.parts_of(plan, sizes))


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding of every document of the mix."""
    return trie_bpe.bpe_round_trip(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("bpe_round_trip", encode_bpe),
]
#: No SQL form: fingerprints, the language model and the tokenizer are outside SQL; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; each result is a table in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
