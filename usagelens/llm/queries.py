"""Queries ``opN_<name>`` over the whole given tables, and the pipeline."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import (
    centroids, chat, embeddings, exact, language, mixing, packing, passages, secret_scan, simhash, token_counts, trie_bpe,
    vector_codes,
)

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op2_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(chat.replay(rows.unionByName(extra))))


@query
def op3_bpe_round_trip(spark, sf_dir):
    return trie_bpe.bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


@query
def op5_exact_dedup(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op6_simhash_dedup(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), words=3, distance=3).select("doc_id", "fingerprint", "component_id")


@query
def op7_embedding_dedup(spark, sf_dir):
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), cut=0.98)


@query
def op8_passage_dedup(spark, sf_dir):
    return passages.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op9_secret_scan(spark, sf_dir):
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


@query
def op10_source_mixing(spark, sf_dir):
    return mixing.taken(*mixing.mix(table(spark, sf_dir, "documents")))


@query
def op11_centroid_clustering(spark, sf_dir):
    return centroids.digests(*centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), k=40, rounds=5, scale=256, dim=64))


@query
def op12_vector_codes(spark, sf_dir):
    return vector_codes.digests(*vector_codes.compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024))


@query
def op13_packing(spark, sf_dir):
    return packing.digests(packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), window=2048, end_id=1))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
