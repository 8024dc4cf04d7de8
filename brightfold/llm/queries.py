"""One query for each numbered operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from brightfold.llm import (
    decontaminate, jaccard_join, kd_shards, line_dedup, mixing, prefix_trie, quotes, secret_scan, substring_dedup, token_counts,
    topk, toxicity, whitening,
)
from brightfold.llm.common import scratch, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest embeddings of every hundredth one."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, scale=1024, every=100)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after the load, the deletion of exact copies, and a repeated delivery of both."""
    docs = table(spark, sf_dir, "documents")
    rows = written(token_counts.counted(docs, token_counts.token_counter(spark)), "op2-counted")
    version = F.lit("byte_bpe_50k").alias("tokenizer_version")
    load = token_counts.signed(rows, 1, "byte_bpe_50k")
    delete = token_counts.copies(rows).withColumn("tokenizer_version", version)
    ledger = token_counts.Ledger(spark, scratch(spark, "op2-ledger"))
    for batch, deltas in (("load", load), ("copies", delete), ("load", load), ("copies", delete)):
        ledger.commit(batch, deltas)
    return ledger.totals()


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have Jaccard 0.8 or more."""
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards of nearly equal bytes."""
    return kd_shards.shard(table(spark, sf_dir, "documents"), shards=40)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after 13-word windows that an earlier document has are removed."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, with the passage."""
    found = decontaminate.copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that aren't held out."""
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chats read as mail that quotes the turns before: own texts, and what each message answers."""
    return quotes.linked(quotes.quoting(table(spark, sf_dir, "conversations")))


#: Target weights of the production mix; what is not named weighs 1.
WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for three quarters of all tokens, mixed to the target weights, two epochs at most."""
    return mixing.select(table(spark, sf_dir, "documents"), WEIGHTS, share=(3, 4), epochs=2, seed=42)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left after later occurrences of three-line windows are removed."""
    return line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents")).drop("kept")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the base patterns' counts and hash, and all spans."""
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie over all conversations, each led by its hundred's first turns."""
    own = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(own, group=100, heads=6))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every embedding; a deviation beyond 64 bits is null."""
    found = whitening.whitened(table(spark, sf_dir, "embeddings"), components=8)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_token_counts": op2_token_counts,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_kd_shards": op4_kd_shards,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_quotation_links": op8_quotation_links,
    "op9_mixing": op9_mixing,
    "op10_line_dedup": op10_line_dedup,
    "op11_secret_scan": op11_secret_scan,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}
