"""Corpus pipeline: toxicity, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of `documents`. Stages filter by row content (id and text), so equal rows
share a stage's verdict, and columns the stages do not know pass through.

- toxicity: documents scored 0.5 or more go.
- near duplicates: of each component of linked documents the one of smallest id stays.
- decontamination: documents with a copy of a benchmark item go.
- mixing: the documents of three quarters of the tokens left, to the target weights, in one epoch.
- sharding: forty shards of nearly equal bytes, one row per document left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brightfold.llm import decontaminate, jaccard_join, kd_shards, mixing, queries, toxicity
from brightfold.llm.common import written


def free_name(docs: DataFrame, name: str) -> str:
    """The name, lengthened until no column of docs has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def kept_columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, whatever characters their names hold."""
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = free_name(docs, "_toxicity")
    scored = toxicity.with_score(docs, queries.table(spark, sf_dir, "labels"), score)
    return kept_columns(scored.where(F.col(score) < 0.5), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of a document that isn't its component's smallest go; of rows of one id, all stay or go."""
    later = jaccard_join.similar_groups(docs).where("NOT doc_id <=> component_id").select("doc_id").distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("l.doc_id"))
    return kept_columns(docs.alias("d").join(later.alias("l"), same, "left_anti"), docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = decontaminate.copies(docs, queries.table(spark, sf_dir, "benchmark")).select(F.col("row").alias("copy")).distinct()
    same = F.xxhash64("d.doc_id", "d.text") == F.col("c.copy")
    return kept_columns(docs.alias("d").join(copies.alias("c"), same, "left_anti"), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chosen = mixing.select(docs, queries.WEIGHTS, share=(3, 4), epochs=1, seed=42)
    keys = chosen.select("doc_id", "lang", "source").distinct()
    same = F.lit(True)
    for c in keys.columns:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"k.{c}"))
    return kept_columns(docs.alias("d").join(keys.alias("k"), same, "left_semi"), docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kd_shards.shard(docs, shards=40)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Scores of a trained model and shard cuts have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written and read again; null ids and repeated rows pass."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
