"""Token counts: rollups kept by signed deltas, committed in idempotent batches.

A ledger is a folder with one sub-folder for each batch: signed sums by source,
language and tokenizer version. Spark's commit of a write puts the marker _SUCCESS; a
batch counts from then on. A batch that is sent again is not applied again; one whose
write broke off has no marker, is not read, and is replaced when it is sent again.
Totals add up all batches, so inserts, deletes and revised counts are one operation.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: Fixed value: the pre-tokenisation pattern that the byte-level vocabulary was made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ["source", "lang", "tokenizer_version"]
SUMS = ["n_docs", "n_tokens", "n_bytes"]
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def token_counter(spark: SparkSession, path: str = TOKENIZER):
    """Column function that counts a text's tokens; the vocabulary file is read by the driver and sent (about 1 MB)."""
    with open(path, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())

    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, sent.value.splitlines())}
        encoder = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for part in parts:
            yield pd.Series([len(encoder.encode_ordinary(t)) if t else 0 for t in part], dtype="int64")

    of.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(of, "long")


def counted(docs: DataFrame, counter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, source, lang, n_tokens, n_bytes, digest of each row; null and empty texts have no tokens."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), "source", "lang", counter(text).alias("n_tokens"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest"))


def signed(rows: DataFrame, sign: int, version: str) -> DataFrame:
    """Deltas of counted rows: sign 1 inserts, -1 deletes. Revised counts are the old rows at -1 and the new ones at 1."""
    return rows.select(
        "source", "lang", F.lit(version).alias("tokenizer_version"), F.lit(sign).cast("long").alias("n_docs"),
        (F.col("n_tokens") * sign).alias("n_tokens"), (F.col("n_bytes") * sign).alias("n_bytes"))


def summed(deltas: DataFrame) -> DataFrame:
    """Additive totals; null sources and languages are groups of their own."""
    return deltas.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))


class Ledger:
    """Rollup totals in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _file(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """Names of committed batches."""
        root, fs = self._file(self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n for n in names if fs.exists(self._file(f"{self.path}/{n}/_SUCCESS")[0]))

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Add a batch's signed deltas; False if a batch of this name is committed already."""
        if batch in self.batches():
            return False
        summed(deltas).write.mode("overwrite").parquet(f"{self.path}/{batch}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, n_docs, n_tokens, n_bytes over committed batches; groups that are back at nothing go."""
        schema = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long, n_bytes long"
        names = self.batches()
        if not names:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*(f"{self.path}/{n}" for n in names))
        return summed(rows).where("n_docs <> 0 OR n_tokens <> 0 OR n_bytes <> 0")


def copies(rows: DataFrame) -> DataFrame:
    """Deltas (without a version) that take all but each text's first row out, as sums.

    Copies collapse to one row for each text, source and language before they meet, so a
    text that a third of the rows share is no hot group. The row of smallest id stays
    (null last; then by source and language).
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id")
    by_place = rows.where("digest IS NOT NULL").groupBy("digest", "source", "lang").agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_bytes").alias("n_bytes"),
        F.min(order).alias("first"), F.max("n_tokens").alias("one"), F.max("n_bytes").alias("one_bytes"))
    rank = F.struct("first", F.col("source").isNull(), "source", F.col("lang").isNull(), "lang")
    stays = F.row_number().over(Window.partitionBy("digest").orderBy(rank)) == 1
    left = by_place.withColumn("stays", stays.cast("long"))
    return left.select("source", "lang", (F.col("stays") - F.col("n_docs")).alias("n_docs"),
                       (F.col("stays") * F.col("one") - F.col("n_tokens")).alias("n_tokens"),
                       (F.col("stays") * F.col("one_bytes") - F.col("n_bytes")).alias("n_bytes"))
