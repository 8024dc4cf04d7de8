"""Shared folders, and words as 64-bit numbers in numpy chunks."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightfold.session import checkpoint_root

#: A word is a longest run of bytes other than ASCII white space; `bytes.split` cuts at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Words held at once by one task, beyond the one document that crosses the mark.
CHUNK_WORDS = 1 << 19
#: Distinct words a task remembers before it starts afresh.
WORDS_KEPT = 300_000
LAST_ID = (1 << 63) - 1

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """Write bucketed by a column that df is partitioned by: later joins on it leave these rows where they are."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, column).option("compression", "zstd").option("path", path).saveAsTable(table)
    return spark.table(table)


def buckets_for(texts: DataFrame, column: str, bytes_each: int = 32 << 20) -> int:
    """Groups for a packed shuffle: their number follows the bytes of all texts."""
    total = texts.agg(F.sum(F.octet_length(column))).first()[0] or 0
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(max(4 * partitions, total // bytes_each + 1))


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers; a bijection, so it adds no collisions."""
    h = values ^ (values >> np.uint64(32))
    h = h * _ODD
    h ^= h >> np.uint64(29)
    h *= _ODD2
    h ^= h >> np.uint64(32)
    return h


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Name of an ordered pair of names."""
    turned = (left << np.uint64(23)) | (left >> np.uint64(41))
    return mix((turned * _ODD2) ^ right)


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position; the last n - 1 positions are left out."""
    count = max(0, len(ids) - n + 1)
    out = mix(ids[:count] + np.uint64(n))
    for j in range(1, n):
        out = combine(out, ids[j : j + count])
    return out


class WordIds(dict):
    """Word (bytes) to 64-bit hash, remembered within the task."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > WORDS_KEPT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@dataclass
class Chunk:
    """Some documents, their words in one array, and each one's first position."""

    rows: list[dict]
    ids: np.ndarray
    lengths: np.ndarray

    def __post_init__(self):
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths

    def owner(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.rows)), self.lengths)

    def left(self) -> np.ndarray:
        """Words from each position to the end of its document."""
        return np.repeat(self.ends, self.lengths) - np.arange(len(self.ids))


def chunks(batches: Iterable[pa.RecordBatch], lower: bool, text: str = "text") -> Iterator[Chunk]:
    """Cut Arrow batches into chunks; rows keep their other columns, and a null text has no words."""
    ids = WordIds()
    for batch in batches:
        others = [c for c in batch.schema.names if c != text]
        columns = {c: batch.column(c).to_pylist() for c in others}
        texts = batch.column(text)
        rows, parts, lengths, held = [], [], [], 0
        for i in range(batch.num_rows):
            value = texts[i]
            raw = value.as_buffer().to_pybytes() if value.is_valid else b""
            words = (raw.lower() if lower else raw).split()
            rows.append({c: columns[c][i] for c in others})
            parts.append(ids.of(words))
            lengths.append(len(words))
            held += len(words)
            if held >= CHUNK_WORDS:
                yield Chunk(rows, np.concatenate(parts), np.array(lengths, np.int64))
                rows, parts, lengths, held = [], [], [], 0
        if rows:
            yield Chunk(rows, np.concatenate(parts), np.array(lengths, np.int64))
