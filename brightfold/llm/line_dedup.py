"""Line dedup: windows of three lines, hashed; later occurrences go, overlaps merged."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightfold.llm.common import CHUNK_WORDS, LAST_ID, WordIds, buckets_for, grams
from brightfold.llm.packed import PACKED, by_row, covered, found, frames, pack

LINES = 3


def _windows(buckets: int):
    def chunk(held) -> pd.DataFrame | None:
        keys, orders, rows, spots = (np.concatenate(x) if x else np.zeros(0) for x in zip(*held))
        return pack("later_spot", buckets, keys, orders, rows, spots)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        ids = WordIds()
        for batch in batches:
            held, lines = [], 0
            for r in batch.to_pylist():
                parts = (r["text"] or "").encode().split(b"\n")
                if len(parts) < LINES:
                    continue
                keys = grams(ids.of(parts), LINES)
                held.append((keys, np.full(len(keys), r["order"], np.int64), np.full(len(keys), r["row"], np.int64),
                             np.arange(len(keys))))
                lines += len(parts)
                if lines >= CHUNK_WORDS:
                    yield chunk(held)
                    held, lines = [], 0
            if held:
                yield chunk(held)

    return lambda batches: (pa.RecordBatch.from_pandas(x, preserve_index=False) for x in frames(of(batches)))


KEPT = "doc_id long, n_lines long, n_removed long, kept_sha256 string, kept string"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_sha256", pa.string()), ("kept", pa.string())])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            lines = [] if r["text"] is None else r["text"].encode().split(b"\n")
            gone = covered(r["spots"], LINES, len(lines))
            left = [x for x, g in zip(lines, gone) if not g]
            kept = b"\n".join(left)
            out.append((r["doc_id"], len(lines), len(lines) - len(left), hashlib.sha256(kept).hexdigest(),
                        None if r["text"] is None else kept.decode()))
        yield pa.RecordBatch.from_pydict({n: [x[i] for x in out] for i, n in enumerate(schema.names)}, schema=schema)


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, kept_sha256, kept.

    Lines end at "\\n" and are compared as they are. Of equal three-line windows the one
    with the smallest (id, line number) stays; all lines that any later one covers go, judged
    on the input. Texts under three lines lose nothing; a null text has no lines and stays
    null. Null ids count as the largest id. Equal rows (same id and text) are one document
    that is present several times and get equal results. Other columns are ignored.
    """
    buckets = buckets_for(docs, text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "row", F.xxhash64("doc_id", "text")
    )
    entries = base.select("row", F.coalesce("doc_id", F.lit(LAST_ID)).alias("order"), "text").mapInArrow(
        _windows(buckets), PACKED
    )
    later = found(entries, "later_spot")
    return base.join(by_row(later), "row", "left").mapInArrow(_remove, KEPT)
