"""Substring dedup by recompression: repeated 13-word windows, found through shared symbols.

Rounds. Each round names pairs of neighbouring symbols: a hash bit of its name puts a
symbol into the left or the right half of the alphabet, and a left one followed by a
right one becomes one symbol named after both. Names are hashes of content, so every
task gives equal pairs equal names without a dictionary to exchange, and equal
substrings get equal symbols but for their edges. Equal neighbours lie in one half and
are never paired: a run stays a row of single symbols, since a window cut out of a run
cannot know the run's length.

Interior symbols. After two rounds a symbol has at most four words, and it hangs only
on the words from one before the first-round symbol on its left to one after the
first-round symbol on its right: 5 to 10 words. Any 13 words hold such a symbol with
all it hangs on (left end at the sixth word at the latest, four words, then three).
Each window picks the one of smallest name; picks that occur in two documents or more
are the only places where a window can repeat.

Verification. Documents that have such places return to their words; only the
windows around those are named as a whole (13 words), and the smallest doc_id that has
a window keeps it.

Copies. Equal texts form a class (128-bit hash). The smallest id of a class has all its
windows, so the others lose all their words, or none if they have no window; only the
smallest goes through the rounds, and a symbol that merely copies share isn't shared.

Text moves between executors once, of one document a class, into a table bucketed by row.
Symbols are named in it, and places and repeats come to it, so it doesn't move again.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brightfold.llm.common import LAST_ID, Chunk, bucketed, buckets_for, chunks, combine, grams, mix, written
from brightfold.llm.packed import PACKED, by_row, covered, found, frames, pack

WINDOW = 13
#: Words a symbol of two rounds hangs on, at least.
LEAST_CONTEXT = 5
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Rows a task remembers to send once.
ROWS_SEEN = 1 << 18


def _round(names: np.ndarray, at: np.ndarray, first: np.ndarray, salt: int):
    """One round of pairing; first marks the first symbol of each document."""
    half = mix(names + np.uint64(salt)) & np.uint64(1)
    pair = np.zeros(len(names), bool)
    pair[:-1] = (half[:-1] == 0) & (half[1:] == 1) & ~first[1:]
    second = np.zeros(len(names), bool)
    second[1:] = pair[:-1]
    named = names.copy()
    p = np.flatnonzero(pair)
    named[p] = combine(names[p] + np.uint64(salt), names[p + 1])
    keep = ~second
    return named[keep], at[keep], first[keep]


def interior(chunk: Chunk):
    """Names and widths of interior symbols by the position their context begins at; NONE where none does."""
    n = len(chunk.ids)
    key, width = np.full(n, NONE), np.full(n, 99, np.int64)
    if n == 0:
        return key, width
    head = np.zeros(n, bool)
    head[chunk.starts[chunk.lengths > 0]] = True
    names1, at1, first1 = _round(chunk.ids, np.arange(n), head, 1)
    names2, at2, _ = _round(names1, at1, first1, 2)
    begin, end = np.repeat(chunk.starts, chunk.lengths), np.repeat(chunk.ends, chunk.lengths)
    i = np.searchsorted(at1, at2)
    stop2 = np.append(at2[1:], n)
    j = np.searchsorted(at1, stop2)  # the first-round symbol that follows
    usable = (i > 0) & (j < len(at1))
    i, j, at2, names2 = i[usable], j[usable], at2[usable], names2[usable]
    left = at1[i - 1] - 1
    right = np.append(at1, n)[j + 1] + 1
    inside = (left >= begin[at2]) & (right <= end[at2]) & (right - left <= WINDOW)
    i, j, left, right, names2 = i[inside], j[inside], left[inside], right[inside], names2[inside]
    name = combine(combine(chunk.ids[left], names1[i - 1]), names2)
    name = combine(combine(name, names1[j]), chunk.ids[right - 1])
    key[left], width[left] = np.minimum(name, NONE - np.uint64(1)), right - left
    return key, width


def picked(chunk: Chunk):
    """Positions and names that some window of the chunk picks."""
    key, width = interior(chunk)
    windows = np.flatnonzero(chunk.left() >= WINDOW)
    best, where = np.full(len(windows), NONE), np.zeros(len(windows), np.int64)
    for shift in range(WINDOW - LEAST_CONTEXT + 1):
        at = windows + shift
        value = np.where(width[at] <= WINDOW - shift, key[at], NONE)
        less = value < best
        best[less], where[less] = value[less], at[less]
    at = np.unique(where[best != NONE])
    return at, key[at]


def _symbols(buckets: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for chunk in chunks(batches, lower=False):
            at, key = picked(chunk)
            owner = chunk.owner()[at]
            row = np.array([r["row"] for r in chunk.rows], np.int64)[owner]
            yield pack("shared", buckets, key, row, row, at - chunk.starts[owner])

    return lambda batches: (pa.RecordBatch.from_pandas(x, preserve_index=False) for x in frames(of(batches)))


def _kept(raw: bytes, gone: np.ndarray | None):
    words = raw.split()
    left = words if gone is None else [w for w, g in zip(words, gone) if not g]
    return len(words), len(words) - len(left), left


KNOWN = "row long, high long, low long, n_words long, short_sha256 string"


def _known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a row's class and a copy's result need: hash of the text, number of words, and the hash of the words of a short text."""
    schema = pa.schema([("order", pa.int64()), ("row", pa.int64()), ("high", pa.int64()), ("low", pa.int64()),
                        ("n_words", pa.int64()), ("short_sha256", pa.string())])
    for batch in batches:
        rows = []
        for order, row, text in zip(*(batch.column(c).to_pylist() for c in ("order", "row", "text"))):
            raw = (text or "").encode()
            words, digest = raw.split(), xxhash.xxh3_128_digest(raw)
            high, low = struct.unpack("<qq", digest)
            short = hashlib.sha256(b" ".join(words)).hexdigest() if len(words) < WINDOW else None
            rows.append((order, row, high, low, len(words), short))
        yield pa.RecordBatch.from_pydict({n: [x[i] for x in rows] for i, n in enumerate(schema.names)}, schema=schema)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop rows a task has just seen, so that a row repeated for a third of the table moves some times a task at most."""
    seen: set[int] = set()
    for batch in batches:
        new = []
        for i, row in enumerate(batch.column("row").to_pylist()):
            if row not in seen:
                seen.add(row)
                new.append(i)
        if len(seen) > ROWS_SEEN:
            seen.clear()
        yield batch.take(pa.array(new, pa.int64()))


def _windows(buckets: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for chunk in chunks(batches, lower=False):
            owner = chunk.owner()
            mark = np.zeros(len(chunk.ids) + WINDOW, bool)
            for start, length, r in zip(chunk.starts, chunk.lengths, chunk.rows):
                places = np.asarray(r["places"], np.int64)
                mark[start + places[places < length]] = True
            near = np.zeros(len(chunk.ids), bool)
            for shift in range(WINDOW - LEAST_CONTEXT + 1):
                near |= mark[shift : shift + len(near)]
            at = np.flatnonzero(near & (chunk.left() >= WINDOW))
            key = grams(chunk.ids, WINDOW)[at]
            order = np.array([r["order"] for r in chunk.rows], np.int64)[owner[at]]
            row = np.array([r["row"] for r in chunk.rows], np.int64)[owner[at]]
            yield pack("later_order", buckets, key, order, row, at - chunk.starts[owner[at]])

    return lambda batches: (pa.RecordBatch.from_pandas(x, preserve_index=False) for x in frames(of(batches)))


def _ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            raw = (r["text"] or "").encode()
            gone = covered(r["spots"], WINDOW, len(raw.split())) if r["spots"] else None
            _, removed, left = _kept(raw, gone)
            rows.append((r["row"], removed, hashlib.sha256(b" ".join(left)).hexdigest()))
        yield pa.RecordBatch.from_pydict({n: [x[i] for x in rows] for i, n in enumerate(schema.names)}, schema=schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a 13-word window over it also starts in a document of smaller id.
    Null ids count as the largest id. Null, empty and short texts have no windows and lose
    nothing. Rows of one id do not remove from each other; equal rows get equal results,
    each its own row. Other columns are ignored, whatever their names.
    """
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    base = docs.select(order.alias("order"), F.xxhash64(order, F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    known = written(base.mapInArrow(_known, f"order long, {KNOWN}"), "op5-known")
    heads = written(known.where(F.col("n_words") >= WINDOW).groupBy("high", "low").agg(
        F.min(F.struct("order", "row")).alias("head")).select("head.row"), "op5-heads")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = bucketed(
        base.mapInArrow(_once, "order long, row long, text string").repartition(partitions, "row").join(heads, "row", "left_semi"),
        "op5-texts", "row")
    buckets = buckets_for(texts, "text")
    places = by_row(found(texts.select("row", "text").mapInArrow(_symbols(buckets), PACKED), "shared"))
    open_ = texts.join(places.withColumnRenamed("spots", "places"), "row").select("row", "order", "text", "places")
    repeats = by_row(found(open_.mapInArrow(_windows(buckets), PACKED), "later_order"))
    ended = written(texts.select("row", "text").join(repeats, "row", "left").mapInArrow(
        _ending, "row long, n_removed long, kept_sha256 string").dropDuplicates(["row"]), "op5-ended")
    nothing = hashlib.sha256().hexdigest()
    short = F.col("n_words") < WINDOW
    return known.join(ended, "row", "left").select(
        F.nullif(F.col("order"), F.lit(LAST_ID)).alias("doc_id"), "n_words",
        F.when(short, F.lit(0).cast("long")).otherwise(F.coalesce("n_removed", "n_words")).alias("n_removed"),
        F.when(short, F.col("short_sha256")).otherwise(F.coalesce("kept_sha256", F.lit(nothing))).alias("kept_sha256"))
