"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds. Every 3-word n-gram of a test item is counted over all documents (documents that
have it); an item's seeds are the rarer half of its n-grams. Rarity is relative to the
item, so a leaked passage that a third of the corpus holds keeps its seeds.

Passages. Documents are scanned once against the n-grams of a block of items. Hits of
one item whose diagonals lie close together make one passage, cut with room for
insertions on both sides. A passage with a seed is aligned word by word with its item:
match 2, mismatch -1, gap -1. The share of the best possible score decides.

Items come in blocks whose n-gram tables have a fixed size, so what is broadcast is
bounded and a larger benchmark only takes more passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightfold.llm.common import chunks, grams, written

GRAM = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of an item's best score from which a passage counts as a copy.
LEAST_SHARE = 0.5
#: n-grams of one block of items: about 30 MB when broadcast.
BLOCK_GRAMS = 1 << 20

ITEMS = "item_id long, words binary, n int"
HITS = "row long, doc_id long, item int, start int, passage binary, hit binary, gram long, df long"


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, lower=True):
        yield pa.RecordBatch.from_pydict({
            "item_id": pa.array([r["item_id"] for r in chunk.rows], pa.int64()),
            "words": pa.array([chunk.ids[a:b].tobytes() for a, b in zip(chunk.starts, chunk.ends)], pa.binary()),
            "n": pa.array(chunk.lengths.astype(np.int32), pa.int32()),
        })


class Block:
    """n-grams of some items, sorted, each with the items and offsets it is at."""

    def __init__(self, words: list[np.ndarray]):
        self.words = words
        parts = [grams(w, min(GRAM, len(w))) for w in words]
        gram = np.concatenate(parts)
        item = np.repeat(np.arange(len(words)), list(map(len, parts)))
        offset = np.concatenate([np.arange(len(p)) for p in parts])
        by = np.lexsort((offset, item, gram))
        self.gram, self.item, self.offset = gram[by], item[by].astype(np.int32), offset[by].astype(np.int32)
        self.distinct, self.first = np.unique(self.gram, return_index=True)
        self.count = np.diff(np.append(self.first, len(self.gram)))
        self.short = sorted({len(w) for w in words if len(w) < GRAM})


def _hits(block):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("item", pa.int32()), ("start", pa.int32()),
                        ("passage", pa.binary()), ("hit", pa.binary()), ("gram", pa.int64()), ("df", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = block.value
        df = np.zeros(len(b.distinct), np.int64)
        lengths = np.array(list(map(len, b.words)))
        for chunk in chunks(batches, lower=True):
            owner, at, kind = chunk.owner(), [], []
            for n in [*b.short, GRAM]:
                g = grams(chunk.ids, n)
                k = np.minimum(np.searchsorted(b.distinct, g), len(b.distinct) - 1)
                p = np.flatnonzero((b.distinct[k] == g) & (chunk.left()[: len(g)] >= n))
                at.append(p)
                kind.append(k[p])
            at, kind = np.concatenate(at), np.concatenate(kind)
            seen = np.unique(owner[at] * len(b.distinct) + kind)
            df += np.bincount(seen % len(b.distinct), minlength=len(df))
            # one entry for each item and offset of the n-gram
            each = b.count[kind]
            entry = np.repeat(b.first[kind], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            at, kind = np.repeat(at, each), np.repeat(kind, each)
            doc, item = owner[at], b.item[entry]
            diagonal = at - b.offset[entry]
            by = np.lexsort((diagonal, item, doc))
            doc, item, diagonal, kind = doc[by], item[by], diagonal[by], kind[by]
            new = np.ones(len(by), bool)
            near = np.maximum(lengths[item] // 2, GRAM)
            new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > near[1:])
            cut = np.flatnonzero(new)
            ends = np.append(cut[1:], len(by))
            out = []
            for x, y in zip(cut, ends):
                d, i = doc[x], item[x]
                room = max(int(lengths[i]) // 2, GRAM)
                start = max(int(chunk.starts[d]), int(diagonal[x]) - room)
                end = min(int(chunk.ends[d]), int(diagonal[y - 1]) + int(lengths[i]) + room)
                r = chunk.rows[d]
                out.append({"row": r["row"], "doc_id": r["doc_id"], "item": int(i), "start": start - int(chunk.starts[d]),
                            "passage": chunk.ids[start:end].tobytes(), "hit": np.unique(kind[x:y]).astype(np.int32).tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pylist([{"gram": int(k), "df": int(df[k])} for k in at], schema=schema)

    return of


def align(items: list[np.ndarray], passages: list[np.ndarray]):
    """Best local score of each pair, and the passage's word range it ends on (first, last + 1).

    All pairs advance together by one word of their item; a row's gaps along the passage
    are a running maximum. The start of the best path travels with each score.
    """
    wide, high = max(map(len, passages)), max(map(len, items))
    p = np.zeros((len(items), wide), np.uint64)
    q = np.zeros((len(items), high), np.uint64)
    in_p, in_q = np.zeros(p.shape, bool), np.zeros(q.shape, bool)
    for k, (i, s) in enumerate(zip(items, passages)):
        p[k, : len(s)], in_p[k, : len(s)], q[k, : len(i)], in_q[k, : len(i)] = s, True, i, True
    # score and start in one number: a higher score first, then a later start
    base, column = np.int64(wide + 1), np.arange(wide, dtype=np.int64)
    held = np.zeros((len(items), wide + 1), np.int64)
    best, end = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    for j in range(high):
        same = (p == q[:, j, None]) & in_p & in_q[:, j, None]
        diagonal = np.where(held[:, :-1] >= base, held[:, :-1], column) + np.where(same, MATCH, MISMATCH) * base
        row = np.maximum(diagonal, held[:, 1:] + GAP * base)
        row[row < base] = 0
        run = np.where(row > 0, row, np.int64(-1) << 40) - GAP * base * column
        row = np.maximum(np.maximum.accumulate(run, axis=1) + GAP * base * column, 0)
        row[(row < base) | ~in_p | ~in_q[:, j, None]] = 0
        held[:, 1:] = np.where(in_q[:, j, None], row, held[:, 1:])
        top = row.argmax(axis=1)
        value = row[np.arange(len(row)), top]
        better = value > best
        best[better], end[better] = value[better], top[better] + 1
    return best // base, best % base, end


def seeds_of(block: Block, df: np.ndarray) -> np.ndarray:
    """The rarer half of each item's n-grams, as sorted item * distinct n-grams + n-gram."""
    size = len(block.distinct)
    own = np.unique(block.item.astype(np.int64) * size + np.searchsorted(block.distinct, block.gram))
    own = own[np.lexsort((own, df[own % size], own // size))]
    _, first, count = np.unique(own // size, return_index=True, return_counts=True)
    rank = np.arange(len(own)) - np.repeat(first, count)
    return np.sort(own[rank < np.repeat((count + 1) // 2, count)])


def _has(rare: np.ndarray, hits: np.ndarray) -> bool:
    """Whether one of the hits is in the sorted seeds."""
    return bool((rare[np.minimum(np.searchsorted(rare, hits), len(rare) - 1)] == hits).any())


def _aligned(block, seeds, least: float):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("item", pa.int32()), ("score", pa.int32()),
                        ("share", pa.float64()), ("first_word", pa.int32()), ("end_word", pa.int32())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = block.value
        rare = seeds.value
        for batch in batches:
            rows = [r for r in batch.to_pylist()
                    if _has(rare, r["item"] * len(b.distinct) + np.frombuffer(r["hit"], np.int32).astype(np.int64))]
            rows.sort(key=lambda r: len(r["passage"]))
            out = []
            for k in range(0, len(rows), 256):
                some = rows[k : k + 256]
                items = [b.words[r["item"]] for r in some]
                score, first, end = align(items, [np.frombuffer(r["passage"], np.uint64) for r in some])
                for r, i, s, f, e in zip(some, items, score.tolist(), first.tolist(), end.tolist()):
                    if s >= least * MATCH * len(i):
                        out.append({"row": r["row"], "doc_id": r["doc_id"], "item": r["item"], "score": s,
                                    "share": s / (MATCH * len(i)), "first_word": r["start"] + f, "end_word": r["start"] + e})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return of


def _blocks(items: DataFrame) -> Iterator[list]:
    held, size = [], 0
    for r in items.orderBy("item_id", "words").toLocalIterator():
        held.append(r)
        size += r["n"]
        if size >= BLOCK_GRAMS:
            yield held
            held, size = [], 0
    if held:
        yield held


def copies(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SHARE, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Copies of test items: row, doc_id, item_id, score, share, first_word, end_word (one per row and item).

    share is the alignment's score over the item's best possible one; the word range is
    that of the best passage. `row` hashes id and text and serves to filter the input. Items
    under three words are looked up as a whole. Null and empty texts, and empty items, match
    nothing. Equal rows or items give one result each time they differ in id. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    words = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    items = words.mapInArrow(_items, ITEMS).where("n > 0").distinct()
    base = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    result = None
    for rows in _blocks(items):
        local = Block([np.frombuffer(bytes(r["words"]), np.uint64) for r in rows])
        block = spark.sparkContext.broadcast(local)
        hits = written(base.mapInArrow(_hits(block), HITS), "op6-hits")
        df = np.zeros(len(local.distinct), np.int64)
        for r in hits.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("df").alias("df")).toLocalIterator():
            df[r["gram"]] = r["df"]
        rare = spark.sparkContext.broadcast(seeds_of(local, df))
        names = F.array(*[F.lit(r["item_id"]).cast("long") for r in rows]) if len(rows) <= 1000 else None
        passed = hits.where("item IS NOT NULL").select("row", "doc_id", "item", "start", "passage", "hit").mapInArrow(
            _aligned(block, rare, least),
            "row long, doc_id long, item int, score int, share double, first_word int, end_word int")
        if names is None:
            ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
            passed = passed.join(ids, "item")
        else:
            passed = passed.withColumn("item_id", F.element_at(names, F.col("item") + 1))
        result = passed if result is None else result.unionByName(passed)
    out = ["row", "doc_id", "item_id", "score", "share", "first_word", "end_word"]
    if result is None:
        return base.selectExpr("row", "doc_id", "CAST(NULL AS BIGINT) AS item_id", "0 AS score", "CAST(0 AS DOUBLE) AS share",
                               "0 AS first_word", "0 AS end_word").where(F.lit(False))
    best = F.max(F.struct("score", "share", -F.col("first_word"), "end_word", F.col("first_word").alias("f")))
    return result.groupBy("row", "doc_id", "item_id").agg(best.alias("b")).select(
        "row", "doc_id", "item_id", "b.score", "b.share", F.col("b.f").alias("first_word"), "b.end_word").select(*out)
