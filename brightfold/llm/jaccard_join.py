"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Sets. A document's set holds the distinct hashes of its 5-word shingles. Documents of
one set form a class, represented by the smallest id.

Prefixes. Shingles are ordered by estimated document frequency, rare ones first. Two
sets with Jaccard 0.8 or more share at least o = ceil(0.8 n) shingles, n being either
size; so their first n - o + l shingles share at least l, for any l up to o. Each
document picks its own l: it lengthens its prefix while the estimated cost (postings
read, plus postings / l candidates at the price of one verification each) falls. Of two
documents the smaller l holds, since the longer prefix contains the shorter one. The
smaller document of a pair needs less: any partner at least as large shares 8/9 of its
shingles, so only its first n - ceil(8n/9) + l count. What both prefixes leave bounds the
shingles that can follow, and so the matches that a pair of given sizes needs.

Frequencies are counted over all documents in a fixed table of hashed counters (2**18,
summed in Spark), less the median counter, which is what chance collisions add. They set
the order and the costs only; any order gives the same links.

Components without all pairs. Shared postings first tie each document to the one it
shares most prefix shingles with among its shingles' smallest and largest holders; then,
as long as that finds links, to one in another component that has most links so far: at
most two candidates a document and round, verified. Every pair that these ties leave in
different components is then joined on its shingles, counted, held against l and verified. Each
such pair has a member outside the shingle's largest component, so one side of the join
is without that component and a group of near copies isn't paired with itself.

Sketches. A set's sketch holds the parities of its shingles in 1,024 hashed cells. Two
sketches differ in at most as many cells as the sets do in shingles, and sets that link
differ in a ninth of both sizes at most. So pairs whose sketches differ in more leave the
joins before they are counted, and never reach their texts; no link is lost. Between
sets too large for their cells the bound says nothing and the other conditions decide.
The rounds of ties, which read a shingle's holders often, take the sketch folded to 256
cells (parities of cells are sums of parities); the last join takes it whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brightfold.llm.common import LAST_ID, Chunk, bucketed, buckets_for, chunks, combine, grams, written
from brightfold.llm.graph import components
from brightfold.llm.packed import PACKED, found, frames, pack

SHINGLE = 5
COUNTERS = 1 << 18
#: Longest multi-match; price of verifying a candidate, in postings read for each shingle of the document.
MOST_MATCHES = 8
VERIFY_PRICE = 0.25

#: Cells of a sketch and of a folded one, in 64-bit parts.
CELLS, FOLDED = 1024, 256
PARTS = [f"s{i}" for i in range(CELLS // 64)]
FOLDED_PARTS = PARTS[: FOLDED // 64]

SKETCH = "struct<n: int, " + ", ".join(f"{p}: long" for p in PARTS) + ">"
SEEN = "row long, n int, high long, low long, counter int, df long, whole " + SKETCH


def shingle_sets(chunk: Chunk) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a chunk."""
    all_ = grams(chunk.ids, SHINGLE)
    out = []
    for start, length in zip(chunk.starts, chunk.lengths):
        if length >= SHINGLE:
            out.append(np.unique(all_[start : start + length - SHINGLE + 1]))
        else:
            out.append(grams(chunk.ids[start : start + length], int(length)) if length else np.zeros(0, np.uint64))
    return out


def overlap_needed(n: int) -> int:
    """Shingles that a set of n shares with any set it links to, at least."""
    return (4 * n + 4) // 5


def overlap_of_smaller(n: int) -> int:
    """Shingles that a set of n shares with a set it links to that is not smaller, at least."""
    return (8 * n + 8) // 9


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles in each cell, as 64-bit parts."""
    cells = np.bincount((shingles >> np.uint64(24)).astype(np.int64) % CELLS, minlength=CELLS) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, 128-bit hash and sketch of every document's set; and the counters of all shingles met."""
    counts = np.zeros(COUNTERS, np.int64)
    names = ["row", "n", "high", "low", "counter", "df", "whole"]
    for chunk in chunks(batches, lower=True):
        sets = shingle_sets(chunk)
        if sum(map(len, sets)):
            counts += np.bincount(np.concatenate(sets) % np.uint64(COUNTERS), minlength=COUNTERS)
        digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        signed = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
        parts = np.array([sketch(s) for s in sets]).reshape(len(sets), len(PARTS)).T
        n = pa.array(np.array(list(map(len, sets)), np.int32))
        whole = pa.StructArray.from_arrays([n, *[pa.array(np.ascontiguousarray(p)) for p in parts]], ["n", *PARTS])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array([r["row"] for r in chunk.rows], np.int64)), n, signed([d >> 64 for d in digests]),
            signed([d & (2**64 - 1) for d in digests]), pa.array(np.full(len(sets), -1, np.int32)),
            pa.array(np.zeros(len(sets), np.int64)), whole], names)
    at = np.flatnonzero(counts)
    zero = pa.array(np.zeros(len(at), np.int64))
    none = pa.nulls(len(at), pa.struct([("n", pa.int32()), *[(p, pa.int64()) for p in PARTS]]))
    yield pa.RecordBatch.from_arrays(
        [zero, zero.cast(pa.int32()), zero, zero, pa.array(at.astype(np.int32)), pa.array(counts[at]), none], names)


def prefix(shingles: np.ndarray, df: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix that a document picks, and each entry's mark; df is its shingles' estimated frequencies.

    A mark holds the size, the matches (below 16) and whether the entry counts when the
    document is the smaller of a pair.
    """
    n = len(shingles)
    order = np.lexsort((shingles, df))
    shortest, most = n - overlap_needed(n), min(MOST_MATCHES, overlap_needed(n))
    read = np.cumsum((df[order[: shortest + most]] - 1).astype(float))[shortest:]
    matches = np.arange(1, most + 1)
    cost = read + VERIFY_PRICE * n * read / matches
    l = int(np.argmin(cost)) + 1
    taken = shingles[order[: shortest + l]]
    return taken, (n * 16 + l) * 2 + (np.arange(len(taken)) < n - overlap_of_smaller(n) + l)


def _postings(buckets: int, df):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        table = df.value
        for chunk in chunks(batches, lower=True):
            keys, rows, spots = [], [], []
            for r, s in zip(chunk.rows, shingle_sets(chunk)):
                if len(s):
                    taken, marks = prefix(s, table[(s % np.uint64(COUNTERS)).astype(np.int64)])
                    keys.append(taken)
                    rows.append(np.full(len(taken), r["row"], np.int64))
                    spots.append(marks)
            if keys:
                rows = np.concatenate(rows)
                yield pack("shared", buckets, np.concatenate(keys), rows, rows, np.concatenate(spots), keyed=True)

    return lambda batches: (pa.RecordBatch.from_pandas(x, preserve_index=False) for x in frames(of(batches)))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        rows = [{"a": a, "b": b} for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
        one = pa.RecordBatch.from_pydict({"i": list(range(len(rows))), "text": batch.column("ta")})
        two = pa.RecordBatch.from_pydict({"i": list(range(len(rows))), "text": batch.column("tb")})
        out = []
        sides = ((c.rows, shingle_sets(c)) for side in (one, two) for c in chunks([side], lower=True))
        held: dict[int, np.ndarray] = {}
        for ids, sets in sides:
            for r, s in zip(ids, sets):
                other = held.pop(r["i"], None)
                if other is None:
                    held[r["i"]] = s
                    continue
                both = len(np.intersect1d(s, other, assume_unique=True))
                if both and 100 * both >= 80 * (len(s) + len(other) - both):
                    out.append(rows[r["i"]])
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _folded():
    """The parities of every FOLDED-th cell together, as a sketch of FOLDED cells."""
    step = len(FOLDED_PARTS)
    fold = lambda i: reduce(lambda a, b: a.bitwiseXOR(b), [F.col(f"whole.{p}") for p in PARTS[i::step]])
    return F.struct("whole.n", *[fold(i).alias(p) for i, p in enumerate(FOLDED_PARTS)])


def _alike(x: str, y: str, parts=tuple(FOLDED_PARTS)):
    """What the sketches (n, parts) of two linked sets satisfy."""
    differ = sum((F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in parts), F.lit(0))
    return differ * 9 <= F.col(f"{x}.n") + F.col(f"{y}.n")


def _linked(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) whose texts link; texts move only for pairs whose sketches allow it."""
    ka = sketches.select(F.col("row").alias("a"), F.col("sketch").alias("ka"))
    kb = sketches.select(F.col("row").alias("b"), F.col("sketch").alias("kb"))
    pairs = written(pairs.join(ka, "a").join(kb, "b").where(_alike("ka", "kb")).select("a", "b").distinct(), f"{name}-asked")
    a = texts.select(F.col("row").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("row").alias("b"), F.col("text").alias("tb"))
    return written(pairs.join(a, "a").join(b, "b").mapInArrow(_verify, "a long, b long").distinct(), name)


def _size(spot: str):
    return F.shiftright(spot, 5)


def _matches(spot: str):
    return F.shiftright(spot, 1).bitwiseAND(15)


def _ceil(times: int, by: int, *sizes):
    total = sum(sizes[1:], sizes[0])
    return F.floor((total * times + (by - 1)) / by)


def _fits(x: str, y: str):
    """Sizes that 0.8 allows."""
    return (F.least(_size(x), _size(y)) * 100) >= (F.greatest(_size(x), _size(y)) * 80)


def _apart(postings: DataFrame, of: DataFrame) -> DataFrame:
    """Postings of shingles that documents of several components hold; components only merge, so the rest is settled."""
    placed = postings.join(of, "row", "left").withColumn("component", F.coalesce("component", "row"))
    keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return placed.join(keys.select("key").hint("merge"), "key", "left_semi")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, class_id.

    A to Z are lowered; texts under five words are one shingle; null texts and texts without
    words have no shingle, no links and their own id as component. component_id is the
    smallest id reachable by links, class_id the smallest with the same set. Rows that share
    an id are one node: each keeps its own n_shingles, and their components are one. A null
    id is a node of its own, the largest; it comes out as null. Other columns are ignored.
    """
    spark = docs.sparkSession
    node = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    base = docs.select(node.alias("row"), F.col(text_col).alias("text"))
    seen = written(base.mapInArrow(_seen, SEEN), "op3-seen")
    df = np.zeros(COUNTERS, np.int64)
    for r in seen.where("counter >= 0").groupBy("counter").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r["counter"]] = r["df"]
    df = np.maximum(df - int(np.median(df)), 1)
    seen_sets = seen.where("counter < 0")
    sets = seen_sets.select("row", "n", "high", "low")
    full = sets.where("n > 0")
    classes = full.groupBy("high", "low", "n").agg(F.min("row").alias("class_id"))
    ids = written(full.join(classes, ["high", "low", "n"]).select("row", "n", "class_id"), "op3-classes")
    heads = ids.select(F.col("class_id").alias("row")).distinct()

    sent = spark.sparkContext.broadcast(df.astype(np.int32) if df.max() < 2**31 else df)
    packed = base.mapInArrow(_postings(buckets_for(docs, text_col), sent), PACKED)
    postings = written(found(packed, "shared", keyed=True).join(heads, "row", "left_semi"), "op3-postings")
    shared = postings.select("row").distinct().hint("merge")
    texts = bucketed(base.join(shared, "row", "left_semi"), "op3-texts", "row")
    sketches = written(
        seen_sets.select("row", "whole", _folded().alias("sketch"))
        .join(shared, "row", "left_semi").dropDuplicates(["row", "whole"]), "op3-sketches")
    folded, whole = sketches.select("row", "sketch").distinct(), sketches.select("row", "whole")

    holders = postings.groupBy("key").agg(
        F.min(F.struct("row", "spot")).alias("lo"), F.max(F.struct("row", "spot")).alias("hi")
    ).where("lo.row <> hi.row")
    ties = (
        postings.join(holders, "key").select("row", "spot", F.explode(F.array("lo", "hi")).alias("to"))
        .where("row <> to.row").where(_fits("spot", "to.spot"))
        .groupBy("row", F.col("to.row").alias("to"), (F.col("to.row") < F.col("row")).alias("down")).count()
        .groupBy("row", "down").agg(F.max_by("to", F.struct("count", "to")).alias("to"))
        .select(F.least("row", "to").alias("a"), F.greatest("row", "to").alias("b")).distinct()
    )
    ties = written(ties, "op3-first")
    tied = _linked(ties, folded, texts, "op3-ties")
    of = components(tied, "op3-stars")
    # Bucketed by shingle: the rounds read each shingle's holders where they are.
    tried, live = ties, bucketed(_apart(postings.join(folded, "row"), of), "op3-live", "key")
    while True:
        links = tied.select(F.col("a").alias("row")).union(tied.select("b")).groupBy("row").count()
        placed = live.join(links, "row", "left").withColumn("count", F.coalesce("count", F.lit(0)))
        hubs = placed.groupBy("key").agg(F.max(F.struct("count", "row", "component", "spot", "sketch")).alias("hub")).where("hub.count > 0")
        nearest = (
            placed.join(hubs, "key").where("component <> hub.component").where(_fits("spot", "hub.spot") & _alike("sketch", "hub.sketch"))
            .groupBy("row", F.col("hub.row").alias("to")).agg(F.count("*").alias("shared"))
            .select("row", "to", "shared", F.least("row", "to").alias("a"), F.greatest("row", "to").alias("b"))
            .join(tried, ["a", "b"], "left_anti")
            .groupBy("row").agg(F.max_by("to", F.struct("shared", "to")).alias("to"))
            .select(F.least("row", "to").alias("a"), F.greatest("row", "to").alias("b")).distinct()
        )
        nearest = written(nearest, "op3-hubs")
        fresh = _linked(nearest, folded, texts, "op3-ties")
        gained, asked = fresh.count(), nearest.count()
        if gained:
            of = components(of.select(F.col("row").alias("a"), F.col("component").alias("b")).union(fresh), "op3-stars")
            live = bucketed(_apart(live.drop("component"), of), "op3-live", "key")
        if gained * 20 < asked or not asked:
            break
        tied, tried = written(tied.union(fresh), "op3-ties"), written(tried.union(nearest), "op3-tried")

    main = live.groupBy("key", "component").count().groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"))
    split = written(live.drop("sketch").join(main, "key").join(whole, "row"), "op3-apart")
    minor = split.where("component <> main").select(
        "key", F.col("row").alias("b"), F.col("spot").alias("sb"), F.col("component").alias("cb"), F.col("whole").alias("kb"))
    major = split.select("key", F.col("row").alias("a"), F.col("spot").alias("sa"), F.col("component").alias("ca"), F.col("whole").alias("ka"),
                         (F.col("component") != F.col("main")).alias("small"))
    a_smaller = (_size("sa") < _size("sb")) | ((_size("sa") == _size("sb")) & (F.col("a") < F.col("b")))
    counts = F.when(a_smaller, F.col("sa")).otherwise(F.col("sb")).bitwiseAND(1) == 1
    na, nb = F.greatest(_size("sa"), _size("sb")), F.least(_size("sa"), _size("sb"))
    la = F.when(a_smaller, _matches("sb")).otherwise(_matches("sa"))
    lb = F.when(a_smaller, _matches("sa")).otherwise(_matches("sb"))
    needed = F.greatest(F.least(la, lb), _ceil(4, 9, na, nb) - F.greatest(_ceil(8, 9, nb) - lb, _ceil(4, 5, na) - la))
    rest = (
        major.join(minor, (major["key"] == minor["key"]) & (F.col("ca") != F.col("cb"))
                   & (~F.col("small") | (F.col("a") < F.col("b"))) & _fits("sa", "sb") & counts & _alike("ka", "kb", PARTS))
        .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .agg(F.count("*").alias("shared"), F.max(needed).alias("needed"))
        .where("shared >= needed").select("a", "b")
    )
    more = _linked(rest, folded, texts, "op3-rest")
    several = ids.groupBy("row").agg(F.min("class_id").alias("b"), F.max("class_id").alias("top")).where("b <> top")
    alike = ids.join(several, "row").select(F.col("class_id").alias("a"), "b")
    final = components(
        of.select(F.col("row").alias("a"), F.col("component").alias("b")).union(more).union(alike), "op3-components"
    )

    grouped = (
        ids.join(final.withColumnRenamed("row", "class_id"), "class_id", "left")
        .select("row", "n", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    )
    alone = sets.where("n = 0").select("row", "n", F.col("row").alias("class_id"), F.col("row").alias("component_id"))
    null_last = lambda c: F.nullif(F.col(c), F.lit(LAST_ID)).alias(c)
    return grouped.unionByName(alone).select(
        F.nullif(F.col("row"), F.lit(LAST_ID)).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
        null_last("component_id"), null_last("class_id"),
    )
