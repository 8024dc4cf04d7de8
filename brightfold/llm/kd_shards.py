"""K-d tree sharding: split at weighted medians along the widest metadata dimension.

A node that is to hold s shards is cut at the weighted quantile floor(s/2)/s of its
bytes (the median, if s is even), along the dimension whose values span the largest
part of that dimension's whole range in this node. Leaves reach the target, total
bytes / shards, within about two documents. A text size dimension and one for each
metadata column are used; strings are placed by their CRC-32, which keeps equal values
together.

A cut is found without moving rows: all nodes of a level are histogrammed at once
inside their brackets (literal maps in the plan, no joins), the bracket narrows to the bin that holds the quantile, and
only a bin of few rows (or of one value) is looked at row by row. The low bits of each
value are a hash of the id, so a value that a third of the rows share is cut as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from brightfold.llm.common import written

#: Bytes that a stored record has besides its text.
OVERHEAD = 16
BINS = 2048
FEW_ROWS = 2048
TIE_BITS = 31
ROWS_OF_A_SLOT_GROUP = 50_000


def _code(column: Column, kind: T.DataType) -> Column:
    """Place of a value on a 32-bit axis; null is first."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        placed = F.greatest(F.lit(0), F.least(F.lit((1 << 32) - 1), column.cast("long")))
    else:
        placed = F.crc32(column.cast("string").cast("binary"))
    return F.coalesce(placed, F.lit(0)).cast("long")


def _of(values: dict[int, int], kind: str = "long") -> Column:
    """The node's entry in a literal map, one entry for each tree node at most; null without one."""
    entries = [F.lit(x).cast(t) for n, v in values.items() for x, t in ((n, "long"), (v, kind))]
    return F.try_element_at(F.create_map(*entries), F.col("node"))


def _key(dims: list[str]) -> Column:
    """The value along the node's dimension."""
    return F.element_at(F.array(*dims), (F.col("dim") + 1).cast("int"))


def _inside(placed: DataFrame, dims: list[str], states: dict[int, list]) -> DataFrame:
    """Rows inside their node's bracket; states: node to [dim, lowest, highest, ...]."""
    columns = {
        "dim": _of({n: s[0] for n, s in states.items()}, "int"),
        "lo": _of({n: s[1] for n, s in states.items()}), "hi": _of({n: s[2] for n, s in states.items()}),
        "width": _of({n: (s[2] - s[1]) // BINS + 1 for n, s in states.items()}),
    }
    return placed.withColumns(columns).withColumn("key", _key(dims)).where("key BETWEEN lo AND hi")


def _by_node(rows: list, order: str) -> dict[int, list]:
    """A level's sums by node: at most BINS or FEW_ROWS of each."""
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: r[order]):
        out.setdefault(r["node"], []).append(r)
    return out


def _cuts(placed: DataFrame, dims: list[str], goals: dict[int, tuple[int, int, int, float]]) -> dict[int, tuple[int, int]]:
    """Dimension and last value of the left side for each node; goals: node to (dim, lowest, highest, bytes wanted left)."""
    cuts: dict[int, tuple[int, int]] = {}
    open_ = {node: [dim, lo, hi, 0, want] for node, (dim, lo, hi, want) in goals.items()}
    while open_:
        bins = (
            _inside(placed, dims, open_).groupBy("node", F.expr("(key - lo) div width").alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
        )
        few, of_node = {}, _by_node(bins, "bin")
        for node, state in list(open_.items()):
            dim, lo, hi, before, want = state
            width, own = (hi - lo) // BINS + 1, of_node[node]
            for b in own:
                if before + b["bytes"] >= want or b is own[-1]:
                    break
                before += b["bytes"]
            start = lo + b["bin"] * width
            state[1:4] = [start, min(hi, start + width - 1), before]
            if width == 1:
                cuts[node] = (dim, start if before + b["bytes"] - want <= want - before else start - 1)
                del open_[node]
            elif b["n"] <= FEW_ROWS:
                few[node] = open_.pop(node)
        if few:
            rows = _inside(placed, dims, few).groupBy("node", "key").agg(F.sum("size").alias("bytes")).collect()
            of_node = _by_node(rows, "key")
            for node, (dim, lo, _, before, want) in few.items():
                cut = lo - 1
                for r in of_node[node]:
                    if before + r["bytes"] - want > want - before:
                        break
                    before += r["bytes"]
                    cut = r["key"]
                cuts[node] = (dim, cut)
    return cuts


def shard(docs: DataFrame, shards: int = 40, dimensions: tuple[str, ...] = ("source", "lang"),
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 bytes of the text plus 16; a null text counts no bytes and has a null
    checksum. The law is `bytes`: shards of nearly equal size, so grown_shard is null. Slots
    run from 0 without gaps in each shard. Null metadata are the lowest value. Rows that agree
    in id, checksum and metadata stay together. An empty input gives no rows; with fewer
    documents than shards some shards stay empty. Other columns are ignored.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    crc = F.crc32(F.col(text_col).cast("binary"))
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    tie = F.xxhash64(F.col(id_col), crc).bitwiseAND((1 << TIE_BITS) - 1)
    axes = {"_d0": F.least(size, F.lit((1 << 32) - 1))}
    axes |= {f"_d{i}": _code(F.col(c), docs.schema[c].dataType) for i, c in enumerate(dimensions, 1)}
    dims = list(axes)
    slim = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (size + OVERHEAD).alias("size"), crc.alias("text_crc32"),
        *(F.shiftleft(v, TIE_BITS).bitwiseOR(tie).alias(k) for k, v in axes.items()),
    ), "op4-slim")
    placed, whole = slim.withColumn("node", F.lit(0).cast("long")), None
    tree = {0: (0, shards)}
    while any(s > 1 for _, s in tree.values()):
        stats = placed.groupBy("node").agg(F.sum("size").alias("bytes"), *(
            f(d).alias(f"{n}{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max)))).collect()
        if not stats:
            break
        whole = whole or {d: max(1, stats[0][f"hi{d}"] - stats[0][f"lo{d}"]) for d in dims}
        goals = {}
        for r in stats:
            first, s = tree[r["node"]]
            if s > 1:
                widest = max(range(len(dims)), key=lambda i: ((r[f"hi{dims[i]}"] - r[f"lo{dims[i]}"]) / whole[dims[i]], -i))
                goals[r["node"]] = (widest, r[f"lo{dims[widest]}"], r[f"hi{dims[widest]}"], r["bytes"] * (s // 2) / s)
        if not goals:
            break
        cuts = _cuts(placed, dims, goals)
        rules = {"dim": _of({n: d for n, (d, _) in cuts.items()}, "int"), "cut": _of({n: c for n, (_, c) in cuts.items()})}
        placed = written(placed.withColumns(rules).withColumn(
            "node", F.when(F.col("cut").isNull(), F.col("node") * 2 + 1)
            .otherwise(F.col("node") * 2 + 1 + (_key(dims) > F.col("cut")).cast("long"))).drop("dim", "cut"), "op4-level")
        # a node of one shard goes on as its own left child
        tree = {2 * n + 1 + right: part for n, (first, s) in tree.items()
                for right, part in ((0, (first, s // 2 if s > 1 else 1)), (1, (first + s // 2, s - s // 2))) if s > 1 or not right}
    leaf = _of({n: first for n, (first, _) in tree.items()}, "int")
    groups = max(1, slim.count() // (shards * ROWS_OF_A_SLOT_GROUP) + 1)
    out = placed.select(
        "doc_id", "size", "text_crc32", leaf.alias("shard"),
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(groups)).alias("part"))
    counts = out.groupBy("shard", "part").count()
    ahead = counts.withColumn("ahead", F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")) - 1
    return out.withColumn("nth", nth).join(ahead, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("ahead") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
