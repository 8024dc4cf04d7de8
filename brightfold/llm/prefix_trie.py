"""Prefix trie of conversations: sorted sequences, neighbours' common prefixes, and range minima over them.

Sequences. A turn is the 128-bit digest of its role and text, a conversation the string of
its turns' digests. Equal conversations collapse, with their number, before anything is
sorted; the rest is sorted over the cluster into blocks of consecutive sequences. The
common prefix (LCP) of each sequence with the one before it, in turns, is all that later
steps know of the order.

Extents. The conversations that start with the first d turns of sequence i are the widest
run around i in which every LCP is d or more. Each candidate prefix (i, d) finds the run's
left and right end by itself, by binary search over a sparse table of range minima; there
is no stack and no candidate waits for another. A table spans one block. Runs may cross a
block's edge, one for each depth up to the LCP there. Each block hands out what it knows
of these; a second sparse table, of the blocks' minima, names the blocks in which they
start and end, and a join by block, side and depth completes them. What is broadcast
is nine numbers for each block of some BLOCK_TURNS turns.

Nodes. Prefix (i, d) is a node where LCP[i] < d; then i is its run's left end. Its parent
is (i, d - 1), whose run may start farther left. Counts, saved tokens and leaves of a
subtree are differences of running sums at the run's ends; the smallest member is another
range minimum.

Odd input. Null roles and texts are empty; turns are ordered with null first, equal turns
by role and digest, and repeated rows are turns like others. Rows without a conv_id belong
to no conversation and are left out. A conversation without turns is a member of the root.
An empty table has no nodes. Texts are digested where they are read and never move. A
conversation is one row of 24 bytes for each turn. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from brightfold.llm.common import written

#: Bytes of a turn's digest.
TURN = 16
#: Turns of the distinct conversations that share a block, about.
BLOCK_TURNS = 1 << 18
#: Members whose ids travel as one piece.
PIECE_IDS = 1 << 14

ORDERED = "key binary, length long, points array<long>, n long, conv_id long, ends_sha256 string, block int, place long, lcp long"
SUMS = ["members", "weighed", "fresh", "leaves"]
SUMMARY = "block int, smallest long, at_smallest long, members long, weighed long, fresh long, leaves long, conv_id long"
PART = "members long, weighed long, fresh long, leaves long, children long, conv_id long"
EDGE = "block int, side string, depth long, whole boolean, " + PART
TARGETS = "block int, side string, depth long, left_block int, right_block int, " + PART
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NOTHING = hashlib.sha256().hexdigest()


def sequences(df: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (digest, points)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    turns = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct("turn", role.alias("role"), digest.alias("digest"), F.char_length(text).cast("long").alias("points")).alias("t"))
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["points"].alias("points"))).alias("turns"))


def rebuilt(own: DataFrame, group: int, heads: int) -> DataFrame:
    """Each conversation led by its group's first turns.

    Conversation c gets the first h turns of conversation c - c % group, with h the CRC-32
    of c in decimal modulo `heads`, then its own turns after its first h. A join on the
    group's number carries at most heads - 1 turns to at most 2 * group rows.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    none = F.array().cast(own.schema["turns"].dataType)
    first = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("first_id"), F.slice("turns", 1, heads - 1).alias("head"))
    led = own.withColumn("first_id", F.col("conv_id") - F.col("conv_id") % group).join(first, "first_id", "left")
    lead = F.when(h > 0, F.slice(F.coalesce("head", none), F.lit(1), F.greatest(h, F.lit(1)))).otherwise(none)
    rest = F.when(F.size("turns") > h, F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(1)))).otherwise(none)
    return led.select("conv_id", F.concat(lead, rest).alias("turns"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one sequence's members as pieces: (seq, first id, ids, their decimal join)."""
    names = ["seq", "first", "n", "ids"]

    def piece(seq, ids):
        return pa.RecordBatch.from_arrays(
            [pa.array([seq], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([len(ids)], pa.int64()),
             pa.array([",".join(map(str, ids)).encode()], pa.binary())], names)

    seq, ids = None, []
    for batch in batches:
        out = []
        for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (s != seq or len(ids) == PIECE_IDS):
                out.append(piece(seq, ids))
                ids = []
            seq = s
            ids.append(c)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield piece(seq, ids)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one row a sequence; pieces stream through the hash one by one."""
    names = ["seq", "n", "conv_id", "ends_sha256"]
    seq, state, n, first = None, None, 0, 0

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([seq], pa.binary()), pa.array([n], pa.int64()), pa.array([first], pa.int64()), pa.array([state.hexdigest()])], names)

    for batch in batches:
        out = []
        for s, c, m, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if s != seq:
                if state is not None:
                    out.append(row())
                seq, state, n, first = s, hashlib.sha256(ids), m, c
            else:
                state.update(b"," + ids)
                n += m
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if state is not None:
        yield row()


def members(keyed: DataFrame) -> DataFrame:
    """(seq, n, conv_id, ends_sha256) of each distinct sequence.

    Ids are sorted by range, so a sequence that a third of all conversations repeat is
    split over many tasks, which join its ids to pieces; only finished pieces meet, and
    they pass through the hash one after the other.
    """
    spread = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = keyed.select("seq", "conv_id").repartitionByRange(spread, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    pieces = pieces.mapInArrow(_joined, "seq binary, first long, n long, ids binary")
    return pieces.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(
        _hashed, "seq binary, n long, conv_id long, ends_sha256 string")


def _common(a: bytes, b: bytes) -> int:
    """Turns that two strings of digests share at their front."""
    most = min(len(a), len(b)) // TURN
    if a[: most * TURN] == b[: most * TURN]:
        return most
    x, y = (np.frombuffer(s, np.uint8, most * TURN) for s in (a, b))
    return int((x != y).argmax()) // TURN


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds block, place in the block, and LCP with the row before; the block's first row gets -1."""
    block, place, last = TaskContext.get().partitionId(), 0, None
    for batch in batches:
        keys = batch.column(0).to_pylist()
        lcp = [_common(a, b) if a is not None else -1 for a, b in zip([last, *keys], keys)]
        count = len(keys)
        if count:
            last = keys[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(count, block, np.int32)), pa.array(np.arange(place, place + count, dtype=np.int64)),
                 pa.array(lcp, pa.int64())], [*batch.schema.names, "block", "place", "lcp"])
            place += count


class Minima:
    """Sparse table of range minima."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= self.size:
            half, below = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum over each [low, high]; both ends inside and not empty."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][low[at]], self.levels[k][high[at] - (1 << int(k)) + 1])
        return out

    def right(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First place from start on whose value is below depth, or the size."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, step = self.levels[k], 1 << k
            fits = at + step <= self.size
            ok = np.zeros(len(at), bool)
            ok[fits] = table[at[fits]] >= depth[fits]
            at[ok] += step
        return at

    def left(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last place up to start whose value is below depth, or -1."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, step = self.levels[k], 1 << k
            fits = at - step >= -1
            ok = np.zeros(len(at), bool)
            ok[fits] = table[at[fits] - step + 1] >= depth[fits]
            at[ok] -= step
        return at


class Block:
    """One block's sequences in order, with running sums and range minima.

    opening and following are the LCPs across its two edges, -1 at the ends of the table.
    """

    def __init__(self, frame: pd.DataFrame, opening: int, following: int):
        frame = frame.sort_values("place")
        self.opening, self.following, self.size = opening, following, len(frame)
        self.ends = frame["ends_sha256"].to_numpy()
        self.length = frame["length"].to_numpy(np.int64)
        self.lcp = frame["lcp"].to_numpy(np.int64).copy()
        self.lcp[0] = opening
        self.points = np.cumsum(np.concatenate([np.zeros(1, np.int64), *map(np.asarray, frame["points"])]).astype(np.int64))
        self.first = np.cumsum(self.length) - self.length
        rows, n = np.arange(self.size), frame["n"].to_numpy(np.int64)
        self.whole = self.prefix(rows, self.length)
        fresh = self.whole - self.prefix(rows, self.lcp.clip(0))
        leaf = np.append(self.lcp[1:], following) < self.length
        self.sums = {name: np.concatenate([[0], np.cumsum(v)]).astype(np.int64)
                     for name, v in zip(SUMS, (n, n * self.whole, fresh, leaf))}
        self.shared, self.conv = Minima(self.lcp), Minima(frame["conv_id"].to_numpy(np.int64))
        by = np.lexsort((rows, self.lcp))
        self.lcp_places = self.lcp[by] * self.size + by

    def prefix(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Code points of the first `depth` turns of each sequence."""
        return self.points[self.first[at] + depth] - self.points[self.first[at]]

    def run(self, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, ...]:
        """(left end, right end, left open, right open) of the run of each candidate prefix, within the block."""
        low = self.shared.left(at, depth)
        high = self.shared.right(at + 1, depth) - 1
        return np.maximum(low, 0), high, low < 0, (high == self.size - 1) & (self.following >= depth)

    def part(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray, skip: int) -> dict[str, np.ndarray]:
        """Sums over [low, high]; fresh points and children leave out the first `skip` places."""
        out = {name: s[high + 1] - s[low + (skip if name == "fresh" else 0)] for name, s in self.sums.items()}
        count = lambda place: np.searchsorted(self.lcp_places, depth * self.size + place)
        return out | {"children": count(high + 1) - count(low + skip), "conv_id": self.conv.of(low, high)}

    def summary(self) -> dict:
        """The whole block; its first sequence counts, as runs that cover the block began before it."""
        least = self.lcp.min()
        end = {name: int(s[-1]) for name, s in self.sums.items()}
        return {"smallest": int(least), "at_smallest": int((self.lcp == least).sum()), **end, "conv_id": int(self.conv.levels[-1].min())}

    def edges(self) -> pd.DataFrame:
        """The block's part of every run that crosses its left ("L") or right ("R") edge."""
        out = []
        for side, at, most in (("L", 0, self.opening), ("R", self.size - 1, self.following)):
            depth = np.arange(most + 1)
            low, high, left, right = self.run(np.full(len(depth), at), depth)
            # A run that began before the block counts all of it; one that begins here is counted without its first place.
            parts = [self.part(low, high, depth, skip) for skip in (0, 1)]
            part = {name: np.where(left, parts[0][name], parts[1][name]) for name in parts[0]}
            out.append(pd.DataFrame({"side": side, "depth": depth, "whole": left & right, **part}))
        return pd.concat(out, ignore_index=True)

    def nodes(self, edges: pd.DataFrame) -> pd.DataFrame:
        """Every prefix whose run starts in the block; `edges` completes the runs that cross its edges."""
        count = self.length - self.lcp
        at = np.repeat(np.arange(self.size), count)
        depth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + self.lcp[at] + 1
        low, high, _, right = self.run(at, depth)
        part = self.part(low, high, depth, 1)
        sides = {side: f.set_index("depth") for side, f in edges.groupby("side")}
        if right.any():
            known = sides["R"].loc[depth[right]]
            for name in part:
                part[name][right] = known[name].to_numpy(np.int64)
        above = np.maximum(depth - 1, 0)
        up_low, up_high, up_left, up_right = self.run(at, above)
        parent = self.conv.of(up_low, up_high)
        for side, mask in (("L", up_left), ("R", up_right & ~up_left)):
            if mask.any():
                parent[mask] = sides[side].loc[above[mask], "conv_id"].to_numpy(np.int64)
        before = self.prefix(at, above)
        ends = np.where(depth == self.length[at], self.ends[at], NOTHING)
        return pd.DataFrame({
            "conv_id": part["conv_id"], "depth": depth,
            "parent_conv_id": pd.arrays.IntegerArray(parent, depth == 0),
            "n_convs": part["members"], "n_children": part["children"] + (self.length[at] > depth), "n_leaves": part["leaves"],
            "saved_tokens": part["weighed"] - part["members"] * before - part["fresh"] - (self.whole[at] - before),
            "ends_sha256": ends,
        })


class Blocks:
    """What is known of every block, with running sums and range minima over the blocks."""

    def __init__(self, table: pd.DataFrame):
        self.block = table["block"].to_numpy(np.int64)
        self.opening = table["opening"].to_numpy(np.int64)
        self.place = {int(b): i for i, b in enumerate(self.block)}
        self.sums = {name: np.concatenate([[0], np.cumsum(table[name].to_numpy(np.int64))]) for name in SUMS}
        self.shared, self.conv = Minima(table["smallest"].to_numpy(np.int64)), Minima(table["conv_id"].to_numpy(np.int64))
        rows = np.arange(len(table))
        by = np.lexsort((rows, self.shared.levels[0]))
        self.lcp_places = self.shared.levels[0][by] * len(table) + by
        self.children = np.concatenate([[0], np.cumsum(table["at_smallest"].to_numpy(np.int64)[by])])

    def load(self, frame: pd.DataFrame) -> Block:
        i = self.place[int(frame["block"].iloc[0])]
        return Block(frame, int(self.opening[i]), int(self.opening[i + 1]) if i + 1 < len(self.block) else -1)

    def between(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> dict[str, np.ndarray]:
        """Sums over the blocks [low, high), all of them within a run of the depth."""
        out = {name: s[np.maximum(high, low)] - s[low] for name, s in self.sums.items()}
        count = lambda i: self.children[np.searchsorted(self.lcp_places, depth * len(self.block) + i)]
        some = high > low
        conv = np.full(len(low), np.iinfo(np.int64).max)
        conv[some] = self.conv.of(low[some], high[some] - 1)
        return out | {"children": np.where(some, count(high) - count(low), 0), "conv_id": conv}

    def targets(self, edges: pd.DataFrame) -> pd.DataFrame:
        """The blocks in which each crossing run starts and ends, and its sums over its own block and those between."""
        own = edges["block"].map(self.place).to_numpy(np.int64)
        depth, last = edges["depth"].to_numpy(np.int64), len(self.block) - 1
        left = ((edges["side"] == "L") | edges["whole"]).to_numpy()
        right = ((edges["side"] == "R") | edges["whole"]).to_numpy()
        start, end = own.copy(), own.copy()
        start[left] = np.maximum(self.shared.left(own[left] - 1, depth[left]), 0)
        stop = self.shared.right(own[right] + 1, depth[right])
        # A block with too small a minimum may be left at its very opening: the run then ended in the block before.
        reaches = (stop <= last) & (self.opening[np.minimum(stop, last)] >= depth[right])
        end[right] = np.where(reaches, stop, stop - 1)
        out = edges[["block", "side", "depth"]].copy()
        out["left_block"] = np.where(left, self.block[start], -1)
        out["right_block"] = np.where(right, self.block[end], -1)
        before = self.between(np.where(left, start + 1, own), own, depth)
        after = self.between(own + 1, np.where(right, end, own + 1), depth)
        for name in before:
            parts = [edges[name].to_numpy(np.int64), before[name], after[name]]
            out[name] = np.minimum.reduce(parts) if name == "conv_id" else sum(parts)
        return out


def _completed(edges: DataFrame, blocks: Blocks) -> DataFrame:
    """(block, side, depth, sums): crossing runs with all their blocks; one row for each edge and depth up to its LCP."""
    names = [*SUMS, "children", "conv_id"]

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield blocks.targets(frame)

    def end(side: str, block: str) -> DataFrame:
        return edges.where(F.col("side") == side).select(
            F.col("block").alias(block), "depth", *[F.col(c).alias(f"{block}_{c}") for c in names])

    found = edges.mapInPandas(of, TARGETS)
    found = found.join(end("R", "left_block"), ["left_block", "depth"], "left").join(
        end("L", "right_block"), ["right_block", "depth"], "left")
    sums = [sum((F.coalesce(f"{b}_{c}", F.lit(0)) for b in ("left_block", "right_block")), F.col(c)).alias(c) for c in names[:-1]]
    least = F.least("conv_id", "left_block_conv_id", "right_block_conv_id").alias("conv_id")
    return found.select("block", "side", "depth", *sums, least)


def ordered_blocks(keyed: DataFrame, block_turns: int) -> DataFrame:
    """Distinct sequences in sorted blocks: (block, place, lcp, length, points, n, conv_id, ends_sha256, key), written."""
    distinct = keyed.select("seq", "key", "points").dropDuplicates(["seq"])
    rows = written(distinct.join(members(keyed), "seq"), "trie-sequences")
    turns = rows.agg(F.sum(F.size("points"))).first()[0] or 0
    rows = rows.select("key", F.size("points").cast("long").alias("length"), "points", "n", "conv_id", "ends_sha256")
    ordered = rows.repartitionByRange(1 + turns // block_turns, "key").sortWithinPartitions("key")
    return written(ordered.mapInArrow(_numbered, ORDERED), "trie-blocks")


def _openings(ordered: DataFrame) -> DataFrame:
    """(block, opening): LCP of each block's first sequence with the last one before it; -1 for the first block.

    One row for each block, so its window is as small as the number of blocks.
    """

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lcp = [-1 if b is None else _common(bytes(b), bytes(k)) for b, k in zip(frame["before"], frame["least"])]
            yield pd.DataFrame({"block": frame["block"], "opening": lcp})

    ends = ordered.groupBy("block").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    before = F.lag("most").over(Window.orderBy("block"))
    return ends.withColumn("before", before).select("block", "before", "least").mapInPandas(of, "block int, opening long")


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each node of the trie over (conv_id, turns) rows, as `sequences` and `rebuilt` give them."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    keyed = written(conversations.select(
        "conv_id", F.unhex(F.md5(key)).alias("seq"), key.alias("key"), F.transform("turns", lambda t: t["points"]).alias("points"),
    ), "trie-keyed")
    ordered = ordered_blocks(keyed, block_turns)
    openings = {r["block"]: r["opening"] for r in _openings(ordered).collect()}
    if not openings:
        return ordered.sparkSession.createDataFrame([], NODES)
    light = ordered.drop("key")

    def summary(frame: pd.DataFrame) -> pd.DataFrame:
        block = int(frame["block"].iloc[0])
        return pd.DataFrame([{"block": block, **Block(frame, openings[block], following[block]).summary()}])

    order = sorted(openings)
    following = {b: openings[c] for b, c in zip(order, order[1:])} | {order[-1]: -1}
    table = light.groupBy("block").applyInPandas(summary, SUMMARY).toPandas().sort_values("block")
    blocks = Blocks(table.assign(opening=[openings[b] for b in order]))

    def edge(frame: pd.DataFrame) -> pd.DataFrame:
        return blocks.load(frame).edges().assign(block=int(frame["block"].iloc[0]))[[c.split()[0] for c in EDGE.split(", ")]]

    def nodes(frame: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        return blocks.load(frame).nodes(edges)

    edges = written(light.groupBy("block").applyInPandas(edge, EDGE), "trie-edges")
    completed = _completed(edges, blocks)
    return light.groupBy("block").cogroup(completed.groupBy("block")).applyInPandas(nodes, NODES)
