"""Which keys repeat, and where: a grouped shuffle of packed arrays.

Tasks hand over one row of arrays for each group of keys in place of a row for each
key. A key that repeats within a chunk is settled there and sent once, so the
commonest key costs a group one entry for each chunk, whatever the number of its
occurrences; settled entries travel along to groups dealt by row; the groups' number follows the size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from brightfold.llm.common import mix

PACKED = "bucket int, keys binary, orders binary, rows binary, spots binary, state binary"
FOUND = "row long, spot int"

#: State of an entry: open, sent only to speak for settled ones, or settled.
OPEN, SPOKEN, SETTLED = 0, 1, 2


def _groups(keys, orders, rows, spots):
    """Sort by key, order, row and spot; give the permutation, each entry's group, and the groups' first entries."""
    by = np.lexsort((spots, rows, orders, keys))
    k = keys[by]
    new = np.empty(len(k), bool)
    new[:1] = True
    new[1:] = k[1:] != k[:-1]
    return by, np.cumsum(new) - 1, np.flatnonzero(new)


def settle(rule: str, keys, orders, rows, spots, state):
    """Settled and open entries under a rule; all arrays are in the order given.

    shared: the key occurs under two orders or more, all its entries are settled.
    later_order: a smaller order has the key.
    later_spot: the entry differs from the key's first by order, row and spot.
    """
    by, group, first = _groups(keys, orders, rows, spots)
    o = orders[by]
    if rule == "shared":
        last = np.append(first[1:], len(by))[: len(first)] - 1
        several = o[first] != o[last]
        if state is not None:
            several |= np.maximum.reduceat(state[by], first) == SPOKEN if len(first) else several
        hit = several[group]
        speak = np.zeros(len(by), bool)
        speak[first] = several
        keep = ~hit
    elif rule == "later_order":
        hit = o > o[first][group]
        speak, keep = np.zeros(len(by), bool), ~hit
    else:
        r, s, own = rows[by], spots[by], first[group]
        hit = (o != o[own]) | (r != r[own]) | (s != s[own])
        speak, keep = np.zeros(len(by), bool), ~hit
    settled, spoken, open_ = (np.zeros(len(by), bool) for _ in range(3))
    settled[by], spoken[by], open_[by] = hit, speak, keep
    return settled, spoken, open_


def pack(rule: str, buckets: int, keys, orders, rows, spots, keyed: bool = False) -> pd.DataFrame | None:
    """One chunk's entries as packed rows; settled ones travel along, dealt out by row; keyed keeps their keys."""
    if not len(keys):
        return None
    settled, spoken, open_ = settle(rule, keys, orders, rows, spots, None)
    sides = [(open_, OPEN), (spoken, SPOKEN), (settled, SETTLED)]
    at = np.concatenate([np.flatnonzero(mask) for mask, _ in sides])
    state = np.concatenate([np.full(int(mask.sum()), s, np.int8) for mask, s in sides])
    by = np.where(state == SETTLED, mix(rows[at].astype(np.uint64)), keys[at])
    where = ((by >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    turn = np.lexsort((at, where))
    at, state, where = at[turn], state[turn], where[turn]
    cut = np.flatnonzero(np.diff(where, prepend=-1))
    ends = np.append(cut[1:], len(at))
    k, o, r, s = keys[at], orders[at], rows[at], spots[at].astype(np.int32)
    if not keyed:
        k[state == SETTLED] = 0
    return pd.DataFrame({
        "bucket": where[cut].astype(np.int32),
        "keys": [k[a:b].tobytes() for a, b in zip(cut, ends)],
        "orders": [np.diff(o[a:b], prepend=0).tobytes() for a, b in zip(cut, ends)],
        "rows": [np.diff(r[a:b], prepend=0).tobytes() if rows is not orders else b"" for a, b in zip(cut, ends)],
        "spots": [s[a:b].tobytes() for a, b in zip(cut, ends)],
        "state": [state[a:b].tobytes() for a, b in zip(cut, ends)],
    })


def found(packed: DataFrame, rule: str, keyed: bool = False) -> DataFrame:
    """(row, spot), with keyed (row, spot, key), of every settled entry, over the packed rows of all chunks."""

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(frame["keys"]), np.uint64)
        undo = lambda column: np.concatenate([np.cumsum(np.frombuffer(x, np.int64)) for x in frame[column]])
        orders = undo("orders")
        rows = undo("rows") if len(frame["rows"].iloc[0]) else orders
        spots = np.frombuffer(b"".join(frame["spots"]), np.int32)
        state = np.frombuffer(b"".join(frame["state"]), np.int8)
        live = state != SETTLED
        settled, _, _ = settle(rule, keys[live], orders[live], rows[live], spots[live], state[live])
        take = ~live
        take[np.flatnonzero(live)[settled & (state[live] == OPEN)]] = True
        out = {"row": rows[take], "spot": spots[take]}
        return pd.DataFrame(out | {"key": keys[take].view(np.int64)} if keyed else out)

    return packed.groupBy("bucket").applyInPandas(of, FOUND + ", key long" * keyed)


def by_row(hits: DataFrame) -> DataFrame:
    """The spots of each row in one array; a row's spots are bounded by its text."""
    return hits.groupBy("row").agg(F.collect_list("spot").alias("spots"))


def covered(spots, width: int, length: int) -> np.ndarray:
    """Mask of positions that windows of a width starting at the spots cover; overlaps merge."""
    edge = np.zeros(length + 1, np.int64)
    at = np.unique(np.asarray(spots, np.int64)) if spots is not None and len(spots) else np.zeros(0, np.int64)
    at = at[(at >= 0) & (at + width <= length)]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return np.cumsum(edge[:-1]) > 0


def frames(parts: Iterator[pd.DataFrame | None]) -> Iterator[pd.DataFrame]:
    for part in parts:
        if part is not None:
            yield part
