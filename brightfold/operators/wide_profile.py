"""One mergeable profile of a wide table: everything the exploration needs, in two scans.

Rows are never expanded. Each task turns its Arrow batches into small summaries, which
Spark adds up; what is shuffled depends on features, classes and cells, not on rows.

First scan, for each feature and class: rows, missing cells, moments, ranges, and counts by
the first 16 bits of the value's place in the order of all doubles. Second scan, given the
first: histogram bins, the sums behind correlations, and for each wanted rank the distinct
values of the cell that holds it. Counts by cell are exact, so a rank's cell is never
missed. A cell with more than `bracket_rows` rows is counted by its next 16 bits instead,
in that scan and at most two more, until its values are few or one.

A task holds half a megabyte of counts for each feature and class.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

DIGIT = 16
CELLS = 1 << DIGIT
#: Classes of the summaries: labels 0 and 1, and all other rows.
OTHER = 2
CLASSES = 3

FIRST = (
    "feature int, class int, cell int, n long, finite long, mean double, m2 double, low double, high double,"
    " finite_low double, finite_high double"
)
SECOND = "kind string, a int, b int, cell long, x double, n long, s double"


def order_keys(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles; both zeros share a key."""
    bits = (x + 0.0).view(np.int64)
    return (np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits).view(np.uint64)) ^ np.uint64(1 << 63)


def key_value(key: int) -> float:
    bits = np.array([key ^ (1 << 63)], np.uint64).view(np.int64)
    return float(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits).view(np.float64)[0])


@dataclass(frozen=True)
class Cell:
    """All values of a feature whose key shifted right is the prefix."""

    feature: int
    shift: int
    prefix: int


def _columns(df: DataFrame, features: Sequence[str], label: str | None) -> DataFrame:
    mark = F.lit(0) if label is None else F.when(F.col(label).isin(0, 1), F.col(label)).otherwise(OTHER)
    return df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(features)], mark.cast("int").alias("_class"))


def _values(batch: pa.RecordBatch, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """(feature, values) of a batch; missing ones are NaN."""
    for i in range(count):
        yield i, batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64)


@dataclass
class Moments:
    """Count, mean and sum of squared distances from it; range of all and of finite values."""

    n: int = 0
    finite: int = 0
    mean: float = 0.0
    m2: float = 0.0
    low: float = np.inf
    high: float = -np.inf
    finite_low: float = np.inf
    finite_high: float = -np.inf

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        if not len(x):
            return cls()
        with np.errstate(invalid="ignore", over="ignore"):
            mean = float(x.mean())
            inside = x[np.isfinite(x)]
            some = len(inside) > 0
            return cls(len(x), len(inside), mean, float(((x - mean) ** 2).sum()), float(x.min()), float(x.max()),
                       float(inside.min()) if some else np.inf, float(inside.max()) if some else -np.inf)

    def plus(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, apart = self.n + other.n, other.mean - self.mean
        with np.errstate(invalid="ignore", over="ignore"):
            return Moments(
                n, self.finite + other.finite, self.mean + apart * (other.n / n),
                self.m2 + other.m2 + apart**2 * (self.n * other.n / n), min(self.low, other.low), max(self.high, other.high),
                min(self.finite_low, other.finite_low), max(self.finite_high, other.finite_high))


def _merged(parts: Column) -> Column:
    """Mean and squares of a few partial moments (n, mean, m2), put together one after the other."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def plus(a, b):
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"), F.when(a["n"] == 0, b["mean"]).otherwise(a["mean"] + apart * (b["n"] / n)).alias("mean"),
            F.when(a["n"] == 0, b["m2"]).otherwise(a["m2"] + b["m2"] + apart * apart * (a["n"] * (b["n"] / n))).alias("m2"))

    return F.aggregate(F.sort_array(parts), none, plus)


@dataclass
class WideProfile:
    """What one scan tells of every feature and class, and what a second one can add."""

    df: DataFrame
    features: list[str]
    label: str | None
    rows: dict[int, int]
    moments: dict[tuple[int, int], Moments]
    cells: dict[int, tuple[np.ndarray, np.ndarray]]
    scans: int = 1

    def total(self, feature: int) -> Moments:
        """All classes together."""
        out = Moments()
        for c in range(CLASSES):
            out = out.plus(self.moments.get((feature, c), Moments()))
        return out

    def missing_pct(self, feature: int) -> float | None:
        rows = sum(self.rows.values())
        return 100.0 * (rows - self.total(feature).n) / rows if rows else None

    def _start(self, feature: int, rank: int) -> tuple[Cell, int, int]:
        """The first cell of a rank, the rank inside it, and the cell's rows."""
        places, counts = self.cells[feature]
        ends = np.cumsum(counts)
        i = int(np.searchsorted(ends, rank, "right"))
        return Cell(feature, 64 - DIGIT, int(places[i])), int(rank - (ends[i] - counts[i])), int(counts[i])

    def measure(
        self,
        ranks: Mapping[int, Sequence[int]] | None = None,
        bins: int | None = None,
        ranges: Mapping[tuple[int, int], tuple[float, float]] | None = None,
        correlate: bool = False,
        bracket_rows: int = 1_000_000,
    ) -> Measured:
        """Exact values at ranks, histogram counts over (feature, class) ranges, and sums for correlations.

        One scan, unless a rank's cell holds too many rows to list its values: then
        one more for each 16 bits that remain to be told apart, three in all at most.
        """
        open_ = {}
        for feature, wanted in (ranks or {}).items():
            for rank in set(wanted):
                open_[feature, rank] = self._start(feature, rank)
        found: dict[tuple[int, int], float] = {}
        out = Measured(found, {}, None)
        first = True
        while open_ or (first and (bins or correlate)):
            listed = sorted({c for c, _, n in open_.values() if n <= bracket_rows}, key=lambda c: (c.feature, c.shift, c.prefix))
            split = sorted({c for c, _, n in open_.values() if n > bracket_rows}, key=lambda c: (c.feature, c.shift, c.prefix))
            self.scans += 1
            rows = _second_scan(
                self.df, self.features, self.label, [*listed, *split], len(listed), bins if first else None, ranges or {},
                [self.total(i).mean for i in range(len(self.features))] if correlate and first else None,
            ).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if first and bins:
                    for r in rows.where("kind = 'h'").collect():
                        out.bins[r["a"], r["b"], r["cell"]] = r["n"]
                if first and correlate:
                    width = 3 * len(self.features)
                    out.gram = np.zeros((width, width))
                    for r in rows.where("kind = 'g'").collect():
                        out.gram[r["a"], r["b"]] = out.gram[r["b"], r["a"]] = r["s"]
                numbers = {c: i for i, c in enumerate([*listed, *split])}
                wanted = [(numbers[c], rank, inside) for (_, rank), (c, inside, _) in open_.items()]
                hits = {(r["b"], r["_rank"]): r for r in _placed(rows, wanted).collect()} if wanted else {}
            finally:
                rows.unpersist()
            for key, (cell, inside, _) in list(open_.items()):
                hit = hits[numbers[cell], key[1]]
                if numbers[cell] < len(listed):
                    found[key] = hit["x"]
                    del open_[key]
                    continue
                below = Cell(cell.feature, cell.shift - DIGIT, cell.prefix * CELLS + hit["cell"])
                if below.shift == 0:
                    found[key] = key_value(below.prefix)
                    del open_[key]
                else:
                    open_[key] = below, inside - (hit["end"] - hit["n"]), hit["n"]
            first = False
        return out


@dataclass
class Measured:
    """Values by (feature, rank), counts by (feature, class, bin), and the product matrix of `_second_scan`."""

    values: dict[tuple[int, int], float]
    bins: dict[tuple[int, int, int], int]
    gram: np.ndarray | None


def _placed(rows: DataFrame, wanted: Sequence[tuple[int, int, int]]) -> DataFrame:
    """For each wanted (cell number, rank, rank inside the cell) the value or sub-cell there.

    A listed cell has `bracket_rows` values at most and a split one 65,536 sub-cells, which
    bounds the window's tasks.
    """
    running = Window.partitionBy("b").orderBy("cell", "x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.where("kind = 'q'").select("b", "cell", "x", "n").withColumn("end", F.sum("n").over(running))
    ranks = rows.sparkSession.createDataFrame(list(wanted), "b int, _rank long, _inside long")
    return ends.join(F.broadcast(ranks), "b").where(
        (F.col("_inside") < F.col("end")) & (F.col("_inside") >= F.col("end") - F.col("n")))


def first_scan(df: DataFrame, features: Sequence[str], label: str | None = None) -> WideProfile:
    """Scan once; labels other than 0 and 1 form a class of their own."""
    count = len(features)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros(CLASSES, np.int64)
        moments: dict[tuple[int, int], Moments] = {}
        counts = [np.zeros(CELLS, np.int64) for _ in range(count)]
        for batch in batches:
            marks = batch.column(count).to_numpy(zero_copy_only=False)
            rows += np.bincount(marks, minlength=CLASSES)
            sides = [marks == c for c in range(CLASSES)]
            for i, x in _values(batch, count):
                here = ~np.isnan(x)
                counts[i] += np.bincount((order_keys(x[here]) >> np.uint64(64 - DIGIT)).astype(np.int64), minlength=CELLS)
                for c in range(CLASSES):
                    part = Moments.of(x[here & sides[c]])
                    if part.n:
                        moments[i, c] = moments[i, c].plus(part) if (i, c) in moments else part
        found = [(-1, c, -1, int(n), 0, None, None, None, None, None, None) for c, n in enumerate(rows) if n]
        found += [(i, c, -1, m.n, m.finite, m.mean, m.m2, m.low, m.high, m.finite_low, m.finite_high) for (i, c), m in moments.items()]
        names = [f.split()[0] for f in FIRST.split(", ")]
        types = [pa.int32()] * 3 + [pa.int64()] * 2 + [pa.float64()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*found), types)] if found else
                                         [pa.array([], t) for t in types], names)
        for i in range(count):
            at = np.flatnonzero(counts[i])
            empty = pa.nulls(len(at), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(np.zeros(len(at), np.int32)), pa.array(at.astype(np.int32)),
                 pa.array(counts[i][at]), pa.array(np.zeros(len(at), np.int64)), *[empty] * 6], names)

    part = F.when((F.col("cell") < 0) & (F.col("feature") >= 0), F.struct("n", "mean", "m2"))
    summed = _columns(df, features, label).mapInArrow(of, FIRST).groupBy("feature", "class", "cell").agg(
        F.sum("n").alias("n"), F.sum("finite").alias("finite"), _merged(F.collect_list(part)).alias("s"),
        *[F.min(c).alias(c) for c in ("low", "finite_low")], *[F.max(c).alias(c) for c in ("high", "finite_high")])
    rows, moments, cells = {}, {}, {i: [] for i in range(count)}
    for r in summed.collect():
        if r["feature"] < 0:
            rows[r["class"]] = r["n"]
        elif r["cell"] < 0:
            moments[r["feature"], r["class"]] = Moments(
                r["n"], r["finite"], r["s"]["mean"], r["s"]["m2"], r["low"], r["high"], r["finite_low"], r["finite_high"])
        else:
            cells[r["feature"]].append((r["cell"], r["n"]))
    ordered = {i: tuple(np.array(v, np.int64) for v in zip(*sorted(found))) if found else (np.zeros(0, np.int64),) * 2
               for i, found in cells.items()}
    return WideProfile(df, list(features), label, rows, moments, ordered)


def _second_scan(
    df: DataFrame, features: Sequence[str], label: str | None, cells: Sequence[Cell], listed: int, bins: int | None,
    ranges: Mapping[tuple[int, int], tuple[float, float]], means: Sequence[float] | None,
) -> DataFrame:
    """(kind, a, b, cell, x, n, s): values or sub-cells "q" of cells, bins "h" of ranges, products "g".

    Products are of the values less their means, of their squares, and of the marks of
    present cells, missing ones being 0: together they hold count, sums, squares and
    cross sums of every pair of columns.
    """
    count = len(features)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * listed
        parts = [np.zeros(CELLS, np.int64) for _ in cells[listed:]]
        counts = {at: np.zeros(bins, np.int64) for at in ranges} if bins else {}
        gram = np.zeros((3 * count, 3 * count)) if means is not None else None
        for batch in batches:
            marks = batch.column(count).to_numpy(zero_copy_only=False)
            wide = np.zeros((batch.num_rows, 3 * count)) if gram is not None else None
            for i, x in _values(batch, count):
                here = ~np.isnan(x)
                for number, cell in enumerate(cells):
                    if cell.feature != i:
                        continue
                    known = x[here] + 0.0
                    keys = order_keys(known)
                    inside = (keys >> np.uint64(cell.shift)) == np.uint64(cell.prefix)
                    if number < listed:
                        both = np.concatenate([values[number][0], known[inside]])
                        weight = np.concatenate([values[number][1], np.ones(int(inside.sum()), np.int64)])
                        seen, back = np.unique(both, return_inverse=True)
                        total = np.zeros(len(seen), np.int64)
                        np.add.at(total, back, weight)
                        values[number] = seen, total
                    else:
                        sub = (keys[inside] >> np.uint64(cell.shift - DIGIT)) & np.uint64(CELLS - 1)
                        parts[number - listed] += np.bincount(sub.astype(np.int64), minlength=CELLS)
                for c in range(CLASSES):
                    if (i, c) in counts:
                        low, high = ranges[i, c]
                        own = x[(marks == c) & np.isfinite(x)]
                        own = own[(own >= low) & (own <= high)]
                        at = np.full(len(own), bins // 2) if low == high else np.minimum(
                            bins - 1, np.floor((own - low) * float(bins) / (high - low))).astype(np.int64)
                        counts[i, c] += np.bincount(at, minlength=bins)
                if wide is not None:
                    centred = np.where(here, x - means[i], 0.0)
                    wide[:, i], wide[:, count + i], wide[:, 2 * count + i] = centred, centred**2, here
            if wide is not None:
                gram += wide.T @ wide
        names = [f.split()[0] for f in SECOND.split(", ")]

        def made(kind, a, b, cell, x, n, s):
            size = max(len(v) for v in (a, cell, x, n, s) if v is not None)
            full = lambda v, t: pa.nulls(size, t) if v is None else pa.array(v, t)
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * size, pa.string()), full(a, pa.int32()), full(b, pa.int32()), full(cell, pa.int64()), full(x, pa.float64()),
                 full(n, pa.int64()), full(s, pa.float64())], names)

        for number, (seen, total) in enumerate(values):
            yield made("q", np.full(len(seen), cells[number].feature), np.full(len(seen), number), None, seen, total, None)
        for number, total in enumerate(parts, listed):
            at = np.flatnonzero(total)
            yield made("q", np.full(len(at), cells[number].feature), np.full(len(at), number), at, None, total[at], None)
        for (i, c), total in counts.items():
            at = np.flatnonzero(total)
            yield made("h", np.full(len(at), i), np.full(len(at), c), at, None, total[at], None)
        if gram is not None:
            a, b = np.triu_indices(3 * count)
            yield made("g", a, b, None, None, None, gram[a, b])

    summed = _columns(df, features, label).mapInArrow(of, SECOND)
    return summed.groupBy("kind", "a", "b", "cell", "x").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))

