"""Train/test splits, folds and stratified samples.

Assignments follow from row content alone, never from partitioning, so lost
tasks recompute to the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from brightfold import config
from brightfold.functions.expressions import HASH_MODULUS
from brightfold.operators.ranks import BRACKET_ROWS, order_statistics

COPIES_PER_TASK_ROW = 10_000


def kfold(df: DataFrame, key: Column, folds: int = config.FOLDS, out: str = "fold") -> DataFrame:
    """Fold by key: a projection, no pass over the data. Rows of one key share a fold; NULL counts as 0."""
    return df.withColumn(out, F.pmod(F.coalesce(key, F.lit(0)), F.lit(folds)).cast("int"))


def random_split(
    df: DataFrame,
    key: Column,
    weights: Sequence[float] = (1.0,) * config.FOLDS,
    modulus: int = HASH_MODULUS,
    out: str = "part",
) -> DataFrame:
    """Weighted random split on a hash key; a seed goes into the key. NULL counts as 0."""
    key = F.pmod(F.coalesce(key, F.lit(0)), F.lit(modulus))
    total, reached, part = float(sum(weights)), 0.0, F.lit(0)
    for weight in list(weights)[:-1]:
        reached += weight
        part = part + F.when(key >= F.lit(math.floor(modulus * (reached / total))), 1).otherwise(0)
    return df.withColumn(out, part.cast("int"))


def fold_complement(df: DataFrame, held_out: int, fold: str = "fold") -> DataFrame:
    """Training side of a fold as a predicate; keeps copies of equal rows."""
    return df.where(F.col(fold) != held_out)


def fold_complement_distinct(
    df: DataFrame, held_out: int, columns: Sequence[str], fold: str = "fold"
) -> DataFrame:
    """Distinct training rows that equal no validation row (EXCEPT DISTINCT).

    One scan and one shuffle: copies collapse in the map-side aggregate, so a
    row repeated millions of times costs one entry per task.
    """
    return (
        df.groupBy(*columns)
        .agg(F.bool_or(F.col(fold) == held_out).alias("_held_out"))
        .where(~F.col("_held_out"))
        .select(*columns)
    )


def except_distinct(df: DataFrame, other: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT of two frames by one aggregate over their union."""
    columns = df.columns
    tagged = df.select(*columns, F.lit(False).alias("_other")).unionByName(
        other.select(*columns, F.lit(True).alias("_other"))
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.bool_or("_other").alias("_other"))
        .where(~F.col("_other"))
        .select(*columns)
    )


def stratified_kfold(
    df: DataFrame,
    key: Column,
    ties: Sequence[str],
    folds: int = config.FOLDS,
    label: str = config.LABEL,
    out: str = "fold",
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """Folds whose class counts differ by one row at most.

    Within each class, rows ordered by hash key are cut into equal runs. The
    cuts are exact order statistics, so the rows themselves are not shuffled.
    """
    def cuts(sizes):
        return {
            name: [i * (size // folds) + min(i, size % folds) for i in range(1, folds)]
            for name, size in sizes.items()
        }

    return rank_parts(df, label, key, ties, cuts, out, bracket_rows)


def sample_quotas(counts: Mapping, n_rows: int) -> dict:
    """Rows per class, proportional, by largest remainder; ties go to the lower class."""
    total = sum(counts.values())
    if n_rows >= total:
        return dict(counts)
    quotas = {c: n_rows * n // total for c, n in counts.items()}
    remainders = sorted(counts, key=lambda c: (-(n_rows * counts[c] % total), c))
    for c in remainders[: n_rows - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def stratified_sample(
    df: DataFrame,
    n_rows: int,
    key: Column,
    ties: Sequence[str],
    label: str = config.LABEL,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """Exactly `n_rows` labelled rows in class proportion; all of them if there are fewer."""
    def cuts(sizes):
        return {name: [quota] for name, quota in sample_quotas(sizes, n_rows).items()}

    parts = rank_parts(df, label, key, ties, cuts, "_part", bracket_rows)
    return parts.where(F.col("_part") == 0).drop("_part")


def nested_samples(
    df: DataFrame,
    search_rows: int | None,
    refit_rows: int | None,
    folds: int,
    key: Column,
    ties: Sequence[str],
    label: str = config.LABEL,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """Search sample with its folds, and refit sample, as ranges of one order: columns `fold` and `in_refit`.

    Both samples hold the first rows of each class by hash key, in class proportion, so the
    smaller one is part of the larger. The search sample is cut into equal runs, its folds;
    rows outside have no fold. None takes all labelled rows. The table is ranked once.
    """
    plans = {}

    def cuts(sizes):
        total = sum(sizes.values())
        searched, refitted = (sample_quotas(sizes, total if n is None else n) for n in (search_rows, refit_rows))
        for name in sizes:
            own = searched[name]
            runs = [i * (own // folds) + min(i, own % folds) for i in range(folds + 1)]
            bounds = sorted({b for b in (*runs, refitted[name]) if b > 0})
            starts = [0, *bounds]
            fold = [max(i for i in range(folds) if runs[i] <= s) if s < own else None for s in starts]
            plans[name] = bounds, fold, [s < refitted[name] for s in starts]
        return {name: bounds for name, (bounds, _, _) in plans.items()}

    parts = rank_parts(df, label, key, ties, cuts, "_part", bracket_rows)

    def read(which, kind):
        found = [
            F.when(F.col(label) == F.lit(name), F.get(F.array(*[F.lit(v).cast(kind) for v in plan[which]]), F.col("_part")))
            for name, plan in plans.items()
        ]
        return F.coalesce(*found) if found else F.lit(None).cast(kind)

    return parts.withColumns({"fold": read(1, "int"), "in_refit": F.coalesce(read(2, "boolean"), F.lit(False))}).drop("_part")


def stratified_sample_hash(
    df: DataFrame,
    fractions: Mapping[int, float],
    key: Column,
    modulus: int = HASH_MODULUS,
    label: str = config.LABEL,
) -> DataFrame:
    """Sample by hash threshold per class: a filter; sizes are close, not exact."""
    threshold = F.coalesce(*[
        F.when(F.col(label) == c, F.lit(math.floor(share * modulus)))
        for c, share in sorted(fractions.items())
    ])
    return df.where(F.pmod(F.coalesce(key, F.lit(0)), F.lit(modulus)) < threshold)


def rank_parts(
    df: DataFrame,
    stratum: str,
    key: Column,
    ties: Sequence[str],
    cuts: Callable[[Mapping], Mapping],
    out: str,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """Number the runs between cut ranks, per stratum, in (key, ties) order.

    `cuts` gets the rows of each stratum and gives its cut ranks. `key` is an integer hash below 2**53; NULL comes
    before all others. The cuts are found by order statistics
    on the hash; rows that share a cut's hash are ordered by `ties` and then by
    all other columns, one after the other, each by order statistics inside the tie
    (`tied_ranks`). Only identical rows stay undecided, and those are
    divided by count. Assigning a part is then a comparison with literals.
    """
    columns = df.columns
    order = [*ties, *[c for c in columns if c not in ties]]
    hashed = df.select("*", F.coalesce(key.cast("double"), F.lit(-1.0)).alias("_h"))
    wanted_cuts = {}

    def wanted(sizes):
        wanted_cuts.update(cuts(sizes))
        return {
            name: [c for c in ranks if 0 < c < sizes[name]] for name, ranks in wanted_cuts.items()
        }

    found = order_statistics(
        hashed.select(stratum, "_h"), stratum, "_h", wanted, bracket_rows=bracket_rows
    )
    inner = {
        (name, rank): hit
        for name, hits in found.hits.items()
        for rank, hit in hits.items()
        if rank > hit.below
    }
    boundaries = _tie_boundaries(hashed, stratum, order, inner, bracket_rows) if inner else {}

    part = None
    for name, ranks in wanted_cuts.items():
        steps = F.lit(0)
        for rank in ranks:
            steps = steps + _crossed(hashed, found, boundaries, order, name, rank)
        branch = F.when(F.col(stratum) == F.lit(name), steps)
        part = branch if part is None else F.coalesce(part, branch)
    assigned = part.cast("int") if part is not None else F.lit(None).cast("int")

    straddling = {}
    for (name, rank), (values, start, copies) in boundaries.items():
        if start < rank and len(values) == len(order):
            straddling[name, tuple(values)] = (values, start, copies)
    if not straddling:
        return hashed.withColumn(out, assigned).select(*columns, out)

    undecided = F.lit(False)
    for (name, _), (values, _, _) in straddling.items():
        undecided = undecided | _equals(hashed, stratum, order, name, values)
    decided = hashed.where(~undecided).withColumn(out, assigned).select(*columns, out)
    for (name, _), (values, start, copies) in straddling.items():
        shares = _shares(start, copies, wanted_cuts[name])
        same = hashed.where(_equals(hashed, stratum, order, name, values)).select(*columns)
        decided = decided.unionByName(_divide_copies(same, shares, out))
    return decided


def _tie_boundaries(hashed, stratum, order, inner, bracket_rows):
    """For cuts that fall among equal hashes: (values at the cut, first rank of these values, their copies).

    Values are of as many columns of the order as it takes to tell the cut's row from the
    one before it; of all columns where identical rows straddle the cut. They travel as
    text and are cast back, so columns must survive that.
    """
    bad = [
        c for c in order
        if isinstance(hashed.schema[c].dataType, (T.BinaryType, T.ArrayType, T.MapType, T.StructType,
                                                  T.UserDefinedType))
    ]
    if bad:
        raise ValueError(f"rows tie at a cut and cannot be ordered by {bad}: split before assembling")
    open_ = {key: (str(hit.value), (), hit.below, hit.copies) for key, hit in inner.items()}
    boundaries = {}
    for column in order:
        if not open_:
            break
        ties = {}
        for (name, rank), (h, values, start, copies) in open_.items():
            ties.setdefault((name, h, values), (copies, start, set()))[2].add(rank - start)
        asked = []
        for (name, h, values), (copies, _, ranks) in ties.items():
            same = (F.col(stratum) == F.lit(name)) & (F.col("_h") == F.lit(float(h)))
            for c, value in zip(order, values):
                same = same & F.col(c).eqNullSafe(F.lit(value).cast(hashed.schema[c].dataType))
            asked.append((same, copies, ranks))
        numbers = {tie: i for i, tie in enumerate(ties)}
        found = tied_ranks(hashed, asked, column, bracket_rows)
        for (name, rank), (h, values, start, _) in list(open_.items()):
            value, below, copies = found[numbers[name, h, values], rank - start]
            values, start = (*values, value), start + below
            open_[name, rank] = h, values, start, copies
            if start == rank:
                boundaries[name, rank] = list(values), start, copies
                del open_[name, rank]
    boundaries |= {key: (list(values), start, copies) for key, (_, values, start, copies) in open_.items()}
    return boundaries


@dataclass(frozen=True)
class Bracket:
    """Values of a tie between two others, both excluded; None is open, and a null is below all."""

    tie: int
    low: str | None
    high: str | None
    below: int
    rows: int
    ranks: frozenset


#: Values that cut a large bracket, about.
SPLITS = 48


def tied_ranks(df: DataFrame, ties: Sequence[tuple], column: str, bracket_rows: int = BRACKET_ROWS) -> dict[tuple[int, int], tuple]:
    """(value as text, rows below it, its copies) of a column at ranks inside disjoint ties.

    A tie is (condition, rows, ranks); nulls come first. Brackets with many rows are cut at
    some values of rows drawn by hash and at their ends, and the rows between counted, until
    each bracket holds `bracket_rows` rows at most or is one value: no window ever sees more.
    Works for every type that can be ordered and written as text.
    """
    kind = df.schema[column].dataType
    x, found, draw = F.col(column), {}, 0
    typed = lambda text: F.lit(text).cast(kind)
    open_ = [Bracket(i, None, None, 0, rows, frozenset(ranks)) for i, (_, rows, ranks) in enumerate(ties) if ranks]

    def inside(b):
        same = ties[b.tie][0]
        if b.low is not None:
            same = same & (x > typed(b.low))
        return same if b.high is None else same & (x < typed(b.high))

    def numbered(brackets):
        number = F.coalesce(*[F.when(inside(b), F.lit(i)) for i, b in enumerate(brackets)])
        return df.withColumn("_b", number).where(F.col("_b").isNotNull())

    while open_:
        small, large = [b for b in open_ if b.rows <= bracket_rows], [b for b in open_ if b.rows > bracket_rows]
        open_ = []
        if small:
            counted = numbered(small).groupBy("_b", x.alias("_x")).agg(F.count("*").alias("_n"))
            running = Window.partitionBy("_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            wanted = df.sparkSession.createDataFrame(
                [(i, rank, rank - b.below) for i, b in enumerate(small) for rank in b.ranks], "_b int, _rank long, _in long")
            hits = counted.withColumn("_end", F.sum("_n").over(running)).join(F.broadcast(wanted), "_b").where(
                (F.col("_in") < F.col("_end")) & (F.col("_in") >= F.col("_end") - F.col("_n")))
            for r in hits.select("_b", "_rank", "_n", "_end", F.col("_x").cast("string").alias("_x")).collect():
                b = small[r["_b"]]
                found[b.tie, r["_rank"]] = r["_x"], b.below + r["_end"] - r["_n"], r["_n"]
        if large:
            draw += 1
            drawn = F.pmod(F.xxhash64(F.lit(draw), *[F.col(c) for c in df.columns]), F.lit(1 << 40))
            share = F.element_at(F.array(*[F.lit(int(SPLITS / b.rows * (1 << 40))) for b in large]), F.col("_b") + 1)
            cuts = numbered(large).groupBy("_b").agg(
                F.sort_array(F.array_distinct(F.concat(
                    F.collect_set(F.when(drawn < share, x)), F.array_compact(F.array(F.min(x), F.max(x)))))).alias("_cuts"),
            ).select("_b", F.transform("_cuts", lambda c: c.cast("string")).alias("_cuts")).collect()
            splits = {r["_b"]: r["_cuts"] for r in cuts}
            # 0 is null, odd zones lie between cuts, even ones are the cuts themselves.
            zone = F.coalesce(*[
                F.when((F.col("_b") == i) & x.isNotNull(), sum(
                    ((x >= typed(c)).cast("int") + (x > typed(c)).cast("int") for c in splits.get(i, ())), F.lit(1)))
                for i in range(len(large))
            ], F.lit(0))
            zones = {}
            for r in numbered(large).groupBy("_b", zone.alias("_z")).count().collect():
                zones.setdefault(r["_b"], {})[r["_z"]] = r["count"]
            for i, b in enumerate(large):
                below, at = b.below, splits.get(i, [])
                for z in sorted(zones[i]):
                    n = zones[i][z]
                    ranks = frozenset(rank for rank in b.ranks if below <= rank < below + n)
                    if ranks and z % 2 == 0:
                        found.update({(b.tie, rank): (at[z // 2 - 1] if z else None, below, n) for rank in ranks})
                    elif ranks:
                        low, high = at[z // 2 - 1] if z > 1 else b.low, at[z // 2] if z // 2 < len(at) else b.high
                        open_.append(Bracket(b.tie, low, high, below, n, ranks))
                    below += n
    return found


def _typed(df, order, values):
    return [F.lit(v).cast(df.schema[c].dataType) for c, v in zip(order, values)]


def _crossed(df, found, boundaries, order, name, rank):
    """1 for rows at or past the cut."""
    if rank <= 0:
        return F.lit(1)
    if rank >= found.sizes[name]:
        return F.lit(0)
    hit = found.hits[name][rank]
    if rank == hit.below:
        return F.when(F.col("_h") >= F.lit(hit.value), 1).otherwise(0)
    values = boundaries[name, rank][0]
    columns = order[: len(values)]
    boundary = F.struct(*[v.alias(c) for c, v in zip(columns, _typed(df, columns, values))])
    at_cut = (F.col("_h") == F.lit(hit.value)) & (F.struct(*columns) >= boundary)
    return F.when((F.col("_h") > F.lit(hit.value)) | at_cut, 1).otherwise(0)


def _equals(df, stratum, order, name, values):
    same = F.col(stratum) == F.lit(name)
    for c, value in zip(order, _typed(df, order, values)):
        same = same & F.col(c).eqNullSafe(value)
    return same


def _shares(start, copies, cuts):
    """How many of the ranks [start, start + copies) fall in each part."""
    bounds = [start, *sorted({c for c in cuts if start < c < start + copies}), start + copies]
    return {
        sum(c <= low for c in cuts): high - low for low, high in zip(bounds, bounds[1:])
    }


def _divide_copies(same, shares, out):
    """Emit the given number of copies per part, spread over all tasks."""
    plan = F.array(*[
        F.struct(F.lit(part).alias(out), F.lit(n).cast("long").alias("_n")) for part, n in shares.items()
    ])
    chunk = F.lit(COPIES_PER_TASK_ROW)
    chunks = same.distinct().select("*", F.inline(plan)).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk)))
    )
    rest = F.least(chunk.cast("long"), F.col("_n") - F.col("_chunk") * chunk)
    spread = chunks.withColumn("_rest", rest).repartition(F.col("_chunk"), F.col(out))
    return spread.select(*same.columns, F.col(out).cast("int").alias(out), "_rest").select(
        *same.columns, out, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rest")))
    ).drop("col")
