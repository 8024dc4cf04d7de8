"""Exact order statistics per group without sorting or shuffling the rows.

A first aggregate brackets every wanted rank between two approximate
percentiles. Further aggregates shrink brackets that still hold too many rows,
and the last one counts the distinct values inside the brackets, where the rank
is read off. Every pass is a map-side combined aggregate over the scan: what is
shuffled is bounded by the groups and the bracket limit, never by the rows, and
copies of one value collapse before they move.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# A summary of this accuracy is some 50 kB per task and group, whatever the rows.
ACCURACY = 2_000
GRID = [i / 1000 for i in range(1001)]
BRACKET_ROWS = 1_000_000
MAX_GROUPS = 100_000


@dataclass(frozen=True)
class RankHit:
    """Value at a zero-based rank, the rows below it, and its copies."""

    value: float
    below: int
    copies: int


@dataclass
class RankResult:
    sizes: dict
    extras: dict
    hits: dict = field(default_factory=dict)


def order_statistics(
    df: DataFrame,
    group: str,
    value: str,
    wanted: Callable[[Mapping], Mapping],
    near: Sequence[float] | None = None,
    extras: Mapping[str, Column] | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> RankResult:
    """Exact values at the wanted ranks of each group.

    `wanted` gets the size of every group and gives the zero-based ranks per
    group. NULL values and NULL groups are left out. `near` names the percentiles the ranks lie at,
    when known beforehand, for tighter first brackets. `extras` are further
    aggregates taken in the same first pass. Groups must be few (features,
    classes): their summaries pass through the driver.
    """
    margin = 2.0 / ACCURACY
    if near is None:
        probes = GRID
    else:
        around = [p + d for p in near for d in (-margin, margin)]
        probes = sorted({0.0, 1.0, *(min(1.0, max(0.0, p)) for p in around)})
    extras = dict(extras or {})
    x = F.col(value)
    df = df.where(F.col(group).isNotNull())
    first = (
        df.groupBy(group)
        .agg(
            F.count(x).alias("_size"),
            F.min(x).alias("_min"),
            F.max(x).alias("_max"),
            F.percentile_approx(x, F.array(*map(F.lit, probes)), ACCURACY).alias("_probes"),
            *[column.alias(name) for name, column in extras.items()],
        )
        .limit(MAX_GROUPS + 1)
        .collect()
    )
    if len(first) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups in {group!r}")
    result = RankResult(
        sizes={row[group]: row["_size"] for row in first},
        extras={row[group]: {name: row[name] for name in extras} for row in first},
    )
    brackets = {}
    rows_inside = {}
    ranks = wanted(result.sizes)
    for row in first:
        size, name = row["_size"], row[group]
        result.hits[name] = {}
        ladder = [row["_min"], *(row["_probes"] or []), row["_max"]]
        for rank in sorted(set(ranks.get(name, ()))) if size else []:
            if not 0 <= rank < size:
                raise ValueError(f"rank {rank} outside the {size} rows of {name!r}")
            share = rank / max(1, size - 1)
            low = bisect_right(probes, share - margin / 2)
            high = bisect_left(probes, share + margin / 2)
            brackets[name, rank] = (ladder[low], ladder[min(high + 1, len(probes) + 1)])
            upper = probes[high] if high < len(probes) else 1.0
            lower = probes[low - 1] if low else 0.0
            rows_inside[name, rank] = (upper - lower + 2 / ACCURACY) * size
    spans = {row[group]: (row["_min"], row["_max"]) for row in first}
    _resolve(df, group, x, brackets, rows_inside, spans, result, bracket_rows)
    return result


def _resolve(df, group, x, brackets, rows_inside, spans, result, limit):
    """Narrow the brackets until each is small, then count the values inside."""
    while brackets:
        zoned, tables = _with_zones(df, group, x, brackets)
        if any(rows_inside[key] > limit for key in brackets):
            summary = zoned.groupBy(group, "_zone").agg(
                F.count(x).alias("n"),
                F.percentile_approx(
                    F.when(F.col("_zone") % 4 == 2, x), F.array(*map(F.lit, GRID)), ACCURACY
                ).alias("grid"),
            ).collect()
            zones = {(row[group], row["_zone"]): (row["n"], row["grid"]) for row in summary}
            for (name, rank), old in list(brackets.items()):
                index, local, inside = _locate(zones, tables[name], name, rank)
                low, high = tables[name][index // 4] if index % 4 else (None, None)
                if index % 4 == 2 and low < high:
                    grid = zones[name, index][1]
                    position = local / max(1, inside - 1) * (len(GRID) - 1)
                    left, right = int(position) - 2, int(position) + 4
                    new = (
                        grid[left] if left >= 0 else low,
                        grid[right] if right < len(GRID) else high,
                    )
                    brackets[name, rank] = new
                    rows_inside[name, rank] = inside * 8 / (len(GRID) - 1)
                elif index % 4 == 0:
                    # An approximate bracket missed its rank: go on in the gap that holds it.
                    brackets[name, rank] = _gap(tables[name], index, spans[name])
                    rows_inside[name, rank] = inside
                else:
                    edge = high if index % 4 == 3 else low
                    brackets[name, rank] = (edge, edge)
                    rows_inside[name, rank] = 0
            continue
        counted = zoned.groupBy(
            group, "_zone", F.when(F.col("_zone") % 4 != 0, x).alias("_x")
        ).agg(F.count(x).alias("n"))
        running = Window.partitionBy(group).orderBy("_zone", "_x")
        placed = counted.withColumn("end", F.sum("n").over(running))
        ranks = _rank_table(df, group, brackets)
        hits = (
            placed.join(F.broadcast(ranks), group)
            .where((F.col("_rank") < F.col("end")) & (F.col("_rank") >= F.col("end") - F.col("n")))
            .collect()
        )
        for row in hits:
            key = (row[group], row["_rank"])
            if row["_x"] is None:
                brackets[key] = _gap(tables[key[0]], row["_zone"], spans[key[0]])
                rows_inside[key] = row["n"]
            else:
                hit = RankHit(row["_x"], row["end"] - row["n"], row["n"])
                result.hits[key[0]][key[1]] = hit
                del brackets[key]


def _with_zones(df, group, x, brackets):
    """Zone of each value: 4i below bracket i, 4i+1 its low end, 4i+2 inside, 4i+3 its high end.

    The bracket table has one row per group, so the broadcast is bounded.
    """
    tables = {}
    for (name, _), bracket in brackets.items():
        tables.setdefault(name, []).append(bracket)
    tables = {name: _disjoint(found) for name, found in tables.items()}
    schema = T.StructType([
        df.schema[group],
        T.StructField("_lows", T.ArrayType(T.DoubleType())),
        T.StructField("_highs", T.ArrayType(T.DoubleType())),
    ])
    width = max(map(len, tables.values()))
    table = df.sparkSession.createDataFrame(
        [
            (name, [float(b[0]) for b in found], [float(b[1]) for b in found])
            for name, found in tables.items()
        ],
        schema,
    )
    zone = F.lit(0)
    for i in range(width):
        low, high = F.get("_lows", F.lit(i)), F.get("_highs", F.lit(i))
        for crossed in (x >= low, (x > low) & (low < high), (x >= high) & (low < high), x > high):
            zone = zone + F.when(crossed, 1).otherwise(0)
        # A single-value bracket has no inside: count its two missing steps above it.
        zone = zone + F.when((low == high) & (x > low), 2).otherwise(0)
    joined = df.where(x.isNotNull()).join(F.broadcast(table), group)
    return joined.withColumn("_zone", zone).drop("_lows", "_highs"), tables


def _gap(table, index, span):
    """Bracket between two others, or an end of the span: the values of zone `index`."""
    i = index // 4
    return (table[i - 1][1] if i else span[0]), (table[i][0] if i < len(table) else span[1])


def _disjoint(found):
    merged = []
    for low, high in sorted(set(found)):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _locate(zones, table, name, rank):
    """Zone that holds the rank, the rank inside it, and the rows in it."""
    below = 0
    for index in range(4 * len(table) + 1):
        rows = zones.get((name, index), (0, None))[0]
        if rank < below + rows:
            return index, rank - below, rows
        below += rows
    raise AssertionError(f"rank {rank} of {name!r} is past the counted rows")


def _rank_table(df, group, brackets):
    schema = T.StructType([df.schema[group], T.StructField("_rank", T.LongType())])
    return df.sparkSession.createDataFrame(list(brackets), schema)


def exact_quantiles(hits: Mapping[int, RankHit], size: int, probabilities: Sequence[float]):
    """Linearly interpolated quantiles from the order statistics around them."""
    values = []
    for p in probabilities:
        below, above = quantile_ranks(size, p)
        weight = (size - 1) * p - below
        low, high = hits[below].value, hits[above].value
        values.append(low if low == high else low + (high - low) * weight)
    return values


def quantile_ranks(size: int, p: float) -> tuple[int, int]:
    below = int((size - 1) * p)
    return below, min(below + 1, size - 1)
