"""Connected components by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightfold.llm.common import written


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first())


def components(edges: DataFrame, name: str) -> DataFrame:
    """(row, component) for every end of an edge (a, b) but the components' smallest ones.

    Each round joins edges with their ends' smallest neighbours, aggregated before the
    shuffle; edges are written to the shared folder between rounds, so a lost executor
    costs one round. Rounds grow with the logarithm of the longest chain.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).distinct()
        )
        edges = written(small, name)
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("row"), F.col("b").alias("component"))
