"""Mixing sources to target weights: budgets over a domain, language and source tree.

Budgets go from the root down. A node's children share its budget by weight; a child
that cannot use its share (its tokens, times the epochs allowed) takes what it has, and
its siblings share the rest by weight. What all siblings together cannot use never
reaches the parent, since its own capacity is the sum of theirs: that shortage is made
good by the parent's siblings. So siblings come before ancestors. All arithmetic is on
whole numbers; a split rounds down and at most one token a child stays unused.

A leaf's budget buys whole epochs and a prefix of the next. Each epoch has an order of
its own, by a hash of seed, epoch and id. The prefix is cut in two steps: sums over
4,096 hash ranges of the leaf find the range that holds the cut, and only its documents
are ordered one by one, so no leaf is sorted in one task.

Built-in DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brightfold.llm.common import WORD_PATTERN, written

WORDS = WORD_PATTERN.replace("\\", "\\\\")
LEVELS = ("domain", "lang", "source")
LEAF = ["_domain", "_lang", "_source"]


def domain_of(source: Column) -> Column:
    """Domain of a source where the table has none: one of four, by the source's MD5."""
    return F.concat(F.lit("d"), (F.ascii(F.md5(F.coalesce(source, F.lit("")).cast("binary"))) % 4).cast("string"))


def _weight(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1).cast("long")
    for name, weight in weights.items():
        if weight < 1:
            raise ValueError("weights are whole numbers from 1")
        out = F.when(F.col(column) == name, F.lit(weight).cast("long")).otherwise(out)
    return out


def _share(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Budget for each child from `budget` of its parent, `weight` and `capacity`."""
    rising = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), name)
    group = Window.partitionBy(*parent)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    before = F.sum("capacity").over(rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("capacity")
    weight_left = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    full = children.withColumn("before", before).withColumn("weight_left", weight_left).withColumn(
        "full", wide("capacity") * F.col("weight_left") <= (F.col("budget") - F.col("before")) * wide("weight"))
    level = full.withColumn("used", F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(group)).withColumn(
        "open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group))
    return level.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(
        F.expr("CAST((CAST(budget - used AS DECIMAL(38,0)) * weight) div open AS BIGINT)"))).drop(
        "before", "weight_left", "full", "used", "open")


def budgets(leaves: DataFrame, target: Column, weights: dict[str, dict[str, int]], epochs: int) -> DataFrame:
    """Leaves (_domain, _lang, _source, tokens) with `budget`, at most tokens * epochs each."""
    tree = leaves.withColumn("capacity", F.col("tokens") * epochs)
    top = tree.groupBy("_domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    top = top.withColumn("budget", target).withColumn("weight", _weight("_domain", weights.get("domain", {})))
    top = _share(top.withColumn("_root", F.lit(0)), ["_root"], "_domain")
    middle = tree.groupBy("_domain", "_lang").agg(F.sum("capacity").alias("capacity"))
    middle = middle.join(top.select("_domain", "budget"), "_domain").withColumn(
        "weight", _weight("_lang", weights.get("lang", {})))
    middle = _share(middle, ["_domain"], "_lang")
    low = tree.join(middle.select("_domain", "_lang", "budget"), ["_domain", "_lang"]).withColumn(
        "weight", _weight("_source", weights.get("source", {})))
    return _share(low, ["_domain", "_lang"], "_source").select(*LEAF, "tokens", "budget")


def select(docs: DataFrame, weights: dict[str, dict[str, int]], share: tuple[int, int] = (3, 4), epochs: int = 2,
           seed: int = 42, domain: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Chosen (doc_id, epoch): doc_id, epoch, domain, lang, source, n_tokens.

    The target is share[0]/share[1] of all tokens (words of the whole texts). A document
    is taken once for each epoch it is in; no leaf passes its budget. Null metadata count as
    the empty name, a null id as the empty id, null and empty texts have no tokens. Rows of
    one id in one leaf are taken together, each as a row of its own. `documents` needs lang
    and source; other columns are ignored.
    """
    tokens = F.expr(f"CAST(coalesce(regexp_count({text_col}, '{WORDS}'), 0) AS BIGINT)")
    slim = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), "lang", "source", tokens.alias("n_tokens"),
        F.coalesce(domain if domain is not None else domain_of(F.col("source")), F.lit("")).alias("_domain"),
        F.coalesce("lang", F.lit("")).alias("_lang"), F.coalesce("source", F.lit("")).alias("_source"),
    ), "op9-slim")
    leaves = slim.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    total = slim.agg(F.sum("n_tokens")).first()[0] or 0
    target = F.lit(total * share[0] // share[1]).cast("long")
    plan = written(budgets(leaves, target, weights, epochs).where("tokens > 0").select(
        *LEAF, F.expr("CAST(budget div tokens AS INT)").alias("whole"), F.expr("budget % tokens").alias("rest")), "op9-budgets")
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    ranked = slim.join(plan, LEAF).withColumn("place", place).withColumn("range", F.substring("place", 1, 3))
    sums = ranked.where("rest > 0").groupBy(*LEAF, "range").agg(F.sum("n_tokens").alias("in_range"), F.first("rest").alias("rest"))
    upto = F.sum("in_range").over(Window.partitionBy(*LEAF).orderBy("range"))
    cuts = sums.withColumn("upto", upto).where("upto > rest").groupBy(*LEAF).agg(
        F.min("range").alias("cut"), F.min(F.col("upto") - F.col("in_range")).alias("ahead"))
    placed = ranked.join(cuts, LEAF, "left")
    units = placed.where("range = cut AND rest > 0").groupBy(*LEAF, "place").agg(
        F.sum("n_tokens").alias("n"), F.first("ahead").alias("ahead"), F.first("rest").alias("rest"))
    running = F.sum("n").over(Window.partitionBy(*LEAF).orderBy("place"))
    inside = units.withColumn("sofar", running + F.col("ahead")).where("sofar <= rest").select(
        *LEAF, "place", F.lit(1).alias("inside"))
    marked = placed.join(inside, [*LEAF, "place"], "left").withColumn(
        "partly", (F.col("rest") > 0) & (F.col("cut").isNull() | (F.col("range") < F.col("cut")) | F.col("inside").isNotNull()))
    taken = marked.withColumn("n_epochs", F.col("whole") + F.coalesce(F.col("partly"), F.lit(False)).cast("int")).where("n_epochs > 0")
    return taken.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n_epochs") - 1)).alias("epoch"),
                        F.col("_domain").alias("domain"), "lang", "source", "n_tokens")
