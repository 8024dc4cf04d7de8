"""Chat formatting: quotation linking.

Quote marks at a line's head give its level. Neighbouring lines of one level are a
passage; a message's own text is its level 0. Normalised passages are hashed and joined
to the hashes of messages' own texts (whole, or one line of them), first within the
thread, among earlier messages, then in other threads. A passage is looked up whole, then
line by line. Originals collapse to one row for each thread and hash, and to the two
smallest threads of a hash, before they are joined, so a text that a third of the messages
share adds no pairs; two, since one of them may be the thread of the message itself. What a
message answers is what its outermost passages quote.

Replies are followed to their root by doubling: each round a message that isn't there yet
takes over the distance of the message it has reached. Reply order is root, depth, then the message's
own place. Built-in DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brightfold.llm.common import written

MARKS = r"^(?:[ \t]*>)+"
#: Line that mail programs put above a quotation.
INTRODUCTION = r"^On .+ wrote:$"


def normalised(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """Arrays for each message: `lines` with level and content, in order. A null text has none."""
    line = lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), r"[^>]", "")).alias("level"),
        F.regexp_replace(x, MARKS + " ?", "").alias("content"))
    return messages.withColumn("lines", F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), line))


def _own(lines: Column) -> Column:
    """Level-0 lines; one that introduces the quotation below it goes."""
    last = F.size(lines)
    kept = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(
        x["content"].rlike(INTRODUCTION)
        & F.when(i + 1 < last, F.element_at(lines, F.least(i + 2, last))["level"] > 0).otherwise(False)))
    return F.transform(kept, lambda x: x["content"])


def _runs(lines: Column) -> Column:
    """Passages: neighbouring quoted lines of one level, each as (level, lines)."""
    start = F.array().cast("array<struct<level:int,content:array<string>>>")

    def add(held, x):
        last = F.element_at(held, -1)
        one = F.struct(x["level"].alias("level"), F.array(x["content"]).alias("content"))
        grown = F.struct(last["level"].alias("level"), F.concat(last["content"], F.array(x["content"])).alias("content"))
        joins = (F.size(held) > 0) & F.coalesce(last["level"] == x["level"], F.lit(False))
        return F.when(joins, F.concat(F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.concat(held, F.array(one)))

    return F.filter(F.aggregate(lines, start, add), lambda x: x["level"] > 0)


def _hash(text: Column) -> Column:
    clean = normalised(text)
    return F.when(clean != "", F.md5(clean.cast("binary")))


def linked(messages: DataFrame, thread: str = "conv_id", place: str = "turn", text: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, own_text, n_quoted, quote_depth, parent_conv_id, parent_turn, root_turn, depth.

    own_text is the text without quotations, trimmed. parent_* is the earliest message that
    the first linked outermost passage quotes (in the thread before this message; else in
    another thread); null without one. depth counts replies up to the root within the
    thread; the order root_turn, depth, turn puts parents before replies. Null and empty
    texts quote nothing and are never quoted; rows without thread or place link to nothing.
    Rows with one thread and place are one message for those that quote it, and come out
    each by itself. Other columns are ignored; `role` is null where absent.
    """
    role = F.col("role") if "role" in messages.columns else F.lit(None).cast("string")
    base = messages.select(F.col(thread).alias("conv_id"), F.col(place).alias("turn"), role.alias("role"), F.col(text).alias("text"))
    read = parsed(base).withColumn("own", _own(F.col("lines"))).withColumn("runs", _runs(F.col("lines")))
    read = read.withColumn("own_text", F.trim(F.array_join("own", "\n"))).withColumn(
        "row", F.xxhash64("conv_id", "turn", "text"))
    read = written(read.select("row", "conv_id", "turn", "role", "own_text", "own", "runs"), "op8-read")

    wholes = read.select("conv_id", "turn", F.explode(F.array_distinct(F.concat(
        F.array(_hash(F.col("own_text"))), F.transform("own", _hash)))).alias("hash")).where(
        "hash IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL")
    in_thread = wholes.groupBy("conv_id", "hash").agg(F.min("turn").alias("near_turn"))
    nth = F.row_number().over(Window.partitionBy("hash").orderBy("conv_id"))
    anywhere = in_thread.withColumn("nth", nth).where("nth <= 2").groupBy("hash").agg(*[
        F.max(F.when(F.col("nth") == i, F.struct("conv_id", F.col("near_turn").alias("turn")))).alias(name)
        for i, name in ((1, "far"), (2, "next"))])

    passages = read.select("row", "conv_id", "turn", F.posexplode("runs").alias("nth", "run")).select(
        "row", "conv_id", "turn", "nth", F.col("run.level").alias("level"), F.explode(F.concat(
            F.array(F.struct(F.lit(0).alias("part"), _hash(F.array_join("run.content", " ")).alias("hash"))),
            F.transform("run.content", lambda x, i: F.struct((i + 1).alias("part"), _hash(x).alias("hash"))))).alias("key")).select(
        "row", "conv_id", "turn", "nth", "level", "key.part", "key.hash").where("hash IS NOT NULL").distinct()
    near = passages.join(in_thread, ["conv_id", "hash"], "left").withColumn(
        "near_turn", F.when(F.col("near_turn") < F.col("turn"), F.col("near_turn")))
    hits = near.join(anywhere, "hash", "left").withColumn(
        "to", F.when(F.col("near_turn").isNotNull(), F.struct("conv_id", F.col("near_turn").alias("turn"))).when(
            ~F.col("far.conv_id").eqNullSafe(F.col("conv_id")), F.col("far")).otherwise(F.col("next")))
    best = hits.where("to IS NOT NULL").groupBy("row").agg(F.min_by("to", F.struct(
        "level", F.col("near_turn").isNull(), "nth", "part")).alias("to"))
    joined = written(read.join(best, "row", "left").select(
        "row", "conv_id", "turn", "role", "own_text", F.size("runs").alias("n_quoted"),
        F.coalesce(F.array_max(F.transform("runs", lambda x: x["level"])), F.lit(0)).alias("quote_depth"),
        F.col("to.conv_id").alias("parent_conv_id"), F.col("to.turn").alias("parent_turn")), "op8-joined")

    step = joined.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min(
        F.when(F.col("parent_conv_id") == F.col("conv_id"), F.col("parent_turn"))).alias("up"))
    step = written(step.select("conv_id", "turn", F.coalesce("up", "turn").alias("up"),
                               F.col("up").isNotNull().cast("int").alias("depth"), F.col("up").isNull().alias("done")), "op8-step")
    # Only messages that haven't reached their root go into the next round.
    roots, open_ = step.where("done"), step.where("NOT done")
    while not open_.isEmpty():
        above = roots.unionByName(open_).select(
            "conv_id", F.col("turn").alias("up"), F.col("up").alias("top"), F.col("depth").alias("more"), F.col("done").alias("last"))
        moved = written(open_.join(above, ["conv_id", "up"]).select(
            "conv_id", "turn", F.col("top").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("last").alias("done")),
            "op8-step")
        roots, open_ = roots.unionByName(moved.where("done")), moved.where("NOT done")
    roots = roots.select("conv_id", "turn", F.col("up").alias("root_turn"), "depth")
    return joined.join(roots, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "own_text", "n_quoted", "quote_depth", "parent_conv_id", "parent_turn", "root_turn",
        F.coalesce("depth", F.lit(0)).alias("depth"))


def quoting(messages: DataFrame) -> DataFrame:
    """Chat turns as mail: each turn above a quotation of the turn before it, which quotes the one before that."""
    marked = lambda c, m: F.array_join(F.transform(F.split(c, "\n"), lambda x: F.concat(F.lit(m), x)), "\n")
    texts = messages.groupBy("conv_id", "turn").agg(F.min("text").alias("before"))
    one = texts.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("before").alias("one"))
    two = texts.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("before").alias("two"))
    return messages.join(one, ["conv_id", "turn"], "left").join(two, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", F.concat_ws("\n", marked(F.col("two"), "> > "), marked(F.col("one"), "> "), "text").alias("text"))
