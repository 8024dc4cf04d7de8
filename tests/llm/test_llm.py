"""Each operator against brute force, and on odd input: nulls, empty and long texts, repeated rows, clashing columns."""

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightfold.llm import (
    decontaminate, jaccard_join, kd_shards, line_dedup, mixing, quotes, substring_dedup, token_counts, topk, toxicity,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, row long, spots string, key int, order double"
LONG = " ".join(f"w{i % 997}" for i in range(30_000))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns named like inner ones."""
    same = " ".join(f"t{i}" for i in range(40))
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one two", "de", None),
        (5, same, "en", "a"), (6, same, "en", "a"), (6, same, "en", "a"), (7, LONG, None, "b"), (8, LONG, "fr", "b"),
        (None, same + " tail", "en", "a"), (9, "a\na\na\na\na\nb", "en", "c"), (10, "x\na\na\na", "en", "c"),
        (11, "ONE two", "de", "d"),
    ]
    return spark.createDataFrame([(*r, 1, "s", 2, 0.5) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where(F.lit(False))


def words(text, lower=False):
    raw = (text or "").encode()
    return WORD.findall(raw.lower() if lower else raw)


def brute_repeats(rows):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out)


def brute_groups(rows):
    sets = {}
    for i, t in rows:
        w = words(t, True)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    holders, parent = defaultdict(list), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        for j, k in Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def drifting(n=60, size=80):
    """Copies of copies, each with some words changed: a chain of links and many pairs just short of one."""
    rng = np.random.default_rng(7)
    text, out = [f"v{i}" for i in range(size)], []
    for i in range(n):
        text = list(text)
        for _ in range(int(rng.integers(0, 4))):
            text[int(rng.integers(0, size))] = f"n{i}_{int(rng.integers(0, 5))}"
        out.append((i, " ".join(text)))
    return out


def test_substring_dedup(docs):
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == brute_repeats([(r.doc_id, r.text) for r in docs.collect()])


def test_substring_runs_and_edges(spark):
    rows = [(1, "a " * 14 + "b c"), (2, "a " * 30), (3, "q " + "a " * 13), (4, " ".join(f"k{i}" for i in range(13))),
            (5, " ".join(f"k{i}" for i in range(13))), (6, "z " + " ".join(f"k{i}" for i in range(13)) + " y")]
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_repeats(rows)


def test_interior_symbol_in_every_window():
    rng = np.random.default_rng(3)
    from brightfold.llm.common import Chunk
    ids = rng.integers(0, 40, 4000).astype(np.uint64)
    chunk = Chunk([{}, {}], ids, np.array([2500, 1500]))
    key, width = substring_dedup.interior(chunk)
    for start in np.flatnonzero(chunk.left() >= 13):
        assert any(width[start + s] <= 13 - s for s in range(9))


def test_substring_odd(odd, empty):
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(odd).collect()}
    assert {(5, 40, 0), (6, 40, 40), (None, 41, 40), (7, 30000, 0), (8, 30000, 30000), (1, 0, 0)} <= got
    assert substring_dedup.remove_repeats(odd).count() == odd.count()
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_line_dedup(odd, empty):
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in line_dedup.remove_repeated_lines(odd).collect()}
    assert got[9] == (6, 4, "a\nb") and got[10] == (4, 3, "x") and got[1] == (0, 0, None) and got[5][1] == 0
    assert line_dedup.remove_repeated_lines(odd).count() == odd.count()
    assert line_dedup.remove_repeated_lines(empty).count() == 0


@pytest.mark.parametrize("make", ["table", "drift"])
def test_jaccard_join(spark, docs, make):
    rows = [(r.doc_id, r.text) for r in docs.collect()] if make == "table" else drifting()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(df).collect()} == brute_groups(rows)


def test_jaccard_odd(odd, empty):
    rows = jaccard_join.similar_groups(odd).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == odd.count()
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[11] == (1, 4) and got[6][1] == 5 and got[None][1] == 5 and got[8][1] == 7
    assert jaccard_join.similar_groups(empty).count() == 0


def test_shards(docs, odd, empty):
    rows = kd_shards.shard(docs, 8).collect()
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(rows) == docs.count() and set(size) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in rows)
    assert max(size.values()) - min(size.values()) <= 4 * largest
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    assert kd_shards.shard(odd).count() == odd.count() and kd_shards.shard(empty).count() == 0
    assert kd_shards.shard(odd, 1).select("shard").distinct().count() == 1


def test_shards_cut_a_value_that_all_rows_share(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    counts = [r["count"] for r in kd_shards.shard(df, 4).groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 3


def test_decontaminate(spark, odd, empty):
    item = "the quick brown fox jumps over the lazy dog while seven small birds sing in the old garden tonight"
    edited = item.replace("quick", "fast").replace("seven small", "seven very small").replace("old ", "")
    rows = [(1, "lead in " + item + " and out"), (2, "say " + edited + " end"), (3, "the lazy garden of birds"), (4, None), (5, ""), (6, item)]
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "zq zr")], "item_id long, text string")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.copies(df, bench).collect()}
    assert set(got) == {1, 2, 6} and got[1].share == 1.0 and (got[1].first_word, got[1].end_word) == (2, 21) and got[2].share < 1
    assert decontaminate.copies(odd, bench).count() == 0 and decontaminate.copies(empty, bench).count() == 0
    assert decontaminate.copies(df, bench.where("item_id > 99")).count() == 0


def test_alignment_against_brute_force():
    rng = np.random.default_rng(1)
    items = [rng.integers(0, 6, int(rng.integers(1, 12))).astype(np.uint64) for _ in range(60)]
    texts = [rng.integers(0, 6, int(rng.integers(1, 25))).astype(np.uint64) for _ in range(60)]
    for q, p, score in zip(items, texts, decontaminate.align(items, texts)[0]):
        h = np.zeros((len(q) + 1, len(p) + 1), int)
        for i in range(1, len(q) + 1):
            for j in range(1, len(p) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if q[i - 1] == p[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert score == h.max()


def test_mixing(spark, odd, empty):
    df = spark.createDataFrame([(i, "w " * 10, "en" if i < 60 else "de", "a" if i < 30 else "b") for i in range(100)],
                               "doc_id long, text string, lang string, source string")
    got = mixing.select(df, {"lang": {"en": 3}}, share=(1, 2), epochs=2, domain=F.lit("d")).collect()
    by = Counter()
    for r in got:
        by[r.lang] += r.n_tokens
    assert by["de"] == 120 and 350 <= by["en"] <= 375
    alone = mixing.select(df.where("lang = 'de'"), {}, share=(3, 1), epochs=2, domain=F.lit("d"))
    assert alone.count() == 80 and alone.groupBy("doc_id").count().where("count <> 2").count() == 0
    assert mixing.select(odd, {}, share=(1, 1), epochs=1).where("n_tokens > 0").count() >= 5
    assert mixing.select(empty, {}).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("x", "en", "a", 10), ("x", "en", "b", 100), ("y", "en", "c", 100)],
                                   "_domain string, _lang string, _source string, tokens long")
    got = {r._source: r.budget for r in mixing.budgets(leaves, F.lit(120).cast("long"), {}, 1).collect()}
    assert got == {"a": 10, "b": 50, "c": 60}
    got = {r._source: r.budget for r in mixing.budgets(leaves, F.lit(190).cast("long"), {}, 1).collect()}
    assert got == {"a": 10, "b": 85, "c": 95}


def test_mixing_has_no_python(docs):
    plan = mixing.select(docs, {})._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.fixture(scope="module")
def insults(spark):
    rng = np.random.default_rng(5)
    syllables = ["ta", "ro", "mi", "len", "su", "po", "ka", "ne"]
    rows = []
    for i in range(500):
        w = ["".join(rng.choice(syllables, 3)) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            w[int(rng.integers(0, 30))] = rng.choice(["blockhead", "nitwit"])
        rows.append((i, " ".join(w) + ".", int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity(spark, insults, odd, empty):
    labels = insults.select("doc_id", "toxic")
    got = toxicity.scores(insults.select("doc_id", "text"), labels).join(insults, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    model = toxicity.train(insults, labels)
    reader = toxicity.Reader(model.kernel)
    s = model.scores(reader, [b"ka ne ta.", b"you block-head ka ne.", b"a n i t w i t ka.", b"", LONG.encode(), ("x" * 5000).encode()])
    assert s[1] > s[0] and s[2] > s[0] and s[3] < 0.5
    both = odd.select("doc_id", "text").unionByName(insults.select("doc_id", "text").where("doc_id > 20"))
    assert toxicity.scores(both, labels.where("doc_id > 20")).count() == both.count()
    with pytest.raises(ValueError):
        toxicity.train(empty, labels)


def test_topk(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(700, 8))
    v[300:520] = v[300]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(9000, None), (9100, [1.0, None]), (9200, [float("nan")] * 8), (9300, [float("inf")] * 8), (None, [1.0] * 8), (9400, []), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    m = {i: np.floor(1024 * np.array(e)).astype(int) for i, e in rows[:700]} | {9400: np.zeros(8, int)}
    want = set()
    for q in (i for i in m if i % 100 == 0):
        best = sorted((-int(m[q] @ m[i]), i) for i in m if i != q)[:10]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df).collect()} == want
    assert topk.top_k(df.where("vec_id < 0")).count() == 0 and topk.top_k(df.where("vec_id = 100")).count() == 0


def test_token_ledger(spark, docs, odd, empty, tmp_path):
    counter = token_counts.token_counter(spark)
    rows = token_counts.counted(docs, counter)
    ledger = token_counts.Ledger(spark, f"file://{tmp_path}/ledger")
    assert ledger.totals().count() == 0
    assert ledger.commit("1", token_counts.signed(rows, 1, "v")) and not ledger.commit("1", token_counts.signed(rows, 1, "v"))
    total = lambda: {tuple(r)[:3]: tuple(r)[3:] for r in ledger.totals().collect()}
    want = defaultdict(lambda: [0, 0, 0])
    for r in rows.collect():
        w = want[(r.source, r.lang, "v")]
        w[0], w[1], w[2] = w[0] + 1, w[1] + r.n_tokens, w[2] + r.n_bytes
    assert total() == {k: tuple(v) for k, v in want.items()}
    before = total()
    revised = rows.where("doc_id = 3").withColumn("n_tokens", F.col("n_tokens") + 5)
    ledger.commit("2", token_counts.signed(rows.where("doc_id = 3"), -1, "v").unionByName(token_counts.signed(revised, 1, "v")))
    assert sum(v[1] for v in total().values()) == sum(v[1] for v in before.values()) + 5
    ledger.commit("3", token_counts.signed(rows.where("doc_id <> 3").unionByName(revised), -1, "v"))
    assert total() == {}
    spread = token_counts.copies(token_counts.counted(odd, counter)).agg(F.sum("n_docs")).first()[0]
    assert spread == -3 and token_counts.counted(empty, counter).count() == 0


def test_quotes(spark):
    rows = [
        ("t", 0, "Hello there friend.\nSecond line."), ("t", 1, "> hello   THERE friend\n> Second line\nMy answer"),
        ("t", 2, "> > Hello there friend.\n> > Second line.\n> My answer\nThird"), ("t", 3, "On Monday Ann wrote:\n> Second line.\nFourth"),
        ("u", 0, "> Third\nfrom elsewhere"), ("t", 4, None), ("t", None, "x"), (None, 1, "> Third"), ("u", 1, ""), ("u", 2, "> nothing known"),
        ("u", 2, "> nothing known"),
    ]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "conv_id string, turn long, text string, row string, own int")
    got = {(r.conv_id, r.turn): r for r in quotes.linked(df).collect()}
    assert quotes.linked(df).count() == len(rows)
    link = lambda k: (got[k].own_text, got[k].parent_conv_id, got[k].parent_turn, got[k].depth)
    assert link(("t", 1)) == ("My answer", "t", 0, 1) and link(("t", 2)) == ("Third", "t", 1, 2)
    assert link(("t", 3)) == ("Fourth", "t", 0, 1) and link(("u", 0)) == ("from elsewhere", "t", 2, 0)
    assert got[("t", 2)].quote_depth == 2 and got[("t", 4)].own_text == "" and got[("u", 2)].parent_turn is None
    assert quotes.linked(df.where(F.lit(False))).count() == 0


def test_pipeline(spark, odd):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = p.drop_near_duplicates(spark, docs, SF)
    groups = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in groups.items() if i == c}
    one = p.mixed(spark, docs, SF)
    assert one.columns == docs.columns and 0 < one.count() < docs.count()
    stream = odd
    for name, stage in p.STAGES[:-1]:
        stream = stage(spark, stream, SF) if name != "toxicity" else stream
        assert stream.columns == odd.columns
    names = ["_id", "_row", "_s", "_l", "_toxicity", "l", "k", "copy", "a.b", "score"]
    clash = docs.where("doc_id < 60").select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for name, stage in p.STAGES[:-1]:
        kept = stage(spark, clash, SF)
        assert kept.columns == clash.columns and kept.count() > 0
        assert {tuple(r) for r in kept.select(*[f"`{n}`" for n in names]).collect()} == {tuple(range(len(names)))}
    out = p.run(spark, SF)
    assert out.count() > 0 and out.select("doc_id").distinct().count() == out.count()


def test_topk_beyond_64_bits(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for rows in ([(0, [1e17]), (1, [0.001]), (2, [0.002])], [(0, [1e12]), (1, [2e12])]):
        with pytest.raises(Exception, match="64 bits"):
            topk.top_k(frame(rows)).collect()
    # Scores near the limit but inside it are exact.
    got = topk.top_k(frame([(0, [1e9]), (1, [1000.0]), (2, [1000.0 + 2.0**-9])])).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 1024 * 10**9 * 1024002), (1, 1024 * 10**9 * 1024000)]


def test_quotes_across_threads_and_lines(spark):
    rows = [
        ("a", 0, "> Shared words here\nmine"), ("a", 1, "Shared words here"), ("b", 4, "Shared words here"), ("c", 1, "Shared words here"),
        ("b", 5, "> Shared words here\nlater"), ("d", 0, "> not known\n> Shared words here\nfirst"),
        ("e", 0, "On " + "long " * 300 + "wrote:\n> Shared words here\nown"),
    ]
    df = spark.createDataFrame(rows, "conv_id string, turn long, text string")
    got = {(r.conv_id, r.turn): (r.parent_conv_id, r.parent_turn) for r in quotes.linked(df).collect()}
    # Said only later in its own thread: the next thread that has it.
    assert got["a", 0] == ("b", 4) and got["b", 5] == ("b", 4) and got["c", 1] == (None, None)
    assert got["d", 0] == ("a", 1) and got["e", 0] == ("a", 1)
    assert {r.own_text for r in quotes.linked(df).where("conv_id = 'e'").collect()} == {"own"}
    long = spark.createDataFrame([("t", 0, "x " * 50_000), ("t", 1, "\n".join("> " * (i % 40 + 1) + f"line {i}" for i in range(1500)))],
                                 "conv_id string, turn long, text string")
    assert [r.quote_depth for r in quotes.linked(long).orderBy("turn").collect()] == [0, 40]


def test_toxicity_scores_do_not_hang_on_slices(monkeypatch):
    rng = np.random.default_rng(3)
    bad = ["idiot", "nitwit", "blockhead", "scum"]
    clean = [f"w{i % 37}x{i % 11} plain talk number{i % 5}." for i in range(400)]
    texts = [f"{rng.choice(clean)} {rng.choice(clean)}" for _ in range(200)] + [f"{rng.choice(clean)} you {b} {c}" for b in bad for c in clean[:40]]
    model = toxicity.fit([t.encode() for t in texts], [0] * 200 + [1] * 160, (0.5, 0.5))
    long = [
        " ".join(["plain words go on"] * 300 + ["idi-ot nitwt miro blckhead"] + ["and on and on"] * 300),
        "a b c d e " * 50 + "s c u m m e r s " + "end. " * 200, "x" * 5000 + " idiot" + "y" * 3000, "b l o c k h e a d " * 40, "idiot", "", "é " * 999,
    ]
    whole = model.scores(toxicity.Reader(model.kernel), [t.encode() for t in long])
    for words, characters in ((7, 10), (50, 1000), (1, 1)):
        monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", words)
        monkeypatch.setattr(toxicity, "CHARACTERS_AT_ONCE", characters)
        np.testing.assert_allclose(model.scores(toxicity.Reader(model.kernel), [t.encode() for t in long]), whole, atol=1e-6)
    # The kernel of a long word is that of its subsequences, whatever its length.
    word = "".join(rng.choice(list("abc"), 300))
    got, norm = np.zeros(len(model.kernel.landmarks)), 0.0
    table = {int(c): model.kernel.table[i] for i, c in enumerate(model.kernel.codes)}
    for i in range(len(word)):
        for k in range(2, toxicity.SPAN):
            for j in range(1, k):
                if i + k < len(word):
                    code = (ord(word[i]) << 42) | (ord(word[i + j]) << 21) | ord(word[i + k])
                    weight = toxicity.DECAY ** (k + 1)
                    norm += weight**2
                    got += table.get(code, 0) * weight
    np.testing.assert_allclose(model.kernel.of([word])[0], np.minimum(got / np.sqrt(norm), 1), rtol=1e-4)


def test_long_reply_chains(spark):
    rows = [("t", i, (f"> line {i - 1}\n" if i else "") + f"line {i}") for i in range(70)] + [("u", 0, "alone"), ("v", 3, "> alone\nx"), ("v", 4, "> x\ny")]
    got = {(r.conv_id, r.turn): (r.root_turn, r.depth) for r in quotes.linked(spark.createDataFrame(rows, "conv_id string, turn long, text string")).collect()}
    assert all(got["t", i] == (0, i) for i in range(70)) and got["u", 0] == (0, 0) and got["v", 3] == (3, 0) and got["v", 4] == (3, 1)


def test_toxicity_fit_holds_words_of_one_text_at_a_time():
    """Peak memory of a fit stays a small multiple of its texts."""
    rng = np.random.default_rng(5)
    texts = []
    for i in range(1500):
        words = [b"w%d" % w for w in rng.integers(0, 3000, 300)] + [b"%x" % w for w in rng.integers(0, 1 << 40, 3)]
        texts.append(b" ".join([*words, b"idiot%d." % (i % 4)] if i % 3 == 0 else words))
    tracemalloc.start()
    try:
        toxicity.fit(texts, [int(i % 3 == 0) for i in range(1500)], (0.7, 0.3))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 6 * sum(map(len, texts))


def test_kernel_sums_of_short_and_long_words():
    """Similarities by hand; and no table row is summed by segments but for words of very many hits."""
    kernel = toxicity.Kernel(["idiot", "moron", "plain"])
    words = ["id-iot", "idiots", "xyz", "", "moronic", "idiot" * 400, "plain", "idiot"]
    got = kernel.of(words)
    for word, row in zip(words, got):
        owner, code, weight = toxicity.subsequences([word])
        at = {int(c): i for i, c in enumerate(kernel.codes)}
        want = np.zeros(3)
        for c, w in zip(code, weight):
            if int(c) in at:
                want += kernel.table[at[int(c)]].astype(float) * w
        norm = max(1e-9, float(np.sqrt((weight.astype(float) ** 2).sum())))
        np.testing.assert_allclose(row, np.minimum(want / norm, 1), atol=1e-5)
    assert kernel.of(["xyz", "qqq"]).sum() == 0 and kernel.of([]).shape == (0, 3)


def test_words_are_numbered_in_one_look():
    numbers = toxicity.Numbers()
    assert [*map(numbers.__getitem__, [b"a", b"b", b"a", b"c"])] == [0, 1, 0, 2]
    assert numbers.fresh == [b"a", b"b", b"c"] and len(numbers) == 3
