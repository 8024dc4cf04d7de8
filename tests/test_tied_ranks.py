"""Order statistics on tuples: exact inside ties of any size and type, without a window over the tie."""

import datetime
import json
import random
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brightfold.operators.split import rank_parts, stratified_kfold, tied_ranks

VALUES = {
    "long": [-(2**62), 2**62, 2**62 + 1, 0, 7, None],
    "double": [0.0, -1e300, 1e-300, float("nan"), float("inf"), None],
    "string": ["", "a", "a ", "Ä", "z" * 50, None],
    "date": [datetime.date(1900, 1, 1), datetime.date(2024, 2, 29), None],
    "timestamp": [datetime.datetime(2001, 1, 1, 1, 2, 3, 456789), datetime.datetime(1999, 12, 31), None],
    "decimal(20,4)": [Decimal("1.0000"), Decimal("-99999999.1234"), None],
    "boolean": [True, False, None],
}


def rank_key(v):
    return (v is not None, (1, 0.0) if v != v else (0, v)) if v is not None else (False, (0, 0))


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("limit", [1, 20, 10_000])
def test_every_rank_of_every_type(spark, kind, limit):
    rng = random.Random(4)
    rows = [(rng.choice(VALUES[kind]), rng.randint(0, 1), i) for i in range(150)]
    df = spark.createDataFrame(rows, f"x {kind}, tie int, id int").repartition(3)
    sides = [sorted((r[0] for r in rows if r[1] == t), key=rank_key) for t in (0, 1)]
    asked = [(F.col("tie") == t, len(side), {0, 1, len(side) // 3, len(side) // 2, len(side) - 1}) for t, side in enumerate(sides)]
    found = tied_ranks(df, asked, "x", limit)
    texts = {r["x"]: r["t"] for r in df.select("x", F.col("x").cast("string").alias("t")).distinct().collect() if r["x"] == r["x"]}
    for t, side in enumerate(sides):
        for rank in asked[t][2]:
            want = side[rank]
            same = [v for v in side if rank_key(v) == rank_key(want)]
            first = next(i for i, v in enumerate(side) if rank_key(v) == rank_key(want))
            assert found[t, rank] == (None if want is None else "NaN" if want != want else texts[want], first, len(same))


@pytest.mark.parametrize("limit", [3, 1_000])
def test_parts_follow_the_whole_order_under_a_constant_key(spark, limit):
    rng = random.Random(6)
    rows = [(rng.randint(0, 1), rng.choice([None, "a", "b"]), rng.choice([None, 1.5, 2.5, -1.0]), rng.randint(0, 30)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, s string, d double, n long").repartition(4)
    got = rank_parts(df, "label", F.lit(5), ["s"], lambda sizes: {c: [n // 3, 2 * n // 3] for c, n in sizes.items()}, "part", limit)
    key = lambda r: tuple((v is not None, v or 0) for v in (r[1], r[0], r[2], r[3]))
    want = []
    for c in (0, 1):
        side = sorted((r for r in rows if r[0] == c), key=key)
        cuts = [len(side) // 3, 2 * len(side) // 3]
        want += [(*r, sum(i >= cut for cut in cuts)) for i, r in enumerate(side)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from brightfold.operators.split import stratified_kfold

spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", sys.argv[2]).config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "4")
         .getOrCreate())
df = spark.range(1_000_000, numPartitions=8).select((F.col("id") % 2).cast("int").alias("label"), F.xxhash64("id").alias("x"), "id")
folded = stratified_kfold(df, F.lit(1), ["x"], 5, bracket_rows=20_000)
counts = folded.groupBy("label", "fold").count().collect()
print("SIZES", sorted(r["count"] for r in counts))
spark.stop()
"""


def test_a_constant_key_leaves_no_large_task(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", SCRIPT, root, f"file://{tmp_path}"], capture_output=True, text=True, timeout=240, check=True)
    assert json.loads(done.stdout.split("SIZES")[1].strip().splitlines()[0]) == [100_000] * 10
    most = 0
    for path in tmp_path.rglob("*"):
        if path.is_file() and not path.name.endswith(".crc"):
            for line in path.read_text().splitlines():
                event = json.loads(line)
                if event["Event"] == "SparkListenerTaskEnd":
                    most = max(most, event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"])
    # A task may hold the brackets of several ties, each of 20,000 rows at most.
    assert 0 < most <= 8 * 20_000


def test_folds_of_a_constant_key_are_equal(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("label"), F.lit("same").alias("s"))
    sizes = stratified_kfold(df, F.lit(None).cast("long"), ["s"], 4, bracket_rows=10).groupBy("label", "fold").count().collect()
    assert sorted(r["count"] for r in sizes) == [125] * 8
