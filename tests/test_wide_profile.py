"""The one-pass profile: exact ranks at any cell size, no row expansion, three scans for a whole exploration."""

import json
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightfold.operators import wide_profile
from brightfold.operators.wide_profile import first_scan

EDGES = [0.0, -0.0, 5e-324, -5e-324, 1.0, np.nextafter(1.0, 2), -1.0, 1e308, -1e308, float("inf"), float("-inf"), 2.5, 2.5, 2.5]


def test_keys_keep_the_order_of_doubles():
    x = np.sort(np.concatenate([np.random.default_rng(1).normal(size=200) * 10.0 ** np.arange(-100, 100), EDGES]))
    keys = wide_profile.order_keys(x)
    assert (np.diff(keys.astype(object)) >= 0).all() and keys[x == 0.0].min() == keys[x == 0.0].max()
    assert all(wide_profile.key_value(int(k)) == v for k, v in zip(keys, x))


@pytest.mark.parametrize("limit", [0, 3, 40, 10**6])
def test_ranks_are_exact_and_rounds_are_few(spark, limit):
    rng = np.random.default_rng(2)
    columns = [np.concatenate([rng.normal(size=200), EDGES]), np.full(214, 7.25), rng.integers(0, 3, 214) + 0.0,
               1.0 + rng.integers(0, 5, 214) * 2.0**-52]
    rows = [tuple(map(float, r)) for r in zip(*columns)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    found = first_scan(df, ["a", "b", "c", "d"])
    ranks = [0, 1, 50, 106, 107, 200, 213]
    measured = found.measure({i: ranks for i in range(4)}, bracket_rows=limit)
    for i, x in enumerate(columns):
        assert [measured.values[i, r] for r in ranks] == list(np.sort(x)[ranks])
    assert found.scans <= 4 and (limit < 10**6 or found.scans == 2)


def test_moments_by_class(spark):
    rng = np.random.default_rng(3)
    x, label = rng.normal(size=500) * 1e-3 + 1e6, rng.integers(0, 4, 500)
    rows = [(int(c) if c < 3 else None, float(v)) for c, v in zip(label, x)]
    found = first_scan(spark.createDataFrame(rows, "label int, x double").repartition(7), ["x"], "label")
    for c, rows in ((0, x[label == 0]), (1, x[label == 1]), (2, x[label >= 2])):
        m = found.moments[0, c]
        assert m.n == len(rows) == found.rows[c] and (m.low, m.high) == (rows.min(), rows.max())
        np.testing.assert_allclose([m.mean, m.m2], [rows.mean(), ((rows - rows.mean()) ** 2).sum()], rtol=1e-6)
    total = found.total(0)
    np.testing.assert_allclose(np.sqrt(total.m2 / (total.n - 1)), x.std(ddof=1), rtol=1e-6)


def test_plans_do_not_expand_rows(spark):
    df = spark.range(100).select(*[(F.col("id") * i).cast("double").alias(f"f{i}") for i in range(28)], (F.col("id") % 2).cast("int").alias("label"))
    names = [f"f{i}" for i in range(28)]
    second = wide_profile._second_scan(df, names, "label", [wide_profile.Cell(0, 48, 0)], 1, 50, {(0, 0): (0.0, 1.0)}, [0.0] * 28)
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not any(word in plan for word in ("Generate", "Expand", "Unpivot", "Join"))


def test_empty_table(spark):
    found = first_scan(spark.createDataFrame([], "x double, label int"), ["x"], "label")
    assert found.total(0).n == 0 and found.missing_pct(0) is None and found.measure({}, 50, {}).bins == {}


SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from brightfold import config
from brightfold.plans.explore import explore

spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", sys.argv[2]).config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "2")
         .getOrCreate())
line = spark.read.parquet(sys.argv[3])
columns = [(F.col("l_quantity") * (1 + i) + F.col("l_tax") / (1 + i)).alias(name) for i, name in enumerate(config.FEATURES)]
found = explore(line.select((F.col("l_linenumber") % 2).cast("int").alias("label"), *columns))
print("ROWS", *[found[name].count() for name in sorted(found)])
spark.stop()
"""


def test_exploration_of_28_columns_in_three_scans(tmp_path, sf_dir):
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", SCRIPT, root, f"file://{tmp_path}", f"{sf_dir}/lineitem.parquet"],
                          capture_output=True, text=True, timeout=240, check=True)
    assert done.stdout.split("ROWS")[1].split() == ["2", str(28 * 28), str(28 * 2 * 50), "28"]
    scans = 0
    for path in tmp_path.rglob("*"):
        if path.is_file() and not path.name.endswith(".crc"):
            for line in path.read_text().splitlines():
                event = json.loads(line)
                if event["Event"] == "SparkListenerStageCompleted":
                    scans += any(r["Name"] == "FileScanRDD" for r in event["Stage Info"]["RDD Info"])
    assert scans == 3
