"""Facts of the running session."""

import subprocess
import sys
from pathlib import Path

import pytest

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from brightfold.session import cores_in_use

spark = (SparkSession.builder.master(sys.argv[2]).config("spark.ui.enabled", "false")
         .config("spark.default.parallelism", "37").getOrCreate())
print("CORES", spark.sparkContext.defaultParallelism, cores_in_use(spark))
spark.stop()
"""


@pytest.mark.parametrize("master,cores", [("local[3]", 3), ("local", 1)])
def test_cores_do_not_follow_the_default_parallelism(master, cores):
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", SCRIPT, root, master], capture_output=True, text=True, timeout=120, check=True)
    assert done.stdout.split("CORES")[1].split()[:2] == ["37", str(cores)]


def test_training_partitions_grow_with_the_rows(spark, monkeypatch):
    from brightfold import session
    from brightfold.plans import inputs, model_queries

    assert [session.partitions_for(n, 8) for n in (0, 8_000_000, 8_000_001, 173_000_000)] == [8, 8, 9, 173]
    monkeypatch.setattr(session, "ROWS_A_PARTITION", 100)
    sf_dir = "/root/testdata/sf0.001"
    n_train = inputs.choose_split(inputs.base(spark, sf_dir), "train").count()
    with model_queries._training_data(spark, sf_dir) as (data, _):
        assert data.rdd.getNumPartitions() == -(-n_train // 100) > inputs.INPUT_PARTITIONS
        assert data.count() == n_train
