"""The whole workflow: explore, train both profiles, benchmark, evaluate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from brightfold import config
from brightfold.plans.benchmark import benchmark
from brightfold.plans.evaluate import evaluate_saved
from brightfold.plans.explore import explore
from brightfold.plans.train import train_all


def run_all(
    train: DataFrame,
    test: DataFrame,
    out: str,
    groups=config.FEATURE_GROUPS,
    profiles: Sequence[str] = config.PROFILES,
    families: Sequence[str] = config.FAMILIES,
    **training,
) -> dict[str, DataFrame]:
    """Result tables by step; everything is also written below `out`.

    `training` goes to `train_all`: method, grids, trials and so on.
    """
    features = [c for columns in groups.values() for c in columns]
    tables = dict(explore(train, groups, out=f"{out}/explore"))
    for profile in profiles:
        train_all(train, features, profile, families=families, out=f"{out}/models", **training)
    tables["benchmark"] = benchmark(train, test, features, families, out=f"{out}/benchmark")
    tables["evaluation"] = evaluate_saved(test, f"{out}/models", profiles, families, f"{out}/evaluation")
    return tables
