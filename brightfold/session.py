"""Shared storage of the running application, and input spreading."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared checkpoint folder; a scratch one is made only on a local master."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return context.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="brightfold-"))
    return context.getCheckpointDir()


def cores_in_use(spark: SparkSession) -> int:
    """Task slots of the running application, whatever `spark.default.parallelism` says.

    A local master names them; on a cluster they are the executors there now times
    `spark.executor.cores`, one each where that is unset.
    """
    context = spark.sparkContext
    if local := re.fullmatch(r"local(?:\[(\*|\d+)(?:,\s*\d+)?\])?", context.master):
        if local[1] == "*":
            return int(context._jvm.java.lang.Runtime.getRuntime().availableProcessors())
        return int(local[1] or 1)
    if workers := re.fullmatch(r"local-cluster\[\s*(\d+)\s*,\s*(\d+)\s*,.*\]", context.master):
        return int(workers[1]) * int(workers[2])
    # The status names the driver as well.
    executors = max(1, context._jsc.sc().getExecutorMemoryStatus().size() - 1)
    return executors * int(context.getConf().get("spark.executor.cores", "1"))


def workspace(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, at each call, for one written result."""
    return f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


#: Training rows that one task holds at most, on average.
ROWS_A_PARTITION = 1_000_000


def partitions_for(n_rows: int, least: int = 1) -> int:
    """Partitions of so many rows: a function of the data alone, so that tasks don't grow with it."""
    return max(least, -(-n_rows // ROWS_A_PARTITION))


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal rows out to a stated number of partitions; None leaves them as they are.

    Training makes many passes over its input, so one shuffle of a file with few row
    groups can pay for itself. The number is the caller's, not the cluster's: bagging
    depends on it, so equal data and seed give equal forests on any cluster.
    """
    return df if partitions is None else df.repartition(partitions)
