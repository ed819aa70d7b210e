"""Parallelism helpers for CPU-heavy row-local work (regex chains, MinHash)."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Below this many input bytes per core, a round-robin shuffle costs less than running the
# text work on the few tasks a small scan yields (a Parquet file splits only at row groups).
SPREAD_BYTES_PER_CORE = 128 * 1024 * 1024
# Absolute ceiling: above this an input's Parquet row groups already give many splits, and a
# round-robin pass would be a large network shuffle however many cores the cluster has.
SPREAD_MAX_BYTES = 16 * 1024 ** 3
TASKS_PER_CORE = 4


def input_bytes(df: DataFrame) -> int:
    """Total size of what the scans below ``df`` read, from the planner's statistics; no job runs and no file is
    listed again. It only steers the spread decision, never a result."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread(df: DataFrame, cores: int | None = None) -> DataFrame:
    """Round-robin ``df`` over all cores when its scan cannot provide the parallelism itself.

    Large inputs (at least one file per core, more than ``SPREAD_BYTES_PER_CORE`` per core, or
    more than ``SPREAD_MAX_BYTES`` in total) are returned unchanged: their scan already yields
    enough splits, and reshuffling them would cost a full network pass.
    """
    cores = cores or df.sparkSession.sparkContext.defaultParallelism
    if input_bytes(df) > min(cores * SPREAD_BYTES_PER_CORE, SPREAD_MAX_BYTES):
        return df  # before any file list reaches the driver's Python
    files = df.inputFiles()
    if not files or len(files) >= cores:
        return df
    return df.repartition(cores * TASKS_PER_CORE)
