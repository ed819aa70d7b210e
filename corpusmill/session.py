"""Session helpers: a local session for tests/bench and a shared staging folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "corpusmill") -> SparkSession:
    """Session used by tests and ``bench.py``. A cluster job gets its session from the launcher."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", os.environ.get("CORPUSMILL_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when a local session names none (tests) do we create one of our own; on a cluster a folder of the
    driver's machine would be lost to the executors, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="corpusmill-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root for written intermediate tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/corpusmill-stage/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back: its lineage ends here."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``write_table`` whose tables are deleted on leaving the block."""
    paths: list[str] = []

    def write(df: DataFrame, name: str) -> DataFrame:
        paths.append(staging_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield write
    finally:
        for path in paths:
            delete_path(spark, path)
