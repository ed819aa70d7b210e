"""Reading the driver's tables (one parquet file each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.partitioning import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Tables whose rows go through regex work, MinHash or line parsing: spread when the scan is too narrow.
TEXT_TABLES = {"documents", "pages", "conversations", "lineitem"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df
