"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staging_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back (cuts lineage, survives executors)."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/corpusmill-stage/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns (by case-insensitive name) that an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``; every other column, whatever its name, is pruned at the scan."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def number_rows(df: DataFrame, order: list[str], group: list[str], out: str, n_rows: int) -> DataFrame:
    """Add ``out``: a gapless number from 0 within each group, the same for any partitioning of ``df``.

    A group is cut into about ``sqrt(n_rows)`` buckets by a hash of the ``order`` columns; bucket counts give
    each bucket's first number and a window numbers the rows inside it. So no task holds a whole group, and
    the count table has ``sqrt(n_rows)`` rows a group. ``df`` is read twice and should be cheap to read. Rows
    equal in all ``order`` columns are interchangeable and get neighbouring numbers.
    """
    buckets = max(1, math.isqrt(max(0, n_rows - 1)) + 1)
    b, i, n, start = fresh(df, "__b", "__i", "__n", "__first")
    df = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = df.groupBy(*group, b).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*group, b, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(*group, b).orderBy(*order)
    numbered = df.withColumn(i, F.row_number().over(inside) - 1).join(first, [*group, b])
    return numbered.withColumn(out, F.col(start) + F.col(i)).drop(b, i, start)


def utf8_len(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def share(spark: SparkSession, value):
    """Broadcast ``value`` pickled by value, so that workers need no copy of this package; returns a loader."""
    import pickle

    from pyspark import cloudpickle

    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)
