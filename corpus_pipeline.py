"""The training-data pipeline: toxicity, SimHash near-dedup, suffix-array dedup, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``. NULL and empty texts pass through every stage: they
are never toxic beyond their base score, they are near-duplicates of each other, and they pack as no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import length_packing, simhash, suffix_dedup, toxicity
from corpusmill.llm.common import read_table, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents predicted toxic go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each component stays, the one with the smallest id. Documents of equal id and
    different texts are separate documents; a component without any id keeps one document too."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: passages of 200 bytes or more that occur twice are cut out of the texts."""
    return suffix_dedup.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: pieces, length buckets and batches."""
    return length_packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("simhash near-dedup", drop_near_copies), ("suffix-array dedup", cut_repeats), ("packing", pack)]

#: The first three stages cannot be written as SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
