"""Canonical schemas of the corpus."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

ORDER = "row_order"
CANONICAL = ["instruction", "input", "output", "source", "data_dir", "source_split"]
DEDUPED = ["instruction", "input", "output", "source"]
LEGACY = ["text", "source", "subset", "source_split"]
STATS = ["label", "nb_docs", "nb_words", "mean_words", "std_words", "nb_chars", "mean_chars", "std_chars"]

CANONICAL_SCHEMA = StructType([StructField(c, StringType(), True) for c in CANONICAL])

STATS_SCHEMA = StructType(
    [
        StructField("label", StringType(), False),
        StructField("nb_docs", LongType(), False),
        StructField("nb_words", LongType(), True),
        StructField("mean_words", DoubleType(), True),
        StructField("std_words", DoubleType(), True),
        StructField("nb_chars", LongType(), True),
        StructField("mean_chars", DoubleType(), True),
        StructField("std_chars", DoubleType(), True),
    ]
)

CATALOG_SCHEMA = StructType(
    [
        StructField("source", StringType(), False),
        StructField("path", StringType(), True),
        StructField("data_dir", ArrayType(StringType()), True),
        StructField("source_split", ArrayType(StringType()), True),
        StructField("target_split", StringType(), True),
        StructField("adaptation_type", StringType(), False),
        StructField("commercial_use", BooleanType(), False),
        StructField("comment", StringType(), True),
        StructField("position", IntegerType(), False),  # place in the catalog: the order of the corpus
    ]
)

FINE_TUNING = "fine-tuning"
INSTRUCTION_TUNING = "instruction-tuning"
ADAPTATION_TYPES = (FINE_TUNING, INSTRUCTION_TUNING)


def check_adaptation_type(value: str) -> str:
    if value not in ADAPTATION_TYPES:
        raise ValueError(f"adaptation_type must be one of {ADAPTATION_TYPES}, got {value!r}")
    return value
