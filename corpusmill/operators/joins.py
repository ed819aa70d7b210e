"""Join helpers: broadcast only a side whose size has been checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when it has at most this many rows (catalog-sized tables) and bytes.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# What a row, or a value of fixed width, takes at most in the hashed table.
FIXED_BYTES = 16


def _value_bytes(field: T.StructField) -> Column:
    """Bytes that a value takes, about: strings and binaries by their octets, nested values by their text form."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(value)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(value.cast("string"))
    return F.lit(0)


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes; one bounded job reads at most
    ``max_rows + 1`` rows, and few but long rows count by their length."""
    row = F.lit(FIXED_BYTES * (1 + len(df.columns))).cast("long")
    for field in df.schema.fields:
        row = row + F.coalesce(_value_bytes(field), F.lit(0))
    # sizes are taken before the limit, so that only numbers go to the one task that adds them up
    found = df.select(row.alias("n")).limit(max_rows + 1).agg(F.count("n").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("bytes")).first()
    return found["rows"] <= max_rows and found["bytes"] <= max_bytes


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join with ``small`` broadcast when its checked size allows, else a plain shuffle join (AQE may still
    switch it at run time from measured sizes)."""
    if is_small(small, max_rows, max_bytes):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
