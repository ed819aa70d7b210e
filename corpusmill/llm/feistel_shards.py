"""Operator 8: a reproducible shuffle and sharding by a Feistel permutation of global row numbers.

Every row gets a global number, the number goes through a keyed permutation of ``0..n-1``, and the permuted
position alone gives the shard (``position % shards``) and the slot (``position // shards``). Shard sizes
differ by one row at most, slots are gapless, and both directions can be computed for any single row without
reading another. The law of the query is therefore ``rows``.

Defined cases: a NULL id or text is ordinary (size 8, checksum 0 for a NULL text); rows with equal ids are
ordered by checksum and size, and rows equal in all three are interchangeable; an empty table gives an empty
result; input columns named like the added ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, number_rows, stage, utf8_len, without

SHARDS = 24
SEED = 20
ROUNDS = 6


class Feistel:
    """A permutation of ``0..n-1``: a balanced Feistel network over the next even power of two, walking
    its cycles until the value falls below ``n`` (under four steps on average)."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, ((max(1, n - 1)).bit_length() + 1) // 2)
        self.keys = np.random.SeedSequence(seed).generate_state(rounds, np.uint64)

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        z = x + key
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (z ^ (z >> np.uint64(31))) & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        h, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> h, x & mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ self._round(left, key), left
            else:
                left, right = right, left ^ self._round(right, key)
        return (left << h) | right

    def _walk(self, x, back: bool) -> np.ndarray:
        out = self._once(np.asarray(x).astype(np.uint64), back)
        far = np.flatnonzero(out >= self.n)
        while len(far):
            out[far] = self._once(out[far], back)
            far = far[out[far] >= self.n]
        return out.astype(np.int64)

    def position(self, number) -> np.ndarray:
        """Shuffled positions of row numbers."""
        return self._walk(number, False)

    def number(self, position) -> np.ndarray:
        """Row numbers at shuffled positions (the inverse)."""
        return self._walk(position, True)


def shard_rows(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``row_number`` and ``position`` (long), ``shard`` (int) and ``slot`` (long).

    ``order`` names the columns that fix the global numbering. ``df`` is read for its count, for bucket counts
    and for the rows. Only the numbering's buckets are shuffled; the permutation is row-local.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    df = without(df, "row_number", "position", "shard", "slot")
    n = df.count()
    perm = Feistel(n, seed)

    @F.pandas_udf("long")
    def position(number: pd.Series) -> pd.Series:
        return pd.Series(perm.position(number.to_numpy()))

    out = number_rows(df, order, [], "row_number", n).withColumn("position", position("row_number"))
    return out.withColumn("shard", (F.col("position") % shards).cast("int")).withColumn(
        "slot", F.expr(f"position div {int(shards)}")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The sharding plan of a document table: ids, sizes and checksums only; the text never moves."""
    text = F.col("text")
    plan = id_text(docs).select(
        "doc_id",
        (utf8_len(text) + 8).alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    out = shard_rows(stage(plan, "shard-plan"), ["doc_id", "text_crc32", "size"], shards, seed)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number", "position",
    )
