"""Operator 9: optimal length buckets and token-budget batches.

Documents are cut into pieces of at most ``max_len`` tokens. The global histogram of piece lengths (at most
``max_len`` entries, whatever the corpus) goes to a dynamic programme that picks the bucket boundaries with
the least total padding. Inside a bucket of padded length ``L``, pieces are numbered in a hashed order and
every ``budget // L`` of them form one batch, so a batch never holds more than ``budget`` padded tokens.

Defined cases: a NULL or empty text has no tokens and gives one row with ``piece`` 0 and NULL bucket, batch and
slot; a very long text gives many pieces and loses none of its tokens; repeated ids are separate documents
(their pieces share the id); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, number_rows, stage

MAX_LEN = 2048
BUCKETS = 16
BUDGET = 32768
WORD = r"[^\x20\x09-\x0D]+"


def optimal_boundaries(counts: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length buckets with the least total padding (exact)."""
    lengths = np.array(sorted(k for k, v in counts.items() if k > 0 and v > 0), dtype=np.int64)
    if not len(lengths):
        return []
    c = np.array([counts[int(k)] for k in lengths], dtype=np.float64)
    n = len(lengths)
    rows = np.concatenate([[0.0], np.cumsum(c)])
    tokens = np.concatenate([[0.0], np.cumsum(c * lengths)])
    # padding of one bucket over lengths i..j-1 is rows(i, j) * lengths[j-1] - tokens(i, j)
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cut = []
    for _ in range(min(buckets, n)):
        new, at = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + (rows[j] - rows[:j]) * lengths[j - 1] - (tokens[j] - tokens[:j])
            at[j] = int(np.argmin(cost))
            new[j] = cost[at[j]]
        best = new
        cut.append(at)
    bounds, j = [], n
    for at in reversed(cut):
        bounds.append(int(lengths[j - 1]))
        j = int(at[j])
    return bounds[::-1]


def count_tokens(text: Column) -> Column:
    """Words split at ASCII white space; NULL counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def pack_documents(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start`` and ``n_tokens`` (long), ``bucket`` (int, from 0),
    ``bucket_len``, ``batch`` (long, from 0 within its bucket), ``slot`` (long, within its batch), ``padding``.

    Text is read once for its word counts; only the pieces' numbers are shuffled.
    """
    if not 0 < max_len <= budget:
        raise ValueError("need 0 < max_len <= budget")
    counted = id_text(docs).select("doc_id", count_tokens(F.col("text")).alias("total"))
    pieces = counted.select(
        "doc_id",
        "total",
        F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("total") / max_len), F.lit(1)).cast("long") - 1)).alias("piece"),
    ).select(
        "doc_id",
        "piece",
        (F.col("piece") * max_len).alias("start"),
        F.least(F.lit(max_len).cast("long"), F.col("total") - F.col("piece") * max_len).alias("n_tokens"),
    )
    pieces = stage(pieces, "pack-pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("n_tokens").count().collect()}  # at most max_len + 1 rows
    bounds = optimal_boundaries(counts, buckets) or [max_len]
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    full = pieces.where("n_tokens > 0").withColumn("bucket", F.size(F.filter(edges, lambda b: b < F.col("n_tokens"))))
    numbered = number_rows(
        full.withColumn("mix", F.xxhash64("doc_id", "piece")),
        ["mix", "doc_id", "piece", "n_tokens"], ["bucket"], "__at", sum(counts.values()),
    )
    numbered = numbered.withColumn("bucket_len", F.element_at(edges, F.col("bucket") + 1)).withColumn(
        "__cap", F.expr(f"{int(budget)} div bucket_len")
    )
    cols = ["doc_id", "piece", "start", "n_tokens", "bucket", "bucket_len"]
    packed = numbered.select(
        *cols,
        F.expr("__at div __cap").alias("batch"),
        (F.col("__at") % F.col("__cap")).alias("slot"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )
    empty = pieces.where("n_tokens = 0").select(
        "doc_id", "piece", "start", "n_tokens", F.lit(None).cast("int").alias("bucket"),
        *[F.lit(None).cast("long").alias(c) for c in ("bucket_len", "batch", "slot", "padding")],
    )
    return packed.unionByName(empty)
