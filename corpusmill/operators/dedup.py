"""Deduplication (D1-D7) and the seeded shuffle (O1).

Built for a corpus far larger than memory; texts are read in scans and leave them at most once:

* D1 exact: ids and 32-byte text keys only are aggregated (the smallest id of a key, partial per map task, so a
  text repeated a billion times ships one row per task). The ids of all later copies are removed by one
  anti-join, which AQE broadcasts when they are few.
* D2 MinHash: tokens and their 32-bit hashes are native expressions; the 128 permutations run in one Arrow UDF
  over list offsets (vectorised numpy, no per-row Python).
* D3 bands: 8 band keys per row (``md5`` of 16 values), exploded to ``(band, key)``.
* D5 greedy: "keep a row unless it shares a band with an already kept earlier row". Only rows of buckets with two
  members or more take part. They are sorted by row order once, which gives each an 8-byte id and a block of
  neighbours; a bucket becomes the id of its first row. Each round scans every block in order and settles whatever
  follows from the block and from what earlier rounds settled, so a chain of near-duplicates inside a block takes
  one round however long it is, and any input at most one round a block. Bucket minima are partial aggregates and
  no pairs are formed, so a bucket holding a third of the corpus settles in the rounds of its first member.
* D6 removes the losers of D1 and of D5 with a single anti-join of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ..functions.charclass import WS
from ..schema import DEDUPED, FINE_TUNING, ORDER, check_adaptation_type
from ..session import scratch_tables, write_table

# ---------------------------------------------------------------------------
# Must equal the reference's dedup parameters.
# ---------------------------------------------------------------------------
NUM_PERM = 128
THRESHOLD = 0.85
SHUFFLE_SEED = 42
# ---------------------------------------------------------------------------
# Our own MinHash family (portable to SQL): token hash = first 32 bits of sha1,
# permutation i = (a_i * (h mod p) + b_i) mod p with p = 2^31 - 1.
MERSENNE_P = (1 << 31) - 1
EMPTY_HASH = (1 << 32) - 1  # signature value of an empty token set (above every real value)
PERM_SEED = 1


@lru_cache(maxsize=None)
def permutations(num_perm: int = NUM_PERM, seed: int = PERM_SEED) -> tuple[tuple[int, ...], tuple[int, ...]]:
    rng = np.random.RandomState(seed)
    a = rng.randint(1, MERSENNE_P, size=num_perm, dtype=np.int64)
    b = rng.randint(0, MERSENNE_P, size=num_perm, dtype=np.int64)
    return tuple(int(x) for x in a), tuple(int(x) for x in b)


@lru_cache(maxsize=None)
def optimal_bands(threshold: float = THRESHOLD, num_perm: int = NUM_PERM) -> tuple[int, int]:
    """(bands, rows) minimising the equally weighted false-positive and false-negative areas of the S-curve."""
    def area(f, lo, hi, n=2001):
        x = np.linspace(lo, hi, n)
        return float(np.trapezoid(f(x), x))

    best, best_err = (1, num_perm), float("inf")
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            fp = area(lambda s: 1 - (1 - s ** r) ** b, 0.0, threshold)
            fn = area(lambda s: 1 - (1 - (1 - s ** r) ** b), threshold, 1.0)
            err = 0.5 * fp + 0.5 * fn
            if err < best_err:
                best, best_err = (b, r), err
    return best


# --- D2 ---------------------------------------------------------------------
def token_hashes(text: Column) -> Column:
    """Distinct 32-bit hashes of the whitespace tokens (``str.split()``) of ``text``."""
    tokens = F.filter(F.split(text, f"[{WS}]+"), lambda t: t != "")
    hashes = F.transform(tokens, lambda t: F.conv(F.substring(F.sha1(t), 1, 8), 16, 10).cast("bigint"))
    return F.array_distinct(hashes)


def _minhash_lists(arr: pa.Array, a: np.ndarray, b: np.ndarray, chunk: int = 1 << 9) -> pa.Array:
    """Signatures of lists of hashes. ``chunk`` hashes meet all permutations at once, few enough for the CPU's cache."""
    k = len(a)
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    offsets = arr.offsets.to_numpy().astype(np.int64)
    values = arr.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False) % MERSENNE_P
    out = np.full((n, k), EMPTY_HASH, dtype=np.int64)
    lengths = np.diff(offsets)
    rows = np.nonzero(lengths > 0)[0]
    if len(rows):
        starts, ends = offsets[rows], offsets[rows + 1]
        lo, hi = int(offsets[0]), int(offsets[-1])
        product, high = np.empty((chunk, k), np.int64), np.empty((chunk, k), np.int64)
        for c0 in range(lo, hi, chunk):
            c1 = min(c0 + chunk, hi)
            m, top = product[: c1 - c0], high[: c1 - c0]
            np.multiply(values[c0:c1, None], a[None, :], out=m)
            m += b
            for _ in range(2):  # modulo 2^31 - 1: the high bits count once more
                np.right_shift(m, 31, out=top)
                m &= MERSENNE_P
                m += top
            m[m == MERSENNE_P] = 0
            i0 = np.searchsorted(ends, c0, side="right")
            i1 = np.searchsorted(starts, c1, side="left")
            seg = rows[i0:i1]
            seg_starts = np.maximum(starts[i0:i1], c0) - c0
            red = np.minimum.reduceat(m, seg_starts, axis=0)
            out[seg] = np.minimum(out[seg], red)
    flat = pa.array(out.reshape(-1), type=pa.int64())
    offs = pa.array(np.arange(0, (n + 1) * k, k, dtype=np.int32), type=pa.int32())
    mask = arr.is_null().to_numpy(zero_copy_only=False) if arr.null_count else None
    return pa.ListArray.from_arrays(offs, flat, mask=pa.array(mask) if mask is not None else None)


def _signature_udf(num_perm: int, seed: int):
    a_t, b_t = permutations(num_perm, seed)
    a = np.array(a_t, dtype=np.int64)
    b = np.array(b_t, dtype=np.int64)

    @F.arrow_udf(ArrayType(LongType()))
    def minhash(hashes: pa.Array) -> pa.Array:
        return _minhash_lists(hashes, a, b)

    return minhash


def minhash_signature(text: Column | str, num_perm: int = NUM_PERM, seed: int = PERM_SEED) -> Column:
    """``num_perm`` MinHash values of the token set; empty text -> all ``EMPTY_HASH``; NULL -> NULL."""
    col = F.col(text) if isinstance(text, str) else text
    return _signature_udf(num_perm, seed)(token_hashes(col))


# --- D3 ---------------------------------------------------------------------
def band_keys(signature: Column | str, bands: int | None = None, rows: int | None = None, binary: bool = True) -> Column:
    """D3: one key per band, ``md5`` of the band's values joined by commas (16-byte binary or hex)."""
    if bands is None or rows is None:
        bands, rows = optimal_bands()
    sig = F.col(signature) if isinstance(signature, str) else signature
    keys = []
    for j in range(bands):
        k = F.md5(F.array_join(F.slice(sig, j * rows + 1, rows).cast("array<string>"), ","))
        keys.append(F.unhex(k) if binary else k)
    return F.array(*keys)


def lsh_bands(df: DataFrame, key_cols: list[str], signature: str = "signature", binary: bool = True) -> DataFrame:
    """Rows ``(*key_cols, band, key)``: each row in each of its band buckets."""
    return df.select(*key_cols, F.posexplode(band_keys(signature, binary=binary)).alias("band", "key"))


# --- D4 (re-aimed) ------------------------------------------------------------
def lsh_candidates(bands: DataFrame, order: str = ORDER) -> DataFrame:
    """Per row: the earliest other row it shares a band bucket with (if earlier) and in how many bands.

    This is what an LSH query answers for the sequential scan, without emitting all pairs
    of a bucket (a bucket can hold a large part of the corpus): bucket minima are partial
    aggregates joined back to the members.
    """
    mins = bands.groupBy("band", "key").agg(F.min(order).alias("__m"))
    j = bands.join(mins, ["band", "key"], "inner").where(F.col("__m") < F.col(order))
    return j.groupBy(order).agg(
        F.min("__m").alias("first_candidate"), F.count(F.lit(1)).cast("bigint").alias("n_bands")
    )


# --- D1 ---------------------------------------------------------------------
def text_key(text: Column | str) -> Column:
    """32-byte key of a text; NULL has the empty key."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.unhex(F.sha2(col, 256)), F.lit(b""))


def refuse_shared_order(df: DataFrame, order: str = ORDER) -> None:
    """Rows that share a row order (or have none) could not be told apart by it: that is an error."""
    shared = df.groupBy(order).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(order).isNull())
    row = shared.first()
    if row is not None:
        raise ValueError(f"{row['n']} rows have the row order {row[order]}: every row needs its own")


def exact_losers(keyed: DataFrame, order: str = ORDER) -> DataFrame:
    """The orders of all rows but the first of each ``__h``, from ``(order, __h)`` rows, as a written table."""
    with scratch_tables(keyed.sparkSession) as write:
        keyed = write(keyed.select(order, "__h"), "text-keys")
        refuse_shared_order(keyed, order)
        first = keyed.groupBy("__h").agg(F.min(order).alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
        later = keyed.join(first, "__h").where(F.col(order) > F.col("__first")).select(order)
        return write_table(later, "exact-losers")


def dedup_exact(df: DataFrame, text: str = "input", order: str = ORDER, materialize: bool = True) -> DataFrame:
    """The first row (smallest ``order``) per identical text over the whole corpus; NULL texts are equal.

    ``df`` is read twice (keys, then the anti-join), so by default it is first written once as Parquet below the
    shared checkpoint folder; pass ``materialize=False`` for a frame that is cheap to read again, such as a scan.
    """
    if materialize:
        df = write_table(df, "exact-dedup-input")
    losers = exact_losers(df.select(order, text_key(text).alias("__h")), order)
    return df.join(losers, order, "left_anti")


# --- D5 ---------------------------------------------------------------------
#: Rows of a block on average: what one task scans in one round. A task keeps the block's buckets in memory.
BLOCK_ROWS = 1 << 18
UNDECIDED, KEPT, DROPPED = 0, 1, 2
_PLACE_BITS = 33  # monotonically_increasing_id: the block above, the place in it below


def _scan_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(id, bucket, wait, claimed)`` in order of ``id`` to ``(id, state, buckets)``.

    ``claimed``: a kept row of another block holds the bucket. ``wait``: an undecided row of an earlier block does.
    """
    claimed: set[int] = set()
    pending: set[int] = set()
    out: tuple[list, list, list] = ([], [], [])

    def settle(row: int, buckets: list[int], wait: bool, hit: bool) -> None:
        if hit or not claimed.isdisjoint(buckets):
            state, buckets = DROPPED, []
        elif wait or not pending.isdisjoint(buckets):
            state = UNDECIDED
            pending.update(buckets)
        else:
            state = KEPT
            claimed.update(buckets)
        for column, value in zip(out, (row, state, buckets)):
            column.append(value)

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int8()), pa.array(out[2], pa.list_(pa.int64()))], names=["id", "state", "buckets"]
        )
        for column in out:
            column.clear()
        return batch

    row, buckets, waits, hits = None, [], False, False
    for batch in batches:
        for i, b, w, c in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if i != row:
                if row is not None:
                    settle(row, buckets, waits, hits)
                row, buckets, waits, hits = i, [], False, False
            buckets.append(b)
            waits, hits = waits or w, hits or c
        if len(out[0]) > 1 << 14:
            yield flush()
    if row is not None:
        settle(row, buckets, waits, hits)
    yield flush()


def greedy_dropped(
    bands: DataFrame,
    order: str = ORDER,
    max_rounds: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, int]:
    """Orders dropped by the greedy scan, given ``(order, band, key)`` rows. Returns (dropped, rounds).

    Exact for any input. A row depends on earlier rows only, so a round decides at least the first block that is
    not decided yet, and there are at most as many rounds as blocks. One table is written a round; all but the
    returned one are deleted at the end. Two rows of equal ``order`` in one band are refused.
    """
    spark = bands.sparkSession
    block = F.shiftright("id", _PLACE_BITS)
    with scratch_tables(spark) as write:
        # The signatures behind the bands are computed a single time.
        bands = write(bands.select(order, F.col("band").cast("int").alias("band"), "key"), "bands")
        first = bands.groupBy("band", "key").agg(F.min(order).alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
        shared = bands.join(first, ["band", "key"]).groupBy(order).agg(F.collect_list(F.struct("band", "__first")).alias("__in"))
        rows = write(shared, "near-candidates")  # of each row at most one bucket a band
        n, n_bands, most = rows.agg(
            F.count(F.lit(1)), F.max(F.array_max("__in.band")) + 1, F.max(F.size("__in") - F.size(F.array_distinct("__in.band")))
        ).first()
        if not n:
            return spark.createDataFrame([], bands.select(order).schema), 0
        if most:
            raise ValueError("rows share a row order: every row needs its own")
        ids = rows.repartitionByRange(max(1, -(-n // block_rows)), order).sortWithinPartitions(order)
        ids = write(ids.withColumn("id", F.monotonically_increasing_id()), "near-ids")
        # a bucket is named by its first row and its band
        named = ids.select("id", F.explode("__in").alias("b")).select("id", "b.band", F.col("b.__first").alias("__first"))
        named = named.join(ids.select(F.col(order).alias("__first"), F.col("id").alias("first_id")), "__first")
        wait = F.shiftright("first_id", _PLACE_BITS) < block
        entries = named.select("id", (F.col("first_id") * n_bands + F.col("band")).alias("bucket"), wait.alias("wait"), F.lit(False).alias("claimed"))
        dropped, rounds = [], 0
        while True:
            rounds += 1
            if max_rounds is not None and rounds > max_rounds:
                raise RuntimeError(f"near-dedup did not settle within {max_rounds} rounds")
            dealt = entries.repartition(block).sortWithinPartitions("id")
            now = write(dealt.mapInArrow(_scan_block, "id long, state byte, buckets array<long>"), "near-round")
            dropped.append(now.where(F.col("state") == DROPPED).select("id"))
            left = now.where(F.col("state") == UNDECIDED)
            if left.isEmpty():
                break
            left = left.select("id", F.explode("buckets").alias("bucket"))
            kept = now.where(F.col("state") == KEPT).select(F.explode("buckets").alias("bucket"))
            held = left.select("bucket", block.alias("block"), F.lit(False).alias("claimed")).unionByName(
                kept.select("bucket", F.lit(None).cast("long").alias("block"), F.lit(True).alias("claimed"))
            )
            held = held.groupBy("bucket").agg(F.min("block").alias("block"), F.max("claimed").alias("claimed"))
            entries = left.join(held, "bucket").select("id", "bucket", (F.col("block") < block).alias("wait"), "claimed")
        lost = reduce(DataFrame.unionByName, dropped).join(ids.select("id", order), "id").select(order)
        return write_table(lost, "near-dropped"), rounds


def dedup_near_greedy(
    df: DataFrame,
    text: str = "input",
    order: str = ORDER,
    bands_df: DataFrame | None = None,
    materialize: bool = True,
) -> DataFrame:
    """Keep a row iff it shares no LSH band with an earlier *kept* row (rows in ``order``).

    ``df`` is read twice (signatures, then the final anti-join), so by default it is first written once as Parquet
    below the shared checkpoint folder. Rows that share an order are refused.
    """
    if materialize:
        df = write_table(df, "near-dedup-input")
    refuse_shared_order(df.select(order), order)
    if bands_df is None:
        sig = df.select(order, minhash_signature(F.col(text)).alias("signature"))
        bands_df = lsh_bands(sig, [order])
    dropped, _ = greedy_dropped(bands_df, order)
    return df.join(dropped, order, "left_anti")


# --- O1 ---------------------------------------------------------------------
def shuffle_key(order: Column | str, seed: int = SHUFFLE_SEED) -> Column:
    col = F.col(order) if isinstance(order, str) else order
    return F.md5(F.concat(F.lit(f"{seed}|"), col.cast("string")))


def _key_range(key: Column, partitions: int) -> Column:
    """The partition of a key: its first 32 bits are uniform, so equal ranges of them hold equal shares."""
    top = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.shiftright(top * partitions, 32).cast("int")


def _partitions(df: DataFrame, partitions: int | None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shuffle_seeded(df: DataFrame, order: str = ORDER, seed: int = SHUFFLE_SEED, partitions: int | None = None) -> DataFrame:
    """O1: a seeded, reproducible global shuffle: rows in order of a hash of their row order.

    The hash itself says which partition a row goes to, so there is no sampling pass and the input is evaluated
    once. Partition ``i`` holds the ``i``-th range of the hash, sorted, whatever the number of partitions.
    """
    n = _partitions(df, partitions)
    keyed = df.withColumn("__key", shuffle_key(order, seed))
    return keyed.repartitionById(n, _key_range(F.col("__key"), n)).sortWithinPartitions("__key", order).drop("__key")


def shuffle_ranked(df: DataFrame, order: str = ORDER, seed: int = SHUFFLE_SEED, rank: str = "shuffle_rank", partitions: int | None = None) -> DataFrame:
    """The rows with their place (from 0) in the shuffled order: the place inside a range of the hash plus the
    rows of earlier ranges, which a count over the orders alone gives. No task holds more than one range."""
    n = _partitions(df, partitions)
    key = shuffle_key(order, seed)
    sizes = df.select(_key_range(key, n).alias("__p")).groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__p").orderBy("__key", order)
    placed = df.withColumn("__key", key).withColumn("__p", _key_range(F.col("__key"), n)).withColumn("__i", F.row_number().over(inside) - 1)
    return placed.join(F.broadcast(starts), "__p").withColumn(rank, F.col("__start") + F.col("__i")).drop("__p", "__key", "__i", "__start")


# --- D6 / D7 ----------------------------------------------------------------
def dedup_pipeline(df: DataFrame, order: str = ORDER) -> DataFrame:
    """Exact dedup -> drop columns -> MinHash -> bands -> greedy near-dedup -> deduped rows.

    The rows are written once as Parquet below the shared checkpoint folder; keys and signatures are scans of it,
    and one anti-join removes the losers of both passes.
    """
    rows = write_table(df.select(*DEDUPED, order), "dedup-input")
    copies = exact_losers(rows.select(order, text_key("input").alias("__h")), order)
    unique = rows.join(copies, order, "left_anti")
    near, _ = greedy_dropped(lsh_bands(unique.select(order, minhash_signature("input").alias("signature")), [order]), order)
    return rows.join(copies.unionByName(near), order, "left_anti")


def dedup_by_adaptation(df: DataFrame, adaptation_type: str, order: str = ORDER, seed: int = SHUFFLE_SEED) -> DataFrame:
    """Instruction-tuning rows pass through, fine-tuning rows are deduplicated; then the seeded shuffle."""
    check_adaptation_type(adaptation_type)
    out = dedup_pipeline(df, order) if adaptation_type == FINE_TUNING else df
    return shuffle_seeded(out, order, seed)


__all__ = [
    "NUM_PERM",
    "THRESHOLD",
    "band_keys",
    "dedup_by_adaptation",
    "dedup_exact",
    "dedup_near_greedy",
    "dedup_pipeline",
    "exact_losers",
    "greedy_dropped",
    "lsh_bands",
    "lsh_candidates",
    "minhash_signature",
    "optimal_bands",
    "permutations",
    "shuffle_ranked",
    "shuffle_seeded",
    "token_hashes",
]
