"""Dedup operators against brute-force formulations on small fixtures, plus invariants."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedup as D


def brute_greedy(rows):
    """Sequential scan: keep a row iff none of its band keys was claimed by an earlier kept row."""
    claimed, kept = set(), []
    for order, keys in sorted(rows):
        if claimed.isdisjoint(keys):
            kept.append(order)
            claimed.update(keys)
    return kept


def _bands_frame(spark, rows):
    flat = [(o, b, k) for o, keys in rows for b, k in keys]
    return spark.createDataFrame(flat, "row_order long, band int, key string")


def test_greedy_fixpoint_equals_sequential_scan(spark):
    rng = random.Random(7)
    for trial in range(6):
        n = rng.randint(20, 60)
        rows = []
        for o in range(n):
            keys = {(b, f"k{rng.randint(0, 12)}") for b in range(3)}
            rows.append((o * 3 + trial, keys))
        dropped, rounds = D.greedy_dropped(_bands_frame(spark, rows))
        dropped_set = {r[0] for r in dropped.collect()}
        kept = sorted(o for o, _ in rows if o not in dropped_set)
        assert kept == brute_greedy(rows), f"trial {trial}"
        assert rounds >= 1


def test_long_chain_by_rounds(spark):
    # edge i~i+1 is bucket (i % 2, "e<i>"): each row sits in two buckets (one per band), a path of 300
    for n, block_rows, most in ((300, D.BLOCK_ROWS, 1), (300, 20, 16), (40, 7, 7)):
        chain = [(i, {((i - 1) % 2, f"e{i - 1}"), (i % 2, f"e{i}")}) for i in range(n)]
        dropped, rounds = D.greedy_dropped(_bands_frame(spark, chain), block_rows=block_rows)
        kept = sorted(set(range(n)) - {r[0] for r in dropped.collect()})
        assert kept == brute_greedy(chain) == list(range(0, n, 2))
        assert rounds <= most


def test_greedy_over_many_blocks(spark):
    """Random rows in blocks of a few: equal to the sequential scan, with struct orders too."""
    rng = random.Random(11)
    rows = [(o, {(b, f"k{rng.randint(0, 60)}") for b in range(3)}) for o in range(160)]
    want = brute_greedy(rows)
    flat = _bands_frame(spark, rows)
    for block_rows in (5, 40):
        dropped, rounds = D.greedy_dropped(flat, block_rows=block_rows)
        assert sorted(set(range(160)) - {r[0] for r in dropped.collect()}) == want and rounds <= -(-160 // block_rows) + 3
    struct = flat.withColumn("row_order", F.struct(F.lit("f").alias("file"), F.col("row_order").alias("pos")))
    dropped, _ = D.greedy_dropped(struct, block_rows=40)
    assert sorted(set(range(160)) - {r[0].pos for r in dropped.collect()}) == want


def test_scratch_tables_are_removed(spark):
    import glob

    from corpusmill.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark).replace("file:", "") + "/corpusmill-stage/"
    rows = [(o, {(0, f"k{o // 3}"), (1, f"m{o % 7}")}) for o in range(60)]
    before = set(glob.glob(root + "*"))
    D.greedy_dropped(_bands_frame(spark, rows), block_rows=8)
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in set(glob.glob(root + "*")) - before] == ["near-dropped"]


def test_shared_orders_are_refused(spark):
    for rows in ([(1, "a b c"), (1, "d e f"), (2, "g")], [(None, "a"), (2, "b")]):
        df = spark.createDataFrame(rows, "row_order long, input string")
        for run in (D.dedup_exact, D.dedup_near_greedy):
            with pytest.raises(ValueError, match="row order"):
                run(df)


def test_null_texts_are_one_text(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, ""), (4, "")], "row_order long, input string")
    assert sorted(r.row_order for r in D.dedup_exact(df).collect()) == [1, 3]
    assert D.dedup_exact(df.where("false")).count() == 0 and D.dedup_near_greedy(df.where("false")).count() == 0


def test_greedy_chain_and_hot_bucket(spark):
    # chain a-b-c-d: greedy keeps a and c (not connected components, which would keep only a)
    chain = [(1, {(0, "x")}), (2, {(0, "x"), (1, "y")}), (3, {(1, "y"), (2, "z")}), (4, {(2, "z")})]
    dropped, _ = D.greedy_dropped(_bands_frame(spark, chain))
    assert sorted(r[0] for r in dropped.collect()) == [2, 4]
    # one bucket holding most rows is settled in one round without pairs
    hot = [(o, {(0, "hot")}) for o in range(200)] + [(1000, {(0, "solo")})]
    dropped, rounds = D.greedy_dropped(_bands_frame(spark, hot))
    assert dropped.count() == 199 and rounds == 1


def test_minhash_matches_python_reference(spark):
    texts = ["le chat dort", "le chat dort dort", "", "a b c d e f", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r.id: r.sig for r in df.select("id", D.minhash_signature("t").alias("sig")).collect()}
    a, b = (np.array(x, dtype=np.int64) for x in D.permutations())
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
            continue
        hs = {int(hashlib.sha1(tok.encode()).hexdigest()[:8], 16) for tok in t.split()}
        if not hs:
            expected = [D.EMPTY_HASH] * D.NUM_PERM
        else:
            h = np.array(sorted(hs), dtype=np.int64) % D.MERSENNE_P
            expected = ((h[:, None] * a[None, :] + b[None, :]) % D.MERSENNE_P).min(axis=0).tolist()
        assert list(got[i]) == expected
    assert list(got[0]) == list(got[1])  # same token set


def test_optimal_bands():
    assert D.optimal_bands(0.85, 128) == (8, 16)


def test_dedup_exact_keeps_smallest_order(spark):
    df = spark.createDataFrame([(5, "x", "a"), (2, "x", "b"), (9, "y", "c"), (7, "y", "d")], "row_order long, input string, source string")
    got = sorted((r.row_order, r.source) for r in D.dedup_exact(df).collect())
    assert got == [(2, "b"), (7, "d")]


def test_near_dedup_invariants_on_documents(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").alias("row_order"), F.col("text").alias("input"))
    exact = D.dedup_exact(docs)
    sig = exact.select("row_order", D.minhash_signature("input").alias("signature"))
    bands = D.lsh_bands(sig, ["row_order"], binary=False)
    rows = {}
    for r in bands.collect():
        rows.setdefault(r.row_order, set()).add((r.band, r.key))
    kept = set(r.row_order for r in D.dedup_near_greedy(exact).collect())
    assert sorted(kept) == brute_greedy(list(rows.items()))
    claimed = {}
    for o in sorted(kept):
        for k in rows[o]:
            assert k not in claimed  # independent: no two kept rows share a band
            claimed[k] = o
    for o, keys in rows.items():
        if o not in kept:  # maximal: every dropped row shares a band with an earlier kept row
            assert any(k in claimed and claimed[k] < o for k in keys)


def test_shuffle_is_deterministic_across_partitionings(spark):
    df = spark.range(500).withColumnRenamed("id", "row_order")
    a = [r.row_order for r in D.shuffle_seeded(df.repartition(1)).collect()]
    b = [r.row_order for r in D.shuffle_seeded(df.repartition(7)).collect()]
    assert a == b and sorted(a) == list(range(500)) and a != list(range(500))


def test_shuffle_ranks(spark):
    df = spark.range(700).selectExpr("id AS row_order", "concat('text ', id) AS text")
    want = [r.row_order for r in D.shuffle_seeded(df).collect()]
    for n in (1, 5, 64):
        assert [r.row_order for r in D.shuffle_seeded(df, partitions=n).collect()] == want
        ranked = D.shuffle_ranked(df, partitions=n).collect()
        assert [r.row_order for r in sorted(ranked, key=lambda r: r.shuffle_rank)] == want
        assert sorted(r.shuffle_rank for r in ranked) == list(range(700))


def test_near_dedup_independent_of_shuffle_partitions(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").alias("row_order"), F.col("text").alias("input"))
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            exact = D.dedup_exact(docs.repartition(int(n) * 3))
            results.append(sorted(r.row_order for r in D.dedup_near_greedy(exact).select("row_order").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] and len(results[0]) > 0
