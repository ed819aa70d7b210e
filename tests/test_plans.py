"""Physical-plan properties that the scale design relies on."""

import io
import os
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from corpusmill.operators import dedup as D
from corpusmill.operators import filters as FL
from corpusmill.operators import stats as ST
from corpusmill.operators.columns import clean_columns
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id").alias("row_order"), F.col("text").alias("input"), "source", "lang"
    )


def test_cleaning_runs_once_and_filters_reach_the_scan(spark):
    cleaned = FL.filter_nonempty_input(clean_columns(_docs(spark).where(F.col("source") == "src3"), ["input"]))
    plan = _plan(cleaned)
    assert "Python" not in plan  # the whole chain stays in the JVM
    tree = cleaned._jdf.queryExecution().executedPlan().toString()
    for step in ("reflect(", "translate(", "(?:www|http)"):  # evaluated once, not again for the gate or the filter
        assert tree.count(step) == 1, step
    assert "EqualTo(source,src3)" in plan  # the source predicate is pushed into the Parquet scan
    without = FL.filter_nonempty_input(clean_columns(_docs(spark), ["input"], nfc=False)).where(F.col("source") == "src3")
    assert "EqualTo(source,src3)" in _plan(without)
    read_schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "n_chars" not in read_schema  # unused columns are pruned at the scan


def test_stats_with_total_is_one_pass(spark):
    plan = _plan(ST.corpus_stats(_docs(spark)))
    scans = [ln for ln in plan.splitlines() if ln.startswith("(") and "Scan parquet" in ln]
    assert len(scans) == 1 and "Expand" in plan


def test_exact_dedup_aggregates_partially_before_the_shuffle(spark):
    plan = _plan(D.dedup_exact(_docs(spark)))
    assert "Sort (" not in plan or "SortMergeJoin" in plan  # no aggregation sorts or carries texts
    keys = _docs(spark).select("row_order", D.text_key("input").alias("__h"))
    first = _plan(keys.groupBy("__h").agg(F.min("row_order")))
    assert "HashAggregate" in first and "SortAggregate" not in first


def test_spread_only_small_narrow_inputs(spark, monkeypatch):
    from corpusmill.operators import partitioning as PT

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert "RoundRobinPartitioning" in _plan(PT.spread(docs, cores=8))
    # a large cluster does not make a large input eligible: the absolute ceiling applies
    monkeypatch.setattr(PT, "input_bytes", lambda df: 100 * 1024 ** 3)
    assert "RoundRobinPartitioning" not in _plan(PT.spread(docs, cores=8000))
    # one file per core or more: the scan already has the splits
    assert PT.spread(docs, cores=1) is docs


def test_broadcast_is_checked_by_bytes(spark):
    """Few but long rows are no broadcast side; many short ones within both bounds are."""
    from corpusmill.operators import joins

    long = spark.range(20).select("id", F.expr("repeat('x', 1000)").alias("text"), F.array(F.lit("y" * 500)).alias("parts"))
    assert joins.is_small(long) and not joins.is_small(long, max_bytes=20_000)
    assert not joins.is_small(long, max_rows=19) and joins.is_small(long.limit(0))
    big = spark.range(100).toDF("id")
    kept = joins.join_small(big, long.select("id", "text"), "id", "left_semi", max_bytes=1_000)
    assert kept.count() == 20
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert not hinted(kept) and hinted(joins.join_small(big, long, "id", "left_semi"))


def test_input_size_comes_from_the_planner(spark):
    from corpusmill.operators.partitioning import input_bytes

    path = f"{SF_SMALL}/documents.parquet"
    size = input_bytes(spark.read.parquet(path))
    assert 0 < size <= 2 * os.path.getsize(path)
