"""Incremental ingestion: two arrivals of files give the same stats as one batch over everything."""

import json
import math
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import stats as ST
from corpusmill.streaming import ingest as IN
from corpusmill.streaming.ingest import FILES_PER_SOURCE, LISTING, ingested_stats, start_ingest


def _write(root, source, name, text):
    os.makedirs(os.path.join(root, source), exist_ok=True)
    with open(os.path.join(root, source, name), "w", encoding="utf-8") as fh:
        fh.write(text)


def test_incremental_ingest_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    corpus, stats, ckpt = (os.path.join(tmp_dir, d) for d in ("corpus", "stats", "ckpt"))
    first = {("A", "a1.txt"): "Le patient est arrivé hier soir.", ("B", "b1.txt"): "Une courte note\r\nsur deux lignes."}
    second = {("A", "a2.txt"): "Encore un texte avec des mots.", ("B", "b2.txt"): "x y", ("C", "c1.txt"): "Trois mots ici"}
    for (s, n), t in first.items():
        _write(src, s, n, t)
    start_ingest(spark, src, corpus, stats, ckpt).awaitTermination()
    for (s, n), t in second.items():
        _write(src, s, n, t)
    start_ingest(spark, src, corpus, stats, ckpt).awaitTermination()

    got = {r.label: r for r in ingested_stats(spark, stats).collect()}
    rows = [(s, t.replace("\r\n", "\n")) for (s, _), t in {**first, **second}.items()]
    df = spark.createDataFrame(rows, "source string, input string").withColumn("input", T.clean_text("input"))
    df = df.where(F.col("input") != "")
    want = {r.label: r for r in ST.stats_by_source(df).collect()}
    assert got.keys() == want.keys() == {"A", "B", "C"}
    for lab in want:
        assert got[lab].nb_docs == want[lab].nb_docs and got[lab].nb_words == want[lab].nb_words
        assert math.isclose(got[lab].std_chars, want[lab].std_chars, rel_tol=1e-9, abs_tol=1e-12)
    assert spark.read.parquet(corpus).count() == sum(r.nb_docs for r in want.values())

    # the last batch is replayed: its entry in the commit log is missing
    for name in ("1", ".1.crc"):
        os.remove(os.path.join(ckpt, "commits", name))
    start_ingest(spark, src, corpus, stats, ckpt).awaitTermination()
    assert {r.label: r for r in ingested_stats(spark, stats).collect()} == got
    assert spark.read.parquet(corpus).count() == sum(r.nb_docs for r in want.values())


def test_a_backlog_is_taken_in_batches(spark, tmp_dir):
    """Five files with two a batch make three batches; the merged stats are those of all files."""
    src = os.path.join(tmp_dir, "in")
    corpus, stats, ckpt = (os.path.join(tmp_dir, d) for d in ("corpus", "stats", "ckpt"))
    for i in range(5):
        _write(src, "A", f"{i}.txt", f"Trois mots ici numéro {i}.")
    start_ingest(spark, src, corpus, stats, ckpt, max_files_per_trigger=2).awaitTermination()
    assert sorted(d for d in os.listdir(corpus) if d.startswith("batch=")) == ["batch=0", "batch=1", "batch=2"]
    assert [r.nb_docs for r in ingested_stats(spark, stats).collect()] == [5]


def test_a_batch_writes_few_files_a_source(spark, tmp_dir):
    """Eighty small files in many scan tasks; a batch's files are listed by a few tasks a core."""
    src = os.path.join(tmp_dir, "in")
    corpus, stats, ckpt = (os.path.join(tmp_dir, d) for d in ("corpus", "stats", "ckpt"))
    for i in range(80):
        _write(src, "A", f"{i}.txt", f"Trois mots ici numéro {i}.")
    start_ingest(spark, src, corpus, stats, ckpt).awaitTermination()
    assert int(spark.conf.get(LISTING)) <= 4 * spark.sparkContext.defaultParallelism
    found = [n for n in os.listdir(os.path.join(corpus, "batch=0", "source=A")) if n.endswith(".parquet")]
    assert 0 < len(found) <= FILES_PER_SOURCE
    assert [r.nb_docs for r in ingested_stats(spark, stats).collect()] == [80]


def _lists(spark, ckpt):
    """The files of each list, in the order in which the stream takes the lists."""
    log = os.path.join(ckpt, "sources", "0")
    entries = [json.loads(line) for n in os.listdir(log) if not n.startswith(".") for line in open(os.path.join(log, n)) if line.startswith("{")]
    paths = [e["path"] for e in sorted(entries, key=lambda e: e["batchId"])]
    return paths, [sorted(r.file_path.rsplit("/", 1)[1] for r in spark.read.parquet(p).collect()) for p in paths]


def test_the_stream_keeps_lists_not_files(spark, tmp_dir):
    """Twenty files in lists of eight: the file stream's log, which the driver holds, has an entry of a list, and a
    restart lists what is new. The oldest files come first."""
    src = os.path.join(tmp_dir, "in")
    corpus, stats, ckpt = (os.path.join(tmp_dir, d) for d in ("corpus", "stats", "ckpt"))
    for i in range(20):
        _write(src, f"s {i % 3}", f"{i:02d}.txt", f"Trois mots ici numéro {i}.\r\nFin.")
        os.utime(os.path.join(src, f"s {i % 3}", f"{i:02d}.txt"), (1e9 - i, 1e9 - i))
    _write(src, "_hidden", "a.txt", "Trois mots ici cachés.")
    _write(src, "s 0", "empty.txt", "")
    start_ingest(spark, src, corpus, stats, ckpt, max_files_per_trigger=8).awaitTermination()
    paths, files = _lists(spark, ckpt)
    assert len(paths) == 3 and all(p.endswith(".parquet") for p in paths)
    oldest = [f"{i:02d}.txt" for i in reversed(range(20))]
    assert files == [sorted(oldest[i : i + 8]) for i in (0, 8, 16)]
    _write(src, "s 0", "new.txt", "Encore trois mots.")
    start_ingest(spark, src, corpus, stats, ckpt, max_files_per_trigger=8).awaitTermination()
    start_ingest(spark, src, corpus, stats, ckpt, max_files_per_trigger=8).awaitTermination()  # nothing new
    assert _lists(spark, ckpt)[1][3:] == [["new.txt"]]
    assert {r.label: r.nb_docs for r in ingested_stats(spark, stats).collect()} == {"s%200": 8, "s%201": 7, "s%202": 6}


def test_a_query_that_goes_on_lists_again(spark, tmp_dir, monkeypatch):
    src = os.path.join(tmp_dir, "in")
    corpus, stats, ckpt = (os.path.join(tmp_dir, d) for d in ("corpus", "stats", "ckpt"))
    _write(src, "A", "first.txt", "Trois mots ici.")
    monkeypatch.setattr(IN, "LISTING_SECONDS", 1)
    query = start_ingest(spark, src, corpus, stats, ckpt, available_now=False)
    _write(src, "B", "later.txt", "Encore trois mots.")

    def wait(done):
        until = time.time() + 60
        while not done() and time.time() < until:
            time.sleep(0.2)
        assert done()

    try:
        wait(lambda: spark.read.schema("file_path string").parquet(os.path.join(ckpt, "arrivals")).count() == 2)
        assert query.isActive
        wait(lambda: os.path.exists(os.path.join(stats, "batch=0", "_SUCCESS")))
        shutil.move(src, src + "-away")  # a listing that fails ends the query
        wait(lambda: not query.isActive)
    finally:
        query.stop()
    shutil.move(src + "-away", src)
    start_ingest(spark, src, corpus, stats, ckpt).awaitTermination()
    assert {r.label: r.nb_docs for r in ingested_stats(spark, stats).collect()} == {"A": 1, "B": 1}


def test_a_checkpoint_without_lists_is_refused(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "ckpt", "offsets"))
    _write(os.path.join(tmp_dir, "in"), "A", "a.txt", "Trois mots ici.")
    with pytest.raises(ValueError, match="without lists"):
        start_ingest(spark, os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "corpus"), os.path.join(tmp_dir, "stats"), os.path.join(tmp_dir, "ckpt"))
