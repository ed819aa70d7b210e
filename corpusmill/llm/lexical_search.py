"""Operator 11: ranked lexical search by an Aho-Corasick scan of the documents, without a document index.

The distinct terms of all items of a block form one automaton, which is broadcast. Every term is guarded by a
blank on either side; a text is scanned with its separators turned to blanks, so that only whole terms match and
one pass over the text counts the occurrences of every item term. An automaton output is a term's number, and a
postings table maps it to the items that hold the term.

1. Scan: per document its number of terms ``n`` and the counts of the item terms that occur, staged in the shared
   folder (the texts are read once).
2. Statistics over all documents, one aggregate: N, L, and df for the item terms.
3. Scores: integer arithmetic per (document, term), summed per (document, item); a task keeps the best ``top``
   documents of each item that it saw, and windows over those rows, salted first, give the ranks.

Items are read in order of their id and dealt into blocks of at most ``BLOCK_ITEMS`` items and about
``BLOCK_TERMS`` distinct terms, which bounds the broadcast whatever the size of the item table (one item alone
may exceed it). Each block scans all documents.

Defined cases: NULL, empty and term-free texts do not count in N and are never found; NULL item texts and items
without terms return nothing; rows of equal ``item_id`` (NULL included) are one item with all their terms; every
row of the documents is a document, so that repeated rows are each ranked; equal scores go by ascending
``doc_id``, NULL ids last, rows of equal id in any order; a very long text is scanned whole; empty tables give
an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, share, stage

TOP = 50
BLOCK_ITEMS, BLOCK_TERMS = 2_000, 100_000
SALTS = 64
#: Bytes of text scanned at once (or one longer text), documents scored at once.
SCAN_BYTES, SCORE_DOCS = 1 << 21, 512
#: Bytes: A-Z to lower case, other ASCII that is no digit or letter to a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
RESULT = "item_id long, rank int, doc_id long, score long"


def terms_of(text: str | None) -> list[str]:
    return [t.decode() for t in (text or "").encode("utf-8", "replace").translate(FOLD).split()]


def build_automaton(terms: list[str]):
    """Automaton over the guarded terms; an output is the term's place in ``terms``. Bytes stand as characters."""
    import ahocorasick

    auto = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        auto.add_word(f" {t} ".encode().decode("latin-1"), i)
    if terms:
        auto.make_automaton()
    return auto


def count_terms(auto, n_terms: int, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of each folded text; and the text, term and tf of every item term found, in text order."""
    joined = b" " + b" ".join(texts) + b" "
    data = np.frombuffer(joined, np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])  # the place of the blank that follows each text
    begins = np.flatnonzero((data[1:] != 32) & (data[:-1] == 32)) + 1
    n = np.bincount(np.searchsorted(ends, begins), minlength=len(texts))
    if not n_terms:
        return n, *(np.zeros(0, np.int64) for _ in range(3))
    hits = np.fromiter(itertools.chain.from_iterable(auto.iter(joined.decode("latin-1"))), np.int64)
    # an output ends on the blank behind the term, so the term's last byte lies one before
    key, tf = np.unique(np.searchsorted(ends, hits[::2] - 1) * n_terms + hits[1::2], return_counts=True)
    return n, key // n_terms, key % n_terms, tf


def _scan(auto_of, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = auto_of()
        for b in batches:
            size = np.cumsum(np.maximum(1, _lengths(b.column(1))))
            for part in np.split(np.arange(b.num_rows), np.searchsorted(size, np.arange(SCAN_BYTES, size[-1], SCAN_BYTES)) if len(size) else []):
                if not len(part):
                    continue
                rows = b.slice(int(part[0]), len(part))
                texts = [(t or "").encode("utf-8", "replace").translate(FOLD) for t in rows.column(1).to_pylist()]
                n, doc, term, tf = count_terms(auto, n_terms, texts)
                at = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(at, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(tf.astype(np.int64)))],
                    names=["doc_id", "n", "terms", "tf"],
                )

    return run


def _lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def best_rows(item: np.ndarray, doc: np.ndarray, score: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` rows of each item by descending score, then ascending document."""
    order = np.lexsort((doc, -score, item))
    it = item[order]
    first = np.flatnonzero(np.concatenate([[True], it[1:] != it[:-1]])) if len(it) else np.zeros(0, np.int64)
    within = np.arange(len(it)) - np.repeat(first, np.diff(np.concatenate([first, [len(it)]])))
    return order[within < top]


NO_ID = np.iinfo(np.int64).max  # stands for a NULL id inside a task: last among ties


def _score(load, top: int):
    """Best rows of a task: ``item`` (place), ``doc_id``, ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, post_at, post_item, n_items, n_docs, n_terms = load()
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        least = np.zeros(n_items, np.int64)  # a row below this cannot be among an item's best

        for b in batches:
            for at in range(0, b.num_rows, SCORE_DOCS):
                rows = b.slice(at, SCORE_DOCS)
                ids = rows.column(0).fill_null(NO_ID).to_numpy()
                size = np.diff(rows.column(2).offsets.to_numpy())
                doc, term, tf = np.repeat(np.arange(rows.num_rows), size), rows.column(2).flatten().to_numpy(), rows.column(3).flatten().to_numpy()
                m = np.array([50 + (50 * n * n_docs) // n_terms for n in rows.column(1).to_pylist()], dtype=np.int64)
                part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                # every (document, term) meets the items that hold the term
                n_post = post_at[term + 1] - post_at[term]
                ends = np.cumsum(n_post)
                item = post_item[np.repeat(post_at[term] - ends + n_post, n_post) + np.arange(ends[-1] if len(ends) else 0)]
                total = np.zeros(rows.num_rows * n_items, np.int64)
                np.add.at(total, np.repeat(doc, n_post) * n_items + item, np.repeat(part, n_post))
                total = total.reshape(-1, n_items)
                d, i = np.nonzero((total > 0) & (total >= least))
                held = [np.concatenate([h, x]) for h, x in zip(held, (i, ids[d], total[d, i]))]
                if len(held[0]) > 4 * top * n_items:
                    held = [h[best_rows(*held, top)] for h in held]
                    full = np.bincount(held[0], minlength=n_items) >= top
                    low = np.full(n_items, NO_ID)
                    np.minimum.at(low, held[0], held[2])
                    least = np.where(full, low, 0)
        keep = best_rows(*held, top)
        if len(keep):
            item, ids, score = (h[keep] for h in held)
            yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(ids, mask=ids == NO_ID), pa.array(score)], names=["item", "doc_id", "score"])

    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str, max_items: int, max_terms: int) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Items with their distinct terms, in blocks; only one block is on the driver at a time."""
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    block: list[tuple[int | None, list[str]]] = []
    seen: set[str] = set()
    for item_id, group in itertools.groupby(rows.orderBy("item_id").toLocalIterator(), key=lambda r: r["item_id"]):
        terms = sorted({t for r in group for t in terms_of(r["text"])})
        if block and (len(block) >= max_items or len(seen.union(terms)) > max_terms):
            yield block
            block, seen = [], set()
        if terms:
            block.append((item_id, terms))
            seen.update(terms)
    if block:
        yield block


def _search_block(docs: DataFrame, block: list[tuple[int | None, list[str]]], top: int) -> DataFrame:
    spark = docs.sparkSession
    terms = sorted({t for _, mine in block for t in mine})
    place = {t: i for i, t in enumerate(terms)}
    auto_of = share(spark, build_automaton(terms))
    counts = stage(docs.mapInArrow(_scan(auto_of, len(terms)), "doc_id long, n long, terms array<int>, tf array<long>"), "lexical-counts")
    n_docs, n_terms = counts.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return spark.createDataFrame([], RESULT)
    weight = np.zeros(len(terms), np.int64)
    for r in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():  # at most one row a term of the block
        weight[r["t"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    pairs = sorted((place[t], i) for i, (_, mine) in enumerate(block) for t in mine)
    post_at = np.searchsorted([t for t, _ in pairs], np.arange(len(terms) + 1))
    load = share(spark, (weight, post_at, np.array([i for _, i in pairs], np.int64), len(block), n_docs, n_terms))
    near = counts.where("size(terms) > 0").mapInArrow(_score(load, top), "item int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # a task sends at most `top` rows an item; salted windows first, so that no window holds those of all tasks
    near = near.withColumn("salt", F.spark_partition_id() % SALTS)
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id long")  # at most BLOCK_ITEMS rows
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, item_col: str = "item_id", item_text: str = "text", top: int = TOP,
           block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id``, ``rank`` (int, from 1), ``doc_id``, ``score``: each item's ``top`` documents with score above 0."""
    src = id_text(docs)
    found = [_search_block(src, block, top) for block in item_blocks(items, item_col, item_text, block_items, block_terms)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], RESULT)


#: The same ranking in DuckDB, over posting rows.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
n AS (SELECT rid, doc_id, len(w)::BIGINT AS n, w FROM d WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM n),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
),
tf AS (
  SELECT rid, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT rid, doc_id, n, unnest(w) AS t FROM n) AS u
  WHERE t IN (SELECT t FROM q) GROUP BY ALL
),
df AS (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t),
part AS (
  SELECT tf.rid, tf.doc_id, tf.t,
    floor(1000 * ln((2 * s.nn + 2)::DOUBLE / (2 * df.df + 1)::DOUBLE))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * s.nn) // s.ll))) AS p
  FROM tf JOIN df USING (t), s
),
score AS (SELECT item_id, rid, doc_id, sum(p)::BIGINT AS score FROM q JOIN part USING (t) GROUP BY ALL HAVING sum(p) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM score QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""
