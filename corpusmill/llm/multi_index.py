"""Operator 1: nearest neighbours by an inverted multi-index.

Vectors are scaled to length one and cut into two halves; each half has its own k-means codebook, fitted on a
bounded sample. A vector's cell is its pair of nearest centroids, and every vector is indexed. A query walks
the centroid pairs by increasing summed distance with a heap until the cells walked hold ``coverage`` of the
index; the vectors of those cells are reranked by exact cosine in double precision on the original vectors.

Equal vectors are indexed once: of a group of copies only the ``k + 1`` smallest distinct ids can ever be among
a query's ``k`` nearest (ties go to the smaller id, and one may be the query itself). Cells are cut into blocks of
bounded size and queries into groups of ``ASKED``; a task compares one group with one block.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components, and rows with a NULL id, take
no part (they get no rows as queries); vectors whose length is not the commonest one take no part either;
repeated rows count once; an id with several vectors is searched with each, and found by the best of them;
with fewer than ``k`` candidates all are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

K = 5
#: Vectors that the codebooks are fitted on, at most; centroids of a half.
SAMPLE, CENTROIDS = 20_000, 16
#: Share of the indexed vectors whose cells a query walks. Measured recall is in the README.
COVERAGE = 0.6
BLOCK = 4096
ASKED = 4096


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :]


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i : i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])


def walk(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
    """Cells (``i * len(d2) + j``) by increasing ``d1[i] + d2[j]`` until they hold ``enough`` vectors."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1], d2[o2]
    heap, seen, out, held = [(float(s1[0] + s2[0]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(o1[i]) * len(o2) + int(o2[j])
        if sizes[cell]:
            out.append(cell)
            held += int(sizes[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(s1) and b < len(s2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (float(s1[a] + s2[b]), a, b))
    return out


def _usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    sound = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    return v


def search(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           centroids: int = CENTROIDS, sample: int = SAMPLE, coverage: float = COVERAGE, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (int), ``vec_id``, ``score`` for the rows where ``is_query`` (on ``vec_id``) holds."""
    spark = df.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = stage(_usable(df, id_col, vec_col), "imi-vectors")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None or common["d"] < 2:
        return spark.createDataFrame([], schema)
    dim = common["d"]
    rows = rows.where(F.size("v") == dim)
    # one row a distinct vector, with the ids that can matter
    ranked = rows.distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    distinct = stage(ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "imi-distinct")
    fit = distinct.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(sample).select("v").toArrow()
    x = np.array(fit.column(0).combine_chunks().values).reshape(-1, dim) if fit.num_rows else np.zeros((0, dim))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    half = dim // 2
    books = kmeans(x[:, :half], centroids, 1), kmeans(x[:, half:], centroids, 2)

    def halves(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        m = batch.flatten().to_numpy().reshape(-1, dim)
        return m, m / np.linalg.norm(m, axis=1, keepdims=True)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, u = halves(b.column(0))
                cell = nearest(u[:, :half], books[0]) * len(books[1]) + nearest(u[:, half:], books[1])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell.astype(np.int64))], names=["v", "ids", "cell"])

    index = stage(distinct.mapInArrow(assign, "v array<double>, ids array<long>, cell long"), "imi-index")
    sizes = np.zeros(len(books[0]) * len(books[1]), dtype=np.int64)
    for r in index.groupBy("cell").count().collect():  # at most centroids ** 2 rows
        sizes[r["cell"]] = r["count"]
    enough = max(coverage * sizes.sum(), 50.0 * k)
    blocks = np.maximum(1, -(-sizes // block))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            _, u = halves(b.column(1))
            d1, d2 = distances(u[:, :half], books[0]), distances(u[:, half:], books[1])
            for i in range(b.num_rows):
                cells = walk(d1[i], d2[i], sizes, enough)
                cell = np.repeat(cells, blocks[cells])
                part = np.concatenate([np.arange(blocks[c]) for c in cells])
                one = pa.array(np.full(len(cell), i))
                yield pa.RecordBatch.from_arrays([b.column(0).take(one), b.column(1).take(one), pa.array(cell), pa.array(part)], names=["query_id", "v", "cell", "part"])

    asked = rows.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "v").distinct()
    groups = max(1, -(-asked.count() // ASKED))
    probes = asked.mapInArrow(probe, "query_id long, v array<double>, cell long, part long").withColumn("asked", F.pmod(F.xxhash64("query_id"), F.lit(groups)))
    edges = F.array(*[F.lit(int(n)) for n in blocks])
    indexed = index.withColumn("part", F.pmod(F.xxhash64("v"), F.element_at(edges, (F.col("cell") + 1).cast("int")).cast("long")))
    indexed = indexed.withColumn("asked", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

    def rerank(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        v = np.stack(c["v"].to_numpy())
        norm = np.sqrt((v * v).sum(1))
        ids = c["ids"].to_numpy()
        out: list[tuple[int, int, float]] = []
        for qid, qv in zip(q["query_id"], q["v"]):
            s = (v * qv).sum(1) / (norm * np.sqrt((qv * qv).sum()))
            n = k + 1
            while True:  # vectors of one id may take several places; ties at the edge stay
                top = np.flatnonzero(s >= np.partition(s, -n)[-n]) if len(s) > n else np.arange(len(s))
                best: dict[int, float] = {}
                for t in top:
                    for i in ids[t]:
                        if i != qid:
                            best[int(i)] = max(best.get(int(i), -2.0), float(s[t]))
                if len(best) >= k or n >= len(s):
                    break
                n *= 4
            near = sorted((-m, i) for i, m in best.items())[:k]
            out += [(int(qid), i, -m) for m, i in near]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    near = probes.groupBy("cell", "part", "asked").cogroup(indexed.groupBy("cell", "part", "asked")).applyInPandas(rerank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
