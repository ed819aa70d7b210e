"""Operator 7: toxicity from the nearest labelled examples by exact TF-IDF cosine over a block-max index.

Terms are words and their 4- and 5-letter beginnings. The labelled rows that may be learned from are split by
``crc32(doc_id) % 3``: remainder 0 fills the index, remainder 2 calibrates the votes (and both choose the
terms by chi-square); remainder 1 is held out. At most ``EXAMPLES`` rows of either kind are used, the ones
first by a hash of the id; document frequencies are counted over all documents. The index keeps examples in
blocks with the largest weight of each term in each block; a query's blocks are taken by falling upper bound
until no block can hold a nearer example, so the neighbours are exact. Votes are weighted by nearness and
calibrated by isotonic regression.

Defined cases: NULL and empty texts, and texts without any chosen term, get the calibrated base score of such
texts; repeated label rows count once (toxic if any says so); labels that are NULL or without a document are
left out; with no labels every score is 0; examples of equal cosine are taken by a hash of their ids, never by their labels; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, share, stage

EXAMPLES, TERMS, NEAREST, BLOCK, THRESHOLD = 8_000, 2_000, 15, 64, 0.7
MIN_CHI2 = 30.0
NOT_LETTERS = r"[^\pL]+"
ROWS = 512  # texts handled at once


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of every word in order: the number of its text and the number of the word; and the distinct words."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), NOT_LETTERS)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    return row, coded.indices.to_numpy(), coded.dictionary


def forms(words: pa.Array) -> list[pa.Array]:
    """The terms that words stand for: each word, and its 4- and 5-letter beginnings, which carry a mark so
    that they are no words. NULL where a word is too short."""
    size = pc.utf8_length(words)
    none = pa.scalar(None, pa.string())
    out = [pc.if_else(pc.greater(size, 0), words, none)]
    for n in (4, 5):
        marked = pc.binary_join_element_wise(pa.scalar("^"), pc.utf8_slice_codeunits(words, 0, n), "")
        out.append(pc.if_else(pc.greater_equal(size, n), marked, none))
    return out


class Terms:
    """Counts chosen terms of texts."""

    def __init__(self, names: list[str]):
        self.names, self.n = pa.array(names, pa.string()), len(names)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the text, number of the term, and count; in this order, each pair once."""
        row, word, words = words_of(texts)
        rows, terms = [], []
        for form in forms(words):
            at = pc.fill_null(pc.index_in(form, value_set=self.names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            hit = at[word]
            rows.append(row[hit >= 0])
            terms.append(hit[hit >= 0])
        key, n = np.unique(np.concatenate(rows) * self.n + np.concatenate(terms), return_counts=True) if self.n else (np.empty(0, np.int64),) * 2
        return key // max(1, self.n), key % max(1, self.n), n

    def each(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Terms and counts of each text."""
        row, term, n = self(texts)
        at = np.searchsorted(row, np.arange(len(texts) + 1))
        for a, b in zip(at[:-1], at[1:]):
            yield term[a:b], n[a:b]


class BlockMaxIndex:
    """Unit vectors of examples (term -> weight dicts) with per-block maxima of every term."""

    def __init__(self, vectors: list[dict[int, float]], n_terms: int, block: int = BLOCK):
        self.block, self.n = block, len(vectors)
        n_blocks = -(-self.n // block) if self.n else 0
        self.top = np.zeros((n_terms, n_blocks), dtype=np.float64)
        lists: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        for i, v in enumerate(vectors):
            for t, w in v.items():
                lists[t].append((i, w))
                self.top[t, i // block] = max(self.top[t, i // block], w)
        self.ids = [np.array([i for i, _ in x], dtype=np.int64) for x in lists]
        self.weights = [np.array([w for _, w in x]) for x in lists]
        self.blocks = [x // block for x in self.ids]

    def nearest(self, query: dict[int, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest inner product above zero: (numbers, products), exact.

        The blocks of the highest bounds give a first threshold; then every other block whose bound reaches it.
        """
        terms = list(query)
        if not terms or not self.n:
            return np.empty(0, np.int64), np.empty(0)
        bound = np.array([query[t] for t in terms]) @ self.top[terms]
        few = max(4, 2 * -(-k // self.block))
        first = np.zeros(len(bound), dtype=bool)
        first[np.argpartition(-bound, min(few, len(bound)) - 1)[:few]] = True
        ids, scores = self._best(query, terms, first & (bound > 0), k)
        rest = ~first & (bound > 0)
        if len(ids) == k:
            rest &= bound >= scores[-1]
        if rest.any():
            more = self._best(query, terms, rest, k)
            ids, scores = np.concatenate([ids, more[0]]), np.concatenate([scores, more[1]])
            keep = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[keep], scores[keep]
        return ids, scores

    def _best(self, query: dict[int, float], terms: list[int], wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        acc = np.zeros(self.n)
        for t in terms:
            use = wanted[self.blocks[t]]
            acc[self.ids[t][use]] += query[t] * self.weights[t][use]
        found = np.flatnonzero(acc > 0)
        if len(found) > k:  # ties at the edge stay for the order below
            found = found[acc[found] >= np.partition(acc[found], -k)[-k]]
        keep = np.lexsort((found, -acc[found]))[:k]
        return found[keep], acc[found[keep]]


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the best non-decreasing fit of ``y`` on ``x`` (pool adjacent violators)."""
    xs, at = np.unique(x, return_inverse=True)
    n = np.bincount(at).astype(float)
    groups: list[list[float]] = []
    for v, w, m in zip(xs, n, np.bincount(at, weights=y) / n):
        groups.append([v, w, m])
        while len(groups) > 1 and groups[-2][2] >= groups[-1][2]:
            _, w2, m2 = groups.pop()
            g = groups[-1]
            g[2], g[1] = (g[2] * g[1] + m2 * w2) / (g[1] + w2), g[1] + w2
    return np.array([g[0] for g in groups]), np.array([g[2] for g in groups])


class Scorer:
    def __init__(self, names: list[str], idf: np.ndarray, examples: list[tuple[dict, int]], held: list[tuple[dict, int]], nearest: int):
        """``examples`` come in an order that does not depend on their labels; it breaks ties."""
        self.terms, self.idf, self.k = Terms(names), idf, nearest
        seen = sorted(((self.unit(c), y) for c, y in examples if c), key=lambda e: max(e[0], key=e[0].get))
        self.index = BlockMaxIndex([v for v, _ in seen], len(idf))
        self.labels = np.array([y for _, y in seen], dtype=float)
        self.cache: dict = {}
        rest = [(self.vote(c)[0], y) for c, y in held if c]
        self.steps = isotonic(np.array([v for v, _ in rest]), np.array([float(y) for _, y in rest])) if rest else (np.array([0.0]), np.array([0.0]))
        none = [y for c, y in [*examples, *held] if not c]
        self.base = float(sum(none)) / (len(none) + 1.0)

    def unit(self, counts: dict) -> dict[int, float]:
        w = {t: (1.0 + np.log(n)) * self.idf[t] for t, n in counts.items()}
        norm = np.sqrt(sum(x * x for x in w.values()))
        return {t: float(x / norm) for t, x in w.items()}

    def vote(self, counts: dict) -> tuple[float, np.ndarray, np.ndarray]:
        ids, near = self.index.nearest(self.unit(counts), self.k)
        if not len(ids):
            return 0.0, ids, near
        w = 1.0 / (1.05 - np.minimum(near, 1.0))
        return float(w @ self.labels[ids] / w.sum()), ids, near

    def score(self, texts: pa.Array) -> list[tuple[float, int, int]]:
        """Of each text: calibrated score, number of neighbours, and how many of them are toxic (the evidence)."""
        out = []
        for at in range(0, len(texts), ROWS):
            for t, n in self.terms.each(texts.slice(at, ROWS)):
                out.append(self._score(t, n) if len(t) else (self.base, 0, 0))
        return out

    def _score(self, t: np.ndarray, n: np.ndarray) -> tuple[float, int, int]:
        key = t.tobytes() + n.tobytes()
        if key not in self.cache:
            if len(self.cache) > 50_000:
                self.cache = {}
            vote, ids, _ = self.vote(dict(zip(t.tolist(), n.tolist())))
            x, y = self.steps
            score = float(y[max(0, np.searchsorted(x, vote, side="right") - 1)])
            self.cache[key] = (score, len(ids), int(self.labels[ids].sum()))
        return self.cache[key]


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, terms: int = TERMS, nearest: int = NEAREST) -> Scorer:
    """Fit on the bounded rows; only document frequencies read all documents."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IS NOT NULL"
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(fold(F.col("doc_id")) != 1)
    picked = marks.join(id_text(docs).select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id")).limit(2 * examples)
    rows = stage(id_text(docs).join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"]), "toxicity-examples")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each term of some rows: how many of them, and how many toxic ones, hold it."""
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                toxic = part.column(0).to_numpy()
                row, word, words = words_of(part.column(1))
                for form in forms(words):
                    coded = form.dictionary_encode()
                    term = pc.fill_null(coded.indices, -1).to_numpy().astype(np.int64)[word]
                    size = len(coded.dictionary)
                    pair = np.unique(row[term >= 0] * max(1, size) + term[term >= 0])
                    n = np.bincount(pair % max(1, size), minlength=size)
                    a = np.bincount(pair % max(1, size), weights=toxic[pair // max(1, size)], minlength=size)
                    yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(a), pa.array(n.astype(np.float64))], names=["term", "a", "n"])

    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = float(totals.get(1, 0)), float(totals.get(0, 0))
    if not n1 or not n0:
        return Scorer([], np.zeros(0), [], [], nearest)
    seen = rows.select("toxic", "text").mapInArrow(bags, "term string, a double, n double").groupBy("term").agg(F.sum("a").alias("a"), F.sum("n").alias("n"))
    a, b = F.col("a"), F.col("n") - F.col("a")
    c, d = n1 - a, n0 - b
    chi2 = (n1 + n0) * (a * d - b * c) ** 2 / (n1 * n0 * F.col("n") * (n1 + n0 - F.col("n")) + 1e-9)
    chosen = seen.withColumn("chi2", chi2).where((F.col("chi2") >= MIN_CHI2) & (a / n1 > b / n0)).orderBy(F.desc("chi2"), "term").limit(terms)
    names = [r["term"] for r in chosen.select("term").collect()]
    if not names:
        return Scorer([], np.zeros(0), [], [], nearest)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Terms(names)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                t, n = zip(*counter.each(part.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(t, pa.list_(pa.int64())), pa.array(n, pa.list_(pa.int64()))],
                    names=["doc_id", "toxic", "t", "n"],
                )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, df, n = Terms(names), np.zeros(len(names), dtype=np.int64), 0
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                texts = b.column(0).slice(at, ROWS)
                df += np.bincount(counter(texts)[1], minlength=len(names))
                n += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(df))), pa.array(np.concatenate([[n], df]))], names=["t", "n"])

    counts = dict(id_text(docs).select("text").mapInArrow(frequencies, "t long, n long").groupBy("t").agg(F.sum("n")).collect())
    idf = np.array([np.log((1.0 + counts.get(-1, 0)) / (1.0 + counts.get(i, 0))) + 1.0 for i in range(len(names))])
    table = rows.select("doc_id", "toxic", "text").mapInArrow(vectors, "doc_id long, toxic int, t array<long>, n array<long>").toArrow().to_pylist()
    table.sort(key=lambda r: (hashlib.sha256(str(r["doc_id"]).encode()).digest(), r["doc_id"]))
    sets: tuple[list, list] = ([], [])
    for r in table:
        sets[zlib.crc32(str(r["doc_id"]).encode()) % 3 == 2].append((dict(zip(r["t"], r["n"])), r["toxic"]))
    return Scorer(names, idf, sets[0], sets[1], nearest)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``neighbours`` and ``toxic_neighbours`` (int)."""
    shared = share(docs.sparkSession, train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared()
        for b in batches:
            if b.num_rows:
                s, n, m = zip(*scorer.score(b.column(1)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array(n, pa.int32()), pa.array(m, pa.int32())], names=["doc_id", "score", "neighbours", "toxic_neighbours"])

    scored = id_text(docs).mapInArrow(run, "doc_id long, score double, neighbours int, toxic_neighbours int")
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "neighbours", "toxic_neighbours",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns kept, that are not predicted toxic. Rows without an id are scored like others."""
    shared = share(docs.sparkSession, train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared()
        for b in batches:
            texts = b.column(b.schema.get_field_index("text"))
            yield b.filter(pa.array([s < threshold for s, _, _ in scorer.score(texts)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
