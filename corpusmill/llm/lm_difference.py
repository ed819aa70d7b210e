"""Operator 10: cross-entropy difference of exact n-gram models.

A target model (documents marked as wanted) and a background model (all documents) count the same words and
pairs of adjacent words, each under its own text: nothing is folded together or left out. Both are bigram
models that fall back on their unigrams by Dirichlet smoothing; the vocabulary is every distinct word of the
input. A document's first token has no word before it and takes its unigram loss. A document's score is the
mean over its tokens of the target's loss minus the background's; lower is more like the target.

The models are matched: background counts weigh as much as if the background had as many tokens as the target, so
the same smoothing acts on both; and no document is scored by a model that holds it, as its own counts are taken out
of each model that it is part of first. So a target document and one like it that is not marked score alike.

Texts are packed into blocks of about ``BLOCK`` characters. The marks of target documents are as many as the
corpus has of them, so they are never broadcast: ids and marks meet in a shuffle join at every size. A block's
n-grams are counted before they are shuffled, so the most frequent n-gram has one entry a block, not one an
occurrence. Entries are dealt by the n-gram's hash into buckets, whose number grows with the input, and travel
sorted and compressed, one row a block and bucket. A bucket adds up equal n-grams by their text (the hash only
deals) and answers each block with the sums in the order in which it asked. Sums meet the texts by block, so a
task holds the counts of one block or one bucket, never a whole model.

Defined cases: NULL and empty texts have no tokens and score 0 with NULL losses; without target documents the
target model is uniform over the vocabulary and background counts weigh 1; a document's label rows count once however often they repeat;
repeated documents count as often as they occur, and each is scored without one occurrence of itself; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, stage

STRENGTH = 32.0  # weight of the unigram in the smoothed bigram
WORD = re.compile(r"\w+|[^\w\s]+")
BLOCK = 1 << 23  # characters of a block, at least one text
BUCKETS = 256  # at least; else one for two blocks, so that a bucket's entries stay bounded
MODELS = ("background", "target")

PACKED = "block long, ids array<long>, size long, texts binary"
ENTRIES = "bucket long, block long, n long, size long, grams binary, counts binary"
SUMS = "bucket long, block long, n long, sums binary, n_words long, background long, target long"
SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _pack(block_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ids, texts = TaskContext.get().partitionId() << 32, 0, [], []

        def flush() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            batch = pa.record_batch([pa.array(texts, pa.large_string())], names=["text"])
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            raw = sink.getvalue()
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([raw.size], pa.int64()), pa.array([pa.compress(raw, "zstd", asbytes=True)], pa.binary())],
                names=["block", "ids", "size", "texts"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = len(text or "") + 1
                if ids and held + n > block_size:
                    yield flush()
                    block, held, ids, texts = block + 1, 0, [], []
                held += n
                ids.append(doc_id)
                texts.append(text)
        if ids:
            yield flush()

    return run


class Block:
    """Words and pairs of a block's texts: ``ids`` (word numbers of all tokens, words in sorted order), ``sizes``
    (tokens of each text), ``later`` (places of tokens with another before them in their text), ``pairs`` and
    ``pair_at`` (the distinct pairs and each later token's). Entries are words, then pairs; ``order`` puts them by
    ``bucket``."""

    def __init__(self, size: int, packed: bytes, buckets: int):
        texts = pa.ipc.open_stream(pa.decompress(packed, size, "zstd")).read_all().column(0).to_pylist()
        found = [WORD.findall((text or "").lower()) for text in texts]
        self.sizes = np.array([len(words) for words in found], dtype=np.int64)
        tokens = pa.array(chain.from_iterable(found), pa.large_string(), size=int(self.sizes.sum())).dictionary_encode()
        del found
        order = pc.array_sort_indices(tokens.dictionary).to_numpy()
        self.words = tokens.dictionary.take(pa.array(order)).cast(pa.string())
        self.n = n = len(self.words)
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        self.ids = place[tokens.indices.to_numpy()] if n else np.zeros(0, np.int64)
        rest = np.ones(len(self.ids), dtype=bool)
        rest[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = False
        self.later = np.flatnonzero(rest)
        self.pairs, self.pair_at = np.unique(self.ids[self.later - 1] * n + self.ids[self.later], return_inverse=True)
        h = np.fromiter((xxhash.xxh64_intdigest(w, 10) for w in self.words.cast(pa.binary()).to_pylist()), dtype=np.uint64, count=n)
        if n:
            z = (h[self.pairs // n] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[self.pairs % n] * np.uint64(0xC2B2AE3D27D4EB4F))
            h = np.concatenate([h, z ^ (z >> np.uint64(29))])
        self.bucket = ((h >> np.uint64(11)) % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(self.bucket, kind="stable")

    def counts(self, mark: np.ndarray) -> np.ndarray:
        """Count of each entry over the tokens (a pair's: over its second token) that ``mark`` holds for."""
        return np.concatenate([np.bincount(self.ids[mark], minlength=self.n), np.bincount(self.pair_at[mark[self.later]], minlength=len(self.pairs))]).astype(np.int64)

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each token's word, and each later token's pair, occurs in its own text."""
        ends = np.cumsum(self.sizes)
        return _repeats(self.ids, ends), _repeats(self.pair_at, np.cumsum(np.maximum(self.sizes - 1, 0)))


def _repeats(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How often each value occurs in its own stretch; the stretches end at ``ends``."""
    out, lo = np.zeros(len(values), dtype=np.int64), 0
    for hi in ends.tolist():
        if hi > lo:
            _, at, n = np.unique(values[lo:hi], return_inverse=True, return_counts=True)
            out[lo:hi] = n[at]
        lo = hi
    return out


def _count(buckets: int):
    def run(texts: pa.Table, marked: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(6)]
        wanted = set(marked.column("doc_id").to_pylist()) if marked.num_rows else set()
        for row in texts.to_pylist():  # one row
            b = Block(row["size"], row["texts"], buckets)
            if not b.n:
                continue
            mark = np.repeat(np.array([i in wanted for i in row["ids"]], dtype=bool), b.sizes)
            both = [b.counts(np.ones(len(b.ids), dtype=bool))[b.order], b.counts(mark)[b.order]]
            # words hold no white space, so a pair's text is no other pair's and no word's
            pairs = pc.binary_join_element_wise(b.words.take(pa.array(b.pairs // b.n)), b.words.take(pa.array(b.pairs % b.n)), " ")
            grams = pa.concat_arrays([b.words, pairs]).take(pa.array(b.order))
            dealt = b.bucket[b.order]
            starts = np.flatnonzero(np.r_[True, dealt[1:] != dealt[:-1]])
            edges = np.r_[starts, len(dealt)]
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), grams), "\n")
            for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
                raw = joined[i].as_buffer()
                counts = np.concatenate([c[lo:hi] for c in both]).tobytes()
                values = (int(dealt[lo]), row["block"], int(hi - lo), raw.size, pa.compress(raw, "zstd", asbytes=True), pa.compress(counts, "zstd", asbytes=True))
                for c, v in zip(out, values):
                    c.append(v)
        types = (pa.int64(),) * 4 + (pa.binary(),) * 2
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=["bucket", "block", "n", "size", "grams", "counts"])

    return run


def _add(entries: pa.Table) -> pa.Table:
    """Sums of one bucket's n-grams, one row a block; its words and their totals stand in the first row only."""
    n = entries.column("n").to_numpy()
    raw = [pa.decompress(g, size, "zstd").to_pybytes().decode("utf-8", "surrogatepass") for g, size in zip(entries.column("grams").to_pylist(), entries.column("size").to_pylist())]
    grams = pa.chunked_array([pa.array(r.split("\n"), pa.string()) for r in raw]).combine_chunks().dictionary_encode()
    at, words = grams.indices.to_numpy(), pc.invert(pc.match_substring(grams.dictionary, " ")).to_numpy(zero_copy_only=False)
    del raw
    counts = [np.frombuffer(pa.decompress(c, 16 * int(k), "zstd"), np.int64).reshape(2, -1) for c, k in zip(entries.column("counts").to_pylist(), n)]
    sums = np.zeros((2, len(words)), dtype=np.int64)
    for which in (0, 1):
        np.add.at(sums[which], at, np.concatenate([c[which] for c in counts]))
    edges = np.concatenate([[0], np.cumsum(n)])
    back = [pa.compress(np.ascontiguousarray(sums[:, at[lo:hi]]).tobytes(), "zstd", asbytes=True) for lo, hi in zip(edges, edges[1:])]
    first = np.arange(len(n)) == 0
    whole = [int(words.sum()), *(int(s[words].sum()) for s in sums)]
    return pa.table(
        [entries.column("bucket"), entries.column("block"), entries.column("n"), pa.array(back, pa.binary()), *[pa.array(np.where(first, v, 0)) for v in whole]],
        names=["bucket", "block", "n", "sums", "n_words", *MODELS],
    )


def _score(buckets: int, n_words: int, totals: dict[str, int]):
    weights = {"target": 1.0, "background": totals["target"] / totals["background"] if totals["target"] else 1.0}

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in texts.to_pylist():  # one row
            b = Block(row["size"], row["texts"], buckets)
            rows = answers.to_pylist()
            asked = sorted((r for r in rows if r["wanted"] is None), key=lambda r: r["bucket"])
            wanted = {i for r in rows for i in r["wanted"] or ()}
            parts = [np.frombuffer(pa.decompress(r["sums"], 16 * r["n"], "zstd"), np.int64).reshape(2, -1) for r in asked]
            loss = {}
            if b.n:
                found = np.empty((2, len(b.order)), dtype=np.int64)
                found[:, b.order] = np.concatenate(parts, axis=1)
                own_word, own_pair = b.own()
                size = np.repeat(b.sizes, b.sizes)
                holds = {"background": np.ones(len(b.ids), dtype=np.int64), "target": np.repeat(np.array([i in wanted for i in row["ids"]], dtype=np.int64), b.sizes)}
                for which, name in enumerate(MODELS):
                    k, held = weights[name], holds[name]
                    seen = k * (found[which, : b.n][b.ids] - held * own_word)  # of each token, elsewhere
                    unigram = (seen + 1.0) / (k * (totals[name] - held * size) + n_words)
                    context, both = np.zeros(len(b.ids)), np.zeros(len(b.ids))
                    context[b.later] = seen[b.later - 1]
                    both[b.later] = k * (found[which, b.n :][b.pair_at] - held[b.later] * own_pair)
                    each = -np.log((both + STRENGTH * unigram) / (context + STRENGTH))
                    loss[name] = [float(each[end - k : end].mean()) if k else None for end, k in zip(np.cumsum(b.sizes), b.sizes)]
            target, background = (loss.get(name, [None] * len(b.sizes)) for name in ("target", "background"))
            score = [0.0 if x is None else x - y for x, y in zip(target, background)]
            out.append(pa.table(
                [pa.array(row["ids"], pa.int64()), pa.array(b.sizes), *[pa.array(c, pa.float64()) for c in (target, background, score)]],
                names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
            ))
        return pa.concat_tables(out) if out else EMPTY

    return run


EMPTY = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *[(c, pa.float64()) for c in ("target_loss", "background_loss", "score")]]).empty_table()


def score_documents(docs: DataFrame, wanted: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``n_tokens`` (long), ``target_loss``, ``background_loss`` (mean nats a token), ``score``.

    ``wanted`` has the ``doc_id`` of target documents.
    """
    texts = stage(id_text(docs).mapInArrow(_pack(block), PACKED), "lm-texts")
    buckets = max(BUCKETS, -(-texts.select("block").count() // 2))
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    held = texts.select("block", F.explode("ids").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    marked = held.join(ids.hint("merge"), "doc_id").select(F.col("block").alias("at"), "doc_id")
    entries = texts.groupBy("block").cogroup(marked.groupBy("at")).applyInArrow(_count(buckets), ENTRIES)
    sums = stage(entries.groupBy("bucket").applyInArrow(_add, SUMS), "lm-counts")
    whole = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", *MODELS)]).first()
    run = _score(buckets, whole["n_words"], {name: whole[name] for name in MODELS})
    answers = sums.select("block", "bucket", "n", "sums", F.lit(None).cast("array<long>").alias("wanted")).unionByName(
        marked.groupBy(F.col("at").alias("block")).agg(F.collect_list("doc_id").alias("wanted")), allowMissingColumns=True
    )
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SCORES)
