"""Operator 2: SimHash near-duplicates by tiled exact comparison.

Each text's shingles are hashed with XXH64; a fingerprint bit is set where over half of the hashes have it.
Equal fingerprints collapse first. Distinct fingerprints are sorted into tiles by the population counts of
their four 16-bit quarters. The Hamming distance is at least the sum of the four differences, so tile pairs
whose counts differ by more than the radius are skipped; all others are compared exactly with numpy exclusive
or and bit counts. A tile of any size is cut into blocks. Each pair of blocks returns a spanning forest of its
links (same components, never all pairs), and components grow from the forests by large-star and small-star
rounds.

Defined cases: a NULL or empty text has fingerprint zero and is linked like any other; fewer words than a
shingle needs give one shingle; repeated rows share a component; an empty table gives an empty result; rows
with a NULL id are returned without a component unless other rows share it; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, id_text, stage, unstage

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Fingerprints a block holds; two blocks are compared in memory at once.
BLOCK = 2048
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
QUARTERS = 4
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the ``shingle``-word shingles, repeats included; bytes.lower() changes A-Z only."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(seed)), dtype=np.uint64)
    cols = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(cols[:, i], minlength=256) @ _BITS for i in range(8)])
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(hashes)))


def text_mark(text: Column) -> Column:
    """A hash of the text; NULL counts as empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text) and ``fp``: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                fp = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp.view(np.int64))], names=["doc_id", "mark", "fp"])

    return id_text(docs).select("doc_id", text_mark(F.col("text")).alias("mark"), "text").mapInArrow(run, "doc_id long, mark long, fp long")


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of the quarters' counts within the radius, one of each pair of opposites, zero included."""
    near = [o for o in itertools.product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, o)) <= radius]
    return [o for o in near if o >= (0,) * QUARTERS]


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links (as two columns) that join what the pairs ``a[i]-b[i]`` join, at most one a node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    link = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[label[link]], nodes[link]])


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for left, right in zip(batch.column(0), batch.column(1)):
                a, b = np.frombuffer(left.as_buffer(), "<u8"), np.frombuffer(right.as_buffer(), "<u8")
                xs, ys = [], []
                for i in range(0, len(a), 256):
                    x, y = np.nonzero(np.bitwise_count(a[i : i + 256, None] ^ b[None, :]) <= radius)
                    keep = a[i + x] != b[y]
                    if keep.any():
                        link = _forest(a[i + x[keep]], b[y[keep]])
                        xs.append(link[0])
                        ys.append(link[1])
                if xs:
                    out.append(_forest(np.concatenate(xs), np.concatenate(ys)))
            if out:
                u, v = np.concatenate(out, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of fingerprints to bytes."""
    for batch in batches:
        packed = [np.asarray(x.values.to_numpy(zero_copy_only=False), "<i8").tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["tile", "fps"])


def links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints (column ``fp``) that join all pairs within ``radius``."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(0xFFFF)) for q in range(QUARTERS)]
    tiled = distinct.select("fp", sum((c.cast("long") * 32**q for q, c in enumerate(counts)), F.lit(0).cast("long")).alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    blocks = tiled.join(sizes, "tile").groupBy(
        "tile", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / block)).alias("k")
    ).agg(F.collect_list("fp").alias("fps"))
    blocks = stage(blocks.select("tile", "fps").mapInArrow(_pack, "tile long, fps binary").withColumn("b", F.monotonically_increasing_id()), "simhash-tiles")
    steps = F.array(*[F.lit(sum(d * 32**q for q, d in enumerate(o))).cast("long") for o in _offsets(radius)])
    left = blocks.select(F.col("fps").alias("a"), F.col("b").alias("ba"), "tile", F.explode(F.transform(steps, lambda s: s + F.col("tile"))).alias("other"))
    right = blocks.select(F.col("fps").alias("b"), F.col("b").alias("bb"), F.col("tile").alias("other"))
    pairs = left.join(right, "other").where((F.col("tile") != F.col("other")) | (F.col("ba") <= F.col("bb")))
    return pairs.select("a", "b").mapInArrow(_compare(radius), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the component's smallest node) for every node of ``edges`` (``u``, ``v``).

    Rounds of large-star and small-star; each is written to the shared folder and ends when the links no
    longer change. Only counts and checksums reach the driver.
    """
    now = stage(edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).where("u <> v").distinct(), "star")
    mark = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(low, "u")
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        new = stage(small, "star")
        unstage(now)
        now = new
        said = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if said == mark:
            break
        mark = said
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def clusters(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``mark``, ``fp``, ``root`` (a fingerprint that names the component), ``component_id`` (its smallest id)."""
    prints = stage(fingerprints(docs, shingle), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(distinct.select("fp"), radius, block))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    found = placed.join(least, "root").select("fp", "root", "component_id")
    return prints.join(found, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex), ``component_id`` (smallest id in the component)."""
    found = clusters(docs, shingle, radius, block)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: of the smallest id (NULL after all others)
    the text of the smallest mark, once however often the row repeats. Documents that share an id but no component
    are separate."""
    found = clusters(docs, shingle, radius, block)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("s"))
    mark, key, kept = fresh(docs, "__mark", "__id", "__kept")
    best = best.select(F.col("s.doc_id").alias(key), F.col("s.mark").alias(kept))
    rows = docs.withColumn(mark, text_mark(F.col("text")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(kept))
    return rows.join(best, same, "left_semi").dropDuplicates(["doc_id", mark]).drop(mark)
