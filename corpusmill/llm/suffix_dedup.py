"""Operator 4: repeated windows by a depth-limited radix sort of suffixes.

Every suffix of every text (as UTF-8 bytes) is followed through ``window`` bytes only. The passes go from the
most significant digit down, and a suffix that is alone after a pass leaves:

1. Suffixes are dealt by the digit that any equal window must share: the ``window - 127`` bytes whose hash is
   least among the 128 such pieces of its window. Neighbouring suffixes share this piece, so a pass ships one
   row for a run of suffixes, not one each.
2. Runs that share the piece are split by the hash of all the bytes they cover. Runs equal in it are repeated
   as a whole.
3. Where a piece occurs with different surroundings, one run of each kind is cut into parts of ``PART``
   neighbouring suffixes, at fixed distances from the piece, so that equal windows fall into equal parts. The
   digit is now the bytes that all suffixes of a part share; parts alone in it leave, and parts whose group
   agrees in all the bytes they cover are repeated as a whole.
4. Only the suffixes of the parts that are left are grouped at full depth; groups of two or more are exactly the
   repeated windows.

Keys are 64-bit hashes compared only among suffixes that already share the 64-bit hash of the piece. Counts are
aggregated before the shuffles, so a passage that a third of the documents share stays a partial count. The digits
that are met again are written before suffixes are joined with them: both sides of such a join are then plain
shuffles, and Spark may split the suffixes of a hot digit over many tasks.

Defined cases: NULL texts are empty; texts shorter than ``window`` keep all bytes; equal rows (same id and
text) are repeats of each other; rows with equal or NULL ids and different texts are separate; very long texts
are cut into overlapping stretches; an empty table gives an empty result; other columns are ignored by
``window_digest`` and kept by ``drop_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, id_text, stage, unstage

WINDOW = 200
PIECES = 128  # pieces a window holds; a power of two
PART = 16  # suffixes a part holds
STRETCH = 1 << 21  # bytes hashed at once
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(4).integers(0, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Rolling:
    """Hashes of any byte range by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, limit: int):
        grow = np.full(limit, _BASE, dtype=np.uint64)
        grow[0] = 1
        back = np.full(limit, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        back[0] = 1
        self.grow, self.back = np.multiply.accumulate(grow), np.multiply.accumulate(back)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * self.grow[: len(data)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((prefix[end] - prefix[start]) * self.back[start])


def _stretches(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Joined bytes of several texts, and per part of a text: its number, offset in it, and bounds here.
    A text longer than a stretch is cut so that each window lies in exactly one stretch."""
    parts: list[tuple[int, int, bytes]] = []
    held = 0

    def done():
        size = np.array([len(b) for _, _, b in parts], dtype=np.int64)
        return np.frombuffer(b"".join(b for _, _, b in parts), np.uint8), np.array([i for i, _, _ in parts]), np.array([o for _, o, _ in parts]), np.concatenate([[0], np.cumsum(size)])

    for i, text in enumerate(texts):
        if len(text) < window:
            continue
        for at in range(0, len(text) - window + 1, STRETCH - window):
            piece = text[at : at + STRETCH - 1]
            if held + len(piece) > STRETCH:
                yield done()
                parts, held = [], 0
            parts.append((i, at, piece))
            held += len(piece)
    if parts:
        yield done()


def _runs(window: int):
    digit = window - PIECES + 1

    def of(texts: list[bytes], rolling: Rolling) -> Iterator[tuple[np.ndarray, ...]]:
        for data, number, offset, bounds in _stretches(texts, window):
            prefix = rolling.prefix(data)
            at = np.arange(len(data) - digit + 1)
            h = rolling.ranges(prefix, at, at + digit)
            low = (h & np.uint64(~((1 << 24) - 1) & (1 << 64) - 1)) | at.astype(np.uint64)
            step = 1
            while step < PIECES:  # least value among the PIECES places from here on
                low = np.minimum(low[:-step], low[step:])
                step *= 2
            start = np.arange(len(low))  # len(data) - window + 1 places
            part = np.searchsorted(bounds, start, side="right") - 1
            start = start[start + window <= bounds[part + 1]]
            if not len(start):
                continue
            part = np.searchsorted(bounds, start, side="right") - 1
            piece = (low[start] & np.uint64((1 << 24) - 1)).astype(np.int64)
            new = np.concatenate([[True], (piece[1:] != piece[:-1]) | (start[1:] != start[:-1] + 1)])
            first = np.flatnonzero(new)
            n = np.diff(np.concatenate([first, [len(start)]]))
            begin = start[first]
            x = piece[first]
            context = rolling.ranges(prefix, begin, begin + n - 1 + window)
            context = _mix(context ^ _mix((x - begin).astype(np.uint64) * np.uint64(512) + n.astype(np.uint64)))
            p = part[first]
            yield number[p], h[x].view(np.int64), context.view(np.int64), begin - bounds[p] + offset[p], n, x - begin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(STRETCH + 1)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                key, mark = part.column(0).to_numpy(), part.column(1).to_numpy()
                texts = [(t or "").encode("utf-8", "surrogatepass") for t in part.column(2).to_pylist()]
                for i, g, c, p, n, o in of(texts, rolling):
                    yield pa.RecordBatch.from_arrays([pa.array(key[i]), pa.array(mark[i]), pa.array(g), pa.array(c), pa.array(p.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(o.astype(np.int32))], names=["key", "mark", "g", "c", "p", "n", "o"])

    return run


def _parts(window: int):
    """Parts of picked runs: the digit ``k`` that their suffixes share, the hash ``v`` of all bytes covered, the
    first suffix ``p``, their number ``n`` and their full-depth keys ``w`` in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, mark, text, runs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                runs = runs.values
                all_p = runs.field("p").to_numpy()
                for lo in range(0, len(data), STRETCH - 2 * window):
                    mine = np.flatnonzero((all_p >= lo) & (all_p < lo + STRETCH - 2 * window))
                    if not len(mine):
                        continue
                    g, p, n, o, m = (runs.field(c).to_numpy()[mine] for c in ("g", "p", "n", "o", "m"))
                    rolling = Rolling(min(len(data) - lo, STRETCH) + 1)
                    prefix = rolling.prefix(data[lo : lo + STRETCH])
                    # a suffix that starts l bytes before the piece belongs to part l // PART
                    first, last = (o - n + 1) // PART, o // PART
                    count = last - first + 1
                    r = np.repeat(np.arange(len(mine)), count)
                    q = first[r] + np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)
                    near, far = np.maximum(o[r] - n[r] + 1, q * PART), np.minimum(o[r], q * PART + PART - 1)
                    piece = p[r] + o[r] - lo
                    k = rolling.ranges(prefix, piece - q * PART, piece - q * PART - PART + 1 + window)
                    v = rolling.ranges(prefix, piece - far, piece - near + window)
                    k, v = _mix(k + q.astype(np.uint64)), _mix(v ^ _mix((near * 512 + far).astype(np.uint64)))
                    size = far - near + 1
                    ends = np.cumsum(size)
                    start = np.repeat(piece - far - ends + size, size) + np.arange(ends[-1])
                    w = rolling.ranges(prefix, start, start + window).view(np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(w))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(r), pa.int64()), pa.array([mark] * len(r), pa.int64()), pa.array(g[r]), pa.array(k.view(np.int64)), pa.array(v.view(np.int64)),
                         pa.array(piece - far + lo), pa.array(size.astype(np.int32)), pa.array(m[r] == 1), lists],
                        names=["key", "mark", "g", "k", "v", "p", "n", "alone", "w"],
                    )

    return run


def removed_spans(src: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key``, ``mark`` and ``spans`` (array of struct<p, n>: ``n`` repeated windows from byte ``p``) of every
    text of ``src`` (``key``, ``mark``, ``text``) that holds a repeated window."""
    schema = "key long, mark long, g long, c long, p long, n int, o int"
    runs = stage(src.mapInArrow(_runs(window), schema), "suffix-runs")
    digit = runs.groupBy("g").agg(F.count(F.lit(1)).alias("all"), F.min("c").alias("c0"), F.max("c").alias("c1"))
    digit = stage(digit.where("all >= 2").select("g", (F.col("c0") != F.col("c1")).alias("many")), "suffix-digits")
    left = stage(runs.join(digit.hint("merge"), "g"), "suffix-left")
    unstage(runs)
    unstage(digit)
    kinds = left.where("many").groupBy("g", "c").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("key", "mark", "p", "n", "o")).alias("r"))
    kinds = stage(kinds.select("g", "c", "m", "r.*"), "suffix-kinds")
    of_run = F.struct("g", "p", F.col("n").cast("long").alias("n"), F.col("o").cast("long").alias("o"), "m")
    picked = kinds.groupBy("key", "mark").agg(F.collect_list(of_run).alias("runs"))
    texts = picked.join(src, ["key", "mark"]).dropDuplicates(["key", "mark"]).select("key", "mark", "text", "runs")
    parts = stage(texts.mapInArrow(_parts(window), "key long, mark long, g long, k long, v long, p long, n int, alone boolean, w array<long>"), "suffix-parts")
    digit = parts.groupBy("g", "k").agg(F.count(F.lit(1)).alias("all"), F.min("v").alias("v0"), F.max("v").alias("v1"))
    digit = stage(digit.where("all >= 2").select("g", "k", (F.col("v0") != F.col("v1")).alias("many")), "suffix-part-digits")
    met = stage(parts.join(digit.hint("merge"), ["g", "k"]).select("key", "mark", "g", "p", "n", "alone", "many", F.when(F.col("many"), F.col("w")).alias("w")), "suffix-met")
    unstage(parts)
    unstage(digit)
    deep = met.where("many").select("key", "mark", "g", "p", "alone", F.posexplode("w").alias("i", "w"))
    shared = stage(deep.groupBy("g", "w").agg(F.count(F.lit(1)).alias("k")).where("k >= 2").select("g", "w"), "suffix-shared")
    partly = deep.where("alone").join(shared.hint("merge"), ["g", "w"]).select("key", "mark", (F.col("p") + F.col("i")).alias("p"), F.lit(1).alias("n"))
    partly = partly.unionByName(met.where("alone AND NOT many").select("key", "mark", "p", "n"))
    whole = left.where("NOT many").select("key", "mark", "p", "n").unionByName(
        left.where("many").join(kinds.where("m >= 2").select("g", "c"), ["g", "c"]).select("key", "mark", "p", "n")
    )
    # rows equal in id and text have equal spans: a set, so that many such rows make no longer list
    return whole.unionByName(partly).groupBy("key", "mark").agg(F.collect_set(F.struct("p", "n")).alias("spans"))


def merged(spans: pa.Array | None, window: int, n_bytes: int) -> list[tuple[int, int]]:
    """Maximal removed byte ranges."""
    if spans is None or not len(spans):
        return []
    p = spans.field("p").to_numpy()
    e = p + spans.field("n").to_numpy() - 1 + window
    order = np.argsort(p, kind="stable")
    p, e = p[order], np.maximum.accumulate(e[order])
    first = np.flatnonzero(np.concatenate([[True], p[1:] > e[:-1]]))
    last = np.concatenate([first[1:], [len(p)]]) - 1
    return [(int(a), min(int(b), n_bytes)) for a, b in zip(p[first], e[last])]


def cut(data: bytes, ranges: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in ranges:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def whole_characters(data: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges shrunk so that no character is cut."""
    out = []
    for a, b in ranges:
        while a < b and a < len(data) and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _keyed(df: DataFrame, key: str, mark: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return df.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))).withColumn(mark, F.xxhash64(text))


def window_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (long), ``kept_sha256``."""
    src = _keyed(id_text(docs), "__key", "__mark")
    spans = removed_spans(src.select(F.col("__key").alias("key"), F.col("__mark").alias("mark"), "text"), window)
    both = src.join(spans.withColumnsRenamed({"key": "__key", "mark": "__mark"}), ["__key", "__mark"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                rows = []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2)):
                    data = (text or "").encode("utf-8", "surrogatepass")
                    r = merged(spans.values, window, len(data))
                    rows.append((len(data), sum(y - x for x, y in r), len(r), hashlib.sha256(cut(data, r)).hexdigest()))
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(x, pa.int64()) for x in c[:3]], pa.array(c[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return both.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with all their columns, every repeated window cut out of ``text`` (whole characters only)
    and ``n_chars``, if there is one, counted anew."""
    key, mark, held = fresh(docs, "__key", "__mark", "__spans")
    src = _keyed(docs, key, mark)
    spans = removed_spans(src.select(F.col(key).alias("key"), F.col(mark).alias("mark"), F.col("text").cast("string").alias("text")), window)
    spans = spans.withColumnsRenamed({"key": key, "mark": mark, "spans": held})
    both = src.join(spans, [key, mark], "left").drop(key, mark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("text")
            texts = b.column(at).to_pylist()
            for i, s in enumerate(b.column(b.schema.get_field_index(held))):
                if s.values is not None and len(s.values):
                    data = texts[i].encode("utf-8", "surrogatepass")
                    texts[i] = cut(data, whole_characters(data, merged(s.values, window, len(data)))).decode("utf-8", "surrogatepass")
            cols = [pa.array(texts, pa.string()) if k == at else b.column(k) for k in range(b.num_columns)]
            keep = [k for k, f in enumerate(b.schema) if f.name != held]
            yield pa.RecordBatch.from_arrays([cols[k] for k in keep], names=[b.schema[k].name for k in keep])

    out = both.mapInArrow(run, both.drop(held).schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
