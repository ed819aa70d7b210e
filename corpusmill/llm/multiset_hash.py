"""Operator 3: document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs: its lines, cut further after sentence ends, so that a text of one line
still has parts. Each paragraph is hashed to a wide vector and the vectors are added lane by lane, modulo
powers of two: 4 equality lanes of 64 bits (modulo 2^64), a paragraph count (modulo 2^64), and 128 sign lanes
of 32 bits (modulo 2^32) to which a paragraph adds +1 or -1; no text has 2^31 paragraphs, so these never wrap. Adding or subtracting a paragraph's vector
inserts or deletes it; order does not matter. The sign lanes also estimate inner products, hence a likeness.

Defined cases: NULL texts are empty; an empty text has the zero fingerprint, and two zero fingerprints are
alike (1.0); equal texts have equal fingerprints; white space around paragraphs does not count. Rows with
equal ids follow each other by checksum and length; NULL ids come last. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text

WIDE, SIGNS = 4, 128
#: Rows that one part of the ordered table holds on average.
PART_ROWS = 8192
CUT = re.compile(r"\n+|(?<=[.!?])\s+")


def paragraphs(text: str | None) -> list[bytes]:
    return [p.encode("utf-8", "surrogatepass") for p in (x.strip() for x in CUT.split(text or "")) if p]


def combine(parts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the paragraphs' vectors: (count and equality lanes as uint64, sign lanes as uint16)."""
    raw = b"".join([hashlib.blake2b(p, digest_size=WIDE * 8 + SIGNS // 8).digest() for p in parts])
    h = np.frombuffer(raw, dtype=np.uint8).reshape(-1, WIDE * 8 + SIGNS // 8)
    n = len(h)
    wide = np.ascontiguousarray(h[:, : WIDE * 8]).view("<u8").sum(axis=0, dtype=np.uint64)
    ones = np.unpackbits(h[:, WIDE * 8 :], axis=1).sum(axis=0, dtype=np.int64)
    return np.concatenate([[np.uint64(n)], wide]), (2 * ones - n).astype(np.uint32)


def add(a, b, times: int = 1):
    """``a`` with ``b``'s paragraphs inserted (``times`` 1) or deleted (-1)."""
    k = np.array(times, dtype=np.int64)
    return a[0] + b[0] * k.astype(np.uint64), a[1] + b[1] * k.astype(np.uint32)


def to_text(f) -> str:
    return f[0].astype("<u8").tobytes().hex() + f[1].astype("<u4").tobytes().hex()


def from_text(s: str):
    raw = bytes.fromhex(s)
    return np.frombuffer(raw[: 8 * (WIDE + 1)], "<u8").copy(), np.frombuffer(raw[8 * (WIDE + 1) :], "<u4").copy()


def likeness(a, b) -> float:
    """``1 - |a-b|^2 / (|a|^2 + |b|^2)`` from the sign lanes, held within 0 and 1; equal fingerprints: 1."""
    if np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]):
        return 1.0
    x, y = a[1].astype(np.int32).astype(np.float64), b[1].astype(np.int32).astype(np.float64)
    whole = float(x @ x + y @ y)
    return min(1.0, max(0.0, 2.0 * float(x @ y) / whole)) if whole else 0.0


def _place(none: np.ndarray, down: np.ndarray, crc: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Order keys as byte strings of one width, which compare as the four numbers do."""
    raw = np.zeros(len(none), dtype=[("none", ">u1"), ("down", ">u8"), ("crc", ">u4"), ("chars", ">u4")])
    raw["none"], raw["crc"], raw["chars"] = none, crc, chars
    raw["down"] = down.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return raw.view("S17")


def _deal(heads: np.ndarray):
    """Twice the number of the part that a row belongs to, plus 1 for a part's first row."""

    def run(none: pa.Array, down: pa.Array, crc: pa.Array, chars: pa.Array) -> pa.Array:
        key = _place(*(x.to_numpy(zero_copy_only=False) for x in (none, down, crc, chars)))
        part = np.searchsorted(heads, key, side="right") - 1
        return pa.array(2 * part + (heads[np.maximum(part, 0)] == key), pa.int64())

    return F.arrow_udf(run, "long")


def fingerprint_edits(docs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Per document: ``n_chars``, the SHA-256 of its edited text, both fingerprints and two likenesses.

    The edited text is the first half with as many characters of the next document (descending id, the last
    followed by the first). Only order keys (id, checksum, length) are range-partitioned, so rows of one id are cut
    too; the first key of each part, 17 bytes for about ``part_rows`` rows, is gathered and broadcast. A row finds
    its part by binary search and goes there once, the first row of a part also to the end of the part before it;
    one task sorts one part, so every successor is in the same task.
    """
    src = id_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.col("doc_id").isNull().cast("int").alias("none"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).cast("long").alias("down"),
        F.crc32(F.encode("text", "UTF-8")).alias("crc"), F.length("text").alias("chars"),
    )
    order = ["none", "down", "crc", "chars"]
    parts = max(1, -(-docs.count() // part_rows))
    ranged = src.select(*order).repartitionByRange(parts, *order).groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*order)).alias("head"))
    table = ranged.select("head.*").toArrow()
    if not table.num_rows:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    heads = np.unique(_place(*(table.column(c).to_numpy() for c in order)))
    dealt = src.withColumn("dealt", _deal(heads)(*order)).withColumn("p", F.shiftright("dealt", 1).cast("int"))
    stays = F.struct(F.col("p").alias("p"), F.lit(False).alias("extra"))
    follows = F.struct(F.pmod(F.col("p") - 1, F.lit(len(heads))).alias("p"), F.lit(True).alias("extra"))
    to = F.explode(F.when(F.col("dealt") % 2 == 1, F.array(stays, follows)).otherwise(F.array(stays))).alias("to")
    rows = dealt.select("doc_id", "text", *order, to).select("doc_id", "text", *order, "to.p", "to.extra")
    return rows.repartitionById(len(heads), "p").sortWithinPartitions("extra", *order).select("doc_id", "text", "p", "extra").mapInArrow(_edit_ordered, SCHEMA)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edit_ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by part, its own rows in order and then the row that follows its last one."""
    out: list[tuple] = []
    held = None

    def close(row, nxt) -> tuple:
        doc_id, text, own = row
        n = len(text)
        edited = text[: n - n // 2] + nxt[1][: n // 2]
        changed = combine(paragraphs(edited))
        return (doc_id, n, hashlib.sha256(edited.encode("utf-8")).hexdigest(), to_text(own), to_text(changed), likeness(own, changed), likeness(own, nxt[2]))

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for doc_id, text, p, extra in zip(*(part.column(i).to_pylist() for i in range(4))):
                row = (doc_id, text, combine(paragraphs(text)))
                if held is not None and held[0] == p:
                    out.append(close(held[1], row))
                held = None if extra else (p, row)
            if len(out) >= 1000:
                yield flush()
                out = []
    if out:
        yield flush()


__all__ = ["add", "combine", "fingerprint_edits", "from_text", "likeness", "paragraphs", "to_text"]
