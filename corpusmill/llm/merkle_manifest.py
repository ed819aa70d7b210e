"""Operator 13: a Merkle manifest of a dataset, proofs by descent of a content-addressed DAG.

The manifest is a set of records ``digest -> children`` (16 at most), one table a height. Leaves of a source are
numbered in order; every 16 consecutive nodes become one record, up to the source's subroot, and the subroots
become one tree in turn. A leaf is found again without any stored position: its request starts at the root and
follows the digits (base 16) of its source's number and of its own rank. At every record it takes the child that
the digit names and collects the unselected children, left and right of it. At the leaf the collected segments
are reversed: that is the proof from the leaf up.

For scale: texts are hashed where they are read, only digests are sorted (range partitioning; a rank is the place
in the partition plus the rows of the source in earlier partitions, so no source meets in one task). Requests
of the 16 leaves of one run share all digits but the last and descend as one row. Heights of at most
``BROADCAST_NODES`` records (proven by the counts; 16 digests each) are broadcast, as their digests are hot keys;
the heights below are shuffle joins on the digest, where a key has at most 16 requests for each record above it.

All steps are native Spark expressions. Tables are staged in the shared folder.

Defined cases: NULL fields hash as ``-``; NULL sources are one source, ordered first; NULL ids come first in their
source and are never tampered with; leaves of equal id are ordered by their digest, so the result does not depend
on the partitioning, and equal rows are leaves of their own with proofs of their own; empty texts hash as ``0:``;
a source of one leaf has that leaf as its subroot; a dataset of one leaf has no siblings (the hash of nothing)
and that leaf as its root; an empty table gives an empty result; columns beyond the five hashed ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, unstage

BITS = 4  # of a digit
FANOUT = 1 << BITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST_NODES = 4096
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sorted_ranks(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df``, staged, with ``i`` (place from 0 within ``group`` in ``order``) and ``total`` (rows of the group)."""
    ordered = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stage(ordered.withColumn("place", F.monotonically_increasing_id()), f"{name}-sorted")
    rows = placed.withColumn("part", F.shiftright("place", 33))  # the partition's number
    counts = rows.groupBy(group, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy(group)  # one row a partition that the group reaches into
    earlier = of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(of).alias("total"))
    ranked = stage(rows.join(counts, [group, "part"]).withColumn("i", F.col("place") + F.col("shift")).drop("place", "part", "shift"), name)
    unstage(placed)
    return ranked


def heights(total: Column) -> Column:
    """Number of times that ``total`` nodes become every 16th until one is left."""
    n, out = total, F.lit(0)
    for _ in range(16):  # a long holds no more digits
        out = out + (n > 1).cast("int")
        n = F.shiftright(n + (FANOUT - 1), BITS)
    return out


def build(nodes: DataFrame, group: str, top: int, name: str) -> tuple[dict[int, DataFrame], DataFrame]:
    """Records of every height and the groups' roots, from ``nodes`` (group, total, i, digest).

    Returns the distinct records ``digest, children`` by height (from 1), and ``group, digest`` of the roots.
    """
    records: dict[int, DataFrame] = {}
    roots = nodes.where("total = 1").select(group, "digest")
    for h in range(1, top + 1):
        runs = nodes.where("total > 1").groupBy(group, "total", F.shiftright("i", BITS).alias("run"))
        runs = runs.agg(F.sort_array(F.collect_list(F.struct("i", "digest"))).alias("kids"))  # at most 16
        runs = runs.select(group, F.shiftright(F.col("total") + (FANOUT - 1), BITS).alias("total"), F.col("run").alias("i"), F.col("kids.digest").alias("children"))
        level = stage(runs.withColumn("digest", digest(F.array_join("children", ""))), f"{name}-{h}")
        records[h] = level.groupBy("digest").agg(F.first("children").alias("children"))  # equal digest, equal children
        nodes = level.select(group, "total", "i", "digest")
        roots = roots.unionByName(nodes.where("total = 1").select(group, "digest"))
    return records, roots


def descend(requests: DataFrame, records: DataFrame, n_records: int, digit: Column, started: Column) -> DataFrame:
    """One step down for the requests that have ``started``: the child under ``digit``, and the segment collected."""
    small = n_records <= BROADCAST_NODES
    # a request that has not started yet must match nothing, and many of them must not share one key
    key = F.when(started, F.col("at")).otherwise(F.concat(F.lit("-"), F.col("source"), F.lit("/"), F.col("run").cast("string")))
    records = records.select(F.col("digest").alias("__key"), "children")
    met = requests.withColumn("__key", key).join(F.broadcast(records) if small else records, "__key", "left")
    d = digit.cast("int")
    left = F.slice("children", F.lit(1), d)
    right = F.slice("children", d + 2, F.greatest(F.size("children") - d - 1, F.lit(0)))
    segment = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
    return (
        met.withColumn("path", F.when(started, F.concat(F.col("path"), F.array(segment))).otherwise(F.col("path")))
        .withColumn("at", F.when(started, F.get("children", d)).otherwise(F.col("at")))
        .drop("__key", "children")
    )


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """One row a document: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``."""
    spark = docs.sparkSession
    rows = docs.select(*[F.col(f"`{c}`") for c in FIELDS])
    leaves = rows.select(  # staged, so that the sort's sampling pass does not hash the texts again
        F.col("doc_id").cast("long").alias("doc_id"),
        # a source's key sorts like the source, NULL first
        F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0")).alias("source"),
        leaf_digest().alias("digest"),
        F.when(is_tampered(F.col("doc_id")), leaf_digest(text=F.translate(F.col("text").cast("string"), UPPER, LOWER))).alias("changed"),
    )
    leaves = stage(leaves, "merkle-hashed")
    ranked = sorted_ranks(leaves, "source", ["doc_id", "digest"], "merkle-leaves")
    unstage(leaves)
    sizes = ranked.groupBy("source").agg(F.first("total").alias("total"))
    top, n_sources = sizes.agg(F.max(heights(F.col("total"))), F.count(F.lit(1))).first()
    if not n_sources:
        return spark.createDataFrame([], RESULT)
    records, subroots = build(ranked.select("source", "total", "i", "digest"), "source", top, "merkle-records")

    # the tree of the subroots
    over = subroots.select(F.lit("").alias("all"), "source", "digest")
    over = sorted_ranks(over, "all", ["source"], "merkle-subroots")
    over_top = over.limit(1).select(heights(F.col("total"))).first()[0]
    over_records, roots = build(over, "all", over_top, "merkle-over")
    root = roots.first()["digest"]
    n_over = {h: -(-n_sources // FANOUT**h) for h in range(1, over_top + 1)}
    n_of = [F.sum(F.when(heights(F.col("total")) >= h, F.shiftright(F.col("total") + (FANOUT**h - 1), BITS * h)).otherwise(0)) for h in range(1, top + 1)]
    n_in = dict(enumerate(sizes.agg(F.lit(0), *n_of).first()[1:], 1))

    # requests: one row for each run of 16 leaves
    asked = F.sort_array(F.collect_list(F.struct("i", "doc_id", "digest", "changed")))
    requests = ranked.groupBy("source", "total", F.shiftright("i", BITS).alias("run")).agg(asked.alias("asked"))
    requests = requests.join(over.select("source", F.col("i").alias("number")), "source")
    empty = F.array().cast("array<struct<left:string,right:string>>")
    requests = requests.select("source", "number", "run", "asked", heights(F.col("total")).alias("height"), F.lit(root).alias("at"), empty.alias("path"))
    for h in range(over_top, 0, -1):
        requests = descend(requests, over_records[h], n_over[h], F.shiftright("number", BITS * (h - 1)) % FANOUT, F.lit(True))
    requests = requests.withColumn("subroot", F.col("at"))
    for h in range(top, 1, -1):
        # the digits of the leaf's rank above the last are those of its run
        requests = descend(requests, records[h], n_in[h], F.shiftright("run", BITS * (h - 2)) % FANOUT, F.col("height") >= h)
    if top:
        # last record: every leaf of the run takes its own child
        key = F.when(F.col("height") >= 1, F.col("at")).otherwise(F.concat(F.lit("-"), F.col("source")))
        last = records[1].select(F.col("digest").alias("__key"), F.col("children").alias("run_children"))
        requests = requests.withColumn("__key", key).join(F.broadcast(last) if n_in[1] <= BROADCAST_NODES else last, "__key", "left")
    else:
        requests = requests.withColumn("run_children", F.lit(None).cast("array<string>"))
    up = F.reverse("path")
    one = requests.select("subroot", up.alias("up"), "run_children", F.explode("asked").alias("leaf"))
    d = (F.col("leaf.i") % FANOUT).cast("int")
    mine = F.coalesce(F.get("run_children", d), F.col("subroot"))
    left = F.coalesce(F.array_join(F.slice("run_children", F.lit(1), d), ""), F.lit(""))
    right = F.coalesce(F.array_join(F.slice("run_children", d + 2, F.greatest(F.size("run_children") - d - 1, F.lit(0))), ""), F.lit(""))
    one = one.select(F.col("leaf.doc_id").alias("doc_id"), mine.alias("leaf"), F.coalesce("leaf.changed", "leaf.digest").alias("shown"), "subroot", "up", F.col("run_children").isNotNull().alias("in_run"), left.alias("left"), right.alias("right"))
    start = F.when(F.col("in_run"), digest(F.col("left"), F.col("shown"), F.col("right"))).otherwise(F.col("shown"))
    siblings = F.array_join(F.transform("up", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("up", start, lambda acc, s: digest(s["left"], acc, s["right"]))
    out = one.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), digest(F.col("left"), F.col("right"), siblings).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
