"""Registered dedup queries (D1-D7, O1) over ``documents`` (row order = ``doc_id``)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import dedup as D
from ..operators.columns import clean_columns
from ..operators import filters as FL
from ..operators import reshape as R
from ..oracle import dedup_sql as DS
from ..oracle import text_sql as S
from ..schema import ORDER
from ..session import write_table
from .registry import register
from .tables import table

DOCS_SQL = "SELECT doc_id, source, text FROM documents"
EXACT_SQL = DS.exact_first_select(DOCS_SQL, "doc_id", "text")


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text")


@register("dedup_exact", "D1", f"SELECT doc_id, source, text FROM ({EXACT_SQL}) AS e")
def q_dedup_exact(spark, sf_dir):
    return D.dedup_exact(_docs(spark, sf_dir), text="text", order="doc_id", materialize=False)


def _sig_sql():
    return DS.signature_select(EXACT_SQL, "doc_id", "text")


@register(
    "minhash_signature",
    "D2",
    lambda: f"SELECT doc_id, array_to_string(signature, ',') AS signature FROM ({_sig_sql()}) AS s",
)
def q_minhash_signature(spark, sf_dir):
    d = D.dedup_exact(_docs(spark, sf_dir), text="text", order="doc_id", materialize=False)
    return d.select("doc_id", F.array_join(D.minhash_signature("text").cast("array<string>"), ",").alias("signature"))


def _bands_sql():
    return DS.bands_select(_sig_sql(), "doc_id")


def _bands(spark, sf_dir, binary=True):
    d = D.dedup_exact(_docs(spark, sf_dir), text="text", order="doc_id", materialize=False)
    sig = d.select("doc_id", D.minhash_signature("text").alias("signature"))
    return D.lsh_bands(sig, ["doc_id"], binary=binary)


@register("lsh_bands", "D3", lambda: f"SELECT doc_id, band, band_key FROM ({_bands_sql()}) AS b")
def q_lsh_bands(spark, sf_dir):
    return _bands(spark, sf_dir, binary=False).select("doc_id", F.col("band").cast("int").alias("band"), F.col("key").alias("band_key"))


@register(
    "lsh_candidates",
    "D4",
    lambda: f"""
WITH b AS ({_bands_sql()}),
m AS (SELECT band, band_key, min(doc_id) AS m FROM b GROUP BY band, band_key)
SELECT b.doc_id, min(m.m) AS first_candidate, count(*)::BIGINT AS n_bands
FROM b JOIN m USING (band, band_key) WHERE m.m < b.doc_id GROUP BY b.doc_id""",
)
def q_lsh_candidates(spark, sf_dir):
    return D.lsh_candidates(_bands(spark, sf_dir), order="doc_id")


@register(
    "dedup_near_greedy",
    "D5",
    lambda: f"SELECT doc_id FROM ({DS.greedy_kept_select(_bands_sql(), 'doc_id')}) AS k",
)
def q_dedup_near_greedy(spark, sf_dir):
    d = D.dedup_exact(_docs(spark, sf_dir), text="text", order="doc_id", materialize=False)
    return D.dedup_near_greedy(d, text="text", order="doc_id").select("doc_id")


# The whole fine-tuning path on cleaned documents: P1 -> T17 -> F1 -> D1 -> D2 -> D3 -> D5.
def _cleaned_sql():
    cleaned = S.clean_text_select(DOCS_SQL, ["doc_id", "source"], "text", "input")
    return f"SELECT doc_id, source, input FROM ({cleaned}) AS c WHERE NOT {S.is_blank('input')}"


def _pipeline_sql():
    exact = DS.exact_first_select(_cleaned_sql(), "doc_id", "input")
    bands = DS.bands_select(DS.signature_select(exact, "doc_id", "input"), "doc_id")
    kept = DS.greedy_kept_select(bands, "doc_id")
    return (
        f"SELECT NULL::VARCHAR AS instruction, e.input, NULL::VARCHAR AS output, e.source, e.doc_id AS {ORDER} "
        f"FROM ({exact}) AS e WHERE e.doc_id IN ({kept})"
    )


def cleaned_corpus(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    canon = R.canonical_projection(d, F.col("source"), None, "train", "text", order="doc_id")
    return FL.filter_nonempty_input(clean_columns(canon, ["input"]))


@register("dedup_pipeline", "D6", _pipeline_sql)
def q_dedup_pipeline(spark, sf_dir):
    return D.dedup_pipeline(cleaned_corpus(spark, sf_dir), order=ORDER)


@register(
    "dedup_by_adaptation",
    "D7",
    lambda: f"SELECT p.*, md5('42|' || p.{ORDER}) AS shuffle_key FROM ({_pipeline_sql()}) AS p",
)
def q_dedup_by_adaptation(spark, sf_dir):
    out = D.dedup_by_adaptation(cleaned_corpus(spark, sf_dir), "fine-tuning", order=ORDER)
    return out.withColumn("shuffle_key", D.shuffle_key(ORDER))


@register(
    "shuffle_seeded",
    "O1",
    "SELECT *, md5('42|' || doc_id) AS shuffle_key, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS shuffle_rank FROM documents",
)
def q_shuffle_seeded(spark, sf_dir):
    """Whole rows in shuffled order, each with its place as it was read off the shuffled partitions."""
    shuffled = D.shuffle_seeded(table(spark, sf_dir, "documents"), order="doc_id")
    return read_ranks(shuffled).withColumn("shuffle_key", D.shuffle_key("doc_id"))


def read_ranks(shuffled, rank: str = "shuffle_rank"):
    """Number the rows as they lie in the shuffled partitions, one after the other."""
    rows = write_table(shuffled.withColumn("__place", F.monotonically_increasing_id()), "shuffled")
    rows = rows.withColumn("__p", F.shiftright("__place", 33))
    sizes = rows.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sizes.select("__p", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    return rows.join(F.broadcast(starts), "__p").withColumn(rank, F.col("__place") + F.col("__shift")).drop("__p", "__place", "__shift")


@register(
    "shuffle_ranked",
    "O1",
    "SELECT doc_id, text, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS shuffle_rank FROM documents",
)
def q_shuffle_ranked(spark, sf_dir):
    return D.shuffle_ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), order="doc_id")
