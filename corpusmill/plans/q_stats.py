"""Registered statistics queries (A1-A9) and the flagship corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedup as D
from ..operators.columns import clean_columns
from ..operators import filters as FL
from ..operators import reshape as R
from ..operators import stats as ST
from ..oracle import dedup_sql as DS
from ..oracle import reshape_sql as RS
from ..oracle import stats_sql as SS
from ..oracle import text_sql as S
from ..session import write_table
from ..schema import CANONICAL_SCHEMA, ORDER
from ..sources.catalog import catalog_from_corpus
from .registry import register
from .tables import table

DOC_SQL = "SELECT doc_id, source, lang, text FROM documents"


def round_stats(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 decimals for engine-independent comparison."""
    return df.select(
        *[F.round(F.col(c), 6).alias(c) if c.startswith(("mean", "std")) else F.col(c) for c in df.columns]
    )


def _raw(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return R.canonical_projection(d, F.col("source"), None, "train", "text", order="doc_id")


@register("stats_by_source", "A1", lambda: SS.rounded(SS.per_label(DOC_SQL, "text")))
def q_stats_by_source(spark, sf_dir):
    return round_stats(ST.stats_by_source(_raw(spark, sf_dir)))


@register("distinct_sources", "A2", "SELECT DISTINCT source FROM documents")
def q_distinct_sources(spark, sf_dir):
    return ST.distinct_sources(table(spark, sf_dir, "documents"))


@register("stats_total_pooled", "A3", lambda: SS.rounded(SS.with_total(SS.per_label(DOC_SQL, "text"))))
def q_stats_total_pooled(spark, sf_dir):
    return round_stats(ST.stats_total_pooled(ST.stats_by_source(_raw(spark, sf_dir))))


def _pv_sql():
    s = SS.per_label(DOC_SQL, "text")
    return f"""SELECT s.label, round(s.nb_docs * (s.std_words * s.std_words + (s.mean_words - t.mw) * (s.mean_words - t.mw)), -2) AS pv_words,
  round(s.nb_docs * (s.std_chars * s.std_chars + (s.mean_chars - t.mc) * (s.mean_chars - t.mc)), -2) AS pv_chars
FROM ({s}) AS s, (SELECT sum(nb_words) / sum(nb_docs) AS mw, sum(nb_chars) / sum(nb_docs) AS mc FROM ({s}) AS x) AS t"""


@register("pooled_variance", "A4", _pv_sql)
def q_pooled_variance(spark, sf_dir):
    s = ST.stats_by_source(_raw(spark, sf_dir))
    t = s.agg((F.sum("nb_words") / F.sum("nb_docs")).alias("mw"), (F.sum("nb_chars") / F.sum("nb_docs")).alias("mc"))
    j = s.crossJoin(F.broadcast(t))  # t is one row
    return j.select(
        "label",
        # The terms are 1e6-1e9 and summation order differs between engines: compare to hundreds.
        F.round(ST.pooled_variance("word", F.col("mw")), -2).alias("pv_words"),
        F.round(ST.pooled_variance("char", F.col("mc")), -2).alias("pv_chars"),
    )


@register(
    "weighted_avg_variance",
    "A5",
    lambda: (
        "SELECT round(sqrt(sum(nb_docs * std_words * std_words) / sum(nb_docs)), 6) AS wav_words, "
        "round(sqrt(sum(nb_docs * std_chars * std_chars) / sum(nb_docs)), 6) AS wav_chars "
        f"FROM ({SS.per_label(DOC_SQL, 'text')}) AS s"
    ),
)
def q_weighted_avg_variance(spark, sf_dir):
    s = ST.stats_by_source(_raw(spark, sf_dir))
    return s.agg(
        F.round(ST.weighted_avg_variance(s, "word"), 6).alias("wav_words"),
        F.round(ST.weighted_avg_variance(s, "char"), 6).alias("wav_chars"),
    )


@register("stats_merge", "A6", lambda: SS.rounded(SS.per_label(DOC_SQL, "text")))
def q_stats_merge(spark, sf_dir):
    """Per-source stats of English and of other documents, merged: equal to stats over all documents."""
    d = table(spark, sf_dir, "documents").select("source", "lang", F.col("text").alias("input"))
    a = ST.stats_by_source(d.where(F.col("lang") == "en"))
    b = ST.stats_by_source(d.where(~F.col("lang").eqNullSafe(F.lit("en"))))
    return round_stats(ST.stats_merge(a, b))


@register(
    "stats_global",
    "A7",
    lambda: SS.rounded(SS.per_label("SELECT 'globals' AS g, text FROM documents", "text", by="g")),
)
def q_stats_global(spark, sf_dir):
    return round_stats(ST.stats_global(_raw(spark, sf_dir)))


CARD_DATE = "2024-01-31"


def _card_sql():
    s = SS.per_label(DOC_SQL, "text")
    layout = ST.CARD_LAYOUT
    card = RS.fill(
        layout,
        source="label",
        comment="'Stand-in entry for ' || label",
        date=f"'{CARD_DATE}'",
        splits="'train'",
        schema=f"'{ST.schema_line(CANONICAL_SCHEMA)}'",
        nb_columns=f"'{len(CANONICAL_SCHEMA.fields)}'",
        nb_docs="CAST(nb_docs AS VARCHAR)",
        nb_words="CAST(nb_words AS VARCHAR)",
        mean_words=SS.fixed2("mean_words"),
        std_words=SS.fixed2("std_words"),
        nb_chars="CAST(nb_chars AS VARCHAR)",
        mean_chars=SS.fixed2("mean_chars"),
        std_chars=SS.fixed2("std_chars"),
    )
    return f"SELECT label AS source, {card} AS card FROM ({s}) AS s"


@register("dataset_card", "A8", _card_sql)
def q_dataset_card(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return ST.dataset_card(ST.stats_by_source(raw), catalog_from_corpus(raw), CARD_DATE)


def _cleaned_sql():
    c = S.clean_text_select("SELECT doc_id, source, text FROM documents", ["doc_id", "source"], "text", "input")
    return f"SELECT doc_id, source, input FROM ({c}) AS c WHERE NOT {S.is_blank('input')}"


def _exact_sql():
    return DS.exact_first_select(_cleaned_sql(), "doc_id", "input")


def cleaned(spark, sf_dir) -> DataFrame:
    return FL.filter_nonempty_input(clean_columns(_raw(spark, sf_dir), ["input"]))


@register(
    "shape_report",
    "A9",
    lambda: f"""SELECT 'raw' AS stage, source, count(*)::BIGINT AS nb_rows, 7::BIGINT AS nb_columns FROM documents GROUP BY source
UNION ALL SELECT 'filtered', source, count(*)::BIGINT, 7::BIGINT FROM ({_cleaned_sql()}) AS c GROUP BY source
UNION ALL SELECT 'dedup_exact', source, count(*)::BIGINT, 7::BIGINT FROM ({_exact_sql()}) AS e GROUP BY source""",
)
def q_shape_report(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    filt = write_table(cleaned(spark, sf_dir), "cleaned")  # cleaned once for both later stages
    exact = D.dedup_exact(filt, "input", ORDER, materialize=False)
    return ST.shape_report({"raw": raw, "filtered": filt, "dedup_exact": exact})


@register("corpus_stats", "A1+A3", lambda: SS.rounded(SS.with_total(SS.per_label(_exact_sql(), "input"))))
def q_corpus_stats(spark, sf_dir):
    """Flagship: cleaned, filtered, exact-deduplicated corpus size per source with the pooled Total."""
    exact = D.dedup_exact(cleaned(spark, sf_dir), "input", ORDER)
    return round_stats(ST.corpus_stats(exact))

