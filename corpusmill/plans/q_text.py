"""Registered queries for the text scalar functions (T1-T20, F5) over ``documents``/``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..oracle import text_sql as S
from .registry import register
from .tables import table


def _doc_query(name: str, op: str, spark_fn, sql_fn, out_type: str | None = None):
    cast = (lambda c: c.cast(out_type)) if out_type else (lambda c: c)

    def q(spark, sf_dir):
        d = table(spark, sf_dir, "documents")
        return d.select("doc_id", cast(spark_fn(F.col("text"))).alias(name))

    sql_expr = sql_fn("text")
    if out_type:
        sql_expr = f"CAST({sql_expr} AS {out_type.upper()})"
    register(name, op, f"SELECT doc_id, {sql_expr} AS {name} FROM documents")(q)


# The driver tables hold strings; the binary path is exercised by encoding
# each text and appending one invalid byte, which decoding must drop again.
@register("decode_utf8", "T1", "SELECT doc_id, text AS decode_utf8 FROM documents")
def q_decode_utf8(spark, sf_dir):
    from pyspark.sql.types import BinaryType

    d = table(spark, sf_dir, "documents")
    raw = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))
    return d.select("doc_id", T.decode_utf8(raw, BinaryType()).alias("decode_utf8"))


# The tables are already NFC, so every text is decomposed first: letters, then their accents.
_COMPOSED = "àâäáãåéèêëíìîïóòôöõúùûüýÿçñÀÂÄÁÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÝÇÑ"


def _decomposed_sql() -> str:
    import unicodedata

    sql = "text"
    for c in _COMPOSED:
        sql = f"replace({sql}, '{c}', '{unicodedata.normalize('NFD', c)}')"
    return sql


@register("normalize_nfc", "T2", lambda: f"SELECT doc_id, nfc_normalize({_decomposed_sql()}) AS normalize_nfc FROM documents")
def q_normalize_nfc(spark, sf_dir):
    """NFC of texts whose accented letters come as letter and combining accent."""
    d = table(spark, sf_dir, "documents")
    decomposed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), F.col("text"), F.lit(False))
    return d.select("doc_id", decomposed.alias("text")).select("doc_id", T.normalize_nfc("text").alias("normalize_nfc"))


_doc_query("normalize_whitespace", "T3", T.normalize_whitespace, S.normalize_whitespace)
_doc_query(
    "normalize_whitespace_rm_newlines",
    "T3",
    lambda c: T.normalize_whitespace(c, rm_new_lines=True),
    lambda x: S.normalize_whitespace(x, rm_new_lines=True),
)


@register("strip_urls_html", "T4", f"SELECT page_id, {S.strip_urls_html('html')} AS strip_urls_html FROM pages")
def q_strip_urls_html(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", T.strip_urls_html("html").alias("strip_urls_html"))


_doc_query("strip_urls_html_docs", "T4", T.strip_urls_html, S.strip_urls_html)
_doc_query("keep_codepage", "T5", T.keep_codepage, S.keep_codepage)
_doc_query("normalize_quote", "T6", T.normalize_quote, S.normalize_quote)
_doc_query("strip_punctuation", "T7", T.strip_punctuation, S.strip_punctuation)
_doc_query("word_gate", "F5", T.word_gate, S.word_gate)
_doc_query("count_gate_words", "F5", T.count_gate_words, S.count_gate_words, "bigint")
_doc_query("word_gate_blank", "T8", T.word_gate_blank, S.word_gate_blank)
_doc_query("strip_foreign_chars", "T9", T.strip_foreign_chars, S.strip_foreign_chars)
_doc_query("collapse_repeats", "T10", T.collapse_repeats, S.collapse_repeats)
_doc_query("space_after_punct", "T11", T.space_after_punct, S.space_after_punct)
_doc_query("space_before_punct", "T12", T.space_before_punct, S.space_before_punct)
_doc_query("drop_long_words", "T13", T.drop_long_words, S.drop_long_words)
_doc_query("collapse_spaces", "T14", T.collapse_spaces, S.collapse_spaces)
_doc_query("lowercase", "T15", T.lowercase, S.lowercase)
_doc_query(
    "clean_strict",
    "T16",
    T.clean_strict,
    lambda x: (
        f"CASE WHEN {S.word_gate(S.normalize_quote(x))} THEN {S.strict_body(S.normalize_quote(x))} "
        f"WHEN {x} IS NOT NULL THEN '' END"
    ),
)
_doc_query("count_words", "T19", T.count_words, S.count_words)
_doc_query("count_chars", "T20", T.count_chars, S.count_chars)


@register(
    "clean_text",
    "T17",
    lambda: S.clean_text_select("SELECT doc_id, text FROM documents", ["doc_id"], "text", "clean_text"),
)
def q_clean_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.clean_text("text").alias("clean_text"))


@register(
    "clean_text_pages",
    "T17",
    lambda: S.clean_text_select("SELECT page_id, html FROM pages", ["page_id"], "html", "clean_text_pages"),
)
def q_clean_text_pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", T.clean_text("html").alias("clean_text_pages"))


@register(
    "clean_text_options",
    "T17",
    lambda: S.clean_text_select(
        "SELECT doc_id, text FROM documents",
        ["doc_id"],
        "text",
        "clean_text_options",
        rm_new_lines=True,
        do_lower=True,
        apply_codepage=True,
        word_check_min=5,
    ),
)
def q_clean_text_options(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    c = T.clean_text("text", rm_new_lines=True, do_lower=True, apply_codepage=True, word_check_min=5)
    return d.select("doc_id", c.alias("clean_text_options"))
