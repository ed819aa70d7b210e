"""Registered reshaping / filter / union queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import filters as FL
from ..operators.columns import clean_columns
from ..operators import reshape as R
from ..oracle import reshape_sql as RS
from ..oracle import text_sql as S
from ..operators import prompts as PR
from ..schema import ORDER
from . import standins as SI
from ..sources import catalog as C
from .registry import register
from .tables import table

CANON_SQL = (
    "SELECT NULL::VARCHAR AS instruction, text AS input, NULL::VARCHAR AS output, source, "
    "{data_dir} AS data_dir, 'train' AS source_split, doc_id AS row_order FROM documents"
)


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@register("canonical_projection", "P1", CANON_SQL.format(data_dir="NULL::VARCHAR"))
def q_canonical_projection(spark, sf_dir):
    return R.canonical_projection(_docs(spark, sf_dir), F.col("source"), None, "train", "text", order="doc_id")


@register("subset_projection", "P2", CANON_SQL.format(data_dir="lang"))
def q_subset_projection(spark, sf_dir):
    return R.subset_projection(_docs(spark, sf_dir), F.col("source"), "train", "text", subset="lang", order="doc_id")


def _translation_sql():
    once = S.clean_text_select("SELECT doc_id, source, text FROM documents", ["doc_id", "source"], "text", "t1")
    twice = S.clean_text_select(once, ["doc_id", "source"], "t1", "input")
    return (
        "SELECT NULL::VARCHAR AS instruction, input, NULL::VARCHAR AS output, source, 'en-fr' AS data_dir, "
        f"'train' AS source_split, doc_id AS row_order FROM ({twice}) AS t"
    )


@register("translation_projection", "P3", _translation_sql)
def q_translation_projection(spark, sf_dir):
    """Every document as the kept side of a parallel corpus, cleaned by the projection and once more after it."""
    d = _docs(spark, sf_dir)
    parallel = d.select("doc_id", "source", F.struct(F.col("text").alias("fr"), F.lit(None).cast("string").alias("en")).alias("translation"))
    # the stand-in has many sources; a parallel corpus has one name
    p = R.translation_projection(parallel, F.col("source"), "en-fr", "train", order="doc_id")
    return R.to_canonical(p.withColumn("input", T.clean_text("input")))


@register(
    "legacy_projection",
    "P4",
    "SELECT text, source, lang AS subset, 'train' AS source_split, doc_id AS row_order FROM documents",
)
def q_legacy_projection(spark, sf_dir):
    return R.legacy_projection(_docs(spark, sf_dir), F.col("source"), F.col("lang"), "train", order="doc_id")


@register(
    "flatten_lines",
    "P5",
    lambda: f"SELECT conv_id, {RS.flatten_lines('text')} AS input FROM ({SI.DIALOGUE_SQL}) AS f",
)
def q_flatten_lines(spark, sf_dir):
    return SI.dialogue_files(spark, sf_dir).select("conv_id", R.flatten_lines(F.col("text")).alias("input"))


@register(
    "explode_lines",
    "P6",
    lambda: (
        "SELECT conv_id, generate_subscripts(arr, 1) - 1 AS line_no, unnest(arr) AS text FROM "
        f"(SELECT conv_id, {S.split_lines('text')} AS arr FROM ({SI.DIALOGUE_SQL}) AS f) AS a"
    ),
)
def q_explode_lines(spark, sf_dir):
    out = R.explode_lines(SI.dialogue_files(spark, sf_dir), "text", keep=["conv_id"])
    return out.select("conv_id", F.col("line_no").cast("bigint").alias("line_no"), "text")


def _tsv_rows_sql():
    return f"""SELECT file, pos, {RS.pystrip('cols[1]')} AS sentence_id, {RS.pystrip('cols[3]')} AS word
FROM (SELECT file, pos, string_split(line, chr(9)) AS cols FROM ({SI.TSV_LINES_SQL}) AS l
      WHERE NOT {S.is_blank('line')}) AS r
WHERE len(cols) >= 6"""


@register("filter_tsv_rows", "F6", lambda: f"SELECT * FROM ({_tsv_rows_sql()}) AS w WHERE word <> ''")
def q_filter_tsv_rows(spark, sf_dir):
    return R.tsv_rows(SI.tsv_lines(spark, sf_dir), "file", "pos", "line")


@register(
    "tsv_tokens_to_sentences",
    "P7",
    lambda: (
        "SELECT file, sentence_id, min(pos) AS first_pos, string_agg(word, ' ' ORDER BY pos, word) AS input "
        f"FROM ({_tsv_rows_sql()}) AS w WHERE word <> '' GROUP BY file, sentence_id"
    ),
)
def q_tsv_tokens_to_sentences(spark, sf_dir):
    return R.tsv_tokens_to_sentences(SI.tsv_lines(spark, sf_dir), "file", "pos", "line")


@register(
    "token_rows_to_documents",
    "P8",
    "SELECT conv_id AS document_id, string_agg(array_to_string(string_split(text, ' '), ' '), chr(10) ORDER BY turn) AS input "
    "FROM conversations GROUP BY conv_id",
)
def q_token_rows_to_documents(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    rows = c.select(F.col("conv_id").alias("document_id"), F.split("text", " ").alias("tokens"), F.col("turn").alias(ORDER))
    return R.token_rows_to_documents(rows, "document_id", "tokens", ORDER)


def _mcq_sql():
    return f"""SELECT item_id,
  {RS.fill(PR.INSTRUCTION_LAYOUT, instruction=RS.instruction('MCQall'))} AS instruction,
  {RS.fill(PR.INPUT_LAYOUT, case="''", question=RS.py_str('question'), **RS.answers())} AS input,
  {RS.fill(PR.OUTPUT_LAYOUT, answers=RS.letters_of('correct_answers'))} AS output
FROM ({SI.MCQ_BANK_SQL}) AS m"""


def _mcq_rows(spark, sf_dir) -> DataFrame:
    p = R.mcq_prompt_array(SI.mcq_bank(spark, sf_dir))
    return R.instruction_rows(p, "FRENCHMEDMCQA", None, "train", order="item_id")


@register("mcq_prompt_array", "P9", _mcq_sql)
def q_mcq_prompt_array(spark, sf_dir):
    return _mcq_rows(spark, sf_dir).select(F.col(ORDER).alias("item_id"), "instruction", "input", "output")


def _subject_sql():
    subj = RS.py_str("medical_subject")
    single = RS.fill(PR.SUBJECT_SINGLE, subject=subj)
    multiple = RS.fill(PR.SUBJECT_MULTIPLE, subject=subj)
    case = f"CASE WHEN clinical_case IS NOT NULL THEN {RS.fill(PR.CASE_LAYOUT, case='clinical_case')} ELSE '' END"
    parts = []
    for dd in ("mcqm", "mcqu"):
        instr = single if dd == PR.SINGLE_ANSWER_DATA_DIR else multiple
        parts.append(
            f"""SELECT item_id, '{dd}' AS data_dir,
  {RS.fill(PR.INSTRUCTION_LAYOUT, instruction=instr)} AS instruction,
  {RS.fill(PR.INPUT_LAYOUT, case=case, question=RS.py_str('question'), **RS.answers())} AS input,
  {RS.fill(PR.OUTPUT_LAYOUT, answers=RS.py_str('correct_answers'))} AS output
FROM ({SI.SUBJECT_BANK_SQL}) AS s"""
        )
    return " UNION ALL ".join(parts)


@register("mcq_prompt_subject", "P10", _subject_sql)
def q_mcq_prompt_subject(spark, sf_dir):
    bank = SI.subject_bank(spark, sf_dir)
    parts = [
        R.instruction_rows(R.mcq_prompt_subject(bank, dd), "MEDIQAL", dd, "train", order="item_id")
        for dd in ("mcqm", "mcqu")
    ]
    u = reduce(DataFrame.unionByName, parts)
    return u.select(F.col(ORDER).alias("item_id"), "data_dir", "instruction", "input", "output")


def _markdown_sql():
    spelt = (
        "array_to_string(list_transform(correct_answers, lambda i: "
        + RS.fill(
            PR.MARKDOWN_ANSWER_LAYOUT,
            letter=f"{RS.letters_list()}[i + 1]",
            answer="[" + ", ".join(RS.py_str(c) for c in PR.ANSWER_COLUMNS) + "][i + 1]",
        )
        + "), '')"
    )
    head = RS.fill(PR.MARKDOWN_LAYOUT, question=RS.py_str("question"), **RS.answers())
    return f"SELECT item_id, {head} || {spelt} AS markdown FROM ({SI.MCQ_BANK_SQL}) AS m"


@register("mcq_markdown", "P11", _markdown_sql)
def q_mcq_markdown(spark, sf_dir):
    bank = SI.mcq_bank(spark, sf_dir)
    return bank.select("item_id", R.mcq_markdown(bank).alias("markdown"))


KIND_SQL = "CASE WHEN len(correct_answers) = 1 THEN 'MCQU' WHEN len(correct_answers) > 1 THEN 'MCQM' ELSE 'MCQall' END"


@register(
    "instruction_lookup",
    "P12",
    lambda: f"SELECT item_id, {KIND_SQL} AS kind, {RS.instruction_lookup(KIND_SQL)} AS instruction FROM ({SI.MCQ_BANK_SQL}) AS m",
)
def q_instruction_lookup(spark, sf_dir):
    bank = SI.mcq_bank(spark, sf_dir)
    n = F.size("correct_answers")
    kind = F.when(n == 1, "MCQU").when(n > 1, "MCQM").otherwise("MCQall")
    return bank.select("item_id", kind.alias("kind"), R.instruction_lookup(kind).alias("instruction"))


@register("cast_null_columns", "P13", CANON_SQL.format(data_dir="NULL::VARCHAR"))
def q_cast_null_columns(spark, sf_dir):
    d = _docs(spark, sf_dir)
    raw = d.select(
        F.lit(None).alias("instruction"),
        F.col("text").alias("input"),
        F.lit(None).alias("output"),
        "source",
        F.lit(None).alias("data_dir"),
        F.lit("train").alias("source_split"),
        F.col("doc_id").alias(ORDER),
    )
    return R.cast_null_columns(raw)


@register(
    "drop_rename",
    "P14",
    "SELECT NULL::VARCHAR AS instruction, text AS input, NULL::VARCHAR AS output, source, doc_id AS row_order FROM documents",
)
def q_drop_rename(spark, sf_dir):
    return R.drop_rename(q_canonical_projection(spark, sf_dir))


def _dialogue_id_sql(x: str) -> str:
    pattern = R.DIALOGUE_ID.replace("(?md)", "(?m)")
    return f"regexp_replace(regexp_replace({x}, '\\r\\n?', chr(10), 'g'), {S.lit(pattern)}, '', 'g')"


@register(
    "strip_dialogue_ids",
    "P15",
    lambda: f"SELECT conv_id, {_dialogue_id_sql('text')} AS text FROM ({SI.PREFIXED_DIALOGUE_SQL}) AS f",
)
def q_strip_dialogue_ids(spark, sf_dir):
    f = SI.prefixed_dialogue_files(spark, sf_dir)
    return f.select("conv_id", R.strip_dialogue_ids(F.col("text")).alias("text"))


# --- filters ---------------------------------------------------------------------------
def _cleaned_docs_sql():
    return S.clean_text_select("SELECT doc_id, text FROM documents", ["doc_id"], "text", "input")


@register(
    "filter_nonempty_input",
    "F1",
    lambda: f"SELECT doc_id, input FROM ({_cleaned_docs_sql()}) AS c WHERE NOT {S.is_blank('input')}",
)
def q_filter_nonempty_input(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", F.col("text").alias("input"))
    return FL.filter_nonempty_input(clean_columns(d, ["input"]))


def _clean_columns_sql():
    s1 = S.clean_text_select(_mcq_sql(), ["item_id", "input", "output"], "instruction", "instruction")
    s2 = S.clean_text_select(s1, ["item_id", "instruction", "output"], "input", "input")
    return S.clean_text_select(s2, ["item_id", "instruction", "input"], "output", "output")


def _clean_columns(spark, sf_dir):
    rows = _mcq_rows(spark, sf_dir)
    cols = ["instruction", "input", "output"]
    return clean_columns(rows, cols).select(F.col(ORDER).alias("item_id"), *cols)


@register("clean_columns", "T18", _clean_columns_sql)
def q_clean_columns(spark, sf_dir):
    return _clean_columns(spark, sf_dir)


@register(
    "filter_nonempty_triplet",
    "F2",
    lambda: (
        f"SELECT * FROM ({_clean_columns_sql()}) AS c WHERE NOT {S.is_blank('instruction')} "
        f"AND NOT {S.is_blank('input')} AND NOT {S.is_blank('output')}"
    ),
)
def q_filter_nonempty_triplet(spark, sf_dir):
    return FL.filter_nonempty_triplet(_clean_columns(spark, sf_dir))


@register("filter_source", "F4", "SELECT doc_id, text FROM documents WHERE source = 'src3'")
def q_filter_source(spark, sf_dir):
    return FL.filter_source(_docs(spark, sf_dir), "src3").select("doc_id", "text")


# --- unions ----------------------------------------------------------------------------
@register("union_splits", "U1", CANON_SQL.format(data_dir="lang"))
def q_union_splits(spark, sf_dir):
    """All data_dirs (languages) of each source, as the catalog lists them, by one scan."""
    d = _docs(spark, sf_dir)
    catalog = C.catalog_from_corpus(d, subset="lang")
    whole = C.SharedInput(lambda s: R.canonical_projection(d, F.col("source"), F.col("lang"), "train", "text", order="doc_id"))
    names = [r.source for r in catalog.select("source").collect()]  # bounded: the catalog
    out = C.ingest_fanout(spark, catalog, C.SourceRegistry({n: whole for n in names}))
    return out.withColumn(ORDER, F.col(f"{ORDER}.pos"))


@register("union_sources", "U2", CANON_SQL.format(data_dir="NULL::VARCHAR"))
def q_union_sources(spark, sf_dir):
    """Pieces with their columns in different orders (as the translation loader emits) matched by name."""
    d = _docs(spark, sf_dir)
    a = R.canonical_projection(d.where(F.col("lang") == "en"), F.col("source"), None, "train", "text", order="doc_id")
    b = R.canonical_projection(d.where(F.col("lang") != "en"), F.col("source"), None, "train", "text", order="doc_id")
    b = b.select("input", "source", ORDER, "source_split", "data_dir", "output", "instruction")
    return a.unionByName(b)


@register(
    "dedup_by_adaptation_instruction",
    "D7",
    lambda: (
        f"SELECT item_id, instruction, input, output, md5('42|' || item_id) AS shuffle_key FROM ({_clean_columns_sql()}) AS c "
        f"WHERE NOT {S.is_blank('instruction')} AND NOT {S.is_blank('input')} AND NOT {S.is_blank('output')}"
    ),
)
def q_dedup_by_adaptation_instruction(spark, sf_dir):
    """Instruction-tuning rows (cleaned question bank without empty triplets) pass D7 unchanged and
    are shuffled with the fixed seed."""
    from ..operators.dedup import dedup_by_adaptation, shuffle_key

    rows = FL.filter_nonempty_triplet(_clean_columns(spark, sf_dir)).withColumnRenamed("item_id", ORDER)
    out = dedup_by_adaptation(rows, "instruction-tuning", order=ORDER)
    return out.select(F.col(ORDER).alias("item_id"), "instruction", "input", "output", shuffle_key(ORDER).alias("shuffle_key"))
