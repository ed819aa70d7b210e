"""Projections and reshaping (P1-P15): each source family -> the canonical six-column row.

All are narrow Column expressions except P7/P8 (group lines/rows of one
document) which aggregate per document id with partial aggregation.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType, NullType, StringType, StructType

from ..functions import text as T
from ..functions.charclass import WS_CHARS
from ..schema import CANONICAL, DEDUPED, ORDER
from . import prompts as PR
from .columns import evaluate_once


def _lit_or_col(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v).cast("string")


def _with_order(cols: list[Column], df: DataFrame, order: str | Column | None) -> list[Column]:
    if order is None:
        return cols
    return cols + [(F.col(order) if isinstance(order, str) else order).alias(ORDER)]


def fill(layout: str, **values: Column) -> Column:
    """Substitute Columns into a ``{name}`` layout with ``concat`` (no format parsing at run time)."""
    parts: list[Column] = []
    for literal, field, _, _ in string.Formatter().parse(layout):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(values[field])
    return F.concat(*parts)


def py_str(c: Column) -> Column:
    """A value as Python's ``%s`` renders it: NULL becomes ``None``."""
    return F.coalesce(c.cast("string"), F.lit(PR.NONE_TEXT))


# --- P1 ---------------------------------------------------------------------
def canonical_projection(
    df: DataFrame,
    source,
    data_dir=None,
    source_split="train",
    text: str = "text",
    order: str | Column | None = None,
) -> DataFrame:
    """``text`` -> ``input``; NULL instruction/output; ``source``/``data_dir``/``source_split`` constants or Columns."""
    cols = [
        F.lit(None).cast("string").alias("instruction"),
        F.col(text).cast("string").alias("input"),
        F.lit(None).cast("string").alias("output"),
        _lit_or_col(source).alias("source"),
        _lit_or_col(data_dir).alias("data_dir"),
        _lit_or_col(source_split).alias("source_split"),
    ]
    return df.select(*_with_order(cols, df, order))


# --- P2 ---------------------------------------------------------------------
def subset_projection(df, source, source_split="train", text="text", subset="subset", order=None) -> DataFrame:
    """As P1, with ``data_dir`` taken from the row's subset."""
    return canonical_projection(df, source, F.col(subset).cast("string"), source_split, text, order)


# --- P3 ---------------------------------------------------------------------
def translation_projection(
    df, source, data_dir=None, source_split="train", translation="translation", lang="fr", order=None
) -> DataFrame:
    """Keep one side of a parallel corpus, cleaned once here (and once more by ``clean_columns``)."""
    cleaned = df.withColumn("__text", T.clean_text(F.col(f"{translation}.{lang}")))
    return canonical_projection(cleaned, source, data_dir, source_split, "__text", order)


# --- P4 ---------------------------------------------------------------------
def legacy_projection(df, source, subset=None, source_split="train", text="text", order=None) -> DataFrame:
    """Four-column variant ``text, source, subset, source_split`` (P1 with subset in data_dir's place)."""
    p = canonical_projection(df, source, subset, source_split, text, order)
    cols = [F.col("input").alias("text"), "source", F.col("data_dir").alias("subset"), "source_split"]
    return p.select(*cols, *([ORDER] if order is not None else []))


# --- P5 ---------------------------------------------------------------------
def flatten_lines(c) -> Column:
    """Lines of one document joined by one space (``' '.join(text.splitlines())``)."""
    return F.array_join(T.split_lines(c), " ")


# --- P6 ---------------------------------------------------------------------
def explode_lines(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per line, blank lines kept, with the line position."""
    keep = keep or []
    return df.select(*keep, F.posexplode(T.split_lines(text)).alias("line_no", "text"))


# --- P7 / F6 ----------------------------------------------------------------
def _pystrip(c: Column) -> Column:
    """Python's ``str.strip()``: trim the Unicode whitespace characters from both ends (no regex)."""
    return F.btrim(c, F.lit("".join(WS_CHARS)))


def tsv_rows(lines: DataFrame, file: str = "file", pos: str = "pos", line: str = "line") -> DataFrame:
    """non-blank lines with >= 6 tab columns and a non-empty word; (file, pos, sentence_id, word).

    A blank line has no word, so the test of the word covers it. The line is built and split once: the filters
    stay above the split.
    """
    return (
        evaluate_once(lines.select(file, pos, line), __cols=F.split(F.col(line), "\t"))
        .where(F.size("__cols") >= 6)
        .select(
            file,
            pos,
            _pystrip(F.col("__cols")[0]).alias("sentence_id"),
            _pystrip(F.col("__cols")[2]).alias("word"),
        )
        .where(F.col("word") != "")
    )


#: Bits of a position inside a stretch: a group's rows meet in tasks by stretches of 65,536 positions.
STRETCH_BITS = 16


def ordered_concat(df: DataFrame, keys: list[str], order: str, value: str, separator: str, out: str = "input", first: str | None = None) -> DataFrame:
    """Per ``keys`` group the texts of ``value`` in ``order``, joined by ``separator``; ``first`` names a column for
    the smallest order.

    Two steps, so that a group holding a large share of all rows is not gathered row by row in one task: stretches
    of neighbouring orders are joined first, each on its own, and the last step only joins the stretches' texts. An
    order is a number or a struct ending in one (its other fields then belong to the stretch); a group of an order
    of any other type is one stretch. Rows of equal order are joined in the order of their texts.
    """
    kind = df.schema[order].dataType
    if isinstance(kind, IntegralType):
        stretch = F.shiftright(F.col(order).cast("long"), STRETCH_BITS)
    elif isinstance(kind, StructType) and isinstance(kind.fields[-1].dataType, IntegralType):
        *outer, last = kind.names
        stretch = F.struct(*[F.col(f"{order}.{f}").alias(f) for f in outer], F.shiftright(F.col(f"{order}.{last}").cast("long"), STRETCH_BITS).alias(last))
    else:
        stretch = F.lit(0)
    rows = df.select(*keys, F.col(order).alias("__o"), F.col(value).alias("__v"), stretch.alias("__s"))

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(items), lambda x: x["__v"]), separator)

    parts = rows.groupBy(*keys, "__s").agg(joined(F.collect_list(F.struct("__o", "__v"))).alias("__v"), F.min("__o").alias("__o"))
    whole = parts.groupBy(*keys).agg(joined(F.collect_list(F.struct("__o", "__v"))).alias(out), F.min("__o").alias("__o"))
    return whole.select(*keys, *([F.col("__o").alias(first)] if first else []), out)


def tsv_tokens_to_sentences(lines: DataFrame, file: str = "file", pos: str = "pos", line: str = "line") -> DataFrame:
    """Words of a sentence id joined by one space in line order; one row per (file, sentence)."""
    return ordered_concat(tsv_rows(lines, file, pos, line), [file, "sentence_id"], pos, "word", " ", first="first_pos")


# --- P8 ---------------------------------------------------------------------
def token_rows_to_documents(
    df: DataFrame, document: str = "document_id", tokens: str = "tokens", order: str = ORDER, first: str | None = None
) -> DataFrame:
    """Each row's tokens joined by a space (scalars as text), rows of a document joined by newline.

    ``first`` names a column for the order of the document's first row."""
    tok_type = df.schema[tokens].dataType
    line = F.array_join(F.col(tokens), " ") if isinstance(tok_type, ArrayType) else F.col(tokens).cast("string")
    return ordered_concat(df.select(document, order, line.alias("__line")), [document], order, "__line", "\n", first=first)


# --- P9 / P11 / P12 -----------------------------------------------------------
def _answers() -> dict[str, Column]:
    return {k: py_str(F.col(c)) for k, c in zip("abcde", PR.ANSWER_COLUMNS)}


def _letters() -> Column:
    return F.array(*[F.lit(x) for x in PR.ANSWER_LETTERS])


def instruction_lookup(kind: Column) -> Column:
    """Constant prompt per question-bank kind (MCQU / MCQM / MCQall)."""
    m = F.create_map(*[x for k, v in PR.INSTRUCTIONS.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, kind)


def mcq_prompt_array(df: DataFrame, correct: str = "correct_answers", question: str = "question") -> DataFrame:
    """Question bank with index answers (0-4) -> instruction / input / output prompt strings."""
    letters = F.array_join(
        F.transform(F.col(correct), lambda i: F.element_at(_letters(), i.cast("int") + 1)), PR.ANSWER_SEPARATOR
    )
    return df.select(
        "*",
        fill(PR.INSTRUCTION_LAYOUT, instruction=instruction_lookup(F.lit("MCQall"))).alias("__instruction"),
        fill(PR.INPUT_LAYOUT, case=F.lit(""), question=py_str(F.col(question)), **_answers()).alias("__input"),
        fill(PR.OUTPUT_LAYOUT, answers=letters).alias("__output"),
    )


def mcq_markdown(df: DataFrame, correct: str = "correct_answers", question: str = "question") -> Column:
    """Plain-text rendering with the correct options spelt out."""
    answers = F.array(*[py_str(F.col(c)) for c in PR.ANSWER_COLUMNS])
    spelt = F.array_join(
        F.transform(
            F.col(correct),
            lambda i: fill(
                PR.MARKDOWN_ANSWER_LAYOUT,
                letter=F.element_at(_letters(), i.cast("int") + 1),
                answer=F.element_at(answers, i.cast("int") + 1),
            ),
        ),
        "",
    )
    return F.concat(fill(PR.MARKDOWN_LAYOUT, question=py_str(F.col(question)), **_answers()), spelt)


# --- P10 --------------------------------------------------------------------
def mcq_prompt_subject(df: DataFrame, data_dir) -> DataFrame:
    """P10: subject question bank; the instruction depends on ``data_dir``, the case block is optional."""
    dd = _lit_or_col(data_dir)
    subject = py_str(F.col("medical_subject"))
    single = fill(PR.SUBJECT_SINGLE, subject=subject)
    multiple = fill(PR.SUBJECT_MULTIPLE, subject=subject)
    instruction = F.when(dd == PR.SINGLE_ANSWER_DATA_DIR, single).otherwise(multiple)
    case = F.when(F.col("clinical_case").isNotNull(), fill(PR.CASE_LAYOUT, case=F.col("clinical_case").cast("string"))).otherwise(
        F.lit("")
    )
    return df.select(
        "*",
        fill(PR.INSTRUCTION_LAYOUT, instruction=instruction).alias("__instruction"),
        fill(PR.INPUT_LAYOUT, case=case, question=py_str(F.col("question")), **_answers()).alias("__input"),
        fill(PR.OUTPUT_LAYOUT, answers=py_str(F.col("correct_answers"))).alias("__output"),
    )


def instruction_rows(prompted: DataFrame, source, data_dir=None, source_split="train", order=None) -> DataFrame:
    """Canonical rows from the ``__instruction/__input/__output`` columns of P9/P10."""
    cols = [
        F.col("__instruction").alias("instruction"),
        F.col("__input").alias("input"),
        F.col("__output").alias("output"),
        _lit_or_col(source).alias("source"),
        _lit_or_col(data_dir).alias("data_dir"),
        _lit_or_col(source_split).alias("source_split"),
    ]
    return prompted.select(*_with_order(cols, prompted, order))


# --- P13 / P14 ----------------------------------------------------------------
def cast_null_columns(df: DataFrame) -> DataFrame:
    """Columns of the void type become strings so schemas of a union agree."""
    return df.select(
        *[F.col(f.name).cast(StringType()).alias(f.name) if isinstance(f.dataType, NullType) else F.col(f.name) for f in df.schema]
    )


def drop_rename(df: DataFrame, keep_order: bool = True) -> DataFrame:
    """The deduped-row schema ``instruction, input, output, source``."""
    extra = [ORDER] if keep_order and ORDER in df.columns else []
    return df.select(*DEDUPED, *extra)


def to_canonical(df: DataFrame) -> DataFrame:
    """Select canonical columns (plus ``row_order`` when present) in canonical order."""
    extra = [ORDER] if ORDER in df.columns else []
    return df.select(*CANONICAL, *extra)


# --- P15 --------------------------------------------------------------------
# Per line (lines end at \n after universal-newline translation): a leading d/p speaker id
# with the whitespace after it; when only whitespace follows, the line's \n goes too.
DIALOGUE_ID = r"(?md)^[dp]\p{Nd}+[\t\x{0b}-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*\n?"


def universal_newlines(c) -> Column:
    """Text-mode file reading: ``\\r\\n`` and ``\\r`` become ``\\n``."""
    return F.regexp_replace(T._c(c), "\r\n?", "\n")


def strip_dialogue_ids(c) -> Column:
    """Remove ``d123 ``/``p123 `` at the start of each dialogue line."""
    return F.regexp_replace(universal_newlines(c), DIALOGUE_ID, "")
