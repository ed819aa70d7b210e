"""Source-family stand-ins derived from the driver's tables (Spark form + SQL form side by side).

Each loader family of the reference reads a particular raw shape; these build that
shape from the given tables so every registered query scales with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import table

# --- dialogue files (one text per conversation, one turn per line) -------------------
DIALOGUE_SQL = (
    "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id"
)
SPEAKER_SQL = "(CASE WHEN role = 'assistant' THEN 'd' ELSE 'p' END || CAST(turn AS VARCHAR) || ' ')"
PREFIXED_DIALOGUE_SQL = (
    f"SELECT conv_id, string_agg({SPEAKER_SQL} || text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id"
)


def _turns_to_file(conv: DataFrame, line) -> DataFrame:
    # One text per conversation: the lines of a dialogue file in turn order.
    return conv.groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col("turn"), line.alias("l")))), lambda x: x["l"]), "\n"
        ).alias("text")
    )


def dialogue_files(spark, sf_dir) -> DataFrame:
    return _turns_to_file(table(spark, sf_dir, "conversations"), F.col("text"))


def speaker_prefix():
    return F.concat(F.when(F.col("role") == "assistant", "d").otherwise("p"), F.col("turn").cast("string"), F.lit(" "))


def prefixed_dialogue_files(spark, sf_dir) -> DataFrame:
    return _turns_to_file(table(spark, sf_dir, "conversations"), F.concat(speaker_prefix(), F.col("text")))


# --- TSV token file (ESSAI-like) from lineitem ------------------------------------------
def tsv_lines(spark, sf_dir) -> DataFrame:
    """``file, pos, line``: one TSV line per lineitem (sentence = order). Quantity < 2 gives a blank line,
    a zero discount a blank word, a zero tax a 5-column line (all skipped by F6).

    Line numbers may repeat within an order, so the file's line order is (pos, line).
    """
    li = table(spark, sf_dir, "lineitem")
    word = F.when(F.col("l_discount") == 0, F.lit(" ")).otherwise(
        F.concat(F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber").cast("string"))
    )
    cols = F.concat_ws(
        "\t",
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string")),
        F.lit("_"),
        word,
        F.lit("_"),
        F.lit("_"),
        F.when(F.col("l_tax") != 0, F.lit("_")),
    )
    line = F.when(F.col("l_quantity") < 2, F.lit("   ")).otherwise(cols)
    return li.select(
        F.lit("lineitem.tsv").alias("file"),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("pos"),
        line.alias("line"),
    )


TSV_LINES_SQL = """SELECT 'lineitem.tsv' AS file, l_orderkey * 16 + l_linenumber AS pos,
  CASE WHEN l_quantity < 2 THEN '   ' ELSE concat_ws(chr(9), ' ' || CAST(l_orderkey AS VARCHAR), '_',
    CASE WHEN l_discount = 0 THEN ' ' ELSE l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) END,
    '_', '_', CASE WHEN l_tax <> 0 THEN '_' END) END AS line
FROM lineitem"""


# --- question banks from benchmark -----------------------------------------------------------
def mcq_bank(spark, sf_dir) -> DataFrame:
    """FrenchMedMCQA-like rows: question = text, answers = first five words, correct = set bits 0-4 of item_id."""
    b = table(spark, sf_dir, "benchmark")
    words = F.split(F.col("text"), " ")
    answers = [F.try_element_at(words, F.lit(i + 1)).alias(f"answer_{c}") for i, c in enumerate("abcde")]
    correct = F.expr("filter(sequence(0, 4), i -> ((item_id >> i) & 1) = 1)")
    return b.select("item_id", F.col("text").alias("question"), *answers, correct.alias("correct_answers"))


MCQ_BANK_SQL = (
    "SELECT item_id, text AS question, "
    + ", ".join(f"string_split(text, ' ')[{i + 1}] AS answer_{c}" for i, c in enumerate("abcde"))
    + ", list_filter(range(5), lambda i: ((item_id >> i) & 1) = 1) AS correct_answers FROM benchmark"
)


def subject_bank(spark, sf_dir) -> DataFrame:
    """MediQAl-like rows: subject = sixth word, question = first line, clinical case = the rest (NULL if none),
    correct answers rendered as letters."""
    b = mcq_bank(spark, sf_dir)
    first_nl = F.instr(F.col("question"), "\n")
    letters = F.array_join(
        F.transform("correct_answers", lambda i: F.element_at(F.array(*[F.lit(x) for x in "ABCDE"]), i + 1)), ", "
    )
    return b.select(
        "item_id",
        F.try_element_at(F.split(F.col("question"), " "), F.lit(6)).alias("medical_subject"),
        F.when(first_nl > 0, F.expr("substring(question, instr(question, '\n') + 1)")).alias("clinical_case"),
        F.when(first_nl > 0, F.expr("substring(question, 1, instr(question, '\n') - 1)"))
        .otherwise(F.col("question"))
        .alias("question"),
        *[f"answer_{c}" for c in "abcde"],
        letters.alias("correct_answers"),
    )


SUBJECT_BANK_SQL = f"""SELECT item_id, string_split(question, ' ')[6] AS medical_subject,
  CASE WHEN strpos(question, chr(10)) > 0 THEN substr(question, strpos(question, chr(10)) + 1) END AS clinical_case,
  CASE WHEN strpos(question, chr(10)) > 0 THEN substr(question, 1, strpos(question, chr(10)) - 1) ELSE question END AS question,
  answer_a, answer_b, answer_c, answer_d, answer_e,
  array_to_string(list_transform(correct_answers, lambda i: ['A','B','C','D','E'][i + 1]), ', ') AS correct_answers
FROM ({MCQ_BANK_SQL}) AS m"""

