"""Reshaping operators on literal frames."""

from pyspark.sql import functions as F

from corpusmill.operators import prompts as PR
from corpusmill.operators import reshape as R


def test_tsv_tokens_to_sentences(spark):
    lines = [
        ("f", 0, "s1\t_\tLe\t_\t_\t_"),
        ("f", 1, "   "),
        ("f", 2, "s2\t_\tAutre\t_\t_\t_"),
        ("f", 3, " s1 \t_\t chat \t_\t_\t_"),
        ("f", 4, "s1\t_\t\t_\t_\t_"),
        ("f", 5, "s1\t_\tcourt\t_"),
    ]
    df = spark.createDataFrame(lines, "file string, pos long, line string")
    got = sorted((r.sentence_id, r.first_pos, r.input) for r in R.tsv_tokens_to_sentences(df).collect())
    assert got == [("s1", 0, "Le chat"), ("s2", 2, "Autre")]


def test_token_rows_to_documents_arrays_and_scalars(spark):
    arr = spark.createDataFrame([("d1", ["a", "b"], 1), ("d1", ["c"], 0), ("d2", ["x"], 5)], "document_id string, tokens array<string>, row_order long")
    assert sorted((r.document_id, r.input) for r in R.token_rows_to_documents(arr).collect()) == [("d1", "c\na b"), ("d2", "x")]
    sc = spark.createDataFrame([("d", 3, 1), ("d", 4, 2)], "document_id string, tokens int, row_order long")
    assert R.token_rows_to_documents(sc).first().input == "3\n4"


def test_mcq_prompt_array_renders_none_and_letters(spark):
    df = spark.createDataFrame(
        [("Q?", "a1", "a2", None, "a4", "a5", [0, 2])],
        "question string, answer_a string, answer_b string, answer_c string, answer_d string, answer_e string, correct_answers array<int>",
    )
    r = R.mcq_prompt_array(df).first()
    assert r["__output"] == "<output>\nA, C\n</output>"
    assert "\tC. None\n" in r["__input"]
    assert r["__instruction"] == "<instruction>\n" + PR.INSTRUCTIONS["MCQall"] + "\n</instruction>"
    md = df.select(R.mcq_markdown(df)).first()[0]
    assert md.endswith("### Réponse.s\nA. a1\nC. None")


def test_mcq_prompt_subject_case_block(spark):
    df = spark.createDataFrame(
        [("cardio", "cas", "Q", "a", "b", "c", "d", "e", "B"), ("neuro", None, "Q2", "a", "b", "c", "d", "e", "A, C")],
        "medical_subject string, clinical_case string, question string, answer_a string, answer_b string, "
        "answer_c string, answer_d string, answer_e string, correct_answers string",
    )
    rows = R.mcq_prompt_subject(df, "mcqu").collect()
    assert rows[0]["__input"].startswith("<input>\n\t<clinical_case>\n\tcas\n\t</clinical_case>\n\t<question>")
    assert rows[1]["__input"].startswith("<input>\n\t<question>\n\tQ2")
    assert "plus particulièrement en cardio" in rows[0]["__instruction"] and "une seule bonne réponse" in rows[0]["__instruction"]
    multi = R.mcq_prompt_subject(df, "mcqm").first()["__instruction"]
    assert "plusieurs bonnes réponses (minimum 2)" in multi


def test_strip_dialogue_ids_line_semantics(spark):
    text = "d12 bonjour\np3   \nsuite\nd4 fin"
    got = spark.createDataFrame([(text,)], "t string").select(R.strip_dialogue_ids(F.col("t"))).first()[0]
    # a line holding only the id loses its newline too (per-line \s* reaches the line end)
    assert got == "bonjour\nsuite\nfin"


def test_flatten_and_explode_lines(spark):
    df = spark.createDataFrame([(1, "a\n\nb\n")], "id int, text string")
    assert df.select(R.flatten_lines(F.col("text"))).first()[0] == "a  b"
    assert [(r.line_no, r.text) for r in R.explode_lines(df, keep=["id"]).collect()] == [(0, "a"), (1, ""), (2, "b")]


def test_cast_null_columns(spark):
    df = spark.range(1).select(F.lit(None).alias("x"), F.lit("y").alias("y"))
    out = R.cast_null_columns(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "string"]


def test_ordered_concat_spreads_a_hot_group(spark):
    """A group of many stretches is joined in order, as number and as struct orders, over several groups."""
    from pyspark.sql import functions as F

    from corpusmill.operators import reshape as R

    rows = [("hot", p, f"w{p % 97}") for p in range(0, 3_000_000, 1000)] + [("a", 5, "x"), ("a", 2**40, "z"), ("a", 70_000, "y"), ("a", 5, "x0")]
    df = spark.createDataFrame(rows, "k string, pos long, w string").repartition(5)
    want = {"hot": (0, " ".join(f"w{p % 97}" for p in range(0, 3_000_000, 1000))), "a": (5, "x x0 y z")}
    got = R.ordered_concat(df, ["k"], "pos", "w", " ", first="first")
    assert {r.k: (r["first"], r.input) for r in got.collect()} == want
    assert got.columns == ["k", "first", "input"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") >= 2
    struct = df.withColumn("pos", F.struct(F.lit("f").alias("file"), F.col("pos").alias("pos")))
    assert {r.k: r.input for r in R.ordered_concat(struct, ["k"], "pos", "w", " ").collect()} == {k: v for k, (_, v) in want.items()}
    text = df.where("k = 'a'").withColumn("pos", F.lpad(F.col("pos").cast("string"), 20, "0"))
    assert [r.input for r in R.ordered_concat(text, ["k"], "pos", "w", " ").collect()] == ["x x0 y z"]
    nulls = spark.createDataFrame([("n", 1, None), ("n", 2, "b"), ("m", 1, None)], "k string, pos long, w string")
    assert {r.k: r.input for r in R.ordered_concat(nulls, ["k"], "pos", "w", " ").collect()} == {"n": "b", "m": ""}
