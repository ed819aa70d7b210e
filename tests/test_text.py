"""Single-operator tests of the cleaning chain on hand-written edge cases."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from corpusmill.functions import text as T

EDGE = [
    ("<output>\nA, B\n</output>", ""),
    ("<output>\nA, B, C\n</output>", "\nA, B, C\n"),
    ("<output>\nA,B,C\n</output>", ""),
    ("maître hôpital où", ""),
    ("3.5 mg à 10:30 !!", ""),
    ("² ½x µ a b c", " x a b c"),
    ("a  b c d\x1c\x1c e\xa0\xa0f", "a b c d\x1c e\xa0f"),
]


def _one(spark, fn, values, schema="t string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col(df.columns[0]))).collect()]


def test_clean_text_edge_cases(spark):
    got = _one(spark, T.clean_text, [a for a, _ in EDGE])
    assert got == [e for _, e in EDGE]


def test_clean_text_null_stays_null(spark):
    assert _one(spark, T.clean_text, [None]) == [None]


def test_gate_counts_letter_only_words(spark):
    # punctuation is removed first, so "A,B,C" is one word; digits and î/ù are not letters of the class
    got = _one(spark, T.count_gate_words, ["A,B,C", "A, B, C", "maître hôpital où", "don't stop now", "É è ç"])
    assert got == [1, 3, 1, 3, 3]


def test_spacing_rules(spark):
    assert _one(spark, T.space_after_punct, ["a.b", "a. b", "3.5", "fin."]) == ["a. b", "a. b", "3. 5", "fin."]
    assert _one(spark, T.space_before_punct, ["a:b", "a :b", ":x", "a!?"]) == ["a :b", "a :b", ":x", "a ! ?"]


def test_collapse_repeats_same_char_only(spark):
    assert _one(spark, T.collapse_repeats, ["!!??..  \t\t", "!?!?"]) == ["!?. \t", "!?!?"]


def test_drop_long_words_glues_neighbours(spark):
    long = "x" * 35
    assert _one(spark, T.drop_long_words, [f"a {long}, b", "a " + "y" * 34 + " b"]) == ["ab", "a " + "y" * 34 + " b"]


def test_strip_urls_html(spark):
    got = _one(spark, T.strip_urls_html, ['voir www.x.fr et http://a.b/c ok', '<a href="x">t</a>', "fin>"])
    assert got == ["voir  et  ok", ' href="x">t', ""]


def test_normalize_whitespace(spark):
    assert _one(spark, T.normalize_whitespace, ["a\fb\r\nc\td"]) == ["a b\nc\td"]
    assert _one(spark, lambda c: T.normalize_whitespace(c, rm_new_lines=True), ["a\fb\r\nc\td"]) == ["a bcd"]


def test_nfc_only_changes_decomposed(spark):
    assert _one(spark, T.normalize_nfc, ["été", "plain", None]) == ["été", "plain", None]


def test_decode_utf8_drops_invalid_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xffc \xc3\xa9"),)], "b binary")
    assert df.select(T.decode_utf8("b", BinaryType())).first()[0] == "abc é"


def test_keep_codepage(spark):
    assert _one(spark, T.keep_codepage, ["é€x→y"]) == ["éxy"]


def test_count_words_and_chars(spark):
    assert _one(spark, T.count_words, ["  a  b　c ", "", "x"]) == [3, 0, 1]
    assert _one(spark, T.count_chars, ["é\U0001F600"]) == [2]


def test_split_lines_like_splitlines(spark):
    cases = ["a\nb\n", "a\r\nb", "", "a\n\nb", "x\x1cy z"]
    got = _one(spark, T.split_lines, cases)
    assert [list(g) for g in got] == [c.splitlines() for c in cases]


@pytest.mark.parametrize("n,expected", [(3, ""), (2, "a, b")])
def test_word_check_min_parameter(spark, n, expected):
    assert _one(spark, lambda c: T.clean_text(c, word_check_min=n), ["a, b"]) == [expected]


def test_clean_columns_by_type(spark):
    from corpusmill.operators.columns import clean_columns

    df = spark.createDataFrame([(bytearray("Le chat dort \xff".encode("latin-1")), "un deux trois", 3)], "b binary, s string, n int")
    out = clean_columns(df, ["b", "s"]).first()
    assert out.b == "Le chat dort " and out.s == "un deux trois"
    with pytest.raises(TypeError):
        clean_columns(df, ["n"])


def test_nfc_equals_python_on_every_code_point(spark):
    """Single characters, marks after a base, Hangul syllables and typographic signs, all in the JVM."""
    import unicodedata

    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"]
    texts = ["".join(f"a{c}é " for c in points[i : i + 200]) for i in range(0, len(points), 200)]
    texts += [unicodedata.normalize("NFD", t) for t in ("été naïve à l’hôpital – où → ça", "각각", "Ǻ ậ ộ")] + ["", None, "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    for r in df.select("i", T.normalize_nfc("t").alias("n")).collect():
        t = texts[r.i]
        assert r.n == (None if t is None else unicodedata.normalize("NFC", t))


def test_cheap_checks_before_the_patterns_change_nothing(spark):
    """Every pattern behind a check, or with a look-ahead, against its plain form."""
    from corpusmill.functions import charclass as CC

    texts = ["", None, "a/>b", "mot/ >", "www", "http a", "<b c", "x" * 34, " " + "x" * 35 + "! y", "日" * 36, "é" * 35, "!!  ..", "\x00a\x7f", "Œ€ß", "a  b", "’\f\r\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    c = F.col("t")
    plain = {
        T.strip_urls_html: F.regexp_replace(c, T.URL_HTML_JAVA, ""),
        T.strip_foreign_chars: F.regexp_replace(c, f"[{CC.J_NOT_KEEP}]", ""),
        T.collapse_repeats: F.regexp_replace(c, f"([{CC.J_P_WS}])\\1+", "$1"),
        T.drop_long_words: F.regexp_replace(c, f"[{CC.J_WS}]?(?<![{CC.J_W}])[{CC.J_W}]{{35,}}+[{CC.J_P}]?[{CC.J_WS}]?", ""),
    }
    for f, want in plain.items():
        assert df.where(~f(c).eqNullSafe(want)).count() == 0, f.__name__
