"""Text scalar functions (T1-T20): the cleaning chain as native Column expressions.

Everything runs in the JVM (``regexp_replace``, ``translate``, ``regexp_count``). NFC has no built-in of its own;
``reflect`` calls the Unicode library that Spark ships with for its collations.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .charclass import (
    DEFAULT_MIN_WORDS,
    J_KEEP_NARROW,
    J_MAYBE_W,
    J_NOT_KEEP,
    J_NOT_P_WS_NARROW,
    J_NOT_WS,
    J_L,
    J_P,
    J_P_WS,
    J_W,
    J_WS,
    LINE_BREAK,
    LONG_WORD,
    W,
    WS,
    esc,
    java_class,
)

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- T1 ---------------------------------------------------------------------
def decode_utf8(c: ColumnOrName, dtype=None) -> Column:
    """bytes -> str dropping invalid sequences; strings pass unchanged.

    ``make_valid_utf8`` marks each invalid sequence with U+FFFD, which we then
    drop (the ``errors='ignore'`` behaviour). Pass ``dtype`` to pick the branch
    without resolving the column.
    """
    col = _c(c)
    if isinstance(dtype, BinaryType):
        return F.regexp_replace(F.make_valid_utf8(col.cast("string")), "�", "")
    return col


# --- T2 ---------------------------------------------------------------------
def normalize_nfc(c: ColumnOrName) -> Column:
    """Unicode NFC, in the JVM; NULL stays NULL.

    Spark holds ``reflect`` for non-deterministic: a projection with it is neither repeated by nor merged with the
    one above, and a filter above stays above. Put filters on other columns before it.
    """
    col = _c(c)
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), col, F.lit(False))
    return F.when(col.isNotNull(), composed)


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` evaluated a single time, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


# --- T3 ---------------------------------------------------------------------
def normalize_whitespace(c: ColumnOrName, rm_new_lines: bool = False) -> Column:
    """Form feed -> space, carriage return deleted; with ``rm_new_lines`` also \\n and \\t deleted."""
    return F.translate(_c(c), "\f\r\n\t" if rm_new_lines else "\f\r", " ")


# --- T4 ---------------------------------------------------------------------
# Fixed value: what the plain pattern matches. It is also the RE2 oracle's form. The Java form adds a run-start anchor and possessive
# quantifiers to the word alternative: a match can only begin where a word begins (a later start
# in the same word ends at the same place, and leftmost wins), so the result is identical while
# each word is scanned once instead of once per character.
URL_HTML = f"(?:www|http)[^{WS}]+|<[^{WS}]+|[{W}]+/*>"
URL_HTML_JAVA = f"(?:www|http)[{J_NOT_WS}]++|<[{J_NOT_WS}]++|(?=[{J_W}])(?<![{J_W}])[{J_W}]++/*>"

# The same without its last alternative, for a text that has no ``>``.
URL_OPEN_JAVA = f"(?:http|www|<)[{J_NOT_WS}]++"


def strip_urls_html(c: ColumnOrName) -> Column:
    """Remove URL runs, ``<`` + non-space runs and ``word>`` ends (not an HTML parser)."""
    def strip(t: Column) -> Column:
        opens = t.contains("<") | t.contains("www") | t.contains("http")
        return F.when(t.contains(">"), F.regexp_replace(t, URL_HTML_JAVA, "")).when(opens, F.regexp_replace(t, URL_OPEN_JAVA, "")).otherwise(t)

    return once(_c(c), strip)


# --- T5 ---------------------------------------------------------------------
@functools.lru_cache(maxsize=None)
def codepage_chars(codepage: str = "cp863") -> str:
    """Characters a single-byte code page can encode, generated from Python's codec."""
    chars = sorted(set(bytes(range(256)).decode(codepage, errors="ignore")))
    return "".join(chars)


def codepage_class(codepage: str = "cp863") -> str:
    """Characters outside the code page (plain negated form)."""
    return "[^" + "".join(esc(ch) for ch in codepage_chars(codepage)) + "]"


@functools.lru_cache(maxsize=None)
def _codepage_class_java(codepage: str) -> str:
    body = "".join(esc(ch) for ch in codepage_chars(codepage))
    return "[" + java_class(body, negate=True) + "]"


def keep_codepage(c: ColumnOrName, codepage: str = "cp863") -> Column:
    """Drop characters the code page cannot encode."""
    return F.regexp_replace(_c(c), _codepage_class_java(codepage), "")


# --- T6 ---------------------------------------------------------------------
def normalize_quote(c: ColumnOrName) -> Column:
    """Typographic apostrophe U+2019 -> ASCII apostrophe."""
    return F.replace(_c(c), F.lit("’"), F.lit("'"))


# --- T7 ---------------------------------------------------------------------
def strip_punctuation(c: ColumnOrName) -> Column:
    """Newline -> space, then every ASCII punctuation mark removed (the word gate's view)."""
    return F.regexp_replace(F.translate(_c(c), "\n", " "), f"[{J_P}]", "")


# --- F5 / T8 ----------------------------------------------------------------
# A gate word is a maximal word-character run, made only of the letter class, of the text with its
# ASCII punctuation removed. Removing punctuation only glues neighbours, so on the original text this
# is a maximal run of word-or-punctuation characters whose non-punctuation characters are all letters
# (at least one): one pass, no intermediate string.
_WP = J_W + J_P
_LP = J_L + J_P
GATE_WORD = f"(?=[{_LP}])(?<![{_WP}])[{J_P}]*+[{J_L}][{_LP}]*+(?![{_WP}])"


def count_gate_words(c: ColumnOrName) -> Column:
    """Words of the gate: maximal word-character runs made only of the letter class (punctuation removed)."""
    return F.regexp_count(_c(c), F.lit(GATE_WORD))


def word_gate(c: ColumnOrName, n: int = DEFAULT_MIN_WORDS) -> Column:
    """at least ``n`` letter-only words after punctuation removal.

    Linear and short-circuiting: the match stops at the ``n``-th word, so a long text that passes
    is not scanned to its end (the reference's look-ahead pattern backtracks polynomially).
    """
    if n <= 0:
        return _c(c).isNotNull()
    return _c(c).rlike(f"(?s){GATE_WORD}(?:.*?{GATE_WORD}){{{n - 1}}}")


def word_gate_blank(c: ColumnOrName, n: int = DEFAULT_MIN_WORDS) -> Column:
    """The text when it passes the gate, else ``''``; NULL stays NULL."""
    col = _c(c)
    return F.when(word_gate(col, n), col).when(col.isNotNull(), F.lit(""))


# --- T9-T14 -----------------------------------------------------------------
def strip_foreign_chars(c: ColumnOrName) -> Column:
    """Delete everything outside letters, ASCII digits, ASCII punctuation and whitespace."""
    return F.regexp_replace(_c(c), f"(?:(?![{J_KEEP_NARROW}])[{J_NOT_KEEP}])++", "")


def collapse_repeats(c: ColumnOrName) -> Column:
    """A run of the same punctuation or whitespace character becomes one."""
    return F.regexp_replace(_c(c), f"(?![{J_NOT_P_WS_NARROW}])([{J_P_WS}])\\1+", "$1")


def space_after_punct(c: ColumnOrName) -> Column:
    """Space after ``: ; , ! ? .`` when a non-space follows."""
    return F.regexp_replace(_c(c), f"([:;,!?.])(?=[{J_NOT_WS}])", "$1 ")


def space_before_punct(c: ColumnOrName) -> Column:
    """Space before ``: ; ! ?`` when a non-space precedes (French spacing)."""
    return F.regexp_replace(_c(c), f"(?=[:;!?])(?<=[{J_NOT_WS}])([:;!?])", " $1")


def drop_long_words(c: ColumnOrName, min_len: int = LONG_WORD) -> Column:
    """Delete words of ``min_len``+ word characters with one optional mark and both neighbouring spaces."""
    # run-start anchor + possessive run: same matches as the plain pattern, no rescans inside words
    words = f"[{J_WS}]?(?<![{J_W}])[{J_W}]{{{min_len},}}+[{J_P}]?[{J_WS}]?"
    # few texts have a run that long, which one bit table tells
    maybe = f"(?<![{J_MAYBE_W}])[{J_MAYBE_W}]{{{min_len}}}"
    return once(_c(c), lambda t: F.when(t.rlike(maybe), F.regexp_replace(t, words, "")).otherwise(t))


def collapse_spaces(c: ColumnOrName) -> Column:
    """Two or more U+0020 become one; nothing is trimmed."""
    return F.regexp_replace(_c(c), " {2,}", " ")


# --- T15 --------------------------------------------------------------------
def lowercase(c: ColumnOrName) -> Column:
    return F.lower(_c(c))


# --- T16 --------------------------------------------------------------------
def _strict_body(col: Column) -> Column:
    t = strip_foreign_chars(col)
    t = collapse_repeats(t)
    t = space_after_punct(t)
    t = space_before_punct(t)
    return drop_long_words(t)


def _gated_body(t: Column, word_check_min: int) -> Column:
    return F.when(word_gate(t, word_check_min), _strict_body(t)).when(t.isNotNull(), F.lit(""))


def clean_strict(c: ColumnOrName, word_check_min: int = DEFAULT_MIN_WORDS) -> Column:
    """Quote normalisation, word gate, then T9-T13."""
    return once(normalize_quote(c), lambda t: _gated_body(t, word_check_min))


# --- T17 --------------------------------------------------------------------
def clean_text(
    c: ColumnOrName,
    rm_new_lines: bool = False,
    do_lower: bool = False,
    apply_codepage: bool = False,
    codepage: str = "cp863",
    word_check_min: int = DEFAULT_MIN_WORDS,
    nfc: bool = True,
    dtype=None,
) -> Column:
    """The whole cleaning chain T1 -> T15. NULL in, NULL out; a failed gate gives ``''``."""
    t = decode_utf8(c, dtype)
    if nfc:
        t = normalize_nfc(t)
    if apply_codepage:
        t = normalize_whitespace(t, rm_new_lines)
        t = strip_urls_html(t)
        t = keep_codepage(t, codepage)  # the code page has no U+2019: it must go before T6
        t = normalize_quote(t)
    else:
        # T3 and T6 together: U+2019 and "'" are both non-space, non-word characters,
        # so T4 removes exactly the same spans whichever apostrophe it sees.
        # Few texts have the others, which a search for bytes tells.
        others = "\f\r\n\t" if rm_new_lines else "\f\r"
        t = F.replace(t, F.lit("’"), F.lit("'"))
        t = once(t, lambda x: F.when(functools.reduce(operator.or_, map(x.contains, others)), normalize_whitespace(x, rm_new_lines)).otherwise(x))
        t = strip_urls_html(t)
    # Gate and body share the text prepared so far. The gate need not be checked a second time.
    t = once(t, lambda prepared: _gated_body(prepared, word_check_min))
    t = collapse_spaces(t)
    if do_lower:
        t = lowercase(t)
    return t


# --- T19 / T20 ----------------------------------------------------------------
def count_words(c: ColumnOrName) -> Column:
    """``len(text.split())``: runs of non-whitespace (Unicode whitespace).

    Splitting on whitespace runs gives one piece per word plus an empty piece for leading and for
    trailing whitespace; that is cheaper than extracting every match. Blank text has no words.
    """
    col = _c(c)
    pieces = F.size(F.split(col, f"[{J_WS}]++"))
    lead = F.substring(col, 1, 1).rlike(f"[{J_WS}]").cast("int")
    trail = F.substring(col, -1, 1).rlike(f"[{J_WS}]").cast("int")
    words = F.when(col.rlike(f"[{J_NOT_WS}]"), pieces - lead - trail).otherwise(F.lit(0))
    return F.when(col.isNotNull(), words).cast("bigint")


def count_chars(c: ColumnOrName) -> Column:
    """``len(text)`` in code points."""
    return F.char_length(_c(c)).cast("bigint")


# --- helpers shared by reshaping and filters ----------------------------------
def strip_final_line_break(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), f"(?:{LINE_BREAK})\\z", "")


def split_lines(c: ColumnOrName) -> Column:
    """``str.splitlines()``: an empty text gives an empty array, a final break adds no empty line."""
    col = _c(c)
    return F.when(col == "", F.array().cast("array<string>")).otherwise(
        F.split(strip_final_line_break(col), LINE_BREAK)
    )


def is_blank(c: ColumnOrName) -> Column:
    """``len(x.strip()) == 0`` with Python's Unicode whitespace; NULL counts as blank."""
    col = _c(c)
    return col.isNull() | ~col.rlike(f"[{J_NOT_WS}]")
