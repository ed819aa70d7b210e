"""DuckDB (RE2) forms of the text functions, used only as the correctness oracle.

RE2 has no lookaround and no backreference, so three steps are rewritten:
``collapse_repeats`` becomes one replacement per character, the two spacing rules
insert everywhere and then undo the insertions next to whitespace.
Each builder takes and returns a SQL expression string.
"""

from __future__ import annotations

from ..functions.charclass import DEFAULT_MIN_WORDS, L, LINE_BREAK, LONG_WORD, P, P_CHARS, W, WS, WS_CHARS, esc
from ..functions.text import URL_HTML, codepage_class


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def normalize_nfc(x: str) -> str:
    return f"nfc_normalize({x})"


def normalize_whitespace(x: str, rm_new_lines: bool = False) -> str:
    frm = "chr(12)||chr(13)||chr(10)||chr(9)" if rm_new_lines else "chr(12)||chr(13)"
    return f"translate({x}, {frm}, ' ')"


def strip_urls_html(x: str) -> str:
    return f"regexp_replace({x}, {lit(URL_HTML)}, '', 'g')"


def keep_codepage(x: str, codepage: str = "cp863") -> str:
    return f"regexp_replace({x}, {lit(codepage_class(codepage))}, '', 'g')"


def normalize_quote(x: str) -> str:
    return f"replace({x}, '’', '''')"


def strip_punctuation(x: str) -> str:
    return f"regexp_replace(replace({x}, chr(10), ' '), {lit('[' + P + ']')}, '', 'g')"


def count_gate_words(x: str) -> str:
    return (
        f"len(list_filter(string_split_regex({strip_punctuation(x)}, {lit('[^' + W + ']+')}), "
        f"lambda w: regexp_full_match(w, {lit('[' + L + ']+')})))"
    )


def word_gate(x: str, n: int = DEFAULT_MIN_WORDS) -> str:
    return f"({count_gate_words(x)} >= {n})"


def word_gate_blank(x: str, n: int = DEFAULT_MIN_WORDS) -> str:
    return f"CASE WHEN {word_gate(x, n)} THEN {x} WHEN {x} IS NOT NULL THEN '' END"


def strip_foreign_chars(x: str) -> str:
    return f"regexp_replace({x}, {lit('[^' + L + '0-9' + P + WS + ']')}, '', 'g')"


def _replacement_literal(ch: str) -> str:
    if ch == "\\":
        return "'\\\\'"
    if ch == "'":
        return "''''"
    if ord(ch) < 0x20 or ord(ch) > 0x7E:
        return f"chr({ord(ch)})"
    return lit(ch)


def collapse_repeats(x: str) -> str:
    out = x
    for ch in P_CHARS + WS_CHARS:
        out = f"regexp_replace({out}, {lit(esc(ch) + '{2,}')}, {_replacement_literal(ch)}, 'g')"
    return out


def space_after_punct(x: str) -> str:
    t = f"regexp_replace({x}, '([:;,!?.])', '\\1 ', 'g')"
    t = f"regexp_replace({t}, {lit('([:;,!?.]) ([' + WS + '])')}, '\\1\\2', 'g')"
    return f"regexp_replace({t}, '([:;,!?.]) $', '\\1')"


def space_before_punct(x: str) -> str:
    t = f"regexp_replace({x}, '([:;!?])', ' \\1', 'g')"
    t = f"regexp_replace({t}, {lit('([' + WS + ']) ([:;!?])')}, '\\1\\2', 'g')"
    return f"regexp_replace({t}, '^ ([:;!?])', '\\1')"


def drop_long_words(x: str, min_len: int = LONG_WORD) -> str:
    return f"regexp_replace({x}, {lit(f'[{WS}]?[{W}]{{{min_len},}}[{P}]?[{WS}]?')}, '', 'g')"


def collapse_spaces(x: str) -> str:
    return f"regexp_replace({x}, ' {{2,}}', ' ', 'g')"


def lowercase(x: str) -> str:
    return f"lower({x})"


def strict_body(x: str) -> str:
    return drop_long_words(space_before_punct(space_after_punct(collapse_repeats(strip_foreign_chars(x)))))


def count_words(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {lit('[^' + WS + ']+')})) AS BIGINT)"


def count_chars(x: str) -> str:
    return f"CAST(length({x}) AS BIGINT)"


def split_lines(x: str) -> str:
    stripped = f"regexp_replace({x}, {lit('(?:' + LINE_BREAK + ')$')}, '')"
    return f"CASE WHEN {x} = '' THEN []::VARCHAR[] ELSE string_split_regex({stripped}, {lit(LINE_BREAK)}) END"


def is_blank(x: str) -> str:
    return f"({x} IS NULL OR NOT regexp_matches({x}, {lit('[^' + WS + ']')}))"


def clean_text_select(
    source_sql: str,
    keep: list[str],
    col: str,
    alias: str,
    *,
    rm_new_lines: bool = False,
    do_lower: bool = False,
    apply_codepage: bool = False,
    codepage: str = "cp863",
    word_check_min: int = DEFAULT_MIN_WORDS,
    nfc: bool = True,
) -> str:
    """A SELECT over ``source_sql`` returning ``keep`` columns and the cleaned ``col`` as ``alias``.

    Written as nested sub-selects so the gate and the strict body read the same staged text once.
    """
    keep_sql = ", ".join(keep)
    sep = ", " if keep else ""
    t = normalize_nfc(col) if nfc else col
    t = normalize_whitespace(t, rm_new_lines)
    t = strip_urls_html(t)
    if apply_codepage:
        t = keep_codepage(t, codepage)
    t = normalize_quote(t)
    stage1 = f"SELECT {keep_sql}{sep}{t} AS __t FROM ({source_sql}) AS __s0"
    gated = f"CASE WHEN {word_gate('__t', word_check_min)} THEN {strict_body('__t')} WHEN __t IS NOT NULL THEN '' END"
    final = collapse_spaces(gated)
    if do_lower:
        final = lowercase(final)
    return f"SELECT {keep_sql}{sep}{final} AS {alias} FROM ({stage1}) AS __s1"


def clean_text_expr(x: str, **opts) -> str:
    """Single-expression form (the staged text is repeated; fine for short oracle inputs)."""
    nfc = opts.get("nfc", True)
    t = normalize_nfc(x) if nfc else x
    t = normalize_whitespace(t, opts.get("rm_new_lines", False))
    t = strip_urls_html(t)
    if opts.get("apply_codepage", False):
        t = keep_codepage(t, opts.get("codepage", "cp863"))
    t = normalize_quote(t)
    n = opts.get("word_check_min", DEFAULT_MIN_WORDS)
    out = collapse_spaces(f"CASE WHEN {word_gate(t, n)} THEN {strict_body(t)} WHEN {t} IS NOT NULL THEN '' END")
    return lowercase(out) if opts.get("do_lower", False) else out
