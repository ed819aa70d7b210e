"""DuckDB forms of the reshaping operators (oracle only)."""

from __future__ import annotations

import string

from ..functions.charclass import WS
from ..operators import prompts as PR
from .text_sql import lit, split_lines


def fill(layout: str, **exprs: str) -> str:
    parts = []
    for literal, field, _, _ in string.Formatter().parse(layout):
        if literal:
            parts.append(lit(literal))
        if field is not None:
            parts.append(f"({exprs[field]})")
    return "(" + " || ".join(parts) + ")"


def py_str(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'None')"


def letters_list() -> str:
    return "[" + ", ".join(lit(x) for x in PR.ANSWER_LETTERS) + "]"


def answers(prefix: str = "") -> dict[str, str]:
    return {k: py_str(prefix + c) for k, c in zip("abcde", PR.ANSWER_COLUMNS)}


def letters_of(correct: str) -> str:
    return f"array_to_string(list_transform({correct}, lambda i: {letters_list()}[i + 1]), {lit(PR.ANSWER_SEPARATOR)})"


def pystrip(x: str) -> str:
    return f"regexp_replace({x}, {lit('^[' + WS + ']+|[' + WS + ']+$')}, '', 'g')"


def flatten_lines(x: str) -> str:
    return f"array_to_string({split_lines(x)}, ' ')"


def instruction(kind: str) -> str:
    return lit(PR.INSTRUCTIONS[kind])


def instruction_lookup(kind_expr: str) -> str:
    cases = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in PR.INSTRUCTIONS.items())
    return f"CASE {kind_expr} {cases} END"
