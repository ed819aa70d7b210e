"""Operator 12: quality rules from a suffix array of each text's words.

The words of many texts stand in one flat array of numbers (a number is a pair of text and word, so nothing
repeats across texts). Prefix doubling orders the suffixes; a pass sorts only the suffixes that still share
their rank with another. The longest common prefix of neighbours is read off the ranks that the passes leave
behind. The deepest LCP interval that a suffix lies in has the depth of the larger LCP beside it: that many words
from here on are found again, and the span is maximal unless the span of the suffix one word earlier covers it.
From the maximal spans of ``MIN_REPEAT`` words or more follow

* the covered fraction: code points in words that some span covers, over code points in all words,
* the longest repeat, in words.

A text passes if the fraction is at most ``MAX_COVERED`` and the longest repeat at most ``MAX_REPEAT`` words, and
the base rules hold (at least 50 words; at most half of the words in repeated 3-word windows). Windows of three
words found twice are the suffixes whose depth is three or more.

One task works on about ``BATCH`` words at a time, or on one longer text; nothing is shuffled. Memory follows the
words of that batch: some 60 bytes a word, and 16 more for each doubling of a repeat's length among the words
inside repeats.

Defined cases: NULL, empty and blank texts have no words and fail the base rules; texts of fewer words than a
window have no repeated window; spans may overlap their own copies (``a a a a`` repeats ``a a a``); repeated rows
are judged each on their own; an empty table gives an empty result; ``quality_rules`` ignores other columns,
``keep_good`` returns them unchanged whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text

MIN_REPEAT = 10  # words of a span that counts
MAX_COVERED = 0.2  # of the code points in words
MAX_REPEAT = 30  # words
BATCH = 1 << 17
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, repeat_chars long, longest_repeat long"


def suffix_ranks(sym: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Rank of every suffix, and per pass (prefixes of 1, 2, 4, … symbols) the suffixes that share their rank
    with another, in order of place, with that rank. A rank is the place of the group's first suffix."""

    def regroup(idx: np.ndarray, key: np.ndarray, base: np.ndarray | None) -> np.ndarray:
        """Rank the suffixes ``idx`` by ``key``; returns those that are not alone, in order of place."""
        order = np.argsort(key, kind="stable")
        key, idx = key[order], idx[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(new)
        size = np.diff(np.concatenate([first, [len(key)]]))
        if base is None:
            rank[idx] = np.repeat(first, size)
        else:  # places inside the old group
            old = base[order]
            group = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
            start = np.repeat(group, np.diff(np.concatenate([group, [len(old)]])))
            rank[idx] = old + np.repeat(first, size) - start
        return np.sort(idx[np.repeat(size, size) > 1])

    n = len(sym)
    rank = np.full(n + 1, -1, np.int64)
    idx = regroup(np.arange(n), sym, None)
    levels = []
    step = 1
    while len(idx):
        levels.append((idx, rank[idx]))
        base = rank[idx]
        after = rank[np.minimum(idx + step, n)] + 1
        idx = regroup(idx, base * (n + 1) + after, base)
        step *= 2
    return rank[:n], levels


def repeat_depths(sym: np.ndarray) -> np.ndarray:
    """For every place the length of the longest prefix of its suffix that starts elsewhere too."""
    n = len(sym)
    depth = np.zeros(n, np.int64)
    if n < 2:
        return depth
    rank, levels = suffix_ranks(sym)
    if not levels:
        return depth
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    near = np.flatnonzero(sym[order[1:]] == sym[order[:-1]])
    a, b, lcp = order[near], order[near + 1], np.zeros(len(near), np.int64)

    def at(idx: np.ndarray, ranks: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Ranks of the places that share theirs; -1 for the others."""
        i = np.minimum(np.searchsorted(idx, place), len(idx) - 1)
        return np.where(idx[i] == place, ranks[i], -1)

    for k in range(len(levels) - 1, -1, -1):
        x = at(*levels[k], a + lcp)
        same = np.flatnonzero(x >= 0)
        same = same[x[same] == at(*levels[k], b[same] + lcp[same])]
        lcp[same] += 1 << k
    np.maximum.at(depth, a, lcp)
    np.maximum.at(depth, b, lcp)
    return depth


def maximal_spans(depth: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the repeated spans of ``least`` words or more that no longer span covers from the left."""
    before = np.concatenate([[0], depth[:-1]])
    start = np.flatnonzero((depth >= least) & (before <= depth))
    return start, depth[start]


def covered(n: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each place lies in a span."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step[:n]) > 0


def duplicate_lines(text: str) -> int:
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return again


def measure(texts: list[str], min_repeat: int, max_covered: float, max_repeat: int) -> list[np.ndarray]:
    """The columns of ``MEASURES`` for a batch of texts."""
    words = [t.encode("utf-8", "replace").split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    bounds = np.concatenate([[0], np.cumsum(n_words)])
    coded = pa.array([w for mine in words for w in mine], pa.binary()).dictionary_encode()
    del words
    word = coded.indices.to_numpy().astype(np.int64)
    chars = pc.utf8_length(coded.dictionary.cast(pa.string())).to_numpy().astype(np.int64)[word]
    text_of = np.repeat(np.arange(len(texts)), n_words)
    depth = repeat_depths(text_of * max(1, len(coded.dictionary)) + word)

    def per_text(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[bounds[1:]] - total[bounds[:-1]]

    triple = np.flatnonzero(depth >= 3)
    n_repeat = per_text(covered(len(word), triple, np.full(len(triple), 3)))
    start, length = maximal_spans(depth, min_repeat)
    repeat_chars = per_text(np.where(covered(len(word), start, length), chars, 0))
    word_chars = per_text(chars)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, text_of, depth)
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    kept = ~failed & (repeat_chars <= max_covered * word_chars) & (longest <= max_repeat)
    symbols = np.array([sum(t.count(c) for c in SYMBOLS) for t in texts], np.int64)
    lines = np.array([duplicate_lines(t) for t in texts], np.int64)
    return [n_words, word_chars, symbols, lines, n_repeat, failed, kept, repeat_chars, longest]


def _measured(min_repeat: int, max_covered: float, max_repeat: int, batch: int):
    """Arrow function: the columns before the last one, and the measures of the last one (the text)."""
    names = [c.split()[0] for c in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = pc.fill_null(pc.binary_length(b.column(b.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(size.astype(np.int64)) // (6 * batch)  # about six bytes a word
            for rows in np.split(np.arange(b.num_rows), np.flatnonzero(np.diff(part)) + 1):
                if not len(rows):
                    continue
                mine = b.slice(int(rows[0]), len(rows))
                found = measure([t or "" for t in mine.column(b.num_columns - 1).to_pylist()], min_repeat, max_covered, max_repeat)
                yield pa.RecordBatch.from_arrays([*mine.columns[:-1], *map(pa.array, found)], names=[*b.schema.names[:-1], *names])

    return run


def quality_rules(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT, batch: int = BATCH) -> DataFrame:
    """``doc_id`` and the columns of ``MEASURES``, one row a document."""
    return id_text(docs).mapInArrow(_measured(min_repeat, max_covered, max_repeat, batch), f"doc_id long, {MEASURES}")


def keep_good(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT, batch: int = BATCH) -> DataFrame:
    """The rows of ``docs``, all columns, whose text passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _measured(min_repeat, max_covered, max_repeat, batch)
        for b in batches:
            text = b.column(b.schema.get_field_index("text"))
            kept = [m.column("kept") for m in judge(iter([pa.RecordBatch.from_arrays([text], names=["text"])]))]
            yield b.filter(pa.concat_arrays(kept)) if kept else b

    return docs.mapInArrow(run, docs.schema)


#: The base measures and the verdict in DuckDB: places covered by repeats of k words or more are those of k-word windows found twice.
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
p AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i, w, len(w) AS n FROM w),
g AS (
  SELECT rid, word, i,
    i + 2 <= n AND count(*) OVER (PARTITION BY rid, i + 2 <= n, array_to_string(w[i:i + 2], ' ')) > 1 AS g3,
    i + {MIN_REPEAT - 1} <= n AND count(*) OVER (PARTITION BY rid, i + {MIN_REPEAT - 1} <= n, md5(array_to_string(w[i:i + {MIN_REPEAT - 1}], ' '))) > 1 AS gk,
    i + {MAX_REPEAT} <= n AND count(*) OVER (PARTITION BY rid, i + {MAX_REPEAT} <= n, md5(array_to_string(w[i:i + {MAX_REPEAT}], ' '))) > 1 AS gl
  FROM p
),
c AS (
  SELECT rid, word, gl,
    bool_or(g3) OVER (PARTITION BY rid ORDER BY i ROWS 2 PRECEDING) AS c3,
    bool_or(gk) OVER (PARTITION BY rid ORDER BY i ROWS {MIN_REPEAT - 1} PRECEDING) AS ck
  FROM g
),
m AS (
  SELECT rid, sum(len(word))::BIGINT AS word_chars, count(*) FILTER (c3) AS n_repeat_words,
    coalesce(sum(len(word)) FILTER (ck), 0)::BIGINT AS repeat_chars, bool_or(gl) AS too_long
  FROM c GROUP BY rid
),
l AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) AS u
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
),
r AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(m.word_chars, 0) AS word_chars,
    len(regexp_replace(w.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
    coalesce(m.n_repeat_words, 0) AS n_repeat_words, coalesce(m.repeat_chars, 0) AS repeat_chars, coalesce(m.too_long, false) AS too_long
  FROM w LEFT JOIN m USING (rid) LEFT JOIN l USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND repeat_chars <= {MAX_COVERED}::DOUBLE * word_chars AND NOT too_long AS kept,
  repeat_chars
FROM r
"""
