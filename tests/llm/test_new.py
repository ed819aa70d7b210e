"""Operators 11 to 13 against brute force, with awkward rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from corpusmill.llm import lexical_search, merkle_manifest, repetition
from corpusmill.llm.common import read_table
from tests.conftest import SF_SMALL
from tests.llm.test_llm import ROWS, SCHEMA, docs, none, small  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _ranked(rows, items, top):
    texts = [(i, collections.Counter(_terms(t))) for i, t in rows]
    sizes = [sum(c.values()) for _, c in texts]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = collections.Counter(t for _, c in texts for t in c)
    asked = collections.defaultdict(set)
    for item, text in items:
        asked[item].update(_terms(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for (doc, c), n in zip(texts, sizes):
            score = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(scores[:top], 1)]
    return sorted(out, key=str)


def test_lexical_search(spark, docs, none, small):  # noqa: F811
    items = [(1, "The QUICK brown fox, it's"), (2, None), (3, "..."), (4, "GRÜSSE Grüße straße w17 x3 x3"), (4, "lazy"), (None, "no id"), (5, "passage naïve ß one " + " ".join(f"w{i}" for i in range(300))), (6, "unseen"), (7, "a\x00b\x7fc 12 Été")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = _ranked(rows, items, 3)
    for limits in ({}, {"block_items": 1}, {"block_terms": 4}):
        got = lexical_search.search(docs.repartition(3), bench, top=3, **limits)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert lexical_search.search(none, bench).count() == 0
    assert lexical_search.search(docs, bench.where("false")).count() == 0
    assert lexical_search.search(docs, bench.where("item_id = 2")).count() == 0
    items = [tuple(r) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    got = lexical_search.search(small, read_table(spark, SF_SMALL, "benchmark")).collect()
    assert sorted((tuple(r) for r in got), key=str) == _ranked([(r.doc_id, r.text) for r in small.collect()], items, 50)


def test_lexical_search_ties_and_many_tasks(spark):
    """Equal scores over many tasks: the smallest ids are found, and repeated rows are ranked each."""
    rows = [(i // 2, "same words here" if i % 3 else "words") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    bench = spark.createDataFrame([(1, "same words"), (2, "here")], "item_id long, text string")
    got = lexical_search.search(df, bench, top=50).collect()
    assert sorted((tuple(r) for r in got), key=str) == _ranked(rows, [(1, "same words"), (2, "here")], 50)


def _depths(words):
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while i + k < n and j + k < n and words[i + k] == words[j + k]:
                    k += 1
                out[i] = max(out[i], k)
    return out


def test_repeat_depths():
    rng = np.random.default_rng(5)
    cases = [[1] * 40, [1, 2] * 30, [1, 2, 3], [], [7], list(range(20)) * 3 + [99] + list(range(20))]
    cases += [list(rng.integers(0, k, n)) for k in (2, 3, 5) for n in (2, 17, 60)]
    for c in cases:
        assert list(repetition.repeat_depths(np.array(c, np.int64))) == _depths(c)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _rules(text):
    """The rules by plain windows: spans of k words or more are k-word windows found twice."""
    text = text or ""
    w = WORD.findall(text)

    def places(k):
        at = collections.defaultdict(list)
        for i in range(len(w) - k + 1):
            at[tuple(w[i : i + k])].append(i)
        return {i + j for v in at.values() if len(v) > 1 for i in v for j in range(k)}

    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    chars = sum(map(len, w))
    again = len(places(3))
    failed = len(w) < 50 or 100 * again > 50 * len(w)
    spans = sum(len(w[i]) for i in places(repetition.MIN_REPEAT))
    kept = not failed and spans <= repetition.MAX_COVERED * chars and not places(repetition.MAX_REPEAT + 1)
    return len(w), chars, sum(c in "#*$%&|<>" for c in text), dup, again, failed, kept, spans


def test_quality_rules(spark, docs, none, small):  # noqa: F811
    plain = " ".join(f"word{i}" for i in range(300))
    long = " ".join(f"w{i}" for i in range(60))
    more = [
        (20, plain), (21, plain + " " + long + " x " + long), (22, " ".join(f"v{i}" for i in range(31)) + " " + plain + " " + " ".join(f"v{i}" for i in range(31))),
        (23, " ".join(f"v{i}" for i in range(30)) + " " + plain + " y " + " ".join(f"v{i}" for i in range(30))), (24, "a " * 400), (25, "# * | été ß x y <>&&\r\n\r\nline\nline\n line\nline \n" + plain),
        (26, "x\n" * 80), (27, plain + "\n" + " ".join(f"u{i % 12}" for i in range(36))), (20, plain), (28, "a" * 300_000 + " " + plain),
    ]
    extra = spark.createDataFrame([(i, t, "g", "a", "b", "c", 0) for i, t in more], SCHEMA)
    for df in (docs, extra, small):
        want = sorted((str(r.doc_id), *_rules(r.text)) for r in df.collect())
        for batch in (repetition.BATCH, 64):
            got = repetition.quality_rules(df, batch=batch).collect()
            assert sorted((str(r.doc_id), *tuple(r)[1:9]) for r in got) == want
    got = {r.doc_id: (r.kept, r.longest_repeat) for r in repetition.quality_rules(extra).collect()}
    assert got[20] == (True, 0) and got[21] == (False, 60) and got[22] == (False, 31) and got[23] == (True, 30)
    assert repetition.quality_rules(none).count() == 0
    kept = repetition.keep_good(extra)
    assert kept.columns == extra.columns and {r.doc_id for r in kept.collect()} == {i for i, (k, _) in got.items() if k}
    assert repetition.keep_good(none).count() == 0


def _sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _tree(nodes):
    """Levels from the given nodes up to the single one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def _proof(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 16 * 16 : i // 16 * 16 + 16]
        out.append((run[: i % 16], run[i % 16 + 1 :]))
        i //= 16
    return out


def _manifest(rows):
    def leaf(r, text):
        return _sha(*map(_field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = _tree([leaf(r, r["text"]) for r in by_source[s]])
    over = _tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by_source[s]):
            path = _proof(trees[s], i) + _proof(over, k)
            now = leaf(r, r["text"])
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                now = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
            for left, right in path:
                now = _sha(*left, now, *right)
            proof = _sha(*[d for left, right in path for d in left + right])
            out.append((str(r["doc_id"]), trees[s][0][i], trees[s][-1][0], over[-1][0], proof, now, now == over[-1][0]))
    return sorted(out)


def test_merkle_manifest(spark, docs, none, small):  # noqa: F811
    schema = "source string, doc_id long, text string, lang string, n_chars long, at string, path string, run int"
    rows = [("hot", i, f"Text {i}" if i % 7 else None, None if i % 5 else "en", i, "x", "y", 1) for i in range(700)]
    rows += [(None, i, "Sans Source É", "fr", None, "x", "y", 1) for i in range(17)] + [("one", 5, "A single Leaf", "en", 3, "x", "y", 1)]
    rows += [("equal", 9, "the Same", "en", 8, "x", "y", 1)] * 40 + [("equal", None, "", "en", 0, "x", "y", 1), ("equal", None, "B", "en", 0, "x", "y", 1)]
    rows += [(f"s{i:02}é", 10 * i, "Few", "de", 3, "x", "y", 1) for i in range(20)] + [("", 1, "Empty Name", "de", 3, "x", "y", 1), ("Z", 1, "x" * 100_000, "de", 3, "x", "y", 1)]
    many = spark.createDataFrame(rows, schema)
    for df in (many, many.where("source = 'one'"), many.where("source = 'equal'"), many.where("source IS NULL"), docs.withColumn("source", docs.lang), small):
        want = _manifest([r.asDict() for r in df.collect()])
        for parts in (1, 7):
            got = merkle_manifest.manifest_proofs(df.repartition(parts))
            assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
    assert not all(w[-1] for w in want) and any(w[-1] for w in want)
    assert merkle_manifest.manifest_proofs(none.selectExpr("*", "'a' AS source")).count() == 0


def test_merkle_shuffled_descent(spark, small, monkeypatch):  # noqa: F811
    """Heights too large to broadcast descend by shuffle joins, with equal results."""
    monkeypatch.setattr(merkle_manifest, "BROADCAST_NODES", 0)
    got = merkle_manifest.manifest_proofs(small).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == _manifest([r.asDict() for r in small.collect()])


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_repetition"])
def test_oracle(spark, name):
    import duckdb

    from corpusmill.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    got = queries.queries()[name](spark, SF_SMALL)
    want = con.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert sorted(map(str, got.select(cols).toPandas().itertuples(index=False, name=None))) == sorted(map(str, want[cols].itertuples(index=False, name=None)))
