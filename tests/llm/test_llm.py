"""The ten operators and the pipeline against brute force on small fixtures with awkward rows."""

import collections
import hashlib
import os
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import feistel_shards, length_packing, license_scan, lm_difference, multi_index, multiset_hash, simhash, suffix_dedup, toxicity, word_bpe
from corpusmill.llm.common import read_table, stage
from tests.conftest import SF_MID, SF_SMALL

LONG = " ".join(f"w{i} x{i % 7}." for i in range(4000))
PASSAGE = "A passage that several documents share, long enough to count as a repeat on its own: " + "été naïve ß " * 20
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en"),
    (2, "the quick brown fox jumps over the lazy dog", "en"),
    (3, None, None),
    (4, "", "en"),
    (5, " \n\t ", "de"),
    (6, LONG, "en"),
    (7, "before " + PASSAGE + " after", "fr"),
    (8, "other start. " + PASSAGE + " other end", "fr"),
    (9, "Straße\nGrüße; it's 12 o'clock <|endoftext|> ΑΣ", "de"),
    (9, "Straße\nGrüße; it's 12 o'clock <|endoftext|> ΑΣ", "de"),
    (None, "no id here", "en"),
    (12, "one", None),
]
SCHEMA = "doc_id long, text string, lang string, size string, score string, shard string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, g, "a", "b", "c", len(t or "")) for i, t, g in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return read_table(spark, SF_SMALL, "documents")


def test_multi_index(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).round(2)
    x[50:150] = x[50]  # a third are copies
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    bad = [(1000, None), (1050, [0.0] * 8), (1100, [None] * 8), (1150, [float("nan")] * 8), (1200, [1.0, 2.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    got = multi_index.search(df, lambda v: v % 50 == 0, coverage=1.0).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 300, 50):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        cos = {i: float((x[q] * x[i]).sum() / (np.sqrt((x[q] ** 2).sum()) * np.sqrt((x[i] ** 2).sum()))) for i in range(300) if i != q}
        want = sorted(cos, key=lambda i: (-cos[i], i))[:5]
        assert [r["vec_id"] for r in mine] == want and [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert np.allclose([r["score"] for r in mine], [u[q] @ u[i] for i in want])
    assert {r.query_id for r in got} == set(range(0, 300, 50))
    assert multi_index.search(df.where("vec_id < 0"), lambda v: v % 50 == 0).count() == 0


def test_multi_index_repeated_rows(spark):
    """Repeated rows take no places, copies go by id, and an id with several vectors counts by its best."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 6)).round(2)
    x[:8] = x[0]
    rows = [(i, [float(v) for v in r], "extra") for i, r in enumerate(x)]
    rows += [rows[1]] * 8 + [(60, rows[61][1], "extra")] * 3 + [(70 + i % 2, [float(i), 1.0, 0.0, 0.0, 0.0, 0.5], "more") for i in range(30)]
    rows += [(i, rows[50][1], "copy") for i in (900, 901) for _ in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    per = collections.defaultdict(list)
    for i, v, _ in rows:
        per[i].append(np.array(v))

    def cos(q, i):
        return max(float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))) for a in per[q] for b in per[i])

    for block in (multi_index.BLOCK, 16):
        got = multi_index.search(df, lambda v: v % 10 == 0, coverage=1.0, block=block).collect()
        assert {r.query_id for r in got} == {i for i in per if i % 10 == 0}
        for q in {r.query_id for r in got}:
            mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
            all_of = {i: cos(q, i) for i in per if i != q}
            want = sorted(all_of, key=lambda i: (-all_of[i], i))[:5]
            assert [r["vec_id"] for r in mine] == want, q
            assert np.allclose([r["score"] for r in mine], [all_of[i] for i in want])


def test_simhash(spark, docs, none, small):
    for df in (docs, small):
        got = simhash.near_duplicates(df, block=8).collect()
        rows = df.select("doc_id", "text").collect()
        fp = np.array([simhash.fingerprint(r.text) for r in rows], dtype=np.uint64)
        root = list(range(len(fp)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i, j in zip(*np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)):
            root[find(int(i))] = find(int(j))
        least: dict = {}
        for i, r in enumerate(rows):
            if r.doc_id is not None:
                least[find(i)] = min(least.get(find(i), r.doc_id), r.doc_id)
        want = sorted((str(r.doc_id), f"{int(fp[i]):016x}", least.get(find(i))) for i, r in enumerate(rows))
        assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_bits():
    import xxhash

    words = "a B c d c d c".split()
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).lower().encode(), 42) for i in range(5)]
    assert simhash.fingerprint("a B  c\td c d c") == sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) > 2.5)
    assert simhash.fingerprint("ab") == xxhash.xxh64_intdigest(b"ab", 42) and simhash.fingerprint(None) == 0


def test_multiset_hash(docs, none, small):
    a, b = multiset_hash.combine([b"x", b"y"]), multiset_hash.combine([b"y", b"x"])
    assert multiset_hash.to_text(a) == multiset_hash.to_text(b)
    less = multiset_hash.add(a, multiset_hash.combine([b"x"]), -1)
    assert multiset_hash.to_text(less) == multiset_hash.to_text(multiset_hash.combine([b"y"]))
    for df in (docs, small):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), len(r[1])))
        want = []
        for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
            want.append((str(i), len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]).encode()).hexdigest()))
        got = multiset_hash.fingerprint_edits(df, part_rows=3).collect()
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert multiset_hash.fingerprint_edits(none).count() == 0


def test_multiset_hash_of_a_hot_id(spark):
    """A third of all rows has one id and another part none: their parts are cut like others, and successors stay right."""
    rows = [(7 if i % 3 == 0 else None if i % 7 == 0 else i - 200, "word " * (i + 1)) for i in range(400)] + [(-(1 << 63), "low"), ((1 << 63) - 1, "high")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), zlib.crc32(r[1].encode()), len(r[1])))
    want = [(str(i), hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest()) for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1])]
    out = multiset_hash.fingerprint_edits(df, part_rows=10)
    assert sorted((str(r.doc_id), r.edited_sha256) for r in out.collect()) == sorted(want)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 60


def test_multiset_likeness():
    """Likeness against true multisets, very long repeats included."""
    long, half = multiset_hash.combine([b"line"] * 40_000), multiset_hash.combine([b"line"] * 20_000)
    assert multiset_hash.likeness(long, half) == pytest.approx(0.8)
    assert multiset_hash.to_text(multiset_hash.from_text(multiset_hash.to_text(long))) == multiset_hash.to_text(long)
    rng = np.random.default_rng(8)
    for shared in (0, 50, 150, 200):
        a = [b"s%d" % i for i in range(shared)] + [b"a%d" % i for i in rng.integers(0, 1 << 40, 200 - shared)]
        b = [b"s%d" % i for i in range(shared)] + [b"b%d" % i for i in rng.integers(0, 1 << 40, 200 - shared)]
        assert abs(multiset_hash.likeness(multiset_hash.combine(a), multiset_hash.combine(b)) - shared / 200) < 0.3


def _windows(texts, w):
    count = collections.Counter(b[p : p + w] for b in texts for p in range(len(b) - w + 1))
    for b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - w + 1):
            if count[b[p : p + w]] > 1:
                gone[p : p + w] = b"\1" * w
        yield gone


def test_suffix_dedup(docs, none, small):
    for df in (docs, small):
        rows = df.select("doc_id", "text").collect()
        data = [(r.text or "").encode() for r in rows]
        want = []
        for r, b, gone in zip(rows, data, _windows(data, 200)):
            kept = bytes(x for x, g in zip(b, gone) if not g)
            want.append((str(r.doc_id), len(b), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
        got = suffix_dedup.window_digest(df).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert suffix_dedup.window_digest(none).count() == 0
    out = suffix_dedup.drop_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[7].startswith("before") and "passage" not in text[7] and text[1] == ROWS[0][1] and text[3] is None


def test_suffix_dedup_of_a_hot_passage(spark):
    """A third of all rows is one row repeated, and a passage stands in many surroundings; nothing is lost or cut besides."""
    rng = np.random.default_rng(11)
    word = lambda n: " ".join(f"w{int(x)}" for x in rng.integers(0, 1 << 30, n))
    passage = word(30)
    rows = [(None, passage + " the end " * 9)] * 60
    rows += [(i, f"{word(i % 9)} {passage[i % 50 :]} {word(i % 7)}") for i in range(90)]
    rows += [(1_000 + i, word(40)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    data = [t.encode() for _, t in rows]
    want = [(str(i), len(b), sum(gone)) for (i, _), b, gone in zip(rows, data, _windows(data, 200))]
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in keys}
    try:  # hot keys are split over tasks
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = suffix_dedup.window_digest(df).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in got) == sorted(want)


def _every_window(text, template, least):
    """Best Dice coefficient over all windows of words, by multisets."""
    w, t = license_scan.words_of(text), license_scan.words_of(template)
    own = collections.Counter(zip(t, t[1:]))
    best = 0.0
    for i in range(len(w)):
        for j in range(i + 2, len(w) + 1):
            held = collections.Counter(zip(w[i:j], w[i + 1 : j]))
            best = max(best, 2 * sum((held & own).values()) / (j - i - 1 + len(t) - 1))
    return best if best >= least else 0.0


def test_license_windows_by_brute_force():
    rng = np.random.default_rng(6)
    templates = [("A", "a b c d a b"), ("B", "b c d e"), ("C", "c a")]
    known = license_scan.Templates(templates, 0.8)
    found = 0
    for _ in range(300):
        text = " ".join(rng.choice(list("abcdexy"), rng.integers(0, 16), p=[0.2, 0.2, 0.2, 0.15, 0.15, 0.05, 0.05]))
        best = collections.defaultdict(float)
        for score, first, after, t in known.windows(text):
            best[t] = max(best[t], score)
            assert score == pytest.approx(_every_window(" ".join(text.split()[first : after + 1]), templates[t][1], 0.8))
        for t, (_, words) in enumerate(templates):
            assert best[t] == pytest.approx(_every_window(text, words, 0.8)), (text, t)
        found += len(best)
        hits = known.notices(text)
        spans = sorted((f, e) for _, f, e, _ in hits)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    assert found > 100


def test_license_scan(spark, none, small):
    import textwrap

    def wrapped(text, mark="# "):
        return "int main;\n" + "\n".join(mark + line for line in textwrap.wrap(text, 50)) + "\nreturn 0; words follow here and there"

    full = {n: t for n, t in license_scan.TEMPLATES}  # the last template of each name
    rows = [(1, "Hello there.\nLicensed under the Apache License, Version 2.0.\nBye"), (2, "MIT people like a license"), (3, None), (4, ""), (5, "Some words. Released under the MIT License. And more words follow here."), (6, "Licensed under CC BY-NC 4.0."), (7, LONG)]
    rows += [(10, wrapped(license_scan.TEMPLATES[2][1])), (11, wrapped(full["GPL-3.0"], " * ")), (12, wrapped(license_scan._MIT)), (13, wrapped(license_scan._BSD)), (14, wrapped(full["LGPL-2.1"])), (15, wrapped(license_scan.TEMPLATES[18][1]))]
    rows += [(20, "Released under the MIT License" + " " * 6000), (21, "Released under\n\n\t the   MIT License\n" * 3), (22, "Released under the MIT License. " + LONG + " Licensed under CC BY 4.0"), (23, "released under the mit license"), (23, "released under the mit license"), (None, "Licensed under CC BY-SA 4.0")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, license string, n_matches int")
    got = collections.defaultdict(list)
    for r in license_scan.scan_licenses(df).collect():
        got[r.doc_id].append((r.license, r.n_matches))
    want = {1: ("Apache-2.0", 1), 2: (None, 0), 3: (None, 0), 4: (None, 0), 5: ("MIT", 1), 6: ("CC-BY-NC-4.0", 1), 7: (None, 0), 10: ("Apache-2.0", 1), 11: ("GPL-3.0", 1), 12: ("MIT", 1), 13: ("BSD", 1), 14: ("LGPL-2.1", 1), 15: ("BSD-3-Clause", 1), 20: ("MIT", 1), 21: ("MIT", 3), 22: ("MIT", 2), None: ("CC-BY-SA-4.0", 1)}
    assert {i: v[0] for i, v in got.items() if i != 23} == want and got[23] == [("MIT", 1)] * 2
    known = license_scan.Templates(license_scan.TEMPLATES, 0.8)
    for name, text in license_scan.TEMPLATES:
        score, _, _, t = known.notices(text)[0]
        assert score == 1.0 and known.names[t] == name
    assert license_scan.scan_licenses(none).count() == 0
    # every document of a table whose licence line the plain search for whole templates finds
    short = [" ".join(license_scan.words_of(t)) for _, t in license_scan.TEMPLATES]
    plain = {r.doc_id for r in small.collect() if any(s in " ".join(license_scan.words_of(r.text or "")) for s in short)}
    assert plain <= {r.doc_id for r in license_scan.scan_licenses(small).where("n_matches > 0").collect()} and plain


def test_word_bpe(docs, none, small):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    tok = tokenizers.Tokenizer.from_file(path)
    for df in (docs, small):
        want = []
        for r in df.collect():
            ids = tok.encode(r.text or "", add_special_tokens=False).ids
            said = tok.decode(ids, skip_special_tokens=False)
            want.append((str(r.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
        got = word_bpe.encode_documents(df, path).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert word_bpe.encode_documents(none, path).count() == 0


def test_word_bpe_every_sign():
    """Every sign of the planes in use, beside letters, digits and other signs, before and after combining marks."""
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    tok, ours = tokenizers.Tokenizer.from_file(path), word_bpe.load(path)
    signs = [chr(c) for lo, hi in word_bpe.PLANES for c in range(lo, hi)]
    texts = [f"a{c}b {c}! 1{c}{c}'s" for c in signs]
    marked = [c for c in signs if unicodedata.category(c) in ("Mn", "Mc", "Cn") and ord(c) < 0x20000]
    texts += [f"a{c}\u0334 e\u0345{c}\u0300 {c}\u0316x" for c in marked]
    texts += ["x" + unicodedata.normalize("NFD", c) for c in signs if unicodedata.normalize("NFD", c) != c]
    for at in range(0, len(texts), 20_000):
        part = texts[at : at + 20_000]
        for text, (ids, said), want in zip(part, ours.encode_batch(part), tok.encode_batch(part, add_special_tokens=False)):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, ascii(text)
            assert said == tok.decode(want.ids, skip_special_tokens=False), ascii(text)


def test_block_max_is_exact():
    rng = np.random.default_rng(3)
    vectors = [{int(t): float(rng.random()) for t in rng.choice(30, 4, replace=False)} for _ in range(500)]
    index = toxicity.BlockMaxIndex(vectors, 30, block=16)
    for q in vectors[:60]:
        dots = np.array([sum(w * v.get(t, 0.0) for t, w in q.items()) for v in vectors])
        ids, near = index.nearest(q, 7)
        assert np.allclose(near, np.sort(dots)[::-1][:7]) and np.allclose(dots[ids], near)


def test_toxicity(spark, docs, none):
    rows = [(i, ("you stupid moron " if i % 4 == 0 else "a fine day ") + f"word{i % 9} here") for i in range(400)]
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(None, 1), (4, None)], "doc_id long, toxic int")
    got = toxicity.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), marks).collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in got) and any(r.held_out for r in got)
    out = toxicity.score_documents(docs, marks.where("false")).collect()
    assert len(out) == len(ROWS) and all(r.score == 0 and r.predicted == 0 for r in out)
    assert toxicity.score_documents(none, marks).count() == 0
    assert toxicity.drop_toxic(docs, marks.where("false")).count() == len(ROWS)


def test_toxicity_ties_ignore_labels(spark):
    """Equal examples vote by the share of toxic ones among them, whatever the order of the labels."""
    same = {0: 1}
    scorers = [toxicity.Scorer(["moron"], np.array([1.0]), [(same, y) for y in order], [], 15) for order in ([0, 1] * 40, [1, 0] * 40)]
    assert all(0.4 < s.vote(same)[0] < 0.6 for s in scorers)
    rows = [(i, "you stupid moron " * 3) for i in range(300)] + [(i, "a fine day here") for i in range(300, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 300 and i % 4 > 0)) for i in range(600)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_documents(df, marks).collect()}
    assert 0.5 < got[0] < 1 and got[0] == got[1] and got[400] < 0.1


def test_feistel(docs, none, small):
    for n in (1, 2, 24, 1000, 4097):
        p = feistel_shards.Feistel(n)
        at = p.position(np.arange(n))
        assert sorted(at) == list(range(n)) and (p.number(at) == np.arange(n)).all()
    for df in (docs, small):
        got = feistel_shards.shard_documents(df).collect()
        sizes = collections.Counter(r.shard for r in got)
        assert max(sizes.values()) - min([sizes[s] for s in range(24)]) <= 1
        for s in sizes:
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
        again = feistel_shards.shard_documents(df.repartition(5)).collect()
        assert sorted(map(str, got)) == sorted(map(str, again))
    assert feistel_shards.shard_documents(none).count() == 0
    assert set(feistel_shards.shard_rows(docs, ["doc_id"], 3).columns) >= set(docs.columns)


def test_packing(docs, none, small):
    counts = {3: 5, 4: 1, 9: 2, 10: 7, 30: 1}
    import itertools

    def cost(bounds):
        return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in counts.items())

    best = min(cost([*c, 30]) for c in itertools.combinations([3, 4, 9, 10], 2))
    assert cost(length_packing.optimal_boundaries(counts, 3)) == best
    for df in (docs, small):
        got = length_packing.pack_documents(df, max_len=100, buckets=4, budget=500).collect()
        per = collections.Counter()
        for r in got:
            per[r.doc_id] += r.n_tokens
        want = collections.Counter()
        for r in df.collect():
            want[r.doc_id] += len((r.text or "").split())
        assert per == want
        batches = collections.Counter((r.bucket, r.batch, r.bucket_len) for r in got if r.bucket is not None)
        assert all(n * size <= 500 for (_, _, size), n in batches.items())
    assert length_packing.pack_documents(none).count() == 0


def test_lm_difference(spark, docs, none):
    rows = [(i, "red green blue " * 5 if i % 2 else "one two three " * 5) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm_difference.score_documents(df, df.where("doc_id % 2 = 1 and doc_id < 20").select("doc_id")).collect()
    assert max(r.score for r in got if r.doc_id % 2) < min(r.score for r in got if r.doc_id % 2 == 0)
    out = lm_difference.score_documents(docs, docs.where("doc_id = 3").select("doc_id")).collect()
    assert len(out) == len(ROWS) and all(r.score == 0 and r.target_loss is None for r in out if r.n_tokens == 0)
    assert lm_difference.score_documents(none, none.select("doc_id")).count() == 0


def test_lm_difference_is_exact(docs, small):
    """Losses equal those of plain counts of every word and pair of all other texts, over many blocks and with rare words."""
    for df, block in ((docs, 100), (small, 20_000), (small, lm_difference.BLOCK)):
        rows = [(r.doc_id, lm_difference.WORD.findall((r.text or "").lower())) for r in df.collect()]
        words = {w for _, t in rows for w in t}
        is_target = lambda i: i is not None and i % 3 == 0
        sizes = [sum(len(t) for i, t in rows if wanted(i)) for wanted in (is_target, lambda i: True)]
        losses = {}
        for name, wanted, weight in (("target", is_target, 1.0), ("background", lambda i: True, sizes[0] / sizes[1])):
            one = collections.Counter(w for i, t in rows if wanted(i) for w in t)
            two = collections.Counter(p for i, t in rows if wanted(i) for p in zip(t, t[1:]))
            whole = sum(one.values())
            losses[name] = []
            for i, t in rows:
                mine, pairs = (collections.Counter(t), collections.Counter(zip(t, t[1:]))) if wanted(i) else ({}, {})
                n = {w: weight * (one[w] - mine.get(w, 0)) for w in t}
                uni = {w: (n[w] + 1) / (weight * (whole - len(t) * wanted(i)) + len(words)) for w in t}
                each = [-np.log((weight * (two[p] - pairs.get(p, 0)) + 32 * uni[p[1]]) / (n[p[0]] + 32)) for p in zip(t, t[1:])]
                losses[name].append(np.mean([-np.log(uni[t[0]]), *each]) if t else None)
        want = [(str(i), len(t), a or 0.0, b or 0.0, (a or 0.0) - (b or 0.0)) for (i, t), a, b in zip(rows, losses["target"], losses["background"])]
        got = lm_difference.score_documents(df, df.where("doc_id % 3 = 0").select("doc_id"), block=block).collect()
        got = sorted((str(r.doc_id), r.n_tokens, r.target_loss or 0.0, r.background_loss or 0.0, r.score) for r in got)
        assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
        assert np.allclose([g[2:] for g in got], [w[2:] for w in sorted(want)])


def test_lm_difference_marked_and_unmarked_alike(spark):
    """Marking half of the wanted documents scores the other half alike: the score is not who was marked."""
    rng = np.random.default_rng(5)
    draw = lambda first: " ".join(f"w{first + int(x)}" for x in rng.zipf(1.3, 60) % 300)
    rows = [(i, draw(0 if i % 2 else 150)) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_difference.score_documents(df, df.where("doc_id % 4 = 1").select("doc_id")).collect()}
    marked, alike, others = ([got[i] for i in range(k, 1200, step)] for k, step in ((1, 4), (3, 4), (0, 2)))
    noise = 4 * np.sqrt(np.var(marked) / len(marked) + np.var(alike) / len(alike))
    assert abs(np.mean(marked) - np.mean(alike)) < noise < np.mean(others) - np.mean(alike)


def test_near_copies_by_brute_force(spark, docs, small):
    """The pipeline's second stage keeps one row of each component; equal ids with other texts are other documents."""
    text = " ".join(f"alpha{i}" for i in range(60))
    same = [(1, text, "en"), (1, "one two three four five", "en"), (2, "one two three four five", "en"), (3, "red green blue", "en"), (None, "red green blue", "en"), (None, "lonely text", "en"), (None, "lonely text", "fr"), (1, text, "de")]
    ids = spark.createDataFrame([(i, t, g, "a", "b", "c", 1, "x", "y") for i, t, g in same], SCHEMA + ", __mark string, __id string")
    for df in (ids, docs, small):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        fp = np.array([simhash.fingerprint(t) for _, t in rows], dtype=np.uint64)
        near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
        group = np.arange(len(rows))
        while True:
            low = np.array([group[n].min() for n in near])
            if (low == group).all():
                break
            group = low
        out = corpus_pipeline.drop_near_copies(spark, df, SF_SMALL)
        assert out.columns == df.columns
        got = [(r.doc_id, r.text) for r in out.collect()]
        where = {(i, t or ""): g for (i, t), g in zip(rows, group)}
        assert sorted(where[i, t or ""] for i, t in got) == sorted(set(group))
        for i, t in got:
            mine = [j for (j, _), g in zip(rows, group) if g == where[i, t or ""]]
            assert i == min((j for j in mine if j is not None), default=None)


def test_helper_columns_stay(spark):
    """Columns named like the operators' helpers come through unchanged."""
    names = ["__b", "__i", "__first", "__n", "__key", "__mark", "__spans", "__id", "__kept"]
    df = spark.createDataFrame([(i, f"text {i} " + "same passage " * 40, *[f"{n}{i}" for n in names]) for i in range(6)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    want = sorted(tuple(r) for r in df.select("doc_id", *names).collect())
    for out in (suffix_dedup.drop_repeats(df), feistel_shards.shard_rows(df, ["doc_id"], 3)):
        assert sorted(tuple(r) for r in out.select("doc_id", *names).collect()) == want


def test_pipeline_toxicity_by_brute_force(spark):
    """The first stage drops what the neighbours by all products say; votes next to a step may fall on either side."""
    now, labels = read_table(spark, SF_MID, "documents"), read_table(spark, SF_MID, "labels")
    rows = [(r.doc_id, r.text) for r in now.collect()]
    scorer = toxicity.train(now, labels)
    assert scorer.terms.n and scorer.index.n
    dense = np.zeros((scorer.index.n, scorer.terms.n))
    for t, (ids, weights) in enumerate(zip(scorer.index.ids, scorer.index.weights)):
        dense[ids, t] = weights
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, now, SF_MID).collect()}
    assert 0 < len(kept) < len(rows)
    for (i, _), (t, n) in zip(rows, scorer.terms.each(pa.array([t for _, t in rows], pa.string()))):
        scores = {scorer.base}
        if len(t):
            unit = (1 + np.log(n)) * scorer.idf[t]
            near = np.round(dense[:, t] @ (unit / np.linalg.norm(unit)), 12)
            best = [j for j in np.lexsort((np.arange(len(near)), -near))[: toxicity.NEAREST] if near[j] > 0]
            weight = 1 / (1.05 - np.minimum(near[best], 1))
            vote = float(weight @ scorer.labels[best] / weight.sum()) if best else 0.0
            scores = {float(scorer.steps[1][max(0, np.searchsorted(scorer.steps[0], v, side="right") - 1)]) for v in (vote - 1e-9, vote + 1e-9)}
        assert (i in kept) in {s < toxicity.THRESHOLD for s in scores}


def test_pipeline_by_brute_force(spark):
    """The decisions of stages 2 and 3 on all that the stage before kept, and the rows of ``run``, against plain Python.
    The labels of sf0.001 are too few for toxicity to drop a row there."""
    now = read_table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in now.collect()]
    now = stage(corpus_pipeline.drop_toxic(spark, now, SF_SMALL), "test-toxic")
    kept = {r.doc_id for r in now.collect()}

    # SimHash: the smallest id of each component, by all pairs
    rows = sorted((i, t) for i, t in rows if i in kept)
    fp = np.array([simhash.fingerprint(t) for _, t in rows], dtype=np.uint64)
    near, group = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3, np.arange(len(rows))
    while True:
        low = np.array([group[n].min() for n in near])
        if (low == group).all():
            break
        group = low
    now = stage(corpus_pipeline.drop_near_copies(spark, now, SF_SMALL), "test-near")
    rows = [rows[g] for g in sorted(set(group.tolist()))]
    assert sorted((r.doc_id, r.text) for r in now.collect()) == rows

    # suffix array: a character goes when all its bytes lie in repeated windows
    now = stage(corpus_pipeline.cut_repeats(spark, now, SF_SMALL), "test-cut")
    data = [(t or "").encode() for _, t in rows]
    want = []
    for (i, t), gone in zip(rows, _windows(data, 200)):
        out, at = [], 0
        for c in t or "":
            size = len(c.encode())
            if not all(gone[at : at + size]):
                out.append(c)
            at += size
        want.append((i, "".join(out)))
    assert sorted((r.doc_id, r.text or "") for r in now.collect()) == want

    # packing: every piece, the least padding that any boundaries reach, and gapless places in each bucket
    pieces = []
    for i, t in want:
        n = len(re.findall(length_packing.WORD, t))
        pieces += [(i, k, k * length_packing.MAX_LEN, min(length_packing.MAX_LEN, n - k * length_packing.MAX_LEN)) for k in range(max(1, -(-n // length_packing.MAX_LEN)))]
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.n_tokens) for r in got) == sorted(pieces)
    sizes = sorted(n for *_, n in pieces if n)
    ends = [k + 1 for k in range(len(sizes)) if k + 1 == len(sizes) or sizes[k + 1] > sizes[k]]
    total = np.concatenate([[0], np.cumsum(sizes)])
    least = {0: 0}
    for _ in range(length_packing.BUCKETS):
        least = least | {e: min(c + (e - b) * sizes[e - 1] - int(total[e] - total[b]) for b, c in least.items() if b < e) for e in ends}
    full = [r for r in got if r.n_tokens]
    assert sum(r.padding for r in full) == least[len(sizes)]
    assert all(r.padding == r.bucket_len - r.n_tokens >= 0 for r in full)
    for b, size in {(r.bucket, r.bucket_len) for r in full}:
        places = sorted(r.batch * (length_packing.BUDGET // size) + r.slot for r in full if r.bucket == b)
        assert places == list(range(len(places)))


def test_pipeline(spark, docs, none):
    for df in (docs, none):
        now = df
        for name, step in corpus_pipeline.STAGES[:-1]:
            now = step(spark, now, SF_SMALL)
            assert now.columns == df.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, now, SF_SMALL).count() >= (0 if df is none else 5)
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 100
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
