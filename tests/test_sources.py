"""File sources and sinks on fresh temporary folders."""

import gzip
import os
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpusmill.operators import dedup as D
from corpusmill.sources import catalog as C
from corpusmill.sources import files as FS
from corpusmill.sources import gzip_members as GM
from corpusmill.sources import text_files as TF


def _byte_split_corpus(root, name, lines, chunk):
    """A corpus as the reference stores it: one gzip stream cut into byte chunks named ``X_part_aa.txt.gz``..."""
    os.makedirs(os.path.join(root, name))
    data = gzip.compress(("\n".join(lines) + "\n").encode("utf-8"))
    for i in range(0, len(data), chunk):
        idx = i // chunk
        suffix = chr(ord("a") + idx // 26) + chr(ord("a") + idx % 26)
        with open(os.path.join(root, name, f"{name}_part_{suffix}.txt.gz"), "wb") as fh:
            fh.write(data[i : i + chunk])
    return os.path.join(root, name)


def test_scan_split_gzip_reads_byte_split_parts_in_order(spark, tmp_dir):
    lines_a = [f"ligne {i} é" for i in range(3000)]
    lines_b = ["x\r\ny", "", "z"]
    da = _byte_split_corpus(tmp_dir, "corpa", lines_a, 997)
    db = _byte_split_corpus(tmp_dir, "corpb", lines_b, 10)
    assert len(os.listdir(da)) > 2
    out = FS.scan_split_gzip(spark, [da, db]).collect()
    by = {}
    for r in out:
        by.setdefault(r.corpus, []).append((r.position, r.text))
    assert [t for _, t in sorted(by["corpa"])] == lines_a
    # universal newlines as Python's text mode: \r\n ends a line
    assert [t for _, t in sorted(by["corpb"])] == ["x", "y", "", "z"]


def test_scan_text_files_whole_file_and_newlines(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "sub"))
    with open(os.path.join(tmp_dir, "a.txt"), "wb") as fh:
        fh.write("l1\r\nl2\rl3\n".encode())
    with open(os.path.join(tmp_dir, "sub", "b.txt"), "w") as fh:
        fh.write("deux")
    with open(os.path.join(tmp_dir, "skip.ann"), "w") as fh:
        fh.write("T1 x")
    got = sorted(r.text for r in FS.scan_text_files(spark, tmp_dir).collect())
    assert got == ["deux", "l1\nl2\nl3\n"]


def test_dispatch_prefers_gzip_and_errors_when_empty(spark, tmp_dir):
    d = _byte_split_corpus(tmp_dir, "c", ["a", "b"], 7)
    with open(os.path.join(d, "note.txt"), "w") as fh:
        fh.write("ignored")
    assert [r.text for r in FS.scan_local_dispatch(spark, d).orderBy("row_order").collect()] == ["a", "b"]
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    with open(os.path.join(empty, "x.ann"), "w") as fh:
        fh.write("no")
    with pytest.raises(RuntimeError):
        FS.scan_local_dispatch(spark, empty)


def test_write_sized_gzip_round_trip_and_refusal(spark, tmp_dir):
    df = spark.range(1000).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("text"))
    out = os.path.join(tmp_dir, "export")
    FS.write_sized_gzip(df, out, max_records=300)
    parts = [p for p in os.listdir(out) if p.endswith(".gz")]
    assert len(parts) >= 4
    assert spark.read.text(out).count() == 1000
    with pytest.raises(Exception):
        FS.write_sized_gzip(df, out, max_records=300)
    FS.write_sized_gzip(df.limit(10), out, max_records=300, override=True)
    assert spark.read.text(out).count() == 10


def _corpus(spark, root, commercial):
    return sorted((r.doc_id, r.source) for r in FS.read_by_source(spark, root, commercial).collect())


def test_write_by_source_builds(spark, tmp_dir):
    root = tmp_dir + "/t"
    schema = "doc_id long, input string, source string"
    df = spark.createDataFrame([(1, "a", "S1"), (2, "b", "S2"), (4, "d", "É/x=1 %"), (5, "e", "007")], schema)
    FS.write_by_source(df, root, make_commercial=False)
    FS.write_by_source(df.where("source = 'S1'"), root, make_commercial=True)
    assert _corpus(spark, root, True) == [(1, "S1")]  # a commercial build never shows research rows
    assert _corpus(spark, root, False) == [(1, "S1"), (2, "S2"), (4, "É/x=1 %"), (5, "007")]
    FS.write_by_source(spark.createDataFrame([(3, "c", "S2")], schema), root, False, sources=["S2", "S1"])
    assert _corpus(spark, root, False) == [(3, "S2"), (4, "É/x=1 %"), (5, "007")]  # replaced and emptied
    assert [r.doc_id for r in FS.read_by_source(spark, root, False, ["007"]).collect()] == [5]
    assert len(FS.remove_old_builds(spark, root, False)) == 2
    assert _corpus(spark, root, False) == [(3, "S2"), (4, "É/x=1 %"), (5, "007")]
    with pytest.raises(ValueError):
        FS.write_by_source(df, root, False, sources=["S2"])
    FS.write_by_source(df.where("false"), root, False)
    assert _corpus(spark, root, False) == []


def test_killed_or_late_builds_change_nothing(spark, tmp_dir, monkeypatch):
    root = tmp_dir + "/t"
    df = spark.createDataFrame([(1, "a", "S1")], "doc_id long, input string, source string")
    with pytest.raises(FileNotFoundError):
        FS.read_by_source(spark, root, True)
    FS.write_by_source(df, root, True)
    failing = df.withColumn("input", F.raise_error(F.lit("killed")).cast("string"))
    with pytest.raises(Exception):
        FS.write_by_source(failing, root, True)
    assert _corpus(spark, root, True) == [(1, "S1")]
    old = FS.read_manifest(spark, root, True)
    FS.write_by_source(df.withColumn("doc_id", F.lit(2).cast("long")), root, True)
    monkeypatch.setattr(FS, "read_manifest", lambda *a: old)  # a build that began before the last one was published
    with pytest.raises(Exception):
        FS.write_by_source(df, root, True)
    monkeypatch.undo()
    assert _corpus(spark, root, True) == [(2, "S1")]


def test_catalog_order_and_shared_input(spark):
    entries = [{"source": s, "data_dir": ["y", "x"], "source_split": None} for s in ("zeta", "alpha")] + [{"source": "mid", "data_dir": None}]
    catalog = C.catalog_frame(spark, entries)
    rows = [("a", "alpha", "x"), ("a", "zeta", "x"), ("b", "alpha", "y"), ("c", "alpha", "x"), ("c", "alpha", "y"), ("c", "mid", "q"), ("d", "mid", None), ("e", "other", "x"), ("f", "zeta", "z")]
    df = spark.createDataFrame([(t, s, d, "train", i) for i, (t, s, d) in enumerate(rows)], "input string, source string, data_dir string, source_split string, row_order long")
    reads = []
    shared = C.SharedInput(lambda s: reads.append(1) or df)
    registry = C.SourceRegistry({s: shared for s in ("alpha", "zeta", "mid", "other")})
    out = C.ingest_fanout(spark, catalog, registry)
    got = {(r.input, r.source, r.row_order.source_rank, r.row_order.data_dir_rank, r.row_order.pos) for r in out.collect()}
    # "other" and the unlisted data_dir "z" are not loaded; "mid" names no data_dir and takes all its rows
    assert got == {("a", "alpha", 1, 1, 0), ("a", "zeta", 0, 1, 1), ("b", "alpha", 1, 0, 2), ("c", "alpha", 1, 1, 3), ("c", "alpha", 1, 0, 4), ("c", "mid", 2, 0, 5), ("d", "mid", 2, 0, 6)}
    assert len(reads) == 1
    kept = D.dedup_exact(out, "input").collect()
    assert {(r.input, r.source, r.row_order.pos) for r in kept} == {("a", "zeta", 1), ("b", "alpha", 2), ("c", "alpha", 4), ("d", "mid", 6)}
    one = C.ingest_fanout(spark, C.catalog_select(catalog, "alpha"), registry)
    assert {r.row_order for r in one.collect()} == {r.row_order for r in out.collect() if r.source == "alpha"}
    for bad in ([*entries, entries[0]], [{"source": "p", "position": 1}, {"source": "q", "position": 1}]):
        with pytest.raises(ValueError):
            C.catalog_frame(spark, bad)


def test_ingest_fanout_scans_once(spark):
    from corpusmill.plans.registry import queries
    from tests.conftest import SF_SMALL

    plan = queries()["ingest_fanout"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_catalog_yaml_select_and_license(spark, tmp_dir):
    path = os.path.join(tmp_dir, "datasets.yaml")
    with open(path, "w") as fh:
        fh.write(
            "datasets:\n"
            "  - source: A\n    path: p\n    data_dir: [x, y]\n    source_split: train\n"
            "    adaptation_type: fine-tuning\n    commercial_use: True\n"
            "  - source: B\n    path: q\n    data_dir:\n    source_split: [train, test]\n"
            "    adaptation_type: instruction-tuning\n    commercial_use: False\n"
        )
    cat = C.read_catalog(spark, path)
    rows = {r.source: r for r in cat.collect()}
    assert rows["A"].data_dir == ["x", "y"] and rows["A"].source_split == ["train"]
    assert rows["B"].data_dir == [None] and rows["B"].source_split == ["train", "test"]
    assert C.catalog_select(cat, "A").count() == 1
    with pytest.raises(ValueError):
        C.catalog_select(cat, "nope")
    assert [r.source for r in C.license_catalog(cat, True).collect()] == ["A"]
    with pytest.raises(RuntimeError):
        C.license_catalog(cat.where("source = 'B'"), True)


def _export(out):
    """Chunks in order, each as its list of lines."""
    files = sorted((d, f) for d in os.listdir(out) if d.startswith("chunk=") for f in os.listdir(os.path.join(out, d)) if f.endswith(".gz"))
    assert len({d for d, _ in files}) == len(files)
    return [gzip.open(os.path.join(out, d, f)).read() for d, f in files]


def test_write_sized_gzip_byte_cap(spark, tmp_dir):
    df = spark.range(20_000).select(F.concat(F.lit("une ligne de texte numéro "), F.col("id").cast("string")).alias("text"))
    want = "".join(f"une ligne de texte numéro {i}\n" for i in range(20_000)).encode()
    for parts in (1, 7):
        out = os.path.join(tmp_dir, f"bytes{parts}")
        FS.write_sized_gzip(df.coalesce(1) if parts == 1 else df.repartitionByRange(parts, "text"), out, max_bytes=8_000)
        chunks = _export(out)
        assert all(len(c) <= 8_000 for c in chunks)
        least = -(-len(want) // 8_000)
        assert least <= len(chunks) <= least * 1.1 + 2
        assert sorted(b"".join(chunks).splitlines()) == sorted(want.splitlines())
        if parts == 1:
            assert b"".join(chunks) == want  # order kept
    with pytest.raises(Exception):
        FS.write_sized_gzip(df, out, max_bytes=8_000)
    FS.write_sized_gzip(df.limit(3), out, max_bytes=8_000, override=True)
    assert spark.read.text(out).count() == 3


def test_write_sized_gzip_one_long_line(spark, tmp_dir):
    """A line above the cap is a file of its own and does not change how the others are cut."""
    rows = ["short line"] * 3000 + ["x" * 50_000] + ["short line"] * 3000 + [None, ""]
    df = spark.createDataFrame([(r,) for r in rows], "text string").coalesce(1)
    out = os.path.join(tmp_dir, "outlier")
    FS.write_sized_gzip(df, out, max_bytes=4_000)
    chunks = _export(out)
    assert b"".join(chunks) == "".join((r or "") + "\n" for r in rows).encode()
    assert [len(c) for c in chunks if len(c) > 4_000] == [50_001] and 17 <= len(chunks) <= 24
    empty = os.path.join(tmp_dir, "empty-export")
    FS.write_sized_gzip(df.where("false"), empty, max_bytes=4_000)
    assert _export(empty) == []


def _cut_into_parts(folder, data, rng):
    os.makedirs(folder)
    at = i = 0
    while at < len(data):
        n = rng.randint(1, max(2, len(data) // 7))
        with open(os.path.join(folder, f"c_part_{chr(97 + i // 26)}{chr(97 + i % 26)}.txt.gz"), "wb") as fh:
            fh.write(data[at : at + n])
        at, i = at + n, i + 1
    return folder


def _python_lines(text):
    """Text mode with universal newlines, line ends removed."""
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    return lines[:-1] if lines[-1] == "" else lines


def test_scan_split_gzip_reads_members_in_many_tasks(spark, tmp_dir):
    """Members, parts and lines are cut at unrelated bytes; the number of tasks changes nothing."""
    rng = random.Random(4)
    for trial, pool in enumerate(("ab\n", "aé\r\n\n", "x\r\n", "abc", "\n")):
        text = "".join(rng.choice(pool) for _ in range(600))
        text = text + "\n" if trial == 1 else text
        raw = text.encode("utf-8")
        data, at = b"", 0
        while at < len(raw):
            n = rng.choice((1, 3, 40, 200))
            data += gzip.compress(raw[at : at + n]) + rng.choice((b"", b"", b"\0\0"))
            at += n
            if rng.random() < 0.2:
                data += gzip.compress(b"")
        folder = _cut_into_parts(os.path.join(tmp_dir, f"m{trial}"), data, rng)
        want = list(enumerate(_python_lines(text)))
        parts = FS.gzip_parts(spark, folder)
        (key, (paths, lengths)), = parts.items()
        stream = GM.Stream(paths, lengths)
        notes = [n for p in range(len(paths)) for s in GM.header_places(stream, p) if (n := GM.note(stream, key, s))]
        for unit_bytes in (1, 300, 1 << 20):
            got = []
            units = GM.chain(key, stream.size, notes, unit_bytes)
            for _, start, stop, skip, position in units:
                got += list(enumerate(GM.unit_lines(stream, start, stop, skip), position))
            assert got == want, (trial, unit_bytes)
        assert len(GM.chain(key, stream.size, notes, 1)) > 3 or pool == "abc"
        df = FS.scan_split_gzip(spark, folder, unit_bytes=200)
        assert sorted((r.position, r.text) for r in df.collect()) == want
        assert trial or df.rdd.getNumPartitions() >= 2


def test_scan_split_gzip_chance_headers(spark, tmp_dir):
    """A stored block may hold the bytes of a header, or a whole member: only the chain's members count."""
    inner = b"\x1f\x8b\x08 no member\n" + gzip.compress(b"an inner member\n")
    raw = gzip.compress(b"first\n") + gzip.compress(b"x" + inner.replace(b"\r", b"") , 0) + gzip.compress(b"last\n")
    folder = _cut_into_parts(os.path.join(tmp_dir, "chance"), raw, random.Random(1))
    (key, (paths, lengths)), = FS.gzip_parts(spark, folder).items()
    stream = GM.Stream(paths, lengths)
    places = [s for p in range(len(paths)) for s in GM.header_places(stream, p)]
    notes = [n for s in places if (n := GM.note(stream, key, s))]
    assert len(places) >= 5 and len(notes) >= 4
    units = GM.chain(key, stream.size, notes, 1)
    assert [u[1] for u in units][0] == 0 and len(units) == 3


def test_scan_split_gzip_refuses_a_cut_stream(spark, tmp_dir):
    folder = _byte_split_corpus(tmp_dir, "cut", [f"line {i}" for i in range(5000)], 997)
    os.remove(os.path.join(folder, sorted(os.listdir(folder))[-1]))
    with pytest.raises(Exception, match="missing or cut"):
        FS.scan_split_gzip(spark, folder).count()
    other = os.path.join(tmp_dir, "plain")
    os.makedirs(other)
    with open(os.path.join(other, "a.txt.gz"), "wb") as fh:
        fh.write(b"not gzip at all")
    with pytest.raises(Exception, match="no gzip member"):
        FS.scan_split_gzip(spark, other).count()


def test_scan_split_gzip_keeps_equal_folder_names_apart(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "a")), os.makedirs(os.path.join(tmp_dir, "b"))
    folders = [_byte_split_corpus(os.path.join(tmp_dir, d), "train", [f"{d}1", f"{d}2"], 9) for d in "ab"]
    got = sorted((r.folder.rsplit("/", 2)[1], r.corpus, r.position, r.text) for r in FS.scan_split_gzip(spark, folders).collect())
    assert got == [("a", "train", 0, "a1"), ("a", "train", 1, "a2"), ("b", "train", 0, "b1"), ("b", "train", 1, "b2")]
    files = {r.row_order.file for d in folders for r in FS.scan_local_dispatch(spark, d).collect()}
    assert len(files) == 2


def test_write_text_files_names_folders_as_partition_by(spark, tmp_dir):
    rows = spark.createDataFrame([("a:b%", "x\r\ny"), (None, None), ("", "é"), ("c", "z")], "source string, text string")
    rows.write.partitionBy("source").text(os.path.join(tmp_dir, "plain"))
    out = os.path.join(tmp_dir, "out")
    FS.write_text_files(rows.select(FS.partition_folder("source", rows.source).alias("folder"), "text"), out)
    plain = {n for n in os.listdir(os.path.join(tmp_dir, "plain")) if n.startswith("source=")}
    assert set(os.listdir(out)) == plain
    texts = sorted(open(os.path.join(d, n), "rb").read() for d, _, names in os.walk(out) for n in names)
    assert texts == sorted([b"x\r\ny\n", b"\n", "é\n".encode(), b"z\n"])


def test_scan_text_files_query_has_one_file_a_document(spark, tmp_dir):
    from corpusmill.plans.q_sources import q_scan_text_files

    rows = [(i, "src0", f"texte {i}\r\nfin") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    assert sorted(r.text for r in q_scan_text_files(spark, tmp_dir).collect()) == sorted(f"texte {i}\nfin\n" for i in range(20))


def _spark_scan(spark, path):
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt")
    return sorted((r.file_path, r.value.replace("\r\n", "\n")) for r in raw.select("_metadata.file_path", "value").collect())


def test_text_files_are_listed_and_read_by_tasks(spark, tmp_dir):
    """The driver's plan has no entry of a text file; rows and names are those of Spark's own scan."""
    names = ["a b.txt", "é.txt", "p%q.txt", "x\u00a0y.txt", "h#[1].txt", "e=?;,&+@!$'()*~.txt", '"<>^`{|}.txt', "tab\t.txt", "\U0001f600.txt", "_a=b.txt", "_hid.txt", ".hid.txt", "y.TXT", "z.txt.gz"]
    for folder in ("", "sub dir", "_hidden", ".dot", "_k=v", "deep/er/é", "source=a%3Ab", "x.txt", "none"):
        os.makedirs(os.path.join(tmp_dir, folder), exist_ok=True)
        for n in names if folder != "none" else []:
            with open(os.path.join(tmp_dir, folder, n), "wb") as fh:
                fh.write(f"{folder}|{n}\r\nfin".encode())
    open(os.path.join(tmp_dir, "empty.txt"), "wb").close()
    os.symlink(os.path.join(tmp_dir, "deep"), os.path.join(tmp_dir, "link"))
    os.symlink(os.path.join(tmp_dir, "nowhere"), os.path.join(tmp_dir, "broken.txt"))
    for path in (tmp_dir, f"file://{tmp_dir}/deep/", f"{tmp_dir}/{{deep,deep/er,sub*}}", f"{tmp_dir}/é.txt", f"{tmp_dir}/_hid.txt", f"{tmp_dir}/none"):
        files = FS.scan_text_files(spark, path)
        assert not [f for f in files.inputFiles() if f.endswith(".txt")], path
        assert sorted((r.file_path, r.text) for r in files.collect()) == _spark_scan(spark, path), path
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        FS.scan_text_files(spark, os.path.join(tmp_dir, "missing"))


def test_text_files_of_many_tasks_and_large_files(spark, tmp_dir):
    """More files than a task's, and files that fill a batch of rows alone."""
    texts = {f"{i}.txt": f"texte {i}\n" for i in range(300)} | {f"big{i}.txt": f"{i}" * (3 << 20) for i in range(4)}
    for n, t in texts.items():
        with open(os.path.join(tmp_dir, n), "w") as fh:
            fh.write(t)
    files = FS.scan_text_files(spark, tmp_dir)
    assert 1 < files.rdd.getNumPartitions() <= TF.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert {r.file_path.rsplit("/", 1)[1]: r.text for r in files.collect()} == texts


def test_many_units_share_tasks(spark, tmp_dir):
    most = GM.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    folder = os.path.join(tmp_dir, "corpus")
    os.makedirs(folder)
    with open(os.path.join(folder, "p0.txt.gz"), "wb") as fh:
        fh.write(b"".join(gzip.compress(f"ligne {i}\n".encode()) for i in range(most + 40)))
    df = FS.scan_split_gzip(spark, folder, unit_bytes=1)
    assert df.rdd.getNumPartitions() <= most
    assert [(r.position, r.text) for r in df.orderBy("position").collect()] == [(i, f"ligne {i}") for i in range(most + 40)]
