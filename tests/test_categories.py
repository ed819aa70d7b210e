"""Category-graph expansion semantics."""

from corpusmill.operators import categories as G


def _graph(spark):
    edges = [
        ("Med", "CatA", True),
        ("Med", "CatIgn", True),
        ("Med", "p0", False),
        ("CatA", "p1", False),
        ("CatA", "CatDeep", True),
        ("CatDeep", "p_deep", False),
        ("CatIgn", "p_ign", False),
        ("Bio", "CatB", True),
        ("CatB", "p1", False),
        ("CatB", "CatIgn", True),
        ("CatB", "p2", False),
    ]
    e = spark.createDataFrame(edges, "parent string, child string, is_category boolean")
    roots = spark.createDataFrame([("Med", 0), ("Bio", 1)], "root string, root_rank int")
    ignore = spark.createDataFrame([("CatIgn",)], "name string")
    return e, roots, ignore


def test_expand_levels_and_ignore_at_level_zero(spark):
    e, roots, ignore = _graph(spark)
    titles = G.category_expand(e, roots, ignore, max_level=1)
    got = sorted((r.root, r.title) for r in G.category_distinct(titles).collect())
    # CatIgn skipped under Med (level 0); CatB's CatIgn is at level 1 and not entered anyway; CatDeep is too deep
    assert got == [("Bio", "p1"), ("Bio", "p2"), ("Med", "p0"), ("Med", "p1")]


def test_first_root_wins_and_counts(spark):
    e, roots, ignore = _graph(spark)
    titles = G.category_distinct(G.category_expand(e, roots, ignore))
    first = {r.title: r.root for r in G.category_first_wins(titles).collect()}
    assert first == {"p0": "Med", "p1": "Med", "p2": "Bio"}
    pages = spark.createDataFrame([("p0", "t0"), ("p1", "t1"), ("p2", "t2")], "title string, text string")
    texts = G.category_texts(G.category_first_wins(titles), pages)
    counts = {r.subset: r.nb_pages for r in G.category_counts(texts).collect()}
    assert counts == {"Med": 2, "Bio": 1, "Total": 3}


def test_extract_job_writes_and_fails_when_empty(spark, tmp_dir):
    import pytest

    e, roots, ignore = _graph(spark)
    titles = G.category_first_wins(G.category_distinct(G.category_expand(e, roots, ignore)))
    pages = spark.createDataFrame([("p0", "t0"), ("p2", "t2")], "title string, text string")
    out = G.extract_category_texts(titles, pages, tmp_dir + "/wiki")
    assert sorted((r.subset, r.text) for r in out.collect()) == [("Bio", "t2"), ("Med", "t0")]
    none = spark.createDataFrame([("zz", "t")], "title string, text string")
    with pytest.raises(ValueError):
        G.extract_category_texts(titles, none, tmp_dir + "/wiki2")


def test_ignore_all_levels_and_deeper(spark):
    e, roots, ignore = _graph(spark)
    titles = G.category_expand(e, roots, ignore, max_level=2, ignore_all_levels=True)
    got = sorted({(r.root, r.title) for r in titles.collect()})
    assert ("Med", "p_deep") in got and ("Bio", "p_ign") not in got


def _brute_expand(edges, roots, ignore, max_level):
    """(root, level, title) per edge of every category, entered at its lowest level."""
    out = []
    for root in roots:
        level_of, frontier = {root: 0}, [root]
        for level in range(max_level + 1):
            found = [(p, c, k) for cat in frontier for p, c, k in edges if p == cat]
            out += [(root, level, c) for _, c, k in found if not k]
            frontier = []
            for _, c, k in found:
                if k and c not in level_of and not (level == 0 and c in ignore):
                    level_of[c] = level + 1
                    frontier.append(c)
    return sorted(out)


def test_diamonds_cycles_and_depth(spark):
    import random

    chain = [(f"c{i}", f"c{i + 1}", True) for i in range(8)] + [(f"c{i}", f"p{i}", False) for i in range(9)]
    diamond = [("c0", "x1", True), ("c0", "x2", True), ("x1", "y", True), ("x2", "y", True), ("y", "py", False), ("y", "py", False), ("y", "c0", True), ("c3", "c0", True), ("c4", "c4", True)]
    rng = random.Random(3)
    dense = [(f"d{rng.randint(0, 11)}", f"d{rng.randint(0, 11)}", True) for _ in range(60)] + [(f"d{i}", f"q{i % 5}", False) for i in range(12)]
    schema = "parent string, child string, is_category boolean"
    for edges, roots in ((chain + diamond, ["c0", "c2"]), (dense, ["d0", "d5", "d7"])):
        e = spark.createDataFrame(edges, schema)
        r = spark.createDataFrame([(n, i) for i, n in enumerate(roots)], "root string, root_rank int")
        ignore = spark.createDataFrame([("x2",), ("d3",)], "name string")
        for depth in (0, 1, 5):
            got = sorted((x.root, x.level, x.title) for x in G.category_expand(e, r, ignore, max_level=depth).collect())
            assert got == _brute_expand(edges, roots, {"x2", "d3"}, depth), depth
    assert G.category_expand(e, r.where("false"), None, 3).count() == 0
