"""Registered category-graph queries (G1-G4) on region -> nation -> supplier/customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import categories as G
from ..session import write_table
from .registry import register
from .tables import table

# Subcategories of the roots skipped at level 0 (a parameter, like the reference's ignore lists).
IGNORED = ["NATION_3", "NATION_7"]


def graph(spark, sf_dir):
    """Edges: region -> nation (category); nation -> supplier, customer (pages); nation -> segment
    (category) -> customer (page, two levels down); a customer is also listed under the nation of
    the supplier with the same key (so some pages sit under two roots)."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    customer = table(spark, sf_dir, "customer")
    nat = nation.select("n_nationkey", "n_name", "n_regionkey")
    e1 = region.join(nat, region["r_regionkey"] == nat["n_regionkey"]).select(
        F.col("r_name").alias("parent"), F.col("n_name").alias("child"), F.lit(True).alias("is_category")
    )
    e2 = supplier.join(nat, supplier["s_nationkey"] == nat["n_nationkey"]).select(
        F.col("n_name").alias("parent"), F.col("s_name").alias("child"), F.lit(False).alias("is_category")
    )
    e3 = customer.join(nat, customer["c_nationkey"] == nat["n_nationkey"]).select(
        F.col("n_name").alias("parent"), F.col("c_name").alias("child"), F.lit(False).alias("is_category")
    )
    seg = customer.join(nat, customer["c_nationkey"] == nat["n_nationkey"]).select(
        "n_name", F.concat(F.col("n_name"), F.lit("/"), F.col("c_mktsegment")).alias("seg"), "c_name"
    )
    e4 = seg.select(F.col("n_name").alias("parent"), F.col("seg").alias("child"), F.lit(True).alias("is_category")).distinct()
    e5 = seg.select(F.col("seg").alias("parent"), F.col("c_name").alias("child"), F.lit(False).alias("is_category"))
    cross = customer.join(supplier, customer["c_custkey"] == supplier["s_suppkey"]).join(
        nat, supplier["s_nationkey"] == nat["n_nationkey"]
    )
    e6 = cross.select(F.col("n_name").alias("parent"), F.col("c_name").alias("child"), F.lit(False).alias("is_category"))
    edges = e1.unionByName(e2).unionByName(e3).unionByName(e4).unionByName(e5).unionByName(e6)
    roots = region.select(F.col("r_name").alias("root"), F.col("r_regionkey").alias("root_rank"))
    pages = supplier.select(
        F.col("s_name").alias("title"),
        F.concat(F.col("s_name"), F.lit(" nation "), F.col("s_nationkey").cast("string")).alias("text"),
    ).unionByName(
        customer.select(
            F.col("c_name").alias("title"), F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment")).alias("text")
        )
    )
    ignore = spark.createDataFrame([(n,) for n in IGNORED], "name string")
    return edges, roots, pages, ignore


EDGES_SQL = """
SELECT r_name AS parent, n_name AS child, true AS is_category FROM region JOIN nation ON r_regionkey = n_regionkey
UNION ALL SELECT n_name, s_name, false FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT n_name, c_name, false FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT DISTINCT n_name, n_name || '/' || c_mktsegment, true FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT n_name || '/' || c_mktsegment, c_name, false FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT n_name, c_name, false FROM customer JOIN supplier ON c_custkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""

IGNORED_SQL = ", ".join(f"'{n}'" for n in IGNORED)

EXPAND_SQL = f"""
WITH e AS ({EDGES_SQL}),
r AS (SELECT r_name AS root, r_regionkey AS root_rank FROM region),
l0 AS (SELECT r.root, r.root_rank, e.child, e.is_category FROM r JOIN e ON e.parent = r.root),
c1 AS (SELECT root, root_rank, child AS cat FROM l0 WHERE is_category AND child NOT IN ({IGNORED_SQL})),
l1 AS (SELECT c1.root, c1.root_rank, e.child, e.is_category FROM c1 JOIN e ON e.parent = c1.cat)
SELECT root, root_rank, 0 AS level, child AS title FROM l0 WHERE NOT is_category
UNION ALL SELECT root, root_rank, 1 AS level, child AS title FROM l1 WHERE NOT is_category"""

FIRST_WINS_SQL = f"""SELECT title, arg_min(root, root_rank) AS root, min(root_rank) AS root_rank
FROM (SELECT DISTINCT root, root_rank, title FROM ({EXPAND_SQL}) AS x) AS d GROUP BY title"""

PAGES_SQL = """SELECT s_name AS title, s_name || ' nation ' || CAST(s_nationkey AS VARCHAR) AS text FROM supplier
UNION ALL SELECT c_name, c_name || ' ' || c_mktsegment FROM customer"""

TEXTS_SQL = f"SELECT f.root AS subset, f.title, p.text FROM ({FIRST_WINS_SQL}) AS f JOIN ({PAGES_SQL}) AS p USING (title)"


def _expand(spark, sf_dir):
    edges, roots, pages, ignore = graph(spark, sf_dir)
    # the edge table is read once per level: materialise it once (a written intermediate table)
    edges = write_table(edges, "category-edges")
    return G.category_expand(edges, roots, ignore, max_level=1), pages


@register("category_expand", "G1", EXPAND_SQL)
def q_category_expand(spark, sf_dir):
    titles, _ = _expand(spark, sf_dir)
    return titles.select("root", F.col("root_rank").cast("int").alias("root_rank"), F.col("level").cast("int").alias("level"), "title")


@register("category_distinct", "G2", f"SELECT DISTINCT root, root_rank, title FROM ({EXPAND_SQL}) AS x")
def q_category_distinct(spark, sf_dir):
    titles, _ = _expand(spark, sf_dir)
    return G.category_distinct(titles)


@register("category_first_wins", "G3", FIRST_WINS_SQL)
def q_category_first_wins(spark, sf_dir):
    titles, _ = _expand(spark, sf_dir)
    return G.category_first_wins(G.category_distinct(titles))


@register("category_texts", "G4", TEXTS_SQL)
def q_category_texts(spark, sf_dir):
    titles, pages = _expand(spark, sf_dir)
    return G.category_texts(G.category_first_wins(G.category_distinct(titles)), pages)


@register(
    "category_counts",
    "G4",
    f"""SELECT coalesce(subset, 'Total') AS subset, count(*)::BIGINT AS nb_pages FROM ({TEXTS_SQL}) AS t
GROUP BY ROLLUP (subset)""",
)
def q_category_counts(spark, sf_dir):
    titles, pages = _expand(spark, sf_dir)
    return G.category_counts(G.category_texts(G.category_first_wins(G.category_distinct(titles)), pages))


# --- depth 5 over a graph with cycles and diamonds ---------------------------------------
#: Segments lead on to two regions: the next one (a cycle over all of them) and the one after (diamonds).
DEEP_EDGES_SQL = f"""{EDGES_SQL}
UNION ALL SELECT DISTINCT n_name || '/' || c_mktsegment, r_name, true FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON r_regionkey = (n_regionkey + 1) % 5 OR r_regionkey = (n_regionkey + 2) % 5"""

DEEP_SQL = f"""
WITH RECURSIVE e AS ({DEEP_EDGES_SQL}),
walk(root, root_rank, cat, level) AS (
  SELECT r_name, r_regionkey, r_name, 0 FROM region
  UNION
  SELECT w.root, w.root_rank, e.child, w.level + 1 FROM walk AS w JOIN e ON e.parent = w.cat
  WHERE e.is_category AND w.level < 5 AND NOT (w.level = 0 AND e.child IN ({IGNORED_SQL}))
),
entered AS (SELECT root, root_rank, cat, min(level) AS level FROM walk GROUP BY root, root_rank, cat)
SELECT n.root, n.root_rank, n.level, e.child AS title FROM entered AS n JOIN e ON e.parent = n.cat WHERE NOT e.is_category"""


@register("category_expand_deep", "G1", DEEP_SQL)
def q_category_expand_deep(spark, sf_dir):
    edges, roots, _, ignore = graph(spark, sf_dir)
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    seg = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        F.concat("n_name", F.lit("/"), "c_mktsegment").alias("parent"), F.explode(F.array((F.col("n_regionkey") + 1) % 5, (F.col("n_regionkey") + 2) % 5)).alias("to")
    )
    on = seg.distinct().join(region, F.col("to") == region["r_regionkey"]).select("parent", F.col("r_name").alias("child"), F.lit(True).alias("is_category"))
    edges = write_table(edges.unionByName(on), "category-edges")
    titles = G.category_expand(edges, roots, ignore, max_level=5)
    return titles.select("root", F.col("root_rank").cast("int").alias("root_rank"), F.col("level").cast("int").alias("level"), "title")
