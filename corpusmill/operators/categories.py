"""Category-graph operators (G1-G4), re-aimed from an encyclopaedia crawler onto tables.

The graph is an edge table ``(parent, child, is_category)`` and a page table
``(title, text)``. Expansion is breadth-first, one equi-join a level over a written frontier, never a recursive
walk on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_table

DEFAULT_MAX_LEVEL = 1


def category_expand(
    edges: DataFrame,
    roots: DataFrame,
    ignore: DataFrame | None = None,
    max_level: int = DEFAULT_MAX_LEVEL,
    ignore_all_levels: bool = False,
) -> DataFrame:
    """G1: page titles below each root ``(root, root_rank, level, title)``.

    Pages of every visited category are collected; subcategories are entered while
    ``level < max_level``. The ignore list (column ``name``) skips subcategories of the
    roots only, unless ``ignore_all_levels``.

    A root enters a category once, at its lowest level, however many paths lead to it, so cycles end and diamonds
    do not multiply rows. A category's own edges are returned as often as they are listed. Each level writes the
    categories it enters and the members it finds; the walk stops when there is nothing new to enter.
    """
    frontier = write_table(roots.select("root", "root_rank", F.col("root").alias("cat")).distinct(), "category-frontier")
    visited = frontier.select("root", "cat")
    hits: list[DataFrame] = []
    for level in range(max_level + 1):
        members = frontier.join(edges, frontier["cat"] == edges["parent"], "inner").select("root", "root_rank", "child", "is_category")
        members = write_table(members, "category-members")
        hits.append(
            members.where(~F.col("is_category")).select(
                "root", "root_rank", F.lit(level).alias("level"), F.col("child").alias("title")
            )
        )
        if level == max_level:
            break
        sub = members.where("is_category").select("root", "root_rank", F.col("child").alias("cat")).distinct()
        if ignore is not None and (level == 0 or ignore_all_levels):
            sub = sub.join(ignore, sub["cat"] == ignore["name"], "left_anti")
        frontier = write_table(sub.join(visited, ["root", "cat"], "left_anti").select("root", "root_rank", "cat"), "category-frontier")
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier.select("root", "cat"))
    return reduce(DataFrame.unionByName, hits)


def category_distinct(titles: DataFrame) -> DataFrame:
    """Distinct titles per root."""
    return titles.select("root", "root_rank", "title").distinct()


def category_first_wins(titles: DataFrame) -> DataFrame:
    """A title found under several roots stays with the first root in list order."""
    return titles.groupBy("title").agg(
        F.min_by("root", "root_rank").alias("root"), F.min("root_rank").alias("root_rank")
    )


def category_texts(titles: DataFrame, pages: DataFrame) -> DataFrame:
    """``(subset, title, text)`` rows, the subset being the root."""
    return titles.join(pages, "title", "inner").select(F.col("root").alias("subset"), "title", "text")


def extract_category_texts(titles: DataFrame, pages: DataFrame, out_path: str) -> DataFrame:
    """G4 as a job: write ``(subset, text)`` as Parquet, then fail when nothing matched (checked on the
    written table, so the join runs once)."""
    category_texts(titles, pages).select("subset", "text").write.mode("overwrite").parquet(out_path)
    written = titles.sparkSession.read.parquet(out_path)
    if written.isEmpty():
        raise ValueError("no page belongs to any of the given categories")
    return written


def category_counts(texts: DataFrame) -> DataFrame:
    """Pages per root and in total (``rollup``), total labelled ``Total``."""
    return (
        texts.rollup("subset")
        .agg(F.count(F.lit(1)).cast("bigint").alias("nb_pages"))
        .select(F.coalesce(F.col("subset"), F.lit("Total")).alias("subset"), "nb_pages")
    )
