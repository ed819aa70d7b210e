"""Source catalog.

The catalog is a small table (one row per source) read from YAML or built from a
list of dicts; its size is bounded by the file it comes from, so it is the one
thing we collect to the driver (to fan out its loads into one lazy plan).

A source's place in the catalog file is kept in ``position``. It leads the row order of the corpus, so the source
that the catalog names first keeps a text that several sources have, and it is the same for any selection of
sources: a build of one source or of the commercial ones gives its rows the order keys that a full build does.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..schema import CATALOG_SCHEMA, FINE_TUNING, INSTRUCTION_TUNING, check_adaptation_type

CATALOG_FIELDS = [f.name for f in CATALOG_SCHEMA]


def _as_list(v) -> list[str | None]:
    """Scalar-or-list catalog field -> list (a missing value is one ``None`` entry)."""
    if isinstance(v, (list, tuple)):
        return [None if x is None else str(x) for x in v]
    return [None if v is None else str(v)]


def normalise_entry(entry: dict, position: int = 0) -> dict:
    return {
        "source": str(entry["source"]),
        "path": entry.get("path"),
        "data_dir": _as_list(entry.get("data_dir")),
        "source_split": _as_list(entry.get("source_split")),
        "target_split": entry.get("target_split"),
        "adaptation_type": check_adaptation_type(entry.get("adaptation_type", FINE_TUNING)),
        "commercial_use": bool(entry.get("commercial_use", False)),
        "comment": entry.get("comment"),
        "position": int(entry.get("position", position)),
    }


def normalise_entries(entries: Iterable[dict]) -> list[dict]:
    """Entries in their given order; a source or a position that occurs twice is an error."""
    rows = [normalise_entry(e, i) for i, e in enumerate(entries)]
    for key in ("source", "position"):
        twice = [v for v, n in Counter(r[key] for r in rows).items() if n > 1]
        if twice:
            raise ValueError(f"catalog entries share the {key} {twice[0]!r}")
    return rows


def read_catalog_entries(path: str) -> list[dict]:
    """Entries of a YAML catalog file (``datasets:`` list)."""
    import yaml

    with open(path, encoding="utf-8") as fh:
        doc = yaml.safe_load(fh)
    entries = doc["datasets"] if isinstance(doc, dict) else doc
    if isinstance(entries, dict):
        entries = [entries]
    return normalise_entries(entries)


def catalog_frame(spark: SparkSession, entries: Iterable[dict]) -> DataFrame:
    rows = normalise_entries(entries)
    return spark.createDataFrame([tuple(r[f] for f in CATALOG_FIELDS) for r in rows], CATALOG_SCHEMA)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return catalog_frame(spark, read_catalog_entries(path))


# --- S1 ---------------------------------------------------------------------
def catalog_select(catalog: DataFrame, source: str | None = None) -> DataFrame:
    """Keep one named source, or all when ``source`` is None; error on an unknown name or an empty result."""
    out = catalog if source is None else catalog.where(F.col("source") == source)
    if out.limit(1).count() == 0:
        if source is not None:
            raise ValueError(f"the catalog has no source {source!r}")
        raise RuntimeError("the catalog is empty")
    return out


# --- S2 ---------------------------------------------------------------------
def license_catalog(catalog: DataFrame, make_commercial: bool) -> DataFrame:
    """Commercial build keeps ``commercial_use`` sources only; research build keeps all."""
    out = catalog.where(F.col("commercial_use")) if make_commercial else catalog
    if out.limit(1).count() == 0:
        raise RuntimeError("none of the selected sources may be used commercially")
    return out


def license_filter(corpus: DataFrame, catalog: DataFrame, make_commercial: bool) -> DataFrame:
    """Corpus rows of the sources the build may use (left-semi join on ``source``).

    With a corpus written ``partitionBy('source')`` the semi-join becomes dynamic partition pruning.
    """
    if not make_commercial:
        return corpus
    return join_small(corpus, catalog.where(F.col("commercial_use")).select("source"), "source", "left_semi")


def catalog_from_corpus(
    corpus: DataFrame, source: str = "source", subset: str | None = None, instruction: str | None = None, place: Column | None = None
) -> DataFrame:
    """A stand-in catalog derived from a corpus: one entry per distinct source.

    ``commercial_use`` is a deterministic flag from the name (first hex digit of its md5 below ``c``),
    ``data_dir`` the sorted distinct ``subset`` values when given, ``adaptation_type`` instruction-tuning
    for sources whose rows carry an ``instruction``. Entries are placed in order of ``place`` (an expression over
    the new catalog; the source's name by default).
    """
    dirs = F.array_sort(F.collect_set(F.col(subset))) if subset else F.array(F.lit(None).cast("string"))
    has_instr = F.max(F.col(instruction).isNotNull()) if instruction else F.lit(False)
    agg = corpus.groupBy(F.col(source).alias("source")).agg(dirs.alias("data_dir"), has_instr.alias("__instr"))
    return agg.select(
        "source",
        F.concat(F.lit("datasets/"), F.col("source")).alias("path"),
        "data_dir",
        F.array(F.lit("train")).alias("source_split"),
        F.lit("train").alias("target_split"),
        F.when(F.col("__instr"), F.lit(INSTRUCTION_TUNING)).otherwise(F.lit(FINE_TUNING)).alias("adaptation_type"),
        (F.substring(F.md5(F.col("source")), 1, 1) < F.lit("c")).alias("commercial_use"),
        F.concat(F.lit("Stand-in entry for "), F.col("source")).alias("comment"),
        (F.row_number().over(Window.orderBy(place if place is not None else F.col("source"))) - 1).alias("position"),  # one row a source
    )


# --- S13 / S8 -----------------------------------------------------------------
Loader = Callable[..., DataFrame]


class SourceRegistry(dict):
    """Catalog ``source`` name -> loader ``(spark, entry, data_dir, split) -> canonical DataFrame``."""

    def register(self, name: str):
        def deco(fn: Loader) -> Loader:
            self[name] = fn
            return fn

        return deco

    def loader(self, name: str) -> Loader:
        if name not in self:
            raise KeyError(f"No loader registered for source {name!r}")
        return self[name]


def _position(part: DataFrame):
    """A loader's ``row_order`` as (file, pos): a bare number is a position in an unnamed file."""
    from pyspark.sql.types import StructType

    t = part.schema["row_order"].dataType
    if isinstance(t, StructType):
        return [F.col("row_order.file").cast("string").alias("file"), F.col("row_order.pos").cast("bigint").alias("pos")]
    return [F.lit(None).cast("string").alias("file"), F.col("row_order").cast("bigint").alias("pos")]


@dataclass(frozen=True, eq=False)
class SharedInput:
    """A loader for sources that lie in one table: ``read(spark)`` gives canonical rows (P1) with a ``row_order``.

    Entries that are registered with the same object are read by a single scan. A rule table (one row per
    catalog entry, data_dir and split) says which rows belong to which entry: ``source`` must be equal, and
    ``data_dir`` and ``source_split`` too where the entry names one.
    """

    read: Callable[[SparkSession], DataFrame]


RULES = "source string, source_rank int, data_dir string, data_dir_rank int, source_split string, split_rank int"


def _rules(entries: list[dict]) -> list[tuple]:
    return [
        (e["source"], e["position"], data_dir, d, split, s)
        for e in entries
        for d, data_dir in enumerate(e["data_dir"] or [None])
        for s, split in enumerate(e["source_split"] or [None])
    ]


def _order(part: DataFrame, *ranks: Column) -> Column:
    names = ("source_rank", "data_dir_rank", "split_rank")
    return F.struct(*[r.cast("int").alias(n) for r, n in zip(ranks, names)], *_position(part))


def _load_shared(spark: SparkSession, shared: SharedInput, entries: list[dict]) -> DataFrame:
    rows = shared.read(spark)
    rules = spark.createDataFrame(_rules(entries), RULES).select(*[F.col(c.split()[0]).alias("__" + c.split()[0]) for c in RULES.split(", ")])
    # the rules are the collected catalog itself, so their size is that of its file
    matched = rows.join(
        F.broadcast(rules),
        (F.col("source") == F.col("__source"))
        & (F.col("__data_dir").isNull() | (F.col("data_dir") == F.col("__data_dir")))
        & (F.col("__source_split").isNull() | (F.col("source_split") == F.col("__source_split"))),
    )
    ordered = matched.withColumn("row_order", _order(rows, F.col("__source_rank"), F.col("__data_dir_rank"), F.col("__split_rank")))
    return ordered.select(*rows.columns)


def ingest_fanout(
    spark: SparkSession,
    catalog: DataFrame,
    registry: SourceRegistry,
    per_kind: Callable[[DataFrame, str, list[str]], DataFrame] | None = None,
) -> DataFrame:
    """Load every catalog entry x data_dir x source_split and union them, in the catalog's order.

    The catalog (bounded metadata) is collected; every load stays a lazy plan, so the whole fan-out is one Spark
    job, and sources of one ``SharedInput`` are one scan. ``row_order`` becomes (source_rank, data_dir_rank,
    split_rank, file, pos), where ``source_rank`` is the entry's place in the whole catalog. ``per_kind`` is applied
    once to the rows of each adaptation type, with the names of their sources (e.g. T18 and F1/F2).
    """
    entries = [r.asDict() for r in catalog.orderBy("position").collect()]  # bounded: one row per catalog entry
    if not entries:
        raise RuntimeError("the catalog selects nothing to load")
    per: list[DataFrame] = []
    for kind in sorted({e["adaptation_type"] for e in entries}):
        mine = [e for e in entries if e["adaptation_type"] == kind]
        parts: list[DataFrame] = []
        shared: dict[SharedInput, list[dict]] = {}
        for entry in mine:
            load = registry.loader(entry["source"])
            if isinstance(load, SharedInput):
                shared.setdefault(load, []).append(entry)
                continue
            for _, rank, data_dir, d_rank, split, s_rank in _rules([entry]):
                part = load(spark, entry, data_dir, split)
                parts.append(part.withColumn("row_order", _order(part, F.lit(rank), F.lit(d_rank), F.lit(s_rank))))
        parts += [_load_shared(spark, load, of) for load, of in shared.items()]
        merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), parts)
        per.append(per_kind(merged, kind, [e["source"] for e in mine]) if per_kind else merged)
    return reduce(DataFrame.unionByName, per)
