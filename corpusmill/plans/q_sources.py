"""Registered source/sink queries (S1-S13, F3): catalog work and file round trips.

File round trips write the driver's tables into a fresh folder below the shared
checkpoint directory and read them back with the source under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup as D
from ..operators import filters as FL
from ..operators import reshape as R
from ..operators import stats as ST
from ..oracle import stats_sql as SS
from ..oracle import text_sql as S
from ..schema import INSTRUCTION_TUNING, ORDER
from ..session import staging_path, write_table
from ..sources import catalog as C
from ..sources import files as FS
from . import standins as SI
from .q_stats import round_stats
from .registry import register
from .tables import table

COMMERCIAL_SQL = "substr(md5(source), 1, 1) < 'c'"


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _canon(spark, sf_dir):
    return R.canonical_projection(_docs(spark, sf_dir), F.col("source"), None, "train", "text", order="doc_id")


def _catalog(spark, sf_dir):
    return C.catalog_from_corpus(_docs(spark, sf_dir), subset="lang")


@register(
    "catalog_select",
    "S1",
    f"""SELECT source, 'datasets/' || source AS path, array_to_string(list_sort(list(DISTINCT lang)), ',') AS data_dir,
  'train' AS source_split, 'fine-tuning' AS adaptation_type, {COMMERCIAL_SQL} AS commercial_use
FROM documents WHERE source = 'src3' GROUP BY source""",
)
def q_catalog_select(spark, sf_dir):
    c = C.catalog_select(_catalog(spark, sf_dir), "src3")
    return c.select(
        "source",
        "path",
        F.array_join("data_dir", ",").alias("data_dir"),
        F.array_join("source_split", ",").alias("source_split"),
        "adaptation_type",
        "commercial_use",
    )


@register("license_filter", "S2", f"SELECT * FROM documents WHERE {COMMERCIAL_SQL}")
def q_license_filter(spark, sf_dir):
    cat = C.license_catalog(_catalog(spark, sf_dir), make_commercial=True)
    return C.license_filter(_docs(spark, sf_dir), cat, make_commercial=True)


def _mixed_corpus(spark, sf_dir) -> DataFrame:
    """Fine-tuning documents plus an instruction-tuning question bank, as one sourced corpus."""
    mcq = R.instruction_rows(R.mcq_prompt_array(SI.mcq_bank(spark, sf_dir)), "FRENCHMEDMCQA", None, "train", order="item_id")
    return _canon(spark, sf_dir).unionByName(mcq)


def _instruction_sql():
    from .q_reshape import _mcq_sql

    return (
        "SELECT instruction, input, output, 'FRENCHMEDMCQA' AS source, NULL::VARCHAR AS data_dir, 'train' AS source_split, "
        f"item_id AS row_order FROM ({_mcq_sql()}) AS m"
    )


@register("filter_adaptation_type", "F3", _instruction_sql)
def q_filter_adaptation_type(spark, sf_dir):
    corpus = _mixed_corpus(spark, sf_dir)
    catalog = C.catalog_from_corpus(corpus, instruction="instruction")
    return FL.filter_adaptation_type(corpus, catalog, INSTRUCTION_TUNING)


# --- file round trips ------------------------------------------------------------------
#: Documents of a staged text file of the dispatch, and of a staged gzip member; bytes of a staged gzip part.
FILE_DOCS, MEMBER_DOCS, PART_BYTES = 16, 64, 100_000


def stage_documents(spark, sf_dir) -> str:
    """``documents`` as ``.txt`` files, one a document, in a folder a task."""
    path = staging_path(spark, "documents")
    FS.write_text_files(_docs(spark, sf_dir).select(_task_folder(), "text"), path)
    return path


def _task_folder():
    return F.concat(F.lit("task="), F.spark_partition_id()).alias("folder")


def stage_text_files(spark, sf_dir) -> str:
    """``documents`` as ``.txt`` files of neighbouring ids, one document after the other, in a folder a task."""
    path = staging_path(spark, "text-files")
    d = _docs(spark, sf_dir).select(F.floor(F.col("doc_id") / FILE_DOCS).alias("file"), F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text")).alias("d"))
    files = d.groupBy("file").agg(F.array_join(F.array_sort(F.collect_list("d")).getField("text"), "\n").alias("text"))
    FS.write_text_files(files.select(_task_folder(), "text"), path)
    return path


def stage_gzip_corpora(spark, sf_dir, path: str | None = None, source: str | None = None) -> str:
    """``documents`` (of one source, if given) as one folder per source: gzip members of neighbouring ids, one after the other, cut every
    ``PART_BYTES`` bytes into parts without regard to members or lines."""
    import gzip

    import pandas as pd
    import pyarrow as pa

    path = path or staging_path(spark, "gzip-corpora")
    docs = _docs(spark, sf_dir)
    d = (docs if source is None else docs.where(F.col("source") == source)).select("source", F.floor(F.col("doc_id") / MEMBER_DOCS).alias("member"), "doc_id", "text")

    def pack(batches):
        """Rows in order of source, member and id; each member's rows become one row."""
        out, held, key, texts = ([], [], []), 0, None, []

        def close() -> int:
            for column, value in zip(out, (*key, gzip.compress("".join(t + "\n" for t in texts).encode("utf-8"), 6))):
                column.append(value)
            texts.clear()
            return len(out[2][-1])

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.binary()))], names=["source", "member", "data"])

        for b in batches:
            for source, member, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if texts and key != (source, member):
                    held += close()
                    if held > 4 << 20:
                        yield batch()
                        out, held = ([], [], []), 0
                key = (source, member)
                texts.append(text)
        if texts:
            close()
        yield batch()

    dealt = d.repartition("source", "member").sortWithinPartitions("source", "member", "doc_id").select("source", "member", "text")
    members = write_table(dealt.mapInArrow(pack, "source string, member long, data binary"), "gzip-members")
    before = Window.partitionBy("source").orderBy("member").rowsBetween(Window.unboundedPreceding, -1)
    at = members.select("source", "member", F.coalesce(F.sum(F.length("data")).over(before), F.lit(0)).alias("at"))
    placed = members.join(at, ["source", "member"])
    first, last = F.floor(F.col("at") / PART_BYTES), F.floor((F.col("at") + F.length("data") - 1) / PART_BYTES)
    pieces = placed.select("source", "at", "data", F.explode(F.sequence(first, last)).alias("part"))
    begin = F.greatest(F.col("part") * PART_BYTES - F.col("at"), F.lit(0))
    end = F.least((F.col("part") + 1) * PART_BYTES - F.col("at"), F.length("data"))
    pieces = pieces.select("source", "part", "at", F.substring(F.col("data"), begin + 1, end - begin).alias("data"))

    def save(rows: pd.DataFrame) -> pd.DataFrame:
        import pyarrow.fs as pfs

        source, part = rows["source"].iloc[0], int(rows["part"].iloc[0])
        fs, inner = pfs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
        fs.create_dir(f"{inner}/{source}", recursive=True)
        with fs.open_output_stream(f"{inner}/{source}/{source}_part_{part:06d}.txt.gz", compression=None) as out:
            out.write(b"".join(rows.sort_values("at")["data"]))
        return pd.DataFrame({"source": [source]})

    pieces.groupBy("source", "part").applyInPandas(save, "source string").write.format("noop").mode("overwrite").save()
    return path


TEXT_FILES_SQL = (
    "SELECT regexp_replace(string_agg(text, chr(10) ORDER BY doc_id) || chr(10), '\\r\\n?', chr(10), 'g') AS text "
    f"FROM documents GROUP BY doc_id // {FILE_DOCS}"
)
LINES_SQL = (
    "SELECT source AS corpus, unnest(ls) AS text, generate_subscripts(ls, 1) - 1 AS position FROM ("
    "SELECT source, string_split_regex(string_agg(text || chr(10), '' ORDER BY doc_id), '\\r\\n|\\r|\\n')[:-2] AS ls FROM documents GROUP BY source) AS c"
)


@register("scan_text_files", "S3", "SELECT regexp_replace(text || chr(10), '\\r\\n?', chr(10), 'g') AS text FROM documents")
def q_scan_text_files(spark, sf_dir):
    files = FS.scan_text_files(spark, stage_documents(spark, sf_dir))
    return files.select("text")


def _corpus_dirs(spark, root: str) -> list[str]:
    listing = FS.list_files(spark, root, "*.gz", recursive=True).select(
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir")
    )
    return sorted(r[0] for r in listing.distinct().collect())  # bounded: one entry per corpus


@register("scan_split_gzip", "S4+O2", f"SELECT corpus, corpus AS folder, position, text FROM ({LINES_SQL}) AS l")
def q_scan_split_gzip(spark, sf_dir):
    """Every corpus by several tasks (units of 256 kB at this scale), its lines numbered across members and parts."""
    root = stage_gzip_corpora(spark, sf_dir)
    lines = FS.scan_split_gzip(spark, _corpus_dirs(spark, root), unit_bytes=1 << 18)
    return lines.select("corpus", F.regexp_extract("folder", "([^/]*)$", 1).alias("folder"), "position", "text")


@register(
    "scan_local_dispatch",
    "S5",
    f"SELECT 'txt' AS kind, 0 AS position, text FROM ({TEXT_FILES_SQL}) AS t UNION ALL SELECT 'gz' AS kind, position, text FROM ({LINES_SQL}) AS g",
)
def q_scan_local_dispatch(spark, sf_dir):
    """A text-file folder and all gzip corpora, each loaded through the dispatch."""
    txt = FS.scan_local_dispatch(spark, stage_text_files(spark, sf_dir))
    gz = FS.scan_local_dispatch(spark, stage_gzip_corpora(spark, sf_dir))
    of = [d.select(F.lit(kind).alias("kind"), F.col(f"{ORDER}.pos").alias("position"), "text") for kind, d in (("txt", txt), ("gz", gz))]
    return of[0].unionByName(of[1])


@register("scan_parquet", "S6", f"SELECT doc_id, source, text FROM documents WHERE {COMMERCIAL_SQL}")
def q_scan_parquet(spark, sf_dir):
    root = staging_path(spark, "by-source")
    _docs(spark, sf_dir).select("doc_id", "text", "source").write.partitionBy("source").parquet(root)
    commercial = [r.source for r in C.license_catalog(_catalog(spark, sf_dir), True).select("source").collect()]
    paths = [f"{root}/source={s}" for s in sorted(commercial)]  # bounded: one path per catalog source
    df = FS.scan_parquet(spark, paths).withColumn("source", F.regexp_extract(F.col("_metadata.file_path"), r"source=([^/]+)", 1))
    return df.select("doc_id", "source", "text")


@register(
    "scan_remote_tables",
    "S7",
    "SELECT NULL::VARCHAR AS instruction, text AS input, NULL::VARCHAR AS output, source, NULL::VARCHAR AS data_dir, "
    "'train' AS source_split, doc_id AS row_order FROM documents",
)
def q_scan_remote_tables(spark, sf_dir):
    d = FS.read_table(spark, sf_dir, "documents.parquet")
    return R.canonical_projection(d, F.col("source"), None, "train", "text", order="doc_id")


#: The stand-in catalog's order: not that of the names.
PLACE_SQL = "row_number() OVER (ORDER BY md5(source || '#')) - 1"


def _placed_catalog(spark, sf_dir):
    return C.catalog_from_corpus(_docs(spark, sf_dir), subset="lang", place=F.md5(F.concat("source", F.lit("#"))))


def _ingested(spark, sf_dir, catalog):
    """All sources lie in one table, so one scan serves the whole catalog."""
    names = [r.source for r in catalog.select("source").collect()]  # bounded metadata
    read = C.SharedInput(lambda s: R.canonical_projection(_docs(s, sf_dir), F.col("source"), F.col("lang"), "train", "text", order="doc_id"))
    return C.ingest_fanout(spark, catalog, C.SourceRegistry({n: read for n in names}))


INGESTED_SQL = f"""SELECT d.source, c.source_rank, dense_rank() OVER (PARTITION BY d.source ORDER BY lang) - 1 AS data_dir_rank,
  0 AS split_rank, lang AS data_dir, 'train' AS source_split, doc_id, text AS input
FROM documents AS d JOIN (SELECT source, {PLACE_SQL} AS source_rank FROM (SELECT DISTINCT source FROM documents) AS s) AS c USING (source)"""


@register("ingest_fanout", "S8", INGESTED_SQL)
def q_ingest_fanout(spark, sf_dir):
    out = _ingested(spark, sf_dir, _placed_catalog(spark, sf_dir))
    ranks = [F.col(f"{ORDER}.{r}").cast("bigint").alias(r) for r in ("source_rank", "data_dir_rank", "split_rank")]
    return out.select("source", *ranks, "data_dir", "source_split", F.col(f"{ORDER}.pos").alias("doc_id"), "input")


@register(
    "ingest_catalog_order",
    "S8",
    f"""SELECT source, doc_id, input FROM ({INGESTED_SQL}) AS i
QUALIFY row_number() OVER (PARTITION BY input ORDER BY source_rank, data_dir_rank, split_rank, doc_id) = 1""",
)
def q_ingest_catalog_order(spark, sf_dir):
    """Of a text that several sources have, the source that comes first in the catalog keeps it."""
    rows = _ingested(spark, sf_dir, _placed_catalog(spark, sf_dir))
    return D.dedup_exact(rows, "input", ORDER, materialize=False).select("source", F.col(f"{ORDER}.pos").alias("doc_id"), "input")


@register(
    "source_registry",
    "S13",
    lambda: (
        "SELECT source, text AS input FROM documents UNION ALL "
        f"SELECT 'MQC' AS source, array_to_string({S.split_lines('text')}, ' ') AS input FROM ({SI.DIALOGUE_SQL}) AS f"
    ),
)
def q_source_registry(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    registry = C.SourceRegistry()

    @registry.register("DOCUMENTS")
    def _load_docs(spark_, entry, data_dir, split):
        return R.canonical_projection(docs, F.col("source"), data_dir, split, "text", order="doc_id")

    @registry.register("MQC")
    def _load_dialogues(spark_, entry, data_dir, split):
        f = SI.dialogue_files(spark_, sf_dir).withColumn("text", R.flatten_lines(F.col("text")))
        return R.canonical_projection(f, entry["source"], data_dir, split, "text", order="conv_id")

    catalog = C.catalog_frame(
        spark,
        [
            {"source": "DOCUMENTS", "path": sf_dir, "data_dir": None, "source_split": "train", "commercial_use": True},
            {"source": "MQC", "path": sf_dir, "data_dir": "French", "source_split": "train", "commercial_use": False},
        ],
    )
    return C.ingest_fanout(spark, catalog, registry).select("source", "input")


def _builds_sql():
    """The commercial corpus after its rebuilds, and the research corpus as first built."""
    cleaned = S.clean_text_select("SELECT source, doc_id, text FROM documents WHERE source = 'src0'", ["source", "doc_id"], "text", "input")
    return f"""SELECT 'commercial' AS licence, source, doc_id, text AS input FROM documents WHERE {COMMERCIAL_SQL} AND source NOT IN ('src0', 'src2')
UNION ALL SELECT 'commercial' AS licence, source, doc_id, input FROM ({cleaned}) AS c WHERE {COMMERCIAL_SQL}
UNION ALL SELECT 'research' AS licence, source, doc_id, text AS input FROM documents"""


@register("write_by_source", "S9", _builds_sql)
def q_write_by_source(spark, sf_dir):
    """A research build, a commercial build into the same root, a commercial rebuild of two sources, one of which
    (``src2``) has no rows any more; then both corpora as their manifests show them."""
    root = staging_path(spark, "sourced")
    docs = _docs(spark, sf_dir).select("doc_id", F.col("text").alias("input"), "source")
    commercial = C.license_filter(docs, C.license_catalog(_catalog(spark, sf_dir), True), True)
    FS.write_by_source(docs, root, make_commercial=False)
    FS.write_by_source(commercial, root, make_commercial=True)
    rebuilt = commercial.where(F.col("source") == "src0").withColumn("input", T.clean_text("input"))
    FS.write_by_source(rebuilt, root, make_commercial=True, sources=["src0", "src2"])
    both = [FS.read_by_source(spark, root, c).select(F.lit(n).alias("licence"), "source", "doc_id", "input") for n, c in (("commercial", True), ("research", False))]
    return both[0].unionByName(both[1])


@register("write_training_set", "S10", f"SELECT doc_id, text AS input FROM documents WHERE {COMMERCIAL_SQL}")
def q_write_training_set(spark, sf_dir):
    root = staging_path(spark, "training")
    cat = C.license_catalog(_catalog(spark, sf_dir), True)
    rows = C.license_filter(_docs(spark, sf_dir), cat, True).select("doc_id", F.col("text").alias("input"))
    path = FS.write_training_set(rows, root, make_commercial=True)
    return spark.read.parquet(path)


@register("write_stats_csv", "S11", lambda: SS.rounded(SS.per_label("SELECT source, text FROM documents", "text")))
def q_write_stats_csv(spark, sf_dir):
    path = staging_path(spark, "stats-csv")
    FS.write_stats_csv(ST.stats_by_source(_canon(spark, sf_dir)), path)
    return round_stats(FS.read_stats_csv(spark, path))


#: Byte cap of the registered export; it holds many documents, and the longest ones exceed it.
EXPORT_BYTES = 100_000


@register(
    "write_sized_gzip",
    "S12",
    f"SELECT text, true AS within_cap FROM (SELECT unnest(string_split(text || chr(10), chr(10))[:-2]) AS text FROM documents) AS l",
)
def q_write_sized_gzip(spark, sf_dir):
    """The export under a byte cap, read back; each line says whether its file keeps the cap (or is a single line)."""
    path = staging_path(spark, "sized-gzip")
    d = _docs(spark, sf_dir).select(F.explode(F.split("text", "\n", -1)).alias("text"))
    FS.write_sized_gzip(d, path, "text", max_bytes=EXPORT_BYTES)
    back = spark.read.text(path).select(F.col("value").alias("text"), "chunk")
    size = F.sum(F.octet_length("text") + 1)
    files = back.groupBy("chunk").agg(((size <= EXPORT_BYTES) | (F.count(F.lit(1)) == 1)).alias("within_cap"))
    return back.join(files, "chunk").select("text", "within_cap")
