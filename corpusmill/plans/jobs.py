"""The three end-to-end jobs: build the sourced corpus, deduplicate it, compute its statistics.

Each job is one lazy plan per output: catalog entries fan out into scans, the reshaping
and cleaning are Column expressions, and only the catalog itself (bounded metadata)
is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_lines
from ..operators import reshape as R
from ..operators.columns import clean_columns
from ..operators.dedup import dedup_by_adaptation
from ..operators.filters import filter_adaptation_type, filter_empty_rows
from ..operators.stats import corpus_stats, observe_rows, stats_global
from ..schema import CANONICAL, FINE_TUNING, INSTRUCTION_TUNING, ORDER, check_adaptation_type
from ..sources.catalog import SourceRegistry, catalog_select, ingest_fanout, license_catalog
from ..sources.files import read_by_source, read_table, scan_local_dispatch, scan_parquet, write_by_source, write_stats_csv, write_training_set

CLEAN_COLUMNS = {FINE_TUNING: ["input"], INSTRUCTION_TUNING: ["instruction", "input", "output"]}

# ---------------------------------------------------------------------------
# Catalog source names (they must equal the catalog's ``source`` entries).
# Sources read as folders of text files and projected with P1:
TEXT_FOLDER_SOURCES = (
    "HAL", "HAS", "EMEA_V3", "QUAERO", "BDPM", "ECDC_TM", "QUALISCOPE", "CNEDIMTS", "WMT18_MEDLINE",
    "ISTEX", "CERIMES", "CLEAR", "E3C", "MANTRA_GSC", "CAS", "FRASIMED",
)
# The other families are registered by name below: MQC, PXCORPUS, ESSAI, WMT16, DEFT2021,
# FRENCHMEDMCQA, MEDIQAL, WIKIPEDIA.
# ---------------------------------------------------------------------------


def _row_position(df: DataFrame) -> DataFrame:
    """Parquet rows get their physical position (file, row index) as the row order."""
    return df.withColumn(
        ORDER, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos"))
    )


def default_registry(lake_root: str, local_root: str = ".") -> SourceRegistry:
    """Loaders for the reference's source families, by catalog name.

    ``lake_root`` holds hub-style datasets as ``<path>/<data_dir>/<split>`` Parquet folders;
    ``local_root`` is where relative local catalog paths live.
    """
    reg = SourceRegistry()

    def local(entry):
        path = entry["path"]
        return path if path.startswith("/") or "://" in path else f"{local_root.rstrip('/')}/{path}"

    def hub(spark, entry, data_dir, split):
        return _row_position(read_table(spark, lake_root, entry["path"], data_dir, split))

    def text_files(spark, entry, data_dir, split):
        files = scan_local_dispatch(spark, local(entry))
        return R.canonical_projection(files, entry["source"], data_dir, split, "text", order=ORDER)

    for name in TEXT_FOLDER_SOURCES:
        reg[name] = text_files

    @reg.register("MQC")
    def mqc(spark, entry, data_dir, split):
        files = scan_local_dispatch(spark, local(entry)).withColumn("text", R.flatten_lines(F.col("text")))
        return R.canonical_projection(files, entry["source"], data_dir, split, "text", order=ORDER)

    @reg.register("PXCORPUS")
    def pxcorpus(spark, entry, data_dir, split):
        files = scan_local_dispatch(spark, local(entry))
        lines = files.select(
            F.col(f"{ORDER}.file").alias("file"), F.posexplode(split_lines(F.col("text"))).alias("pos", "text")
        )
        order = F.struct(F.col("file"), F.col("pos").cast("bigint").alias("pos"))
        return R.canonical_projection(lines, entry["source"], data_dir, split, "text", order=order)

    @reg.register("ESSAI")
    def essai(spark, entry, data_dir, split):
        files = scan_local_dispatch(spark, local(entry))
        lines = files.select(
            F.col(f"{ORDER}.file").alias("file"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
        )
        sentences = R.tsv_tokens_to_sentences(lines, "file", "pos", "line")
        order = F.struct(F.col("file"), F.col("first_pos").cast("bigint").alias("pos"))
        return R.canonical_projection(sentences, entry["source"], data_dir, split, "input", order=order)

    @reg.register("WMT16")
    def wmt16(spark, entry, data_dir, split):
        return R.translation_projection(hub(spark, entry, data_dir, split), entry["source"], data_dir, split, order=ORDER)

    @reg.register("DEFT2021")
    def deft2021(spark, entry, data_dir, split):
        rows = hub(spark, entry, data_dir, split)
        docs = R.token_rows_to_documents(rows, "document_id", "tokens", ORDER, first="first_row")
        return R.canonical_projection(docs, entry["source"], data_dir, split, "input", order=F.col("first_row"))

    @reg.register("FRENCHMEDMCQA")
    def frenchmedmcqa(spark, entry, data_dir, split):
        bank = hub(spark, entry, data_dir, split)
        return R.instruction_rows(R.mcq_prompt_array(bank), entry["source"], data_dir, split, order=ORDER)

    @reg.register("MEDIQAL")
    def mediqal(spark, entry, data_dir, split):
        bank = hub(spark, entry, data_dir, split)
        return R.instruction_rows(R.mcq_prompt_subject(bank, data_dir), entry["source"], data_dir, split, order=ORDER)

    @reg.register("WIKIPEDIA")
    def wikipedia(spark, entry, data_dir, split):
        pages = _row_position(scan_parquet(spark, f"{local(entry)}/wikipedia.parquet"))
        return R.subset_projection(pages, entry["source"], split, "text", "subset", order=ORDER)

    return reg


def build_sourced(
    spark: SparkSession,
    catalog: DataFrame,
    registry: SourceRegistry,
    out_root: str | None = None,
    make_commercial: bool = True,
    source: str | None = None,
    report: dict | None = None,
) -> DataFrame:
    """Job 1: select (S1) and licence-filter (S2) the catalog, load every entry (S8), clean the
    columns of its adaptation type (T18), drop empty rows (F1/F2), union (U2) and, when ``out_root`` is
    given, publish it as the current corpus of its licence (S9). A build of one ``source`` replaces that source.

    With ``report`` (a dict) and ``out_root``, the row counts per source before and after the
    empty-row filter (A9) are filled in from ``observe()`` metrics of the write itself.
    """
    cat = license_catalog(catalog_select(catalog, source), make_commercial)
    observations: list = []

    def counted(df: DataFrame, sources: list[str], stage: str) -> DataFrame:
        if report is None:
            return df
        df, seen = observe_rows(df, f"{stage}:{len(observations)}", by="source", values=sources)
        observations.append((stage, sources, seen))
        return df

    def finish(df: DataFrame, kind: str, sources: list[str]) -> DataFrame:
        check_adaptation_type(kind)
        cleaned = counted(clean_columns(R.cast_null_columns(df), CLEAN_COLUMNS[kind]), sources, "loaded")
        return counted(filter_empty_rows(cleaned, kind).select(*CANONICAL, ORDER), sources, "non_empty")

    corpus = ingest_fanout(spark, cat, registry, per_kind=finish)
    if out_root:
        write_by_source(corpus, out_root, make_commercial, None if source is None else [source])
        for stage, sources, seen in observations:
            for i, name in enumerate(sources):
                report.setdefault(name, {})[stage] = seen.get[f"n{i}"]
        return read_by_source(spark, out_root, make_commercial)
    return corpus


def deduplicate(
    spark: SparkSession,
    sourced: DataFrame,
    catalog: DataFrame,
    adaptation_type: str,
    make_commercial: bool = True,
    out_root: str | None = None,
    report: dict | None = None,
) -> DataFrame:
    """Job 2: sources of the adaptation type (F3) and licence (S2), deduplicated when fine-tuning (D7),
    shuffled with the fixed seed (O1), written as the training set (S10) when ``out_root`` is given.

    With ``report`` and ``out_root``, the rows going in and coming out (A9) are filled in from
    ``observe()`` metrics of the passes that run anyway.
    """
    cat = license_catalog(catalog, make_commercial)
    rows = filter_adaptation_type(sourced, cat, adaptation_type)
    if report is not None:
        rows, seen_in = observe_rows(rows, "dedup:input")
    out = dedup_by_adaptation(rows, adaptation_type)
    if out_root:
        if report is not None:
            out, seen_out = observe_rows(out, "dedup:output")
        path = write_training_set(out, out_root, make_commercial, adaptation_type)
        if report is not None:
            report["input"] = seen_in.get["nb_rows"]
            report["output"] = seen_out.get["nb_rows"]
        return spark.read.parquet(path)
    return out


def compute_stats(df: DataFrame, out_csv: str | None = None, is_sourced: bool = True) -> DataFrame:
    """Job 3: per-source statistics with the pooled Total (A1 + A3), or one ``globals`` row (A7);
    written as CSV (S11) when ``out_csv`` is given."""
    stats = corpus_stats(df) if is_sourced else stats_global(df)
    if out_csv:
        write_stats_csv(stats, out_csv)
    return stats


__all__ = ["build_sourced", "compute_stats", "deduplicate", "default_registry"]
