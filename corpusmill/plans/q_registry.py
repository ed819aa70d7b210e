"""Registered end-to-end query (S13): the default source registry over one folder or table of every family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..oracle import reshape_sql as RS
from ..oracle import text_sql as S
from ..schema import INSTRUCTION_TUNING, ORDER
from ..session import staging_path
from ..sources import catalog as C
from . import jobs
from . import q_reshape as QR
from . import q_sources as QS
from . import standins as SI
from .registry import register
from .tables import table

#: Rows of a staged file: conversations, and orders of the TSV file.
FILE_CONVS, FILE_ORDERS = 8, 4096

# In catalog order, which is not that of the names.
ENTRIES = [
    {"source": "WIKIPEDIA", "path": "wikipedia", "data_dir": None, "source_split": "train", "commercial_use": True},
    {"source": "HAL", "path": "hal", "data_dir": "fr", "source_split": "train", "commercial_use": True},
    {"source": "ISTEX", "path": "istex", "data_dir": None, "source_split": "train", "commercial_use": True},
    {"source": "MQC", "path": "mqc", "data_dir": "French", "source_split": "train", "commercial_use": False},
    {"source": "PXCORPUS", "path": "pxcorpus", "data_dir": None, "source_split": "train", "commercial_use": True},
    {"source": "ESSAI", "path": "essai", "data_dir": None, "source_split": "train", "commercial_use": True},
    {"source": "WMT16", "path": "wmt", "data_dir": "en-fr", "source_split": ["train", "test"], "commercial_use": True},
    {"source": "DEFT2021", "path": "deft", "data_dir": None, "source_split": "train", "commercial_use": True},
    {"source": "MEDIQAL", "path": "mediqal", "data_dir": ["mcqu", "mcqm"], "source_split": "train", "adaptation_type": INSTRUCTION_TUNING, "commercial_use": True},
    {"source": "FRENCHMEDMCQA", "path": "qa", "data_dir": None, "source_split": "train", "adaptation_type": INSTRUCTION_TUNING, "commercial_use": True},
]


def _write_files(rows: DataFrame, path: str) -> None:
    """``text`` lines as one file per ``file``, in order of ``at``."""
    rows.repartition("file").sortWithinPartitions("file", "at").select("text", "file").write.partitionBy("file").text(path)


def stage_sources(spark, sf_dir) -> str:
    """Every family's input below one folder: ``local/<path>`` and ``lake/<path>/<data_dir>/<split>``."""
    root = staging_path(spark, "sources")
    docs, conv = table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations")
    hal = docs.where("source = 'src1'").select("text", F.floor(F.col("doc_id") / QS.FILE_DOCS).alias("file"), F.col("doc_id").alias("at"))
    _write_files(hal, f"{root}/local/hal")
    QS.stage_gzip_corpora(spark, sf_dir, f"{root}/local/istex", "src2")
    dialogue = conv.select("text", F.floor(F.col("conv_id") / FILE_CONVS).alias("file"), F.struct("conv_id", "turn").alias("at"))
    for name in ("mqc", "pxcorpus"):
        _write_files(dialogue, f"{root}/local/{name}")
    lines = SI.tsv_lines(spark, sf_dir).select(F.col("line").alias("text"), F.floor(F.col("pos") / (16 * FILE_ORDERS)).alias("file"), F.struct("pos", "line").alias("at"))
    _write_files(lines, f"{root}/local/essai")
    docs.where("lang IN ('de', 'es')").select(F.col("lang").alias("subset"), "text").write.parquet(f"{root}/local/wikipedia/wikipedia.parquet")
    pairs = docs.where("lang = 'fr'").select("doc_id", F.struct(F.lit(None).cast("string").alias("en"), F.col("text").alias("fr")).alias("translation"))
    for split, rest in (("train", "doc_id % 4 <> 0"), ("test", "doc_id % 4 = 0")):
        pairs.where(rest).select("translation").write.parquet(f"{root}/lake/wmt/en-fr/{split}")
    tokens = conv.sort("conv_id", "turn").select(F.col("conv_id").cast("string").alias("document_id"), F.split("text", " ").alias("tokens"))
    tokens.write.parquet(f"{root}/lake/deft/train")
    SI.mcq_bank(spark, sf_dir).drop("item_id").write.parquet(f"{root}/lake/qa/train")
    for kind in ("mcqu", "mcqm"):
        SI.subject_bank(spark, sf_dir).drop("item_id").write.parquet(f"{root}/lake/mediqal/{kind}/train")
    return root


def _files_sql(group: str, order: str, table_sql: str, where: str = "true") -> str:
    return f"SELECT string_agg(text, chr(10) ORDER BY {order}) || chr(10) AS text FROM ({table_sql}) AS f WHERE {where} GROUP BY {group}"


def _raw_sql() -> str:
    """Fine-tuning rows of every source before cleaning."""
    hal = _files_sql(f"doc_id // {QS.FILE_DOCS}", "doc_id", "SELECT * FROM documents", "source = 'src1'")
    conv = _files_sql(f"conv_id // {FILE_CONVS}", "conv_id, turn", "SELECT * FROM conversations")
    tsv = f"""SELECT sentence_id, string_agg(word, ' ' ORDER BY pos, line) AS text FROM (
  SELECT pos, line, {RS.pystrip('cols[1]')} AS sentence_id, {RS.pystrip('cols[3]')} AS word
  FROM (SELECT pos, line, string_split(line, chr(9)) AS cols FROM ({SI.TSV_LINES_SQL}) AS l WHERE NOT {S.is_blank('line')}) AS r
  WHERE len(cols) >= 6) AS w WHERE word <> '' GROUP BY sentence_id"""
    wmt = S.clean_text_select("SELECT doc_id, text FROM documents WHERE lang = 'fr'", ["doc_id"], "text", "text")
    parts = [
        ("WIKIPEDIA", 0, "lang", "'train'", "text", "SELECT lang, text FROM documents WHERE lang IN ('de', 'es')"),
        ("HAL", 1, "'fr'", "'train'", "regexp_replace(text, '\\r\\n?', chr(10), 'g')", hal),
        ("ISTEX", 2, "NULL", "'train'", "text", f"SELECT text FROM ({QS.LINES_SQL}) AS g WHERE corpus = 'src2'"),
        ("MQC", 3, "'French'", "'train'", RS.flatten_lines("text"), conv),
        ("PXCORPUS", 4, "NULL", "'train'", "text", f"SELECT unnest({S.split_lines('text')}) AS text FROM ({conv}) AS c"),
        ("ESSAI", 5, "NULL", "'train'", "text", tsv),
        ("WMT16", 6, "'en-fr'", "CASE WHEN doc_id % 4 = 0 THEN 'test' ELSE 'train' END", "text", wmt),
        ("DEFT2021", 7, "NULL", "'train'", "text", "SELECT string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, {rank} AS source_rank, {data_dir}::VARCHAR AS data_dir, {split} AS source_split, {text} AS text FROM ({sql}) AS p{rank}"
        for source, rank, data_dir, split, text, sql in parts
    )


def _built_sql() -> str:
    keep = ["source", "source_rank", "data_dir", "source_split"]
    fine = S.clean_text_select(_raw_sql(), keep, "text", "input")

    def cleaned(sql: str, keys: list[str]) -> str:
        for c in ("instruction", "input", "output"):
            sql = S.clean_text_select(sql, [*keys, *[o for o in ("instruction", "input", "output") if o != c]], c, c)
        return sql

    filled = " AND ".join(f"NOT {S.is_blank(c)}" for c in ("instruction", "input", "output"))
    return f"""SELECT source, source_rank, data_dir, source_split, NULL::VARCHAR AS instruction, input, NULL::VARCHAR AS output
FROM ({fine}) AS f WHERE NOT {S.is_blank('input')}
UNION ALL SELECT 'MEDIQAL', 8, data_dir, 'train', instruction, input, output FROM ({cleaned(QR._subject_sql(), ['data_dir'])}) AS m WHERE {filled}
UNION ALL SELECT 'FRENCHMEDMCQA', 9, NULL::VARCHAR, 'train', instruction, input, output FROM ({cleaned(QR._mcq_sql(), ['item_id'])}) AS q WHERE {filled}"""


@register("default_registry_build", "S13+S8+S9", _built_sql)
def q_default_registry_build(spark, sf_dir):
    """Job 1 over the default registry: every family loaded, cleaned, filtered, published and read back."""
    root = stage_sources(spark, sf_dir)
    catalog = C.catalog_frame(spark, ENTRIES)
    registry = jobs.default_registry(f"{root}/lake", f"{root}/local")
    built = jobs.build_sourced(spark, catalog, registry, out_root=f"{root}/sourced", make_commercial=False)
    rank = F.col(f"{ORDER}.source_rank").cast("int").alias("source_rank")
    return built.select("source", rank, "data_dir", "source_split", "instruction", "input", "output")

