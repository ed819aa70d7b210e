"""Incremental ingestion with Structured Streaming.

The cleaning chain, the projections and the empty-row filters are row-local, so the
same Column expressions run on a streaming DataFrame. New corpus files dropped into
a folder are cleaned and appended by source; each micro-batch writes its own
per-source statistics, and the mergeable-stats operator (A6) joins them when they are
read, which is exactly its purpose (merging the stats of an added corpus).

Spark's file stream keeps every file it has met on the driver. Here tasks list the
folder, the files that no earlier list names are written as new lists, one a
micro-batch, and the stream's source is the folder of lists: the driver has an entry
of each list, and tasks open the files that a list names.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.columns import clean_columns
from ..operators.filters import filter_nonempty_input
from ..operators.reshape import canonical_projection
from ..operators.stats import stats_by_source, stats_merge
from ..schema import ORDER, STATS_SCHEMA
from ..session import delete_path, scratch_tables
from ..sources import text_files as TF


#: Files of one micro-batch; a backlog is worked off in batches of this size.
FILES_PER_TRIGGER = 10_000
#: Output files of one source and batch, at most.
FILES_PER_SOURCE = 4
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_CORE = 4
#: Seconds from one listing to the next of a query that goes on.
LISTING_SECONDS = 60


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files with their task and their place in it."""
    from pyspark import TaskContext

    part, row = TaskContext.get().partitionId(), 0
    for b in batches:
        n = b.num_rows
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(n, part, np.int32)), pa.array(row + np.arange(n))], names=["file_path", "part", "row"])
        row += n


def listed_by_tasks(spark: SparkSession, path: str) -> bool:
    return all(TF.tasks_can_open(*root) for root in TF.find_roots(spark, path, must_match=False))


def _make_folder(spark: SparkSession, lists: str) -> None:
    """The folder of lists, in a checkpoint that is new or has one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(lists)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), "offsets")):
        raise ValueError(f"{path.getParent()} is the checkpoint of a query that read the files without lists: its files would be read again")
    fs.mkdirs(path)


def _add_lists(spark: SparkSession, files: list[str], lists: str) -> None:
    """Move the new lists to their folder, with times in their order: the stream takes the oldest list first."""
    jvm, now = spark._jvm, time.time_ns() // 1_000_000
    for i, name in enumerate(files):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.setTimes(path, now + i, -1)
        if not fs.rename(path, jvm.org.apache.hadoop.fs.Path(lists, path.getName())):
            raise OSError(f"{name} cannot be moved to {lists}")


def list_arrivals(spark: SparkSession, path: str, lists: str, files_per_list: int) -> None:
    """Write the ``*.txt`` files below ``path`` that no list names yet, oldest first, as new lists of ``files_per_list``.

    A list is one Parquet file, moved in as a whole: what a killed run did not list, the next one does.
    """
    with scratch_tables(spark) as write:
        listed = TF.list_text_files(spark, TF.find_roots(spark, path, must_match=False), write)
        known = spark.read.schema("file_path string").parquet(lists)
        # a shuffled join: lists are small files, their paths are not
        fresh = write(listed.join(known.hint("merge"), "file_path", "left_anti").select("file_path", "modified"), "arrivals")
        total = fresh.count()
        if not total:
            return
        n = -(-total // files_per_list)
        ordered = fresh.repartitionByRange(n, "modified", "file_path").sortWithinPartitions("modified", "file_path").select("file_path")
        placed = write(ordered.mapInArrow(_numbered, "file_path string, part int, row long"), "arrivals-in-order")
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
        starts = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
        place = F.floor((F.col("start") + F.col("row")) / files_per_list).cast("int")
        dealt = placed.join(F.broadcast(starts), "part").select("file_path", place.alias("list")).repartitionById(n, F.col("list"))
        made = f"{lists}/_made"  # hidden from the stream
        dealt.select("file_path").write.mode("overwrite").parquet(made)
        _add_lists(spark, sorted(spark.read.schema("file_path string").parquet(made).inputFiles()), lists)
        delete_path(spark, made)


def read_text_stream(spark: SparkSession, path: str, lists: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Whole ``*.txt`` files below ``path`` (one row per file), newline-normalised: those there now, and what
    ``list_arrivals`` adds to the folder ``lists`` while the stream runs.

    The source directory layout is ``<path>/<source>/<file>.txt``; the source name is the
    parent folder of each file.
    """
    if listed_by_tasks(spark, path):
        _make_folder(spark, lists)
        list_arrivals(spark, path, lists, max_files_per_trigger)
        named = spark.readStream.schema("file_path string").option("maxFilesPerTrigger", 1).parquet(lists)
        most = TF.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        raw = TF.read_text_files(named, min(most, -(-max_files_per_trigger // TF.TASK_FILES)))
    else:  # a store that only Spark's readers know
        reader = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.txt")
        reader = reader.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files_per_trigger)
        raw = reader.load(path).select(F.col("_metadata.file_path").alias("file_path"), "value")
    return raw.select(
        "file_path",
        F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1).alias("source"),
        F.regexp_replace("value", "\r\n?", "\n").alias("text"),
    )


def clean_stream(stream: DataFrame) -> DataFrame:
    """Canonical rows, cleaned and without empty inputs (T17 + F1 on a stream)."""
    canon = canonical_projection(stream, F.col("source"), None, "train", "text", order=F.col("file_path"))
    return filter_nonempty_input(clean_columns(canon, ["input"]))


def ingested_stats(spark: SparkSession, stats_dir: str) -> DataFrame:
    """Per-source statistics of all batches below ``stats_dir`` (A6 over one partial table per batch)."""
    return stats_merge(spark.read.schema(STATS_SCHEMA).parquet(f"{stats_dir.rstrip('/')}/batch=*"))


def start_ingest(
    spark: SparkSession,
    source_dir: str,
    corpus_dir: str,
    stats_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    max_files_per_trigger: int = FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Clean new files, append them partitioned by source, and write their stats below ``stats_dir``.

    ``foreachBatch`` writes are idempotent per batch id (it is part of the output path of the corpus rows and
    of the partial stats), so a restarted query that replays a batch after an executor or driver loss replaces
    that batch's output. ``ingested_stats`` reads the merged table. The lists of files are kept below
    ``checkpoint_dir``; a query that goes on lists ``source_dir`` again every ``LISTING_SECONDS`` and is stopped when
    that fails. Folders are listed in the caller's session: its conf ``LISTING`` is lowered and has to stay so while
    the query runs.
    """
    lists = f"{checkpoint_dir.rstrip('/')}/arrivals"
    cleaned = clean_stream(read_text_stream(spark, source_dir, lists, max_files_per_trigger))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = f"{corpus_dir.rstrip('/')}/batch={batch_id}"
        # a scan task meets files of many sources: dealt by source, a batch writes a few files a source, not a few a task
        dealt = batch.repartition("source", F.pmod(F.xxhash64(ORDER), F.lit(FILES_PER_SOURCE)))
        dealt.write.mode("overwrite").partitionBy("source").parquet(rows)
        written = spark.read.schema(batch.schema).parquet(rows)
        stats_by_source(written).write.mode("overwrite").parquet(f"{stats_dir.rstrip('/')}/batch={batch_id}")

    writer = cleaned.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    # Each batch lists the folders it wrote, by default in one Spark task a folder.
    spark.conf.set(LISTING, str(LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    query = writer.start()
    if not available_now and listed_by_tasks(spark, source_dir):
        threading.Thread(target=_keep_listing, args=(query, spark, source_dir, lists, max_files_per_trigger), daemon=True).start()
    return query


def _keep_listing(query: StreamingQuery, spark: SparkSession, path: str, lists: str, files_per_list: int) -> None:
    try:
        while not query.awaitTermination(LISTING_SECONDS):
            list_arrivals(spark, path, lists, files_per_list)
    except StreamingQueryException:  # its caller is told by the query
        return
    except Exception:
        logging.getLogger(__name__).exception("%s cannot be listed, the query is stopped", path)
        with suppress(Exception):  # the session may be gone
            query.stop()
