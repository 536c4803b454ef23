"""Incremental drop-folder ingest (J1) on Structured Streaming.

``start_feed`` watches a folder of tabular feed files (Parquet, CSV, JSON);
``start`` one of workbooks. The file source hands over each new file once (it
keeps the set of seen files in the checkpoint); every micro-batch is matched to
its mapping by file name, mapped, and merged into the snapshot tables inside
``foreachBatch``. A batch also writes its error log,
conversion audit and run report. Processed files can be moved by the file source
itself (``cleanSource=archive``).

A batch is told by the stream's own id (which its checkpoint keeps) and its
number, and is merged through the snapshot's commit log (``operators.snapshots``):
what it starts from is read from the log, so further jobs and new checkpoints
over one root go on where the tables stand, a replayed batch finds its own commit,
and of two jobs that commit at once one merges again. A stream whose earlier
batches the log does not hold stops with an error; it never starts from empty
tables. A batch's working tables are deleted at its end.
``trigger(availableNow=True)`` turns a run into a bounded catch-up job, the
streaming form of the scheduled folder sweep.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import match_rules_df
from ..operators import snapshots as S
from ..operators.classify import classify
from ..operators.files import vendor_match, with_name_parts
from ..operators.mapping import conversion_audit, union_vendors
from ..operators.report import file_status, run_report, write_report
from ..operators.validate import error_rows
from ..plans.ingest import as_feed, canonical_rows, ingest_cells, match_files, normalize_feed, probe_columns, stage_rows_counted
from ..schema import PATH
from ..session import scratch_scope, ship_package, stage_table
from ..sources.xlsx import WORKBOOK_GLOB, cells_of

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
_NO_FATAL = "path string, reason string"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote into the stream's checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def _write_batch(out: dict, root: str, stream: str, batch_id: int, buckets: int) -> None:
    """The batch's commit, then its logs, under the commit's version. Written
    again on a replay."""
    spark = out["rows"].sparkSession
    version = S.merge_batch(spark, root, out["rows"].filter(F.col("status") == "ok"), stream, batch_id, buckets)
    logs = f"{root}/logs/batch={version}"
    out["errors"].write.mode("overwrite").parquet(f"{logs}/errors")
    out["audit"].write.mode("overwrite").parquet(f"{logs}/conversions")
    write_report(out["report"], f"{logs}/report")


def _scoped(batch_work: Callable[[DataFrame, str, int], None], checkpoint: str) -> Callable[[DataFrame, int], None]:
    """A batch's work inside a scope of working tables of its own."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark):
            batch_work(batch, stream_id(spark, checkpoint), batch_id)
    return run


def _feed_batch(mappings: list[dict], root: str, columns: dict, run_id: int | None, input_dir: str, buckets: int) -> Callable[[DataFrame, str, int], None]:
    def run(batch: DataFrame, stream: str, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = stage_table(batch, "batch")
        files = vendor_match(with_name_parts(batch.select(F.col(PATH).alias("path")).distinct()), match_rules_df(spark, mappings))
        files = stage_table(files, "files")
        matched = files.filter(F.col("status") == "matched").select(F.col("path").alias(PATH), "mapping_seq")
        rows, audits = [], []
        for seq, cfg in enumerate(mappings):
            own = batch.join(matched.filter(F.col("mapping_seq") == seq).select(PATH), PATH, "left_semi")
            feed = normalize_feed(as_feed(own, **columns))
            rows.append(canonical_rows(feed, cfg, run_id=run_id, normalize=False, keep=probe_columns(feed)))
            audits.append(conversion_audit(classify(feed, cfg), cfg))
        whole, totals = stage_rows_counted(union_vendors(rows), mappings)
        status = file_status(files, spark.createDataFrame([], _NO_FATAL))
        _write_batch({"rows": whole, "errors": error_rows(whole), "audit": union_vendors(audits),
                      "report": run_report(whole, status, input_dir, totals=totals)}, root, stream, batch_id, buckets)
    return run


def _workbook_batch(mappings: list[dict], root: str, run_id: int | None, input_dir: str, buckets: int) -> Callable[[DataFrame, str, int], None]:
    def run(batch: DataFrame, stream: str, batch_id: int) -> None:
        files = stage_table(match_files(batch, mappings), "files")
        sheets = sorted({s["sheet_name"] for m in mappings for s in m.get("sheets") or []})
        matched = batch.join(files.filter(F.col("status") == "matched").select("path"), "path", "left_semi")
        cells = stage_table(cells_of(matched, sheets), "cells")
        _write_batch(ingest_cells(cells, files, mappings, run_id=run_id, input_dir=input_dir, merge=False), root, stream, batch_id, buckets)
    return run


def _run(reader, drop_dir: str, max_files: int | None, archive_dir: str | None):
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.option("recursiveFileLookup", "true").load(drop_dir)


def start_feed(spark: SparkSession, drop_dir: str, mappings: list[dict], root: str, checkpoint: str, schema: str, fmt: str = "parquet",
               columns: dict | None = None, options: dict | None = None, archive_dir: str | None = None,
               run_id: int | None = None, max_files: int | None = None, buckets: int = S.BUCKETS):
    """One ``availableNow`` run over a folder of feed files; returns the query.

    ``schema``: the files' columns; ``columns``: arguments of
    :func:`~feedloom.plans.ingest.as_feed` (which column is the row number, the
    vendor and so on). A file is told by its path. The query's progress has the
    rows of each batch (``observedMetrics["feed"].rows_read``), matched to a mapping or not.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    stream = _run(reader, drop_dir, max_files, archive_dir).withColumn(PATH, F.col("_metadata.file_path"))
    stream = stream.observe("feed", F.count(F.lit(1)).alias("rows_read"))  # a batch is read once, by the write that stages it
    return (stream.writeStream.foreachBatch(_scoped(_feed_batch(mappings, root, columns or {"row": "row_idx"}, run_id, drop_dir, buckets), checkpoint))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start(spark: SparkSession, drop_dir: str, mappings: list[dict], root: str, checkpoint: str, archive_dir: str | None = None,
          run_id: int | None = None, max_files: int | None = None, buckets: int = S.BUCKETS):
    """One ``availableNow`` run over a folder of workbooks; returns the query."""
    ship_package(spark)
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", WORKBOOK_GLOB)
    return (_run(reader, drop_dir, max_files, archive_dir).writeStream.foreachBatch(_scoped(_workbook_batch(mappings, root, run_id, drop_dir, buckets), checkpoint))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_snapshot(spark: SparkSession, root: str, checkpoint: str | None = None) -> dict[str, DataFrame] | None:
    """The newest committed snapshot, by its log; with ``checkpoint``, as that
    stream's last batch left it. None before the first batch."""
    version = None
    if checkpoint is not None:
        commit = S.read_commit(spark, root)
        held = commit["streams"].get(stream_id(spark, checkpoint)) if commit else None
        if held is None:
            return None
        version = held["version"]
    return S.read_snapshot(spark, root, version)
