"""Incremental ingest as a Structured Streaming job (K4, streaming form).

The batch job appends rows newer than the target's high-water mark.  The
streaming form reads new impression files as they land, joins the static
identity dimension (stream-static left join), and appends each micro-batch
through ``foreachBatch``.  The high-water mark is read once, when a run
starts, and kept beside the checkpoint until the run has ended, so how files
fall into micro-batches - and a restart within the run - changes nothing:
files of one run may overlap in time.  Rows whose key the target already has
since the mark are left out, so a replayed batch inserts nothing twice.

``trigger(availableNow=True)`` processes everything present and stops, which
is how a scheduled ingest task runs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import IngestSpec
from ..operators.ingest import append_rows, as_column, ensure_table, frozen_mark, in_window, recent, training_rows

KEY = "event_id"


def _mark_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-mark"


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def run_mark(spark: SparkSession, table: str, checkpoint: str, as_of, days: int):
    """The mark of the run that is under way, or of the one that starts now."""
    files, place = _folder(spark, _mark_path(checkpoint))
    if not files.exists(place):
        mark = frozen_mark(spark, spark.table(table), as_of, days)
        spark.createDataFrame([(str(mark),)], "mark string").coalesce(1).write.json(_mark_path(checkpoint))
    return spark.read.schema("mark string").json(_mark_path(checkpoint)).first()["mark"]


def end_run(spark: SparkSession, checkpoint: str) -> None:
    """Forget the mark of a run that has ended well; the next run reads a new one."""
    files, place = _folder(spark, _mark_path(checkpoint))
    files.delete(place, True)


def run_ingest(spark: SparkSession, impressions_stream: DataFrame, identity: DataFrame, table: str, checkpoint: str,
               as_of, spec: IngestSpec = IngestSpec(), partition_by: str | None = "event_date") -> None:
    """One whole run over all files that are there."""
    start_ingest(spark, impressions_stream, identity, table, checkpoint, as_of, spec, partition_by).awaitTermination()
    end_run(spark, checkpoint)


def start_ingest(
    spark: SparkSession,
    impressions_stream: DataFrame,
    identity: DataFrame,
    table: str,
    checkpoint: str,
    as_of,
    spec: IngestSpec = IngestSpec(),
    partition_by: str | None = "event_date",
    available_now: bool = True,
):
    """Start the streaming append; returns the ``StreamingQuery``.

    Call ``end_run`` when a run has ended (``run_ingest`` does both).
    """
    rows = training_rows(impressions_stream, identity, as_of, spec)
    ensure_table(spark, table, rows, partition_by)
    mark = as_column(run_mark(spark, table, checkpoint, as_of, spec.window_days))

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        there = recent(batch.sparkSession.table(table), as_of, spec.window_days).where(F.col("timestamp") > mark).select(KEY)
        fresh = batch.where(in_window(as_of, spec.window_days) & (F.col("timestamp") > mark))
        append_rows(fresh.join(there, KEY, "left_anti"), table, partition_by)
        spark.catalog.refreshTable(table)  # the caller's session lists the table's files on its own

    writer = rows.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def file_stream(spark: SparkSession, directory: str, schema, pattern: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files landing in ``directory`` as a stream (fixed schema, no inference).

    ``pattern`` keeps only matching file names (``pathGlobFilter``).
    """
    r = spark.readStream.schema(schema)
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(directory)


def rows_in_table(spark: SparkSession, table: str) -> int:
    return spark.table(table).agg(F.count(F.lit(1)).alias("n")).first()["n"]
