"""Routed two-model scoring as a Structured Streaming job (M10 + K8, streaming form).

The original served two models behind one endpoint with a traffic split and
captured every scored request to a table.  Here requests arrive as a stream
(files landing in a folder, or any streaming source); routing, both fitted
pipelines and the campaign lookup (a stream-static join) are stateless per
row, so each micro-batch is scored on the executors and appended to the
inference log.

Exactly once: every micro-batch overwrites only its own ``batch_id``
partition (a static partition insert), so a batch that is replayed after a failure
replaces its earlier output instead of duplicating it.  The price is one
partition per micro-batch; choose a trigger interval that keeps batches
large, and compact old batch partitions into daily files in a separate job
once their batches are committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import scoring
from ..plans.modeling import ClickModel


def start_scoring(
    spark: SparkSession,
    requests_stream: DataFrame,
    model1: ClickModel,
    model2: ClickModel,
    campaigns: DataFrame,
    table: str,
    checkpoint: str,
    pct_model1: float = 50.0,
    key: str = "event_id",
    available_now: bool = True,
):
    """Start the scoring stream; returns the ``StreamingQuery``."""
    scored = scoring.score_routed(requests_stream, model1, model2, campaigns, pct_model1, key, capture=True)

    view = "adresponse_scored_batch"

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        out = scoring.inference_log(batch)
        if not session.catalog.tableExists(table):
            (
                out.withColumn("batch_id", F.lit(0).cast("long")).limit(0)
                .write.format("parquet").partitionBy("batch_id").saveAsTable(table)
            )
        cols = [c for c in session.table(table).columns if c != "batch_id"]
        out.select(*cols).createOrReplaceTempView(view)
        # a static partition spec replaces exactly this batch's partition,
        # whatever the session's partition overwrite mode is
        session.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) SELECT * FROM {view}")

    writer = scored.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
