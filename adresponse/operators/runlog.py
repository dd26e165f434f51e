"""Run metrics/params log (K9) and "latest run" reads.

Runs append rows ``(run_id, model, key, value, end_time)`` to a table; values
are text (numbers and JSON alike).  Reads are aggregates over that table:
``max_by(value, end_time)`` per key (one shuffle on the key, partial
aggregation first), or a top-1 by end time.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BoostParams

TUNE_RUN = "tune-"  # run ids of the hyper-parameter search begin so; no other run's may
RUNLOG_SCHEMA = "run_id string, model string, key string, value string, end_time timestamp_ntz"


def metric_rows(spark: SparkSession, run_id: str, model: str, values: dict, end_time=None) -> DataFrame:
    """One row per logged key (params as JSON text)."""
    end_time = end_time or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [
        (run_id, model, k, v if isinstance(v, str) else json.dumps(v, sort_keys=True), end_time)
        for k, v in values.items()
    ]
    return spark.createDataFrame(rows, RUNLOG_SCHEMA)


def append_metrics(spark: SparkSession, table: str, rows: DataFrame, path: str | None = None) -> None:
    """K9: append to the run log table (created on first use, at ``path`` if given)."""
    if spark.catalog.tableExists(table):
        rows.select(*spark.table(table).columns).write.insertInto(table)
    else:
        w = rows.write.format("parquet")
        (w.option("path", path) if path else w).saveAsTable(table)


def latest_values(runlog: DataFrame, keys=None) -> DataFrame:
    """Per key, the value of the most recently ended run."""
    df = runlog if keys is None else runlog.where(F.col("key").isin(*keys))
    return df.groupBy("key").agg(
        F.max_by("value", "end_time").alias("value"),
        F.max_by("run_id", "end_time").alias("run_id"),
        F.max("end_time").alias("end_time"),
    )


def latest_run(runlog: DataFrame) -> DataFrame:
    """O1 + O2: the whole latest run by end time (top-1, then its rows)."""
    top = runlog.select("run_id", "end_time").orderBy(F.col("end_time").desc(), F.col("run_id").desc()).limit(1)
    return runlog.join(top.select("run_id"), on="run_id", how="left_semi")


def tuned_params(runlog: DataFrame, model: str) -> BoostParams:
    """M2: latest tuned hyper-parameters of ``model``, else the defaults.

    Training runs log the values they used under the same key; only search
    runs count here.
    """
    key = f"{model}_hyperparams"
    tuned = runlog.where((F.col("model") == model) & F.col("run_id").startswith(TUNE_RUN))
    row = latest_values(tuned, [key]).first()
    if row is None or row["value"] is None:
        return BoostParams()
    return BoostParams.from_dict(json.loads(row["value"]))


def rows_after(runlog: DataFrame, target: str) -> int | None:
    """K5: the row count that the last ingest run into ``target`` left, None without one."""
    said = lambda key: F.max(F.when(F.col("key") == key, F.col("value")))
    runs = runlog.where("model = 'ingest'").groupBy("run_id").agg(said("target").alias("target"), said("rows_after").alias("rows"), F.max("end_time").alias("end"))
    last = runs.where((F.col("target") == target) & F.col("rows").isNotNull()).orderBy(F.desc("end"), F.desc("run_id")).first()
    return int(last["rows"]) if last else None


def ingest_replay(training: DataFrame, first_day=None) -> DataFrame:
    """Run log of a daily ingest schedule replayed from the training rows.

    Each calendar day is one ingest run that appends that day's rows; the
    audit keys of K5 are logged per run.  A windowed running total gives the
    rows before/after without any self-join.
    """
    from pyspark.sql import Window

    daily = training.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("rows_inserted"), F.max("timestamp").alias("end_time")
    )
    if first_day is not None:
        daily = daily.where(F.col("day") >= F.lit(first_day))
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = daily.select(
        F.concat(F.lit("ingest-"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
        "end_time",
        "rows_inserted",
        (F.sum("rows_inserted").over(w) - F.col("rows_inserted")).alias("rows_before"),
    ).withColumn("rows_after", F.col("rows_before") + F.col("rows_inserted"))
    return runs.select(
        "run_id",
        F.lit("ingest").alias("model"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value"))
                    for k in ("rows_before", "rows_after", "rows_inserted")
                ]
            )
        ).alias("kv"),
        "end_time",
    ).select("run_id", "model", "kv.key", "kv.value", "end_time")
