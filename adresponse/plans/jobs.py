"""End-to-end jobs, in the order a scheduled workflow runs them.

    ingest_job  -> tune_job (optional) -> retrain_job(MODEL1), retrain_job(MODEL2)
                -> score_job (two-model routing + inference log)

Each job takes catalog table names (or DataFrames) and the caller's session,
and leaves its results in tables: the training table (day-partitioned), the
run log, saved models, the inference log.  Models are saved under a shared
path (``spark.checkpoint.dir``'s file system or any other the caller gives).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MODEL1, MODEL2, IngestSpec, ModelSpec, WINDOW_DAYS
from ..operators import commits, ingest, joins, runlog, sampling
from ..session import apply_scale_settings
from . import contract, modeling, scoring, tuning


def _table(spark: SparkSession, t) -> DataFrame:
    return spark.table(t) if isinstance(t, str) else t


def _campaigns(spark: SparkSession, campaigns, spec: ModelSpec):
    """The campaign feature table of a lookup model, its key checked unique."""
    if not spec.lookup_features or campaigns is None:
        return None
    df = _table(spark, campaigns)
    joins.assert_unique_key(df, "campaign_id")
    return df


def _run_id(prefix: str) -> str:
    return _dt.datetime.now().strftime(f"{prefix}-%Y%m%d%H%M%S%f")


def ingest_job(spark: SparkSession, impressions, identity, training_table: str, runlog_table: str,
               as_of=None, spec: IngestSpec = IngestSpec(), run_id: str | None = None,
               input_bytes: int | None = None, concurrent: bool = False) -> DataFrame:
    """K1-K5: append new training rows and log the audit to the run log.

    With ``concurrent`` a table made by this call takes commits, and then runs
    of it may overlap (``operators.commits``); a table that has a commit column
    is always written so.
    ``input_bytes`` (the day's impressions + identity) sizes file splits and
    shuffle partitions for the run; without it the session's settings stay.
    """
    run_id = run_id or _run_id("ingest")
    if input_bytes:
        apply_scale_settings(spark, input_bytes)
    schema = training_table.rsplit(".", 1)[0] if "." in training_table else None
    if schema:
        ingest.ensure_schema(spark, schema)
    as_of = as_of if as_of is not None else _dt.datetime.now(_dt.timezone.utc)  # one time for the whole run
    sides = _table(spark, impressions), _table(spark, identity)
    like = ingest.training_rows(*sides, as_of, spec)
    created = (commits.ensure_commit_table if concurrent else ingest.ensure_table)(spark, training_table, like)
    if commits.takes_commits(spark, training_table):
        seen = commits.snapshot(spark, training_table, as_of, spec.window_days)
        rows = ingest.training_rows(*sides, as_of, spec, newer_than=seen.mark)
        audit = commits.append_committed(spark, rows, training_table, as_of, spec.window_days,
                                         ingest.query_text(spec, seen.mark), seen)
    elif concurrent:
        raise ValueError(f"{training_table} has no {commits.COMMIT_COLUMN} column; make a table for concurrent runs")
    else:
        before = 0 if created else None
        if before is None and spark.catalog.tableExists(runlog_table):
            before = runlog.rows_after(spark.table(runlog_table), training_table)
        mark = ingest.frozen_mark(spark, spark.table(training_table), as_of, spec.window_days)
        rows = ingest.training_rows(*sides, as_of, spec, newer_than=mark)
        audit = ingest.append_new(spark, rows, training_table, as_of, spec.window_days, description=ingest.query_text(spec, mark),
                                  mark=mark, rows_before=before)
    a = audit.first()
    runlog.append_metrics(
        spark,
        runlog_table,
        runlog.metric_rows(
            spark, run_id, "ingest",
            {"rows_before": str(a.rows_before), "rows_after": str(a.rows_after),
             "rows_inserted": str(a.rows_inserted), "data_query": a.data_query, "target": training_table},
        ),
    )
    return audit


def tune_job(spark: SparkSession, training_table: str, runlog_table: str, spec: ModelSpec = MODEL1,
             campaigns=None, as_of=None, n_evals: int = 2, parallelism: int = 4, seed: int = 0) -> DataFrame:
    """M3: random search; the best values go to the run log under ``<model>_hyperparams``."""
    training = modeling.load_window(spark.table(training_table), as_of, WINDOW_DAYS)
    prepared = modeling.materialize(modeling.prepare(training, spec, _campaigns(spark, campaigns, spec)))
    trials = tuning.search(spark, prepared, spec, n_evals, parallelism, seed)
    best = tuning.best(trials)
    runlog.append_metrics(
        spark, runlog_table,
        runlog.metric_rows(spark, _run_id(runlog.TUNE_RUN.rstrip("-")), spec.name, {f"{spec.name}_hyperparams": best.as_dict()}),
    )
    return trials


def retrain_job(spark: SparkSession, training_table: str, runlog_table: str, model_path: str,
                spec: ModelSpec = MODEL1, campaigns=None, as_of=None, params=None,
                run_id: str | None = None, input_bytes: int | None = None) -> modeling.ClickModel:
    """M1/M2/M4/K6/K9: fit with tuned (or default) values, evaluate, log, save."""
    run_id = run_id or _run_id("train")
    if run_id.startswith(runlog.TUNE_RUN):
        raise ValueError(f"a training run's id may not begin with {runlog.TUNE_RUN!r}")
    if input_bytes:
        apply_scale_settings(spark, input_bytes)
    if params is None:
        params = (
            runlog.tuned_params(spark.table(runlog_table), spec.name)
            if spark.catalog.tableExists(runlog_table) and spec is MODEL1
            else None
        )
    training = modeling.load_window(spark.table(training_table), as_of, WINDOW_DAYS)
    lookup = _campaigns(spark, campaigns, spec)
    prepared = modeling.materialize(modeling.prepare(training, spec, lookup), modeling.layout(input_bytes))
    model = modeling.fit(prepared, spec, params, run_id)
    evaluation = modeling.evaluate(model, prepared)
    runlog.append_metrics(spark, runlog_table, runlog.metric_rows(spark, run_id, spec.name, modeling.metrics(model, evaluation)))
    loaded = [f for f in spec.features if f not in spec.lookup_features]
    examples = sampling.example_rows(prepared.where(F.col("variant") == 0).select("event_id", *loaded))
    modeling.save(model, spark, model_path, examples)
    contract.save(contract.infer(training, spec), spark, model_path)
    return model


def score_job(spark: SparkSession, requests, model1_path: str, model2_path: str, campaigns,
              inference_table: str, pct_model1: float = 50.0, run_id: str | None = None, strict: bool = False) -> DataFrame:
    """M10 + K8: route each request to one model, score, log; a retry under the same ``run_id`` replaces its rows.

    With ``strict`` requests that break either model's contract (M7) are an
    error before anything is written.
    """
    if strict:
        for path in (model1_path, model2_path):
            contract.check(_table(spark, requests), contract.load(spark, path))
    m1 = modeling.load(spark, model1_path, MODEL1)
    m2 = modeling.load(spark, model2_path, MODEL2)
    scored = scoring.score_routed(_table(spark, requests), m1, m2, _campaigns(spark, campaigns, MODEL2), pct_model1, capture=True)
    scoring.append_inference_log(spark, scored, inference_table, run_id or _run_id("score"))
    return spark.table(inference_table)
