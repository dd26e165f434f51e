"""Hyper-parameter search (M3).

Random draws from the original search ranges (seeded), each judged by the
log-loss of the validation rows, which no tree sees; the test side judges
nothing and only reports each trial's loss.  The feature stages and the assembled frame are
built once; only the boosters differ between trials, and up to
``parallelism`` of them train at the same time as concurrent Spark jobs.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEARCH_EVALS, SEARCH_PARALLELISM, SEARCH_SPACE, BoostParams, ModelSpec
from .boosting import boost, with_probability
from .modeling import assembled, feature_stages, log_loss


def draw(n: int, seed: int = 0, space: dict = SEARCH_SPACE) -> list[BoostParams]:
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        d = {}
        for name, (lo, hi, kind) in space.items():
            if kind == "loguniform":
                d[name] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
            elif kind == "quniform":
                d[name] = int(round(rng.uniform(lo, hi)))
            else:
                d[name] = float(rng.uniform(lo, hi))
        out.append(BoostParams.from_dict(d))
    return out


def search(spark: SparkSession, prepared: DataFrame, spec: ModelSpec, n_evals: int = SEARCH_EVALS,
           parallelism: int = SEARCH_PARALLELISM, seed: int = 0, candidates=None) -> DataFrame:
    """Trials table ``(trial, <params>, trees, valid_log_loss, test_log_loss)``; the lowest validation loss wins."""
    candidates = candidates or draw(n_evals, seed)
    feats = assembled(prepared, feature_stages(prepared, spec), spec).persist(StorageLevel.MEMORY_AND_DISK)

    def run(i_params):
        i, params = i_params
        m = boost(feats, spec.label, params).model
        loss = log_loss(F.col(spec.label), F.col("p"))
        losses = with_probability(m, feats.where("not is_fit"), spec.label, "is_valid", "is_test").agg(
            F.avg(F.when(F.col("is_valid"), loss)).alias("valid"), F.avg(F.when(F.col("is_test"), loss)).alias("test")
        ).first()
        return (i, params, len(m.trees), losses["valid"], losses["test"])

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            results = list(pool.map(run, enumerate(candidates)))
    finally:
        feats.unpersist()
    rows = [
        (i, p.n_estimators, p.max_depth, p.learning_rate, p.subsample, p.colsample_bytree,
         p.early_stopping_rounds, trees, valid, test)
        for i, p, trees, valid, test in results
    ]
    return spark.createDataFrame(
        rows,
        "trial int, n_estimators int, max_depth int, learning_rate double, subsample double, "
        "colsample_bytree double, early_stopping_rounds int, trees int, valid_log_loss double, test_log_loss double",
    )


def best(trials: DataFrame) -> BoostParams:
    r = trials.orderBy(F.col("valid_log_loss").asc_nulls_last(), "trial").first()
    return BoostParams.from_dict(r.asDict())
