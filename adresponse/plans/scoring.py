"""Batch scoring, two-model routing and the inference log.

Scoring is map-only: the fitted pipeline adds column expressions and a tree
ensemble evaluation per row; the only join is the campaign lookup of model 2
(its key checked unique).  Routing assigns each request to a
model by a hash of its key, so each request is scored exactly once.  A model of
more than ``WALKED`` trees scores batches of rows (Arrow), tree by tree: Spark's
classifier walks the nodes of every tree for one row after the other.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pandas import NA
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, NumericType, StringType

from ..config import MISSING_NUMBER, ROUTE_SEED
from ..functions.cleaning import clean_frame, clean_gender, clean_number, clean_os, clean_traffic_source, parse_number_text
from ..functions.hashing import below
from ..operators.features import cast_features, lookup_features
from .boosting import with_probability
from .modeling import KEY, ClickModel, positive_probability

WALKED = 12  # trees that Spark's classifier walks row by row
MARKED_NUMBERS = ("age", "household_income")  # features whose number -1 means missing


def _missing(v) -> bool:
    return v is None or v is NA or (isinstance(v, float) and v != v)


def _as_text(v) -> str | None:
    if _missing(v):
        return None
    return str(v)


def _typed(values: list, declared: str, marker: bool) -> tuple[list, str]:
    """One feature's values and their Spark type.

    Features declared as text are text.  Others keep the type they come with:
    numbers are doubles (the cleaners then treat them as numbers), text stays
    text.  Where both come in one column, numbers are written as text, whole
    ones without a fraction, and the marker -1 as missing.
    """
    values = [v.item() if hasattr(v, "item") else v for v in values]
    texts = any(isinstance(v, str) for v in values)
    if declared == "string":
        return [_as_text(v) for v in values], "string"
    if not texts:
        return [None if _missing(v) else float(v) for v in values], "double"

    def written(v):
        if _missing(v) or isinstance(v, str):
            return _as_text(v) if isinstance(v, str) else None
        if marker and v == MISSING_NUMBER:
            return None
        return str(int(v)) if float(v).is_integer() else str(float(v))

    return [written(v) for v in values], "string"


def requests_frame(spark, payload, spec, key: str = "event_id") -> DataFrame:
    """M8: a request payload as a DataFrame, typed by its values.

    Accepts a DataFrame (returned as is), a pandas DataFrame, a list of
    records, or ``{"instances": [...]}``; any other shape is rejected.  A
    feature that no record has is a column of missing values.
    """
    if isinstance(payload, DataFrame):
        return payload
    if isinstance(payload, dict) and "instances" in payload:
        payload = payload["instances"]
    if isinstance(payload, pd.DataFrame):
        payload = payload.to_dict("records")
    if not isinstance(payload, list) or not all(isinstance(r, dict) for r in payload):
        raise TypeError("Invalid model input: expected a DataFrame, a list of records or {'instances': [...]}")
    columns, schema = [[int(r.get(key, i)) for i, r in enumerate(payload)]], [f"{key} bigint"]
    for f in spec.features:
        if f not in spec.lookup_features:
            values, kind = _typed([r.get(f) for r in payload], spec.feature_types[f], f in MARKED_NUMBERS)
            columns.append(values)
            schema.append(f"{f} {kind}")
    return spark.createDataFrame(list(zip(*columns)), ", ".join(schema))


def _by_kind(name: str, value: Column) -> Column:
    """A number feature of one JSON request: text by the text rules, a number by the number rules, else missing."""
    kind = F.schema_of_variant(value)
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    number = F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(value, "$", "double"))
    if name in MARKED_NUMBERS:
        return F.coalesce(clean_number(text, StringType()), clean_number(number, DoubleType()))
    if name == "traffic_source_id":
        return F.coalesce(clean_traffic_source(text, StringType()), clean_traffic_source(number, DoubleType()))
    return F.coalesce(parse_number_text(text), number)


def json_requests(requests: DataFrame, spec, column: str = "request", key: str = "event_id") -> DataFrame:
    """Requests that are JSON texts, one in a row, as the features that ``score`` takes with ``cleaned``.

    Every value is read by its own kind on the executors, so one column may
    hold numbers, text and nulls.  Numbers follow the number rules (-1 marks a
    missing age or income), text the text rules ("-1" is -1); true, false,
    lists and objects are missing where a number is asked.  A model with a
    look-up takes text, and cleans it itself.  A text that is no JSON, or
    null, is a request without any value.
    """
    doc = F.try_parse_json(F.col(column))
    cleaners = {} if spec.lookup_features else {"os_name": clean_os, "gender": clean_gender}
    out = []
    for f, declared in spec.feature_types.items():
        if f in spec.lookup_features:
            continue
        text = F.try_variant_get(doc, f"$.{f}", "string")
        if spec.lookup_features or (declared == "string" and f not in cleaners):
            c = text
        elif f in cleaners:
            c = cleaners[f](text, "serve")
        else:
            c = _by_kind(f, F.try_variant_get(doc, f"$.{f}", "variant"))
        out.append(c.alias(f))
    return requests.select(key, *out)


def check_requests(requests: DataFrame, model: ClickModel) -> None:
    """M7/M8: the request frame must carry every loaded feature."""
    if not isinstance(requests, DataFrame):
        raise TypeError("requests must be a DataFrame")
    need = [f for f in model.spec.features if f not in model.spec.lookup_features]
    missing = [f for f in need if f not in requests.columns]
    if missing:
        raise ValueError(f"requests lack features {missing}")
    wrong = [f for f in need if not isinstance(requests.schema[f].dataType, (NumericType, StringType))]
    if wrong:
        raise ValueError(f"requests hold neither numbers nor text in {wrong}")


def score(model: ClickModel, requests: DataFrame, campaigns: DataFrame | None = None,
          keys=("event_id",), capture: bool = False, cleaned: bool = False) -> DataFrame:
    """M5 (no lookup) / M6 (with lookup): ``keys + campaign_id, position, model_ctr, model_version``.

    ``capture`` adds the request as it came, as JSON (K8).  ``cleaned`` requests
    (of ``json_requests``) aren't cleaned again.
    """
    check_requests(requests, model)
    spec = model.spec
    as_sent = F.to_json(F.struct(*[c for c in requests.columns if c != "served_model"]))
    df = requests.withColumn("request", as_sent) if capture else requests
    if spec.lookup_features:
        loaded = {f: t for f, t in spec.feature_types.items() if f not in spec.lookup_features}
        df = lookup_features(cast_features(df, loaded), campaigns, names=spec.lookup_features)
    elif not cleaned:
        df = clean_frame(df, "serve")
    carried = [*[k for k in keys if k in requests.columns], "campaign_id", "position"]
    if model.n_trees > WALKED:
        for stage in model.pipeline.stages[:-1]:
            df = stage.transform(df)
        out = with_probability(model.pipeline.stages[-1], df, *dict.fromkeys([*carried, *(["request"] if capture else [])]), p="model_ctr")
    else:
        out = model.pipeline.transform(df).withColumn("model_ctr", positive_probability())
    return out.select(
        *carried,
        "model_ctr",
        F.lit(model.version_tag).alias("model_version"),
        *(["request"] if capture else []),
    )


def route(requests: DataFrame, pct_model1: float, key: str = "event_id", seed: int = ROUTE_SEED) -> DataFrame:
    """M9: ``served_model`` = MODEL1 for about pct_model1 % of keys, else MODEL2."""
    return requests.withColumn(
        "served_model",
        F.when(below(key, seed, pct_model1 / 100.0), F.lit("MODEL1")).otherwise(F.lit("MODEL2")),
    )


def _assembled(model: ClickModel, df: DataFrame, campaigns: DataFrame | None, carried: list, number: int) -> DataFrame:
    """``df`` with what model ``number`` makes of its own requests: the feature vector, campaign and position.

    Requests of the other model pass as rows of missing values, which ask no
    look-up anything.
    """
    spec = model.spec
    loaded = [f for f in spec.features if f not in spec.lookup_features]
    own = F.col("served_model") == f"MODEL{number}"
    rows = df.select(*carried, *[F.when(own, F.col(f"__sent.`{f}`")).alias(f) for f in loaded])
    if spec.lookup_features:
        rows = lookup_features(cast_features(rows, {f: spec.feature_types[f] for f in loaded}), campaigns, names=spec.lookup_features)
    else:
        rows = clean_frame(rows, "serve")
    for stage in model.pipeline.stages[:-1]:
        rows = stage.transform(rows)
    made = {"features": f"__features{number}", "campaign_id": f"__campaign{number}", "position": f"__position{number}"}
    return rows.select(*carried, *[F.col(c).alias(out) for c, out in made.items()])


def score_routed(requests: DataFrame, model1: ClickModel, model2: ClickModel, campaigns: DataFrame,
                 pct_model1: float = 50.0, key: str = "event_id", capture: bool = False) -> DataFrame:
    """Route (unless ``requests`` are routed) and score each request with its model, in one pass over them.

    Both models' features are put beside each other first; the trees of both
    then stand in one projection under the route's condition, so a request is
    read once and runs through the trees of its own model alone.  Models of
    many trees score batches, in which the other model's requests are NULL.
    """
    check_requests(requests, model1)
    check_requests(requests, model2)
    sent = [c for c in requests.columns if c != "served_model"]
    routed = requests if "served_model" in requests.columns else route(requests, pct_model1, key)
    carried = list(dict.fromkeys([key, *[c for c in (KEY,) if c in sent], "served_model", "__sent", *(["__request"] if capture else [])]))
    held = list(dict.fromkeys(f for m in (model1, model2) for f in m.spec.features if f not in m.spec.lookup_features))
    own = {"__sent": F.struct(*[F.col(f"`{f}`") for f in held])}
    if capture:
        own["__request"] = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sent]))
    df = routed.where(F.col("served_model").isin("MODEL1", "MODEL2")).withColumns(own).select(*carried)
    df = _assembled(model1, df, None, carried, 1)
    carried = df.columns
    df = _assembled(model2, df, campaigns, carried, 2)
    df, p = df.drop("__sent"), {}
    for n, model in ((1, model1), (2, model2)):
        trees = model.pipeline.stages[-1]
        if model.n_trees > WALKED:
            p[n], others = F.col(f"__p{n}"), [c for c in df.columns if c != f"__features{n}"]
            own = df.withColumn(f"__features{n}", F.when(F.col("served_model") == f"MODEL{n}", F.col(f"__features{n}")))
            df = with_probability(trees, own, *others, features=f"__features{n}", p=f"__p{n}")
            continue
        p[n] = positive_probability(f"__probability{n}")
        df = trees.transform(df, {trees.featuresCol: f"__features{n}", trees.rawPredictionCol: f"__raw{n}",
                                  trees.probabilityCol: f"__probability{n}", trees.predictionCol: f"__prediction{n}"})
    first = F.col("served_model") == "MODEL1"
    return df.select(
        key,
        F.when(first, F.col("__campaign1")).otherwise(F.col("__campaign2")).alias("campaign_id"),
        F.when(first, F.col("__position1")).otherwise(F.col("__position2").try_cast("int")).alias("position"),
        F.when(first, p[1]).otherwise(p[2]).alias("model_ctr"),
        F.when(first, F.lit(model1.version_tag)).otherwise(F.lit(model2.version_tag)).alias("model_version"),
        *([F.col("__request").alias("request")] if capture else []),
        "served_model",
    )


def inference_log(scored: DataFrame) -> DataFrame:
    """K8: scored rows stamped with the scoring time in UTC (append to a log table)."""
    return scored.withColumn("scored_at", F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()))


def append_inference_log(spark, scored: DataFrame, table: str, run_id: str, path: str | None = None) -> None:
    """K8: the run's rows in the log table, a partition of their own.

    The write replaces exactly that partition, so a run that is repeated under
    its id leaves its rows once.
    """
    rows = inference_log(scored)
    if not spark.catalog.tableExists(table):
        w = rows.withColumn("run_id", F.lit(run_id)).limit(0).write.format("parquet").partitionBy("run_id")
        (w.option("path", path) if path else w).saveAsTable(table)
    if "run_id" not in spark.table(table).columns:
        raise ValueError(f"{table} has no run_id to log by")
    view = f"adresponse_scored_{uuid.uuid4().hex}"
    rows.select(*[c for c in spark.table(table).columns if c != "run_id"]).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = :run_id) SELECT * FROM {view}", {"run_id": run_id})
    finally:
        spark.catalog.dropTempView(view)
    spark.catalog.refreshTable(table)
