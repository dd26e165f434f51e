"""Click models on Spark ML.

Flow (both models, all on executors, nothing collected but the fitted trees
and the number of categories of each feature):

    training rows --load window--> prepare (model 1: clean; model 2: cast to
    text + campaign lookup) --> augment (blanked copies) --> is_test flag
    --> cleaner -> caster -> dictionary, or target rates for wide features
    (fit on the train side only) -> missing fill -> assembler --> boosted
    trees, stopped by the loss of a part of the train side that no tree sees.

The fitted ``PipelineModel`` holds every stage, so scoring applies exactly
the training-time cleaning and encoding.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import VERSION_PREFIX, BoostParams, ModelSpec, WINDOW_DAYS
from ..functions.cleaning import clean_frame
from ..operators.encoding import CODE_SUFFIX, dictionary_sizes, fit_counts, present
from ..operators.features import cast_features, lookup_features, select_loaded
from ..operators.ingest import in_window, recent
from ..operators.rates import RATE_SUFFIX, fit_rates
from ..operators.sampling import augment_nulls, is_test, is_validation
from ..session import checkpoint_dir
from .boosting import MAX_BINS, boost, with_probability
from .stages import DictionaryEncoder, FeatureCaster, MissingFill, RateEncoder, RowCleaner

EPS = 1e-15
KEY = "event_id"


# ---------------------------------------------------------------------------
# data preparation
# ---------------------------------------------------------------------------
def load_window(training: DataFrame, as_of=None, days: int = WINDOW_DAYS) -> DataFrame:
    """S3: ``SELECT * FROM training WHERE timestamp > as_of - 22 days``."""
    return recent(training, as_of, days).where(in_window(as_of, days))


def prepare(training: DataFrame, spec: ModelSpec, campaigns: DataFrame | None = None,
            augment: bool = True) -> DataFrame:
    """Rows the model trains on: key, features, label, variant, is_test."""
    if spec.lookup_features:
        loaded = {f: t for f, t in spec.feature_types.items() if f not in spec.lookup_features}
        df = select_loaded(cast_features(training, loaded), spec, keys=(KEY,))
        if campaigns is None:
            raise ValueError(f"{spec.name} needs the campaign feature table")
        df = lookup_features(df, campaigns, names=spec.lookup_features)
    else:
        df = clean_frame(training, spec.clean_policy).select(
            KEY, *spec.features, F.col(spec.label).cast(spec.label_type).alias(spec.label)
        )
    df = augment_nulls(df) if augment else df.withColumn("variant", F.lit(0))
    return df.withColumn("is_test", is_test(KEY))


def materialize(df: DataFrame, partitions: int = 8) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    The prepared frame feeds the dictionary fit, the feature assembly, the
    boosting passes and the evaluation; without this the scan + identity
    join + augmentation would run again for each.  A reliable checkpoint (not a local one) survives the
    loss of the executors that computed it.

    Boosting samples rows by their place, so the layout - ``partitions`` by
    key, sorted - depends on the data alone and not on the cluster; a job
    takes the count from its input's size.
    """
    checkpoint_dir(df.sparkSession)
    order = [c for c in (KEY, "variant") if c in df.columns]
    if KEY in df.columns:
        df = df.repartition(partitions, KEY).sortWithinPartitions(*order)
    return df.checkpoint(eager=True)


def layout(input_bytes: int | None, per_partition: int = 128 << 20) -> int:
    """Partitions of a prepared frame, from the size of its input."""
    return max(8, -(-(input_bytes or 0) // per_partition))


def request_signature(spec: ModelSpec) -> str:
    """M7: the request contract (loaded features and their types)."""
    loaded = {f: t for f, t in spec.feature_types.items() if f not in spec.lookup_features}
    return ", ".join(f"{f} {t}" for f, t in loaded.items())


def model_types(spec: ModelSpec) -> dict:
    """Categorical features keep their declared type; numeric ones are doubles."""
    return {f: (spec.feature_types[f] if f in spec.categorical else "double") for f in spec.features}


# ---------------------------------------------------------------------------
# metrics
# ---------------------------------------------------------------------------
def positive_probability(col: str = "probability") -> Column:
    """P(click) from the probability vector."""
    return vector_to_array(F.col(col))[1]


def log_loss(label: Column, p: Column, eps: float = EPS) -> Column:
    """A4 per row: -(y ln p + (1-y) ln(1-p)), p clipped to [eps, 1-eps]."""
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    y = label.cast("double")
    return -(y * F.log(q) + (1 - y) * F.log(1 - q))


def split_name() -> Column:
    return F.when(F.col("is_test"), F.lit("test")).otherwise(F.lit("train"))


# ---------------------------------------------------------------------------
# fitting
# ---------------------------------------------------------------------------
@dataclass
class ClickModel:
    spec: ModelSpec
    pipeline: PipelineModel
    params: BoostParams
    run_id: str
    fit_seconds: float = 0.0
    trees_fitted: int = 0

    @property
    def version_tag(self) -> str:
        """P12."""
        return f"{VERSION_PREFIX}{self.spec.name} - {self.run_id}"

    @property
    def n_trees(self) -> int:
        return len(self.pipeline.stages[-1].trees)


def feature_stages(prepared: DataFrame, spec: ModelSpec, widest: int = MAX_BINS - 1) -> list:
    """Cleaner, caster, codes, rates (of features with more than ``widest`` categories), fill, assembler.

    Everything is learnt from the train side only.
    """
    cleaner = RowCleaner(spec.clean_policy)
    caster = FeatureCaster(model_types(spec))
    train = caster.transform(cleaner.transform(prepared)).where(~F.col("is_test"))
    counts = fit_counts(train, spec.categorical, spec.numeric_order)
    sizes = dictionary_sizes(counts, present(train, spec.categorical))
    narrow = [f for f, n in sizes.items() if n <= widest]
    wide = {f: n for f, n in sizes.items() if n > widest}
    stages = [cleaner, caster, DictionaryEncoder.fitted(counts.where(F.col("feature").isin(narrow)), narrow)]
    if wide:
        stages.append(RateEncoder.fitted(fit_rates(train, list(wide), spec.label, KEY), wide, KEY))
    filler = MissingFill(list(spec.numeric))
    inputs = (
        [f + CODE_SUFFIX for f in narrow]
        + [f + RATE_SUFFIX for f in wide]
        + [f + "_filled" for f in spec.numeric]
        + [f + "_missing" for f in spec.numeric]
    )
    return [*stages, filler, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")]


def assembled(prepared: DataFrame, stages: list, spec: ModelSpec) -> DataFrame:
    """Features, label and the sides: the trees' rows, those that say when to stop, and the test side."""
    out = PipelineModel(stages=stages).transform(prepared).withColumn("is_valid", is_validation(KEY) & ~F.col("is_test"))
    return out.select("features", spec.label, "is_test", "is_valid", (~F.col("is_test") & ~F.col("is_valid")).alias("is_fit"))


def fit(prepared: DataFrame, spec: ModelSpec, params: BoostParams | None = None,
        run_id: str | None = None, widest: int = MAX_BINS - 1) -> ClickModel:
    """Fit one click model; only the assembled features are kept in memory."""
    params = params or BoostParams()
    run_id = run_id or _dt.datetime.now().strftime("run-%Y%m%d%H%M%S")
    stages = feature_stages(prepared, spec, widest)
    feats = assembled(prepared, stages, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        t0 = time.time()
        boosted = boost(feats, spec.label, params)
        secs = time.time() - t0
    finally:
        feats.unpersist()
    return ClickModel(spec, PipelineModel(stages=stages + [boosted.model]), params, run_id, secs, boosted.fitted)


def evaluate(model: ClickModel, prepared: DataFrame) -> DataFrame:
    """M4: log-loss and rows per split, one aggregation over the scored rows."""
    made = prepared
    for stage in model.pipeline.stages[:-1]:
        made = stage.transform(made)
    scored = with_probability(model.pipeline.stages[-1], made, model.spec.label, "is_test")
    p = F.col("p")
    return scored.groupBy(split_name().alias("split")).agg(
        F.avg(log_loss(F.col(model.spec.label), p)).alias("log_loss"),
        F.count(F.lit(1)).alias("rows"),
    )


def fit_summary(model: ClickModel, evaluation: DataFrame) -> DataFrame:
    """One row per split: trees used, loss, rows, fit time and settings."""
    return evaluation.select(
        F.lit(model.spec.name).alias("model"),
        "split",
        F.round("log_loss", 6).alias("log_loss"),
        "rows",
        F.lit(model.n_trees).alias("trees"),
        F.lit(int(model.params.max_depth)).alias("max_depth"),
        F.lit(round(model.fit_seconds, 3)).alias("fit_seconds"),
    )


def metrics(model: ClickModel, evaluation: DataFrame) -> dict:
    """K9 payload: losses, settings, types and scheme names (run-log keys)."""
    rows = {r["split"]: r["log_loss"] for r in evaluation.collect()}
    n = model.spec.name
    return {
        f"{n}_version": "1",
        f"{n}_hyperparams": model.params.as_dict(),
        f"{n}_test_log_loss": str(rows.get("test")),
        f"{n}_train_log_loss": str(rows.get("train")),
        f"{n}_training_duration": str(_dt.timedelta(seconds=model.fit_seconds)),
        f"{n}_training_run_id": model.run_id,
        f"{n}_features_types": model_types(model.spec),
        f"{n}_encoding_scheme": "dictionary(alphabetic/numeric order, keep); out-of-fold rates of wide features",
        f"{n}_scaling_strategy": "None",
        f"{n}_trees": str(model.n_trees),
        f"{n}_signature": request_signature(model.spec),
    }


# ---------------------------------------------------------------------------
# persistence (K6, K7)
# ---------------------------------------------------------------------------
def save(model: ClickModel, spark: SparkSession, path: str, examples: DataFrame | None = None) -> None:
    """K6: pipeline (stages incl. dictionary and trees), metadata, input examples (M7)."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    if examples is not None:
        examples.coalesce(1).write.mode("overwrite").json(f"{path}/input_example")
    meta = spark.createDataFrame(
        [(model.spec.name, model.run_id, json.dumps(model.params.as_dict(), sort_keys=True), float(model.fit_seconds))],
        "model string, run_id string, params string, fit_seconds double",
    )
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load(spark: SparkSession, path: str, spec: ModelSpec) -> ClickModel:
    """K7."""
    pipeline = PipelineModel.load(f"{path}/pipeline")
    m = spark.read.json(f"{path}/meta").first()
    params = BoostParams.from_dict(json.loads(m["params"]))
    return ClickModel(spec, pipeline, params, m["run_id"], m["fit_seconds"])
