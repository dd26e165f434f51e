"""Dictionaries ranked without one task per feature, look-ups of any width, target rates, one-run boosting."""

import random

import pytest
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from adresponse.config import MODEL1, BoostParams
from adresponse.operators import encoding, joins, rates
from adresponse.plans import boosting, modeling, scoring, stages
from tests.test_modeling import SMALL, learnable_training


def plan(df):
    return df._jdf.queryExecution().toString()


def test_dense_codes_over_many_partitions(spark):
    rng = random.Random(2)
    rows = [("a", None, f"c{i:04d}") for i in range(900)] + [("b", float(rng.randrange(10**6)), f"x{i}") for i in range(900)] + [("c", None, "only")]
    rng.shuffle(rows)
    values = spark.createDataFrame(rows, "feature string, num double, category string").withColumn("n", F.lit(1).cast("long"))
    got = {(r.feature, r.category): r.code for r in encoding.dense_codes(values.repartition(7)).collect()}
    for f in "abc":
        own = sorted({(n is None, n or 0.0, c) for g, n, c in rows if g == f})
        assert [got[f, c] for _, _, c in own] == list(range(len(own)))
    assert "Window" not in plan(encoding.dense_codes(values))
    assert encoding.dense_codes(values.limit(0)).count() == 0


@pytest.fixture()
def small_rows(monkeypatch):
    monkeypatch.setattr(joins, "SMALL_ROWS", 10)


def hot_frame(spark, n=6000):
    """A third of the rows on one value, a tenth without one, the rest on many."""
    value = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("v"), F.col("id") % 500))
    return spark.range(n).select(F.col("id").alias("event_id"), value.alias("c"))


def test_wide_look_up_is_the_narrow_one(spark, small_rows, monkeypatch):
    df = hot_frame(spark)
    counts = encoding.fit_counts(df.where("event_id % 7 <> 0"), ["c"])
    encoder = stages.DictionaryEncoder.fitted(counts, ["c"])
    wide = encoder.transform(df)
    assert "__asks" in plan(wide) and "__asks" not in plan(df)
    got = {r.event_id: r.c_idx for r in wide.collect()}
    monkeypatch.setattr(joins, "SMALL_ROWS", 10**6)
    assert got == {r.event_id: r.c_idx for r in encoder.transform(df).collect()}
    size = encoder.sizes["c"]
    assert got[1] == size and max(got.values()) == size  # no value: the last index


def test_hot_values_are_spread(spark, small_rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = hot_frame(spark, 24000)
        encoder = stages.DictionaryEncoder.fitted(encoding.fit_counts(df, ["c"]), ["c"])
        sizes = [r["n"] for r in encoder.transform(df).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[4]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_encoders_save_and_load(spark, scratch):
    df = hot_frame(spark).withColumn("click", (F.col("event_id") % 4 == 0).cast("int")).withColumn("is_test", F.col("event_id") % 5 == 0)
    train = df.where("not is_test")
    counts = encoding.fit_counts(train, ["c"])
    rated = stages.RateEncoder.fitted(rates.fit_rates(train, ["c"], "click", "event_id"), encoding.dictionary_sizes(counts, ["c"]), "event_id")
    model = PipelineModel(stages=[stages.DictionaryEncoder.fitted(counts, ["c"]), rated])
    model.write().overwrite().save(f"{scratch}/p")
    back = PipelineModel.load(f"{scratch}/p")
    assert sorted(back.transform(df).collect()) == sorted(model.transform(df).collect())


def test_rates_never_see_their_own_click(spark):
    df = hot_frame(spark, 3000).withColumn("click", (F.hash("event_id") % 3 == 0).cast("int")).withColumn("is_test", F.col("event_id") % 5 == 0)
    rows = [r.asDict() for r in df.withColumn("fold", rates.fold("event_id")).collect()]
    state = rates.fit_rates(df.where("not is_test"), ["c"], "click", "event_id")
    encoder = stages.RateEncoder.fitted(state, {"c": 501}, "event_id")
    got = {r.event_id: r.c_rate for r in encoder.transform(df).collect()}
    train = [r for r in rows if not r["is_test"]]
    for r in rows[:400]:
        others = train if r["is_test"] else [t for t in train if t["fold"] != r["fold"]]
        prior = sum(t["click"] for t in others) / len(others)
        own = [t["click"] for t in others if r["c"] is not None and t["c"] == r["c"]]
        assert got[r["event_id"]] == pytest.approx((sum(own) + rates.PRIOR_ROWS * prior) / (len(own) + rates.PRIOR_ROWS))
    # without is_test: all sums, and the common rate for what is new or missing
    fresh = spark.createDataFrame([(1, "new"), (2, None)], "event_id long, c string")
    common = sum(t["click"] for t in train) / len(train)
    assert [r.c_rate for r in encoder.transform(fresh).collect()] == pytest.approx([common, common])


def test_a_million_categories_fit_and_score(spark):
    """Half of the rows on ids that say much, the others on ids of their own; bins don't follow the data."""
    n = 1_000_000
    few, own = F.concat(F.lit("f"), F.col("id") % 50), F.concat(F.lit("u"), F.col("id"))
    df = spark.range(2 * n, numPartitions=8).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, few).otherwise(own).alias("c"),
        ((F.col("id") % 50 < 20) & (F.col("id") % 2 == 0)).cast("int").alias("click"),
        (F.col("id") % 10 == 0).alias("is_test"),
    ).persist()
    train = df.where("not is_test")
    sizes = {"c": train.select("c").distinct().count()}
    assert sizes["c"] > 900_000
    encoder = stages.RateEncoder.fitted(rates.fit_rates(train, ["c"], "click", "event_id"), sizes, "event_id")
    feats = PipelineModel(stages=[encoder, VectorAssembler(inputCols=["c_rate"], outputCol="features")]).transform(df)
    feats = feats.select("features", "click", (F.col("event_id") % 10 == 1).alias("is_valid"), (F.col("event_id") % 10 > 1).alias("is_fit"))
    boosted = boosting.boost(feats, "click", BoostParams(n_estimators=2, max_depth=2, early_stopping_rounds=1))
    scored = boosted.model.transform(feats.where("is_valid")).select("click", modeling.positive_probability().alias("p"))
    assert scored.count() == 2 * n // 10 and scored.where("p is null").count() == 0
    df.unpersist()


def test_wide_features_of_a_model_become_rates(spark, scratch):
    t = learnable_training(spark)
    prepared = modeling.prepare(t, MODEL1)
    model = modeling.fit(prepared, MODEL1, SMALL, run_id="w1", widest=20)
    assert [type(s).__name__ for s in model.pipeline.stages[2:4]] == ["DictionaryEncoder", "RateEncoder"]
    assert "campaign_id" in model.pipeline.stages[3].sizes and "os_name" in model.pipeline.stages[2].sizes
    modeling.save(model, spark, f"{scratch}/m")
    back = modeling.load(spark, f"{scratch}/m", MODEL1)
    a = {r.event_id: r.model_ctr for r in scoring.score(model, t).collect()}
    assert a == {r.event_id: r.model_ctr for r in scoring.score(back, t).collect()} and len(a) > 100


def boosting_frame(spark, n=3000):
    """A label that many small trees learn: the sum of six features."""
    names = [f"x{i}" for i in range(6)]
    x = spark.range(n, numPartitions=2).select("id", *[F.rand(10 + i).alias(c) for i, c in enumerate(names)])
    x = x.withColumn("click", (sum(F.col(c) for c in names) > 3).cast("int"))
    out = VectorAssembler(inputCols=names, outputCol="features").transform(x)
    return out.select("features", "click", (F.col("id") % 5 == 0).alias("is_valid"), (F.col("id") % 5 > 0).alias("is_fit")).checkpoint()


def test_one_run_equals_a_straight_fit(spark):
    feats = boosting_frame(spark)
    params = BoostParams(n_estimators=11, max_depth=2, learning_rate=0.3, subsample=0.9, colsample_bytree=1.0, early_stopping_rounds=3)
    run = boosting.boost(feats, "click", params, opening=3)
    kept = len(run.model.trees)
    assert run.fitted <= kept + 3 + boosting.CHUNK and run.losses[kept - 1] == min(run.losses) and kept > 5
    # where a run ends changes none of its trees
    short = boosting.boost(feats, "click", BoostParams(**{**params.__dict__, "n_estimators": 7}), opening=3)
    assert short.losses == run.losses[:7]
    # the losses are those of the model cut there
    loss = run.model.transform(feats.where("is_valid")).agg(F.avg(modeling.log_loss(F.col("click"), modeling.positive_probability()))).first()[0]
    assert loss == pytest.approx(run.losses[kept - 1])


def test_a_tree_takes_one_pass_a_level(spark):
    """Rows are cut into bins once: a further tree costs as many Spark jobs as it has levels."""
    feats = boosting_frame(spark)
    params = dict(max_depth=3, learning_rate=0.1, subsample=0.9, colsample_bytree=0.7, early_stopping_rounds=9)
    jobs = {}
    for n in (4, 9):
        spark.sparkContext.setJobGroup(f"boost-{n}", "trees")
        assert boosting.boost(feats, "click", BoostParams(n_estimators=n, **params), opening=1).fitted == n
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boost-{n}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[9] - jobs[4] <= 5 * 3


def test_trees_split_categories_and_numbers_as_spark_reads_them(spark):
    """The sums of the passes choose the best split; the model's own scores are those of the evaluation."""
    x = spark.range(4000).select(
        (F.col("id") % 7).cast("double").alias("c", metadata={"ml_attr": {"type": "nominal", "num_vals": 7, "name": "c"}}),
        F.rand(3).alias("x"), (F.col("id") % 5 == 0).alias("is_valid"), (F.col("id") % 5 > 0).alias("is_fit"))
    x = x.withColumn("click", (F.col("c").isin(1, 4, 6) | (F.col("x") > 0.9)).cast("int"))
    feats = VectorAssembler(inputCols=["c", "x"], outputCol="features").transform(x).checkpoint()
    model = boosting.boost(feats, "click", BoostParams(n_estimators=3, max_depth=2, subsample=1.0, colsample_bytree=1.0)).model
    first = model.trees[0].toDebugString
    assert "feature 0 in {1.0,4.0,6.0}" in first or "feature 0 in {0.0,2.0,3.0,5.0}" in first
    own = [r.p for r in model.transform(feats).orderBy("click", "x").select(modeling.positive_probability().alias("p")).collect()]
    scored = boosting.with_probability(model, feats, "click", "x")
    assert "MapInArrow" in plan(scored)
    assert [r.p for r in scored.orderBy("click", "x").collect()] == pytest.approx(own, abs=1e-12)
    means = {bool(r.click): r.p for r in scored.groupBy("click").agg(F.avg("p").alias("p")).collect()}
    assert means[True] > 0.8 and means[False] < 0.3


def test_passes_are_data_frames_that_send_one_row(spark, monkeypatch):
    """Many blocks and tasks give the trees of one block; the caller's session keeps its settings."""
    feats, passes, own = boosting_frame(spark), [], boosting._summed
    params = BoostParams(n_estimators=3, max_depth=2, learning_rate=0.3, subsample=1.0, colsample_bytree=1.0, early_stopping_rounds=3)
    whole = boosting.boost(feats, "click", params)

    def seen(blocks, *args):
        passes.append((type(blocks), blocks.select(F.spark_partition_id()).distinct().count() if not passes else None))
        return own(blocks, *args)

    monkeypatch.setattr(boosting, "_summed", seen)
    monkeypatch.setattr(boosting, "BLOCK", 100)
    cut = boosting.boost(feats, "click", params)
    assert len(passes) == 3 * 2 + 1 and {kind for kind, _ in passes} == {type(feats)} and passes[0][1] > 1
    assert [t.toDebugString.split("\n", 1)[1] for t in cut.model.trees] == [t.toDebugString.split("\n", 1)[1] for t in whole.model.trees]
    assert cut.losses == pytest.approx(whole.losses, rel=1e-12)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_without_rows_to_stop_on_all_trees_are_kept(spark):
    feats = boosting_frame(spark, 400).withColumn("is_valid", F.lit(False))
    assert len(boosting.boost(feats, "click", BoostParams(n_estimators=3, max_depth=2)).model.trees) == 3


def test_rates_query_joins_the_identities_once(spark, scratch):
    """The rows to encode are read from what the first pass wrote, not joined with the identity table again."""
    import __spark_entry__ as E

    events = spark.range(60).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id % 48) AS ts", "id % 7 AS user_id",
        "if(id % 3 = 0, 'click', 'purchase') AS event_type", "id * 1.5D AS value", """concat('{"k": ', id % 4, '}') AS props""")
    events.write.parquet(f"{scratch}/events.parquet")
    people = spark.range(7).selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "int(id) AS c_nationkey", "id * 10D AS c_acctbal", "'x' AS c_mktsegment")
    people.write.parquet(f"{scratch}/customer.parquet")
    out = E.queries()["m1_target_rates"](spark, scratch)
    read = [f for f in out.inputFiles() if "customer.parquet" in f]
    kept = E.queries()["e1_model1_frame"](spark, scratch)
    assert not read and "customer.parquet" not in plan(out) and "customer.parquet" in plan(kept)
    assert out.count() == kept.count() > 20 and out.where("campaign_id_rate IS NULL OR traffic_source_id_rate IS NULL").count() == 0


def test_tasks_that_hold_their_rows_fit_the_trees_of_the_passes(spark, monkeypatch):
    """One job for many trees: the same trees and losses, with more tasks than blocks and from job to job."""
    x = boosting_frame(spark).withColumn("c", (F.rand(5) * 7).cast("int").cast("double"))
    c = F.col("c").alias("c", metadata={"ml_attr": {"type": "nominal", "num_vals": 7, "name": "c"}})
    feats = VectorAssembler(inputCols=["features", "c"], outputCol="all").transform(x.select("features", "click", "is_valid", "is_fit", c))
    feats = feats.select(F.col("all").alias("features"), "click", "is_valid", "is_fit").checkpoint()
    params = BoostParams(n_estimators=7, max_depth=4, learning_rate=0.3, subsample=0.8, colsample_bytree=0.7, early_stopping_rounds=3)
    monkeypatch.setattr(boosting, "BLOCK", 700)
    passes = boosting.boost(feats, "click", params)
    monkeypatch.setattr(boosting, "HOLD", 1)
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 1000)
    monkeypatch.setattr(boosting, "JOINT", 200)
    monkeypatch.setattr(boosting, "_run", None)
    sent = cloudpickle.dumps(boosting._holder(None, "/x", boosting.Bins([0], [[]]), params, 3, 7, 3, True))
    assert b"adresponse.config" not in sent  # executors need no copy of the package
    for trees in (50, 3):
        monkeypatch.setattr(boosting, "RELIABLE", trees)
        spark.sparkContext.setJobGroup(f"held-{trees}", "trees")
        held = boosting.boost(feats, "click", params)
        assert held.losses == passes.losses and len(held.losses) == 7
        assert [t.toDebugString.split("\n", 1)[1] for t in held.model.trees] == [t.toDebugString.split("\n", 1)[1] for t in passes.model.trees]
    jobs = [len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"held-{trees}")) for trees in (50, 3)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[1] - jobs[0] <= 4
