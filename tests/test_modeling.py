"""Model fitting, evaluation, persistence, scoring, routing, tuning, run log."""

import math

import pytest
from pyspark.sql import functions as F

from adresponse.config import MODEL1, MODEL2, BoostParams
from adresponse.operators import ingest, runlog
from adresponse.plans import boosting, modeling, scoring, tuning
from adresponse.plans.context import FIXTURE_SPEC
from adresponse.sources import tables

SF001 = "/root/testdata/sf0.01"
SMALL = BoostParams(n_estimators=10, max_depth=3, learning_rate=0.3, subsample=1.0, colsample_bytree=1.0)


def learnable_training(spark, sf_dir=SF001):
    """FIXTURES.md 'learnable' variant: clicks depend on the OS (user_id % 8)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    click = (F.col("user_id") % 8).isin(0, 1) & (F.col("event_id") % 3 != 0)
    ev = ev.withColumn("event_type", F.when(click, F.lit("click")).otherwise(F.lit("purchase")))
    imp = tables.impressions_from_events(ev)
    as_of = imp.select(F.max("timestamp")).scalar()
    return ingest.training_rows(imp, tables.identity(spark, sf_dir), as_of, FIXTURE_SPEC)


@pytest.fixture(scope="module")
def m1(spark):
    prepared = modeling.prepare(learnable_training(spark), MODEL1)
    return modeling.fit(prepared, MODEL1, SMALL, run_id="t1"), prepared


def test_model_beats_constant_rate(spark, m1):
    model, prepared = m1
    ev = {r.split: r.log_loss for r in modeling.evaluate(model, prepared).collect()}
    rate = prepared.where(~F.col("is_test")).agg(F.avg("click")).first()[0]
    const = (
        prepared.where(F.col("is_test"))
        .agg(F.avg(modeling.log_loss(F.col("click"), F.lit(rate))))
        .first()[0]
    )
    assert ev["test"] < 0.8 * const
    assert model.n_trees >= 2


def test_save_load_same_scores(spark, m1, scratch):
    model, prepared = m1
    modeling.save(model, spark, f"{scratch}/m1")
    back = modeling.load(spark, f"{scratch}/m1", MODEL1)
    a = scoring.score(model, learnable_training(spark)).select("event_id", "model_ctr")
    b = scoring.score(back, learnable_training(spark)).select("event_id", F.col("model_ctr").alias("b"))
    j = a.join(b, "event_id")
    assert j.count() == a.count()
    assert j.where(F.abs(F.col("model_ctr") - F.col("b")) > 1e-12).count() == 0
    assert back.run_id == "t1" and back.pipeline.stages[2].sizes == model.pipeline.stages[2].sizes


def test_blanked_request_scores_finite(spark, m1):
    model, _ = m1
    req = spark.createDataFrame(
        [(1, None, None, None, None, None, None, None, None, None), (2, "NA", "7", "p1", "abc", "", "-1", 5, "x", 3)],
        "event_id long, gender string, campaign_id string, traffic_partner_id string, traffic_source_id string, "
        "os_name string, age string, hour int, household_income string, position int",
    )
    out = scoring.score(model, req).collect()
    assert len(out) == 2
    assert all(0.0 < r.model_ctr < 1.0 and math.isfinite(r.model_ctr) for r in out)
    assert all(r.model_version == "adflow_click_MODEL1 - t1" for r in out)


def test_request_contract(spark, m1):
    model, _ = m1
    with pytest.raises(ValueError):
        scoring.score(model, spark.createDataFrame([(1,)], "event_id long"))


def test_model2_lookup_and_routing(spark, m1, scratch):
    model1, _ = m1
    t = learnable_training(spark)
    camp = tables.campaign_features(spark, SF001)
    prepared = modeling.prepare(t, MODEL2, camp)
    assert {"vertical", "subvertical"} <= set(prepared.columns)
    model2 = modeling.fit(prepared, MODEL2, SMALL, run_id="t2")
    routed = scoring.score_routed(t, model1, model2, camp, pct_model1=30.0)
    counts = {r.served_model: r["count"] for r in routed.groupBy("served_model").count().collect()}
    assert sum(counts.values()) == t.count()
    assert 0.2 < counts["MODEL1"] / t.count() < 0.4
    assert routed.where(F.col("model_ctr").isNull()).count() == 0

    # the same rows as each share scored alone, request for request, from one read of them
    path = f"{scratch}/requests"
    t.write.parquet(path)
    requests = spark.read.parquet(path)
    routed = scoring.score_routed(requests, model1, model2, camp, pct_model1=30.0, capture=True)
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    read = [r for r in routed._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in r and "/requests" in r]
    assert len(read) == 1 and "Union" not in plan
    # both models' trees stand under the route's condition in one projection
    assert [r for r in plan.splitlines() if r.count("CASE WHEN (served_model") and r.count("UDF(") >= 4]
    shares = scoring.route(requests, 30.0)
    alone1 = scoring.score(model1, shares.where("served_model = 'MODEL1'"), capture=True).withColumn("served_model", F.lit("MODEL1"))
    alone2 = scoring.score(model2, shares.where("served_model = 'MODEL2'"), camp, capture=True).withColumn("served_model", F.lit("MODEL2"))
    alone = alone1.unionByName(alone2.withColumn("position", F.col("position").try_cast("int")))
    assert routed.schema.names == alone.schema.names
    assert sorted(map(str, routed.collect())) == sorted(map(str, alone.collect()))


def test_search_two_trials(spark):
    prepared = modeling.prepare(learnable_training(spark), MODEL1)
    cands = [BoostParams(n_estimators=3, max_depth=2), BoostParams(n_estimators=5, max_depth=3)]
    trials = tuning.search(spark, prepared, MODEL1, candidates=cands, parallelism=2)
    rows = trials.collect()
    assert len(rows) == 2 and all(r.test_log_loss > 0 for r in rows)
    assert tuning.best(trials).max_depth in (2, 3)
    drawn = tuning.draw(2, seed=1)
    assert all(0.01 <= p.learning_rate <= 0.1 and 5 <= p.max_depth <= 8 for p in drawn)


def test_run_log_latest_params(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    old = runlog.metric_rows(spark, "tune-1", "MODEL1", {"MODEL1_hyperparams": {"max_depth": 5}}, t0)
    new = runlog.metric_rows(spark, "tune-2", "MODEL1", {"MODEL1_hyperparams": {"max_depth": 7}}, t0 + dt.timedelta(days=1))
    log = old.unionByName(new)
    assert runlog.tuned_params(log, "MODEL1").max_depth == 7
    # a later training run with explicit values isn't a search
    trained = runlog.metric_rows(spark, "train-3", "MODEL1", {"MODEL1_hyperparams": {"max_depth": 3}}, t0 + dt.timedelta(days=2))
    assert runlog.tuned_params(log.unionByName(trained), "MODEL1").max_depth == 7
    assert runlog.tuned_params(log.limit(0), "MODEL1") == BoostParams()
    assert {r.run_id for r in runlog.latest_run(log).collect()} == {"tune-2"}


def test_clean_encode_idempotent_query(spark):
    import __spark_entry__ as E

    r = E.queries()["e8_clean_encode_twice"](spark, "/root/testdata/sf0.001").first().asDict()
    n = r.pop("rows")
    assert n > 0 and all(v == n for v in r.values())


def test_request_payload_shapes(spark, m1):
    model, _ = m1
    recs = [{"gender": "F", "campaign_id": "7", "traffic_partner_id": "p1", "traffic_source_id": "3",
             "os_name": "iOS", "age": "42", "hour": 5, "household_income": "NA", "position": 2}]
    import pandas as pd

    for payload in (recs, {"instances": recs}, pd.DataFrame(recs)):
        df = scoring.requests_frame(spark, payload, MODEL1)
        out = scoring.score(model, df).collect()
        assert len(out) == 1 and 0.0 < out[0].model_ctr < 1.0 and out[0].position == 2
    with pytest.raises(TypeError):
        scoring.requests_frame(spark, "not a payload", MODEL1)
    gaps = pd.DataFrame([{**recs[0], "age": None}, {**recs[0], "age": 7}])  # numeric column: the gap is NaN
    assert gaps["age"].isna().tolist() == [True, False]
    assert [r.age for r in scoring.requests_frame(spark, gaps, MODEL1).collect()] == [None, 7.0]


def test_model2_scores_record_payload(spark):
    camp = tables.campaign_features(spark, "/root/testdata/sf0.001")
    t = learnable_training(spark, "/root/testdata/sf0.001")
    m2 = modeling.fit(modeling.prepare(t, MODEL2, camp), MODEL2, SMALL, run_id="p2")
    recs = [
        {"event_id": 1, "gender": "female", "campaign_id": "7", "traffic_partner_id": "p1", "traffic_source_id": "3",
         "os_name": "iOS", "age": "42", "hour": "5", "household_income": "NA", "position": "2"},
        {"event_id": 2, "gender": None, "campaign_id": "95", "traffic_partner_id": None, "traffic_source_id": None,
         "os_name": None, "age": "-1", "hour": None, "household_income": None, "position": None},
    ]
    out = scoring.score(m2, scoring.requests_frame(spark, {"instances": recs}, MODEL2), camp).orderBy("event_id").collect()
    assert [r.event_id for r in out] == [1, 2]
    assert all(0.0 < r.model_ctr < 1.0 for r in out)
    assert out[0].position == "2" and out[0].model_version == "adflow_click_MODEL2 - p2"


def test_typed_payloads_keep_their_values(spark):
    """Numbers stay numbers: gaps, the marker -1, negative and fractional source ids."""
    import pandas as pd

    from adresponse.functions.cleaning import clean_frame

    frame = pd.DataFrame({"traffic_source_id": [5.0, None, 1.5, -5.0], "hour": [3, None, 4, 5], "position": [2.0, None, 1, 1],
                          "age": [-1, 30, None, 41], "household_income": ["NA", "1200.5", "-1", "x"]})
    got = clean_frame(scoring.requests_frame(spark, frame, MODEL1), "serve").orderBy("event_id").collect()
    assert [r.traffic_source_id for r in got] == [5.0, None, 1.5, -5.0]
    assert [r.age for r in got] == [None, 30.0, None, 41.0]
    assert [r.household_income for r in got] == [None, 1200.5, -1.0, None]
    assert [r.hour for r in got] == [3.0, None, 4.0, 5.0]


def test_wrong_request_types_are_rejected(spark, m1):
    model, _ = m1
    req = spark.createDataFrame([(1, None)], "event_id long, age date")
    need = [f for f in MODEL1.features if f != "age"]
    with pytest.raises(ValueError, match="age"):
        scoring.score(model, req.withColumns({f: F.lit(None).cast("string") for f in need}))


def test_patience_decides_where_boosting_stops():
    losses = [5.0, 4.0, 4.5, 3.0, 3.5, 3.4, 3.3]
    assert boosting.stopping_point(losses, 1) == (2, True)
    assert boosting.stopping_point(losses, 2) == (4, True)
    assert boosting.stopping_point(losses, 9) == (4, False)


def test_lookup_cleaning_twice_is_once(spark):
    from adresponse.functions.cleaning import clean_frame

    rows = spark.createDataFrame([("-1", "-1"), ("42", "NA")], "age string, household_income string")
    once = clean_frame(rows, "lookup")
    assert clean_frame(once, "lookup").collect() == once.collect()


def test_many_trees_score_batches(spark, m1, monkeypatch):
    """Above ``WALKED`` trees rows run in batches: the same requests and scores, alone, routed and captured."""
    model, _ = m1
    t, camp = learnable_training(spark), tables.campaign_features(spark, SF001)
    model2 = modeling.fit(modeling.prepare(t, MODEL2, camp), MODEL2, SMALL, run_id="t3")

    def made():
        return (scoring.score(model, t, capture=True), scoring.score(model2, t, camp),
                scoring.score_routed(t, model, model2, camp, pct_model1=30.0, capture=True), scoring.score_routed(t, model, model2, camp, pct_model1=100.0))

    walked = made()
    monkeypatch.setattr(scoring, "WALKED", 0)
    for own, batches in zip(walked, made()):
        assert "MapInArrow" in batches._jdf.queryExecution().toString() and "MapInArrow" not in own._jdf.queryExecution().toString()
        assert own.columns == batches.columns and [f.dataType for f in own.schema] == [f.dataType for f in batches.schema]
        a, b = (sorted((r.asDict() for r in df.collect()), key=lambda r: r["event_id"]) for df in (own, batches))
        assert len(a) == len(b) and [{**r, "model_ctr": 0} for r in a] == [{**r, "model_ctr": 0} for r in b]
        assert [r["model_ctr"] for r in b] == pytest.approx([r["model_ctr"] for r in a], abs=1e-12)
    assert t.count() == walked[0].count() > 1000
