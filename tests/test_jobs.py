"""The whole workflow on catalog tables: ingest -> tune -> retrain x2 -> routed scoring."""

import pytest
from pyspark.sql import functions as F

from adresponse.config import MODEL1, MODEL2
from adresponse.operators import runlog
from adresponse.plans import jobs
from adresponse.plans.context import FIXTURE_SPEC
from adresponse.sources import tables

SF = "/root/testdata/sf0.001"


def test_workflow(spark, scratch):
    spark.sql("CREATE SCHEMA IF NOT EXISTS src")
    for name, df in (
        ("src.impressions", tables.impressions(spark, SF)),
        ("src.identity", tables.identity(spark, SF)),
        ("src.campaigns", tables.campaign_features(spark, SF)),
    ):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        df.write.saveAsTable(name)
    for t in ("ml.training", "ml.run_log", "ml.inference_log"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    as_of = spark.table("src.impressions").agg(F.max("timestamp")).first()[0]

    a1 = jobs.ingest_job(spark, "src.impressions", "src.identity", "ml.training", "ml.run_log", as_of,
                         FIXTURE_SPEC).first()
    assert a1.rows_inserted == 340
    a2 = jobs.ingest_job(spark, "src.impressions", "src.identity", "ml.training", "ml.run_log", as_of,
                         FIXTURE_SPEC).first()
    assert a2.rows_inserted == 0 and a2.rows_before == 340
    assert runlog.rows_after(spark.table("ml.run_log"), "ml.training") == 340
    assert runlog.rows_after(spark.table("ml.run_log"), "ml.other") is None

    trials = jobs.tune_job(spark, "ml.training", "ml.run_log", MODEL1, as_of=as_of, n_evals=2, parallelism=2)
    assert trials.count() == 2
    tuned = runlog.tuned_params(spark.table("ml.run_log"), "MODEL1")
    assert 5 <= tuned.max_depth <= 8 and 300 <= tuned.n_estimators <= 400

    m1 = jobs.retrain_job(spark, "ml.training", "ml.run_log", f"{scratch}/m1", MODEL1, as_of=as_of)
    assert m1.params == tuned
    m2 = jobs.retrain_job(spark, "ml.training", "ml.run_log", f"{scratch}/m2", MODEL2, "src.campaigns", as_of=as_of)
    assert m2.n_trees >= 1
    keys = {r.key for r in spark.table("ml.run_log").select("key").distinct().collect()}
    assert {"MODEL1_test_log_loss", "MODEL2_train_log_loss", "rows_inserted", "MODEL1_hyperparams"} <= keys

    log = jobs.score_job(spark, "ml.training", f"{scratch}/m1", f"{scratch}/m2", "src.campaigns", "ml.inference_log")
    assert log.count() == 340
    broken = spark.table("ml.training").withColumn("campaign_id", F.lit("NA"))
    with pytest.raises(ValueError, match=r"campaign_id missing \(340\)"):
        jobs.score_job(spark, broken, f"{scratch}/m1", f"{scratch}/m2", "src.campaigns", "ml.inference_log", strict=True)
    assert spark.table("ml.inference_log").count() == 340
    jobs.contract.check(spark.table("ml.training"), jobs.contract.load(spark, f"{scratch}/m1"))
    for run_id in ("again", "again", "other"):
        log = jobs.score_job(spark, "ml.training", f"{scratch}/m1", f"{scratch}/m2", "src.campaigns", "ml.inference_log", run_id=run_id)
    assert {r.run_id: r["count"] for r in log.groupBy("run_id").count().collect() if r.run_id in ("again", "other")} == {"again": 340, "other": 340}
    assert log.count() == 3 * 340
    assert set(log.columns) >= {"event_id", "campaign_id", "position", "model_ctr", "model_version", "served_model", "scored_at"}


def test_command_line(spark, scratch, capsys):
    from adresponse.__main__ import main

    spark.sql("CREATE SCHEMA IF NOT EXISTS cli")
    for name, df in (
        ("cli.impressions", tables.impressions(spark, SF)),
        ("cli.identity", tables.identity(spark, SF)),
        ("cli.campaigns", tables.campaign_features(spark, SF)),
    ):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        df.write.saveAsTable(name)
    for t in ("cli.training", "cli.run_log", "cli.inference"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    as_of = str(spark.table("cli.impressions").agg(F.max("timestamp")).first()[0])
    main(["ingest", "--impressions", "cli.impressions", "--identity", "cli.identity",
          "--training", "cli.training", "--runlog", "cli.run_log", "--as-of", as_of, "--excluded-partner", "p4"])
    assert '"rows_inserted": 340' in capsys.readouterr().out
    for model, extra in (("MODEL1", []), ("MODEL2", ["--campaigns", "cli.campaigns"])):
        main(["retrain", "--training", "cli.training", "--runlog", "cli.run_log",
              "--model-path", f"{scratch}/{model}", "--model", model, "--as-of", as_of, *extra])
    # a second (daily) retrain replaces the saved model in place
    main(["retrain", "--training", "cli.training", "--runlog", "cli.run_log",
          "--model-path", f"{scratch}/MODEL1", "--model", "MODEL1", "--as-of", as_of])
    main(["score", "--requests", "cli.training", "--model1-path", f"{scratch}/MODEL1",
          "--model2-path", f"{scratch}/MODEL2", "--campaigns", "cli.campaigns", "--inference", "cli.inference"])
    assert '"inference_rows": 340' in capsys.readouterr().out
    examples = spark.read.json(f"{scratch}/MODEL1/input_example")
    assert examples.count() == 5
