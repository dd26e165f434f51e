"""Contracts of requests: kinds, required features, breaches (M7)."""

import pytest
from pyspark.sql import functions as F

from adresponse.config import MODEL1, MODEL2
from adresponse.plans import contract

SCHEMA = ("event_id long, gender string, campaign_id string, traffic_partner_id string, traffic_source_id double, "
          "os_name string, age double, hour int, household_income double, position int")
FULL = (1, "F", "7", "p1", 3.0, "iOS", 40.0, 5, 1000.0, 2)


def learnt(spark):
    gaps = (2, None, "8", "NA", float("nan"), "iOS", None, 6, 1.0, 1)
    return contract.infer(spark.createDataFrame([FULL, gaps], SCHEMA), MODEL1)


def test_kinds_and_required(spark, scratch):
    got = {f.feature: (f.kind, f.required) for f in learnt(spark)}
    assert got == {"gender": ("text", False), "campaign_id": ("text", True), "traffic_partner_id": ("text", False),
                   "traffic_source_id": ("number", False), "os_name": ("text", True), "age": ("number", False),
                   "hour": ("whole", True), "household_income": ("number", True), "position": ("whole", True)}
    contract.save(learnt(spark), spark, scratch)
    assert contract.load(spark, scratch) == learnt(spark)
    nothing = contract.infer(spark.createDataFrame([], SCHEMA), MODEL1)
    assert not any(f.required for f in nothing)
    assert {f.kind for f in contract.infer(spark.createDataFrame([FULL], SCHEMA), MODEL2)} == {"text"}


def test_breaches_by_value(spark):
    asked = spark.createDataFrame(
        [(1, "7", "1_000", "5", "40", 2.0), (2, "", "x", "5.5", "NA", 2.5), (3, None, None, "inf", "old", float("nan"))],
        "event_id long, campaign_id string, household_income string, hour string, age string, position double",
    ).withColumn("os_name", F.lit("iOS"))
    got = {(r.event_id, r.feature): r.breach for r in contract.breaches(asked, learnt(spark)).collect()}
    assert got == {(2, "campaign_id"): "missing", (3, "campaign_id"): "missing", (2, "household_income"): "not a number",
                   (3, "household_income"): "missing", (2, "hour"): "not a whole number", (3, "hour"): "not a whole number",
                   (3, "age"): "not a number", (2, "position"): "not a whole number", (3, "position"): "missing"}
    with pytest.raises(ValueError, match=r"campaign_id missing \(2\)"):
        contract.check(asked, learnt(spark))
    contract.check(asked.where("event_id = 1"), learnt(spark))
    contract.check(asked.limit(0), learnt(spark))


def test_columns(spark):
    asked = spark.createDataFrame([FULL], SCHEMA)
    with pytest.raises(ValueError, match="lack the required features .'hour'"):
        contract.check(asked.drop("hour", "gender"), learnt(spark))
    with pytest.raises(ValueError, match="neither numbers nor text"):
        contract.check(asked.withColumn("age", F.array("age")), learnt(spark))
    contract.check(asked.drop("gender").withColumn("extra", F.lit(1)), learnt(spark))
