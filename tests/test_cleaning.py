"""Truth tables for the cleaners (FIXTURES.md section 3) and their properties."""

import math

import pytest
from pyspark.sql import functions as F

from adresponse.functions import cleaning as C

OS_TABLE = [
    # input, train, lookup, serve
    ("iOS", "iOS", "iOS", "iOS"),
    ("ios", "Other", "Other", "Other"),
    ("Linux", "Other", "Other", "Other"),
    ("", "Other", "Other", ""),
    ("null", "Other", "Other", ""),
    ("NA", "Other", "Other", ""),
    (None, "Other", None, ""),
    ("Android", "Android", "Android", "Android"),
    ("Windows", "Windows", "Windows", "Windows"),
    ("Mac", "Mac", "Mac", "Mac"),
]

GENDER_TABLE = [
    ("F", "F", "F", "F"),
    ("FEMALE", "F", "F", "F"),
    ("m", "M", "M", "M"),
    ("Male", "M", "M", "M"),
    ("x", None, None, ""),
    ("", None, None, ""),
    ("NA", None, None, ""),
    (None, None, None, ""),
]

TEXT_NUMBER_TABLE = [
    ("-1", -1.0),
    ("42", 42.0),
    ("1.5", 1.5),
    ("abc", None),
    ("", None),
    ("NA", None),
    ("null", None),
    (None, None),
    (" 7 ", 7.0),
    ("1_000", 1000.0),
    ("1e3", 1000.0),
    (".5", 0.5),
    ("5.", 5.0),
    ("+3", 3.0),
    ("nan", None),
    ("12d", None),
    ("0x10", None),
    ("1__0", None),
    ("inf", math.inf),
    ("-Infinity", -math.inf),
]

SOURCE_TEXT_TABLE = [
    ("-1", None),
    ("42", 42.0),
    ("1.5", None),
    ("abc", None),
    ("", None),
    ("NA", None),
    ("null", None),
    (None, None),
]


def _apply(spark, rows, schema, fn):
    df = spark.createDataFrame(rows, schema)
    out = df.select(fn(F.col("x"), df.schema["x"].dataType).alias("y")).collect()
    return [r["y"] for r in out]


@pytest.mark.parametrize("idx,policy", [(1, "train"), (2, "lookup"), (3, "serve")])
def test_os_truth_table(spark, idx, policy):
    got = _apply(spark, [(r[0],) for r in OS_TABLE], "x string", lambda c, t: C.clean_os(c, policy))
    assert got == [r[idx] for r in OS_TABLE]


@pytest.mark.parametrize("idx,policy", [(1, "train"), (2, "lookup"), (3, "serve")])
def test_gender_truth_table(spark, idx, policy):
    got = _apply(spark, [(r[0],) for r in GENDER_TABLE], "x string", lambda c, t: C.clean_gender(c, policy))
    assert got == [r[idx] for r in GENDER_TABLE]


@pytest.mark.parametrize("policy", ["serve", "lookup"])
def test_number_from_text(spark, policy):
    got = _apply(spark, [(r[0],) for r in TEXT_NUMBER_TABLE], "x string", lambda c, t: C.clean_number(c, t, policy))
    assert got == [r[1] for r in TEXT_NUMBER_TABLE]


def test_number_typed_marker(spark):
    rows = [(-1,), (42,), (None,), (0,)]
    got = _apply(spark, rows, "x int", lambda c, t: C.clean_number(c, t, "serve"))
    assert got == [None, 42.0, None, 0.0]
    got = _apply(spark, [(-1.0,), (float("nan"),), (3.5,)], "x double", lambda c, t: C.clean_number(c, t, "serve"))
    assert got == [None, None, 3.5]


def test_source_id(spark):
    got = _apply(spark, [(r[0],) for r in SOURCE_TEXT_TABLE], "x string", C.clean_traffic_source)
    assert got == [r[1] for r in SOURCE_TEXT_TABLE]
    got = _apply(spark, [(-1,), (42,), (None,)], "x bigint", C.clean_traffic_source)
    assert got == [-1.0, 42.0, None]


def test_unknown_policy_rejected():
    with pytest.raises(ValueError):
        C.clean_os(F.col("x"), "other")


@pytest.mark.parametrize("policy", ["train", "serve"])
def test_frame_cleaner_idempotent(spark, policy):
    """Cleaning cleaned rows changes nothing (train/serve on typed input)."""
    from adresponse.plans.context import Inputs

    t = Inputs(spark, "/root/testdata/sf0.001").training()
    once = C.clean_frame(t, policy)
    twice = C.clean_frame(once, policy)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_frame_cleaner_skips_absent_columns(spark):
    df = spark.createDataFrame([("ios",)], "os_name string")
    assert C.clean_frame(df, "serve").first()["os_name"] == "Other"


def test_cleaners_stay_native(spark):
    """No Python UDF in the plan: the cleaners are plain expressions."""
    df = spark.createDataFrame([("ios", "F", "3")], "os_name string, gender string, age string")
    plan = C.clean_frame(df, "lookup")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
