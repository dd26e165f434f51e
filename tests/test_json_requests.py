"""JSON requests are read value by value, on executors."""

import json

from adresponse.config import MODEL1, MODEL2
from adresponse.plans import scoring


def _read(spark, *requests, spec=MODEL1):
    rows = [(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(requests)]
    return [r.asDict() for r in scoring.json_requests(spark.createDataFrame(rows, "event_id long, request string"), spec).orderBy("event_id").collect()]


def test_each_value_follows_its_own_kind(spark):
    values = [-1, "-1", 2.5, "2.5", "x", "", None, True, [1], {"a": 1}, -3, "1_000", 1e300]
    got = _read(spark, *[{"age": v, "traffic_source_id": v, "position": v} for v in values])
    assert [r["age"] for r in got] == [None, -1.0, 2.5, 2.5, None, None, None, None, None, None, -3.0, 1000.0, 1e300]
    assert [r["traffic_source_id"] for r in got] == [-1.0, None, 2.5, None, None, None, None, None, None, None, -3.0, None, 1e300]
    assert [r["position"] for r in got] == [-1.0, -1.0, 2.5, 2.5, None, None, None, None, None, None, -3.0, 1000.0, 1e300]


def test_requests_without_values(spark):
    for r in _read(spark, None, "", "{broken", "[]", "7", {}):
        assert (r["gender"], r["os_name"]) == ("", "") and all(r[f] is None for f in MODEL1.features if f not in ("gender", "os_name"))


def test_look_up_model_takes_text(spark):
    got = _read(spark, {"age": -1, "os_name": "", "campaign_id": 12, "gender": None}, spec=MODEL2)[0]
    assert (got["age"], got["os_name"], got["campaign_id"], got["gender"]) == ("-1", "", "12", None)


def test_no_python_per_row(spark):
    df = scoring.json_requests(spark.range(3).selectExpr("id AS event_id", "'{}' AS request"), MODEL1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
