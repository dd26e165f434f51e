"""Sampling/split/augmentation properties and the encoding fixture (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from adresponse.config import AUGMENT_COLUMNS
from adresponse.operators import encoding, sampling
from adresponse.plans import stages
from adresponse.plans.context import Inputs

SF001 = "/root/testdata/sf0.01"


def _training(spark):
    return Inputs(spark, SF001).training()


def test_split_disjoint_and_complete(spark):
    t = _training(spark)
    train, test = sampling.hash_split(t)
    n, a, b = t.count(), train.count(), test.count()
    assert a + b == n
    assert train.join(test, "event_id", "inner").count() == 0
    assert 0.7 < a / n < 0.9


def test_split_ignores_partitioning(spark):
    t = _training(spark)
    ids = lambda df: sorted(r[0] for r in sampling.hash_split(df)[1].select("event_id").collect())
    assert ids(t.repartition(1)) == ids(t.repartition(7)) == ids(t.repartition(13, "hour"))


def test_augment_forms_equal_and_originals_untouched(spark):
    t = _training(spark)
    u = sampling.augment_union(t)
    e = sampling.augment_nulls(t)
    assert u.count() == e.count() > t.count()
    assert u.exceptAll(e).count() == 0 and e.exceptAll(u).count() == 0
    base = e.where(F.col("variant") == 0).drop("variant")
    assert base.exceptAll(t).count() == 0 and t.exceptAll(base).count() == 0
    for i, c in enumerate(AUGMENT_COLUMNS, start=1):
        copies = e.where(F.col("variant") == i)
        assert copies.where(F.col(c).isNotNull()).count() == 0
        assert 0 < copies.count() < 0.1 * t.count()


def test_copies_stay_with_their_original(spark):
    """A blanked copy keeps the key, so it lands on its original's side."""
    a = sampling.augment_nulls(_training(spark)).withColumn("is_test", sampling.is_test())
    sides = a.groupBy("event_id").agg(F.countDistinct("is_test").alias("k"))
    assert sides.where(F.col("k") > 1).count() == 0


def test_augment_single_scan(spark):
    t = _training(spark)
    base = t._jdf.queryExecution().executedPlan().toString()
    plan = sampling.augment_nulls(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == base.count("FileScan parquet")
    assert "Union" not in plan and "Exchange hashpartitioning" not in plan


def test_example_rows(spark):
    t = _training(spark).select("event_id", "gender", "age", "position")
    ex = sampling.example_rows(t).collect()
    assert len(ex) == 5
    blank = [r for r in ex if r["gender"] is None and r["age"] is None and r["position"] is None]
    assert len(blank) >= 1
    again = sampling.example_rows(t.repartition(5)).collect()
    assert sorted(r["event_id"] for r in ex) == sorted(r["event_id"] for r in again)


def test_encoding_fixture_text_order(spark):
    train = spark.createDataFrame([("10",), ("2",), ("1",), ("2",)], "c string").withColumn("is_test", F.lit(False))
    counts = encoding.fit_counts(train, ["c"])
    d = encoding.fit_dictionary(train, ["c"])
    assert sorted((r.category, r.code) for r in d.collect()) == [("1", 0), ("10", 1), ("2", 2)]
    idx = stages.DictionaryEncoder.fitted(counts, ["c"])
    test = spark.createDataFrame([("2",), ("zz",), (None,)], "c string")
    assert [r["c_idx"] for r in idx.transform(test).collect()] == [2.0, 3.0, 3.0]


def test_encoding_fixture_numeric_order(spark):
    train = spark.createDataFrame([(10,), (2,), (1,)], "c int")
    counts = encoding.fit_counts(train, ["c"], numeric_order=("c",))
    d = encoding.fit_dictionary(train, ["c"], numeric_order=("c",))
    assert [r.category for r in d.orderBy("code").collect()] == ["1", "2", "10"]
    idx = stages.DictionaryEncoder.fitted(counts, ["c"])
    test = spark.createDataFrame([(10,), (5,), (None,)], "c int")
    assert [r["c_idx"] for r in idx.transform(test).collect()] == [2.0, 3.0, 3.0]


def test_absent_feature_warns_and_continues(spark):
    df = spark.createDataFrame([("a",)], "c string")
    d = encoding.fit_dictionary(df, ["c", "missing"])
    assert {r.feature for r in d.collect()} == {"c"}


def test_int_columns_with_nulls_become_double(spark):
    from adresponse.config import MODEL1
    from adresponse.operators import features
    from adresponse.plans import modeling

    prepared = modeling.prepare(_training(spark), MODEL1).where(~F.col("is_test"))
    cols = ["hour", "position", "traffic_source_id", "age", "gender"]
    out = features.promote_ints_with_nulls(prepared, cols)
    types = dict(out.dtypes)
    assert types["hour"] == "int"  # never NULL
    assert types["position"] == types["traffic_source_id"] == types["age"] == "double"
    assert types["gender"] == "string"
    same = out.select(*[F.col(c).cast("string") for c in cols]).exceptAll(
        prepared.select(*[F.col(c).cast("double").cast("string") if c != "gender" and c != "hour" else F.col(c).cast("string") for c in cols])
    )
    assert same.count() == 0


def test_hex_draw_equals_numeric_draw(spark):
    from adresponse.functions.hashing import TWO32, below, unit

    df = spark.range(20000).withColumnRenamed("id", "event_id")
    for frac in (0.0, 0.05, 0.8, 0.999, 1.0):
        a = df.where(below("event_id", 7, frac)).count()
        b = df.where(unit("event_id", 7) < int(round(frac * TWO32))).count()
        assert a == b
