"""Skew handling of the identity join when it shuffles (no broadcast)."""

import contextlib

from pyspark.sql import functions as F

from adresponse.operators import ingest
from adresponse.sources import tables

SF = "/root/testdata/sf0.1"


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_null_keys_spread_over_reducers(spark):
    imp = tables.impressions(spark, SF)
    ident = tables.identity(spark, SF)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                        "spark.sql.shuffle.partitions": "16"}):
        j = ingest.join_identity(imp, ident).where(F.col("profile_emailsha256").isNull())
        parts = j.select(F.spark_partition_id().alias("p")).distinct().count()
        plan = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert parts == 16  # NULL keys land on every reducer, not on one


def test_hot_key_split_by_aqe_and_exact(spark):
    """One e-mail holds a third of all impressions; AQE splits its partition."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")))
    # the file is one row group (one mapper); AQE splits a hot reducer at map
    # boundaries, so give it the several mappers every cluster-sized scan has
    hot = hot.repartition(8)
    imp = tables.impressions_from_events(hot)
    ident = tables.identity(spark, SF)
    # carry varying columns through the join, as real rows do: a hot key whose
    # rows are otherwise identical compresses to almost nothing in the shuffle
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("exact_age", F.lit(0))).alias("s"),
        F.sum("event_id").alias("e"),
        F.max("timestamp").alias("t"),
    ]
    expected = ingest.join_identity(imp, F.broadcast(ident)).groupBy().agg(*aggs).first()
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.enabled": "true",
                        "spark.sql.adaptive.coalescePartitions.enabled": "false",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
                        "spark.sql.shuffle.partitions": "16"}):
        j = ingest.join_identity(imp, ident)
        got = j.groupBy().agg(*aggs)
        row = got.collect()[0]  # runs this plan, so its adaptive plan becomes final
        final = got._jdf.queryExecution().executedPlan().toString()
    assert tuple(row) == tuple(expected)
    assert "skew=true" in final


def test_scale_settings_size_partitions():
    from adresponse.session import scale_settings

    tb100 = 100 * 1024**4
    s = scale_settings(tb100, total_cores=8000)
    parts = int(s["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and tb100 / parts <= 256 * 1024**2
    assert int(scale_settings(10 * 1024**2, total_cores=8)["spark.sql.shuffle.partitions"]) == 8


def test_bucketed_identity_is_not_shuffled(spark):
    from adresponse.sources.tables import save_bucketed

    spark.sql("DROP TABLE IF EXISTS default.identity_bucketed")
    save_bucketed(tables.identity(spark, SF), "default.identity_bucketed", "sha256_email_address", 8)
    ident = spark.table("default.identity_bucketed")
    imp = tables.impressions(spark, SF)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        j = ingest.join_identity(imp, ident)
        plan = j._jdf.queryExecution().executedPlan().toString()
        n = j.count()
    assert plan.count("Exchange hashpartitioning") == 1  # the impressions side only
    assert "Exchange hashpartitioning(__jk" in plan
    assert n == imp.count()


def test_heavy_key_of_a_bucketed_side(spark):
    """A third of the impressions on one e-mail, identity bucketed and with copies: even tasks, same rows."""
    from adresponse.operators import joins
    from adresponse.sources.tables import save_bucketed

    spark.sql("DROP TABLE IF EXISTS default.identity_bucketed_twice")
    save_bucketed(tables.identity(spark, SF, fanout=True), "default.identity_bucketed_twice", "sha256_email_address", 8)
    ident = spark.table("default.identity_bucketed_twice")
    one = F.when(F.col("event_id") % 3 == 0, F.sha2(F.lit("50"), 256)).otherwise(F.col("profile_emailsha256"))
    imp = tables.impressions(spark, SF).withColumn("profile_emailsha256", one).repartition(8)
    args = "profile_emailsha256", "sha256_email_address", "event_id"
    hot = joins.heavy_keys(imp, args[0])
    assert len(hot) == 1 and 0.33 < next(iter(hot.values())) < 0.42  # a share of the impressions that have an e-mail

    def sums(df):
        v = [F.coalesce(F.col("exact_age"), F.lit(0)), F.coalesce(F.hash("gender", "est_household_income"), F.lit(0))]
        return df.agg(F.count(F.lit(1)), F.sum("event_id"), F.sum(F.xxhash64("event_id", *args[:2], *v) % 1_000_003)).first()

    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                        "spark.sql.shuffle.partitions": "8"}):
        expected = sums(joins.left_join_spread_nulls(imp, ident, *args))
        for small in (None, 0):  # hot rows sent to every task, or salted
            j = joins.left_join_heavy(imp, ident, *args, small_rows=small)
            assert sums(j) == expected
            rows = [r["count"] for r in j.groupBy(F.spark_partition_id()).count().collect()]
            middle = sorted(rows)[len(rows) // 2]
            assert max(rows) <= 2 * middle if small is None else max(rows) < sum(rows) / 6
        plan = joins.left_join_heavy(imp, ident, *args)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastHashJoin") == 1  # only the cold impressions move
        plain = joins.left_join_spread_nulls(imp, ident, *args).groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in plain.collect()) > 2 * middle  # what the plain join does
    no_keys = imp.withColumn("profile_emailsha256", F.lit(None).cast("string"))
    assert joins.heavy_keys(no_keys, args[0]) == {} and joins.heavy_keys(imp.limit(0), args[0]) == {}
