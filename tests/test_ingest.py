"""Training-row query, identity join semantics and the high-water append (K1-K5)."""

from pyspark.sql import functions as F

from adresponse.config import IngestSpec
from adresponse.operators import ingest
from adresponse.plans.context import FIXTURE_SPEC, Inputs
from adresponse.sources import tables

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def test_training_rows_summary(spark):
    """FIXTURES.md: 340 rows, 83 clicks, non-NULL gender 326, age 323, position 280, source 309."""
    t = Inputs(spark, SF0001).training()
    r = t.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("click").alias("clicks"),
        F.count("gender").alias("gender"),
        F.count("age").alias("age"),
        F.count("position").alias("position"),
        F.count("traffic_source_id").alias("source"),
    ).first()
    assert (r.n, r.clicks, r.gender, r.age, r.position, r.source) == (340, 83, 326, 323, 280, 309)


def test_fanout_keeps_duplicates(spark):
    i = Inputs(spark, SF001)
    assert i.training(fanout=True).count() == 3479
    assert i.training(fanout=True, spec=IngestSpec(excluded_partner="p4", dedup_identity=True)).count() == 3424


def test_null_keys_never_match(spark):
    """Impressions without a hashed e-mail keep their row and get no identity columns."""
    i = Inputs(spark, SF001)
    j = ingest.join_identity(i.impressions(), i.identity())
    assert j.count() == i.impressions().count()
    nulls = j.where(F.col("profile_emailsha256").isNull())
    assert nulls.count() > 0
    assert nulls.where(F.col("exact_age").isNotNull() | F.col("gender").isNotNull()).count() == 0


def test_partner_null_dropped_position_null_kept(spark):
    t = Inputs(spark, SF001).training()
    assert t.where(F.col("traffic_partner_id").isNull()).count() == 0
    assert t.where(F.col("traffic_partner_id") == "p4").count() == 0
    assert t.where(F.col("position").isNull()).count() > 0
    assert t.where(F.col("position") > 4).count() == 0


def test_window_filter_reaches_scan(spark):
    """The time bound is pushed into the parquet reader."""
    plan = Inputs(spark, SF001).training()._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "IsNotNull(ts)" in plan


def test_incremental_append_and_rerun(spark):
    """Target up to as_of - 5 days holds 2,648 rows; the append adds 776; a rerun adds 0."""
    i = Inputs(spark, SF001)
    ingest.ensure_schema(spark, "ads")
    table = "ads.training_incr"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    as_of = spark.read.parquet(f"{SF001}/events.parquet").agg(F.max("ts")).first()[0]
    rows = i.training()
    first = ingest.append_new(spark, i.target_before(5), table, as_of).first()
    assert first.rows_before == 0 and first.rows_inserted == 2648 and first.created
    second = ingest.append_new(spark, rows, table, as_of).first()
    assert (second.rows_before, second.rows_inserted, second.rows_after) == (2648, 776, 3424)
    third = ingest.append_new(spark, rows, table, as_of).first()
    assert third.rows_inserted == 0 and not third.created
    # the table is partitioned by day so the window prunes whole partitions
    assert "event_date" in spark.table(table).columns


def test_empty_target_uses_window_floor(spark):
    i = Inputs(spark, SF001)
    empty = i.training().limit(0)
    n = ingest.new_rows(i.training(), empty, i.as_of(), 22).count()
    assert n == 3424


def test_create_empty_table_has_query_schema(spark):
    i = Inputs(spark, SF0001)
    spark.sql("DROP TABLE IF EXISTS default.training_schema_only")
    assert ingest.ensure_table(spark, "default.training_schema_only", i.training(), partition_by=None)
    t = spark.table("default.training_schema_only")
    assert t.count() == 0
    assert t.columns == i.training().columns
    assert not ingest.ensure_table(spark, "default.training_schema_only", i.training(), partition_by=None)


def test_fixture_views_schema(spark):
    imp = tables.impressions(spark, SF0001)
    assert dict(imp.dtypes)["campdata_flowimpressionposition"] == "int"
    cf = tables.campaign_features(spark, SF0001)
    n = spark.read.parquet(f"{SF0001}/part.parquet").where("p_partkey % 10 != 9").count()
    assert cf.count() == n and cf.select("campaign_id").distinct().count() == n


def test_window_bound_pushed_for_run_time_as_of(spark):
    """With a run-time as_of (literal or now()) the bound itself reaches the parquet reader."""
    import datetime as dt

    for as_of in (dt.datetime(2024, 1, 30), None):
        df = ingest.training_rows(tables.impressions(spark, SF001), tables.identity(spark, SF001), as_of, FIXTURE_SPEC)
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = [ln for ln in plan.splitlines() if "events.parquet" in ln][0]
        assert "GreaterThan(ts," in scan


def test_duplicate_feature_keys_rejected(spark):
    import pytest

    from adresponse.operators import features, joins

    camp = tables.campaign_features(spark, SF0001)
    joins.assert_unique_key(camp, "campaign_id")
    twice = camp.unionByName(camp.limit(1))
    with pytest.raises(ValueError):
        joins.assert_unique_key(twice, "campaign_id")
    with pytest.raises(ValueError):  # on every path that looks features up
        features.lookup_features(spark.createDataFrame([("1",)], "campaign_id string"), twice)


def test_day_partitioned_impressions_are_pruned(spark, scratch):
    imp = tables.impressions(spark, SF001).withColumn("event_date", F.to_date("timestamp"))
    imp.write.partitionBy("event_date").parquet(f"{scratch}/imp")
    part = spark.read.parquet(f"{scratch}/imp")
    as_of = part.agg(F.max("timestamp")).first()[0]
    rows = ingest.training_rows(part, tables.identity(spark, SF001), as_of, FIXTURE_SPEC)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "PartitionFilters" in ln and "event_date" in ln][0]
    assert "PartitionFilters: [isnotnull(event_date" in scan
    assert rows.count() == 3424


def test_rows_at_the_high_water_mark_are_not_appended(spark):
    """F4 is strict: a new row sharing the target's newest timestamp is skipped (original semantics)."""
    i = Inputs(spark, SF001)
    target = i.target_before(5)
    top = target.orderBy(F.col("timestamp").desc()).limit(1)
    twin = top.withColumn("event_id", F.col("event_id") + 10**12)  # same timestamp, new row
    rows = i.training().unionByName(twin)
    fresh = ingest.new_rows(rows, target, i.as_of(), 22)
    assert fresh.count() == 776
    assert fresh.where(F.col("event_id") >= 10**12).count() == 0


def test_as_of_means_the_same_in_every_time_zone(spark):
    """A naive time is UTC whatever the driver's zone; an aware one is converted."""
    import datetime as dt
    import os
    import time

    naive, aware = "2024-01-31T00:00:00", dt.datetime(2024, 1, 31, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        for as_of in (naive, dt.datetime.fromisoformat(naive), aware):
            row = spark.range(1).select(ingest.as_column(as_of).cast("string").alias("t")).first()
            assert row.t == "2024-01-31 00:00:00"
    finally:
        os.environ.pop("TZ") if old is None else os.environ.update(TZ=old)
        time.tzset()


def test_impressions_without_a_key_get_one(spark):
    i = Inputs(spark, SF0001)
    rows = ingest.training_rows(i.impressions().drop("event_id"), i.identity(), i.as_of(), FIXTURE_SPEC)
    assert rows.count() == 340 and rows.select("event_id").distinct().count() > 300


def test_dedup_identity_keeps_the_smallest_row(spark):
    ident = spark.createDataFrame([("a", "M", 30, 1.0), ("a", "F", 40, 2.0)], "sha256_email_address string, gender string, exact_age int, est_household_income double")
    imp = spark.createDataFrame([(1, "a")], "event_id long, profile_emailsha256 string")
    assert [(r.gender, r.exact_age) for r in ingest.join_identity(imp, ident, dedup=True).collect()] == [("F", 40)]


def test_append_reads_only_new_days_and_writes_few_files(spark, scratch):
    imp = tables.impressions(spark, SF001).withColumn("event_date", F.to_date("timestamp"))
    imp.write.partitionBy("event_date").parquet(f"{scratch}/imp-days")
    part = spark.read.parquet(f"{scratch}/imp-days")
    as_of = part.agg(F.max("timestamp")).first()[0]
    mark = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    rows = ingest.training_rows(part, tables.identity(spark, SF001), as_of, FIXTURE_SPEC, newer_than=mark)
    days = {f.split("event_date=")[1][:10] for f in rows.select("timestamp").inputFiles() if "event_date=" in f}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "PartitionFilters" in ln and "event_date" in ln][0]
    assert str(mark.date()) in scan or "event_date" in scan
    assert rows.where(F.col("timestamp") <= mark).count() == 0 and days
    spark.sql("DROP TABLE IF EXISTS default.training_files")
    whole = ingest.training_rows(part, tables.identity(spark, SF001), as_of, FIXTURE_SPEC)
    ingest.append_new(spark, whole, "default.training_files", as_of)
    n_days = spark.table("default.training_files").select("event_date").distinct().count()
    assert len(spark.table("default.training_files").inputFiles()) <= 2 * n_days
