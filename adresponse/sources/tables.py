"""Table readers (S1, S2, S4) and the fixture views over the test tables.

In production the three inputs are catalog tables (``spark.table``).  The
test data holds no such tables, so ``impressions``, ``identity`` and
``campaign_features`` derive them from ``events``, ``customer`` and ``part``
with plain column expressions (mapping in FIXTURES.md); every derivation is a
narrow projection, so filters and column pruning still reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver test table, or a catalog table when ``sf_dir`` is None."""
    if sf_dir is None:
        return spark.table(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(key == k, F.lit(v))) if out is None else out.when(key == k, F.lit(v))
    return out


# FIXED VALUES of the fixture mapping (FIXTURES.md section 2).
GENDER_BY_USER_MOD7 = {0: "F", 1: "female", 2: "Male", 3: "m", 4: "NA", 5: ""}
OS_BY_USER_MOD8 = {0: "Android", 1: "iOS", 2: "Windows", 3: "Mac", 4: "Linux", 5: "", 6: "null"}
# Of every ten campaigns, the fixture's feature table lacks this one (lookup misses).
CAMPAIGN_MISSING_MOD10 = 9
# The fixture's stand-in for the excluded traffic partner.
FIXTURE_EXCLUDED_PARTNER = "p4"


def impressions(spark: SparkSession, sf_dir: str | None) -> DataFrame:
    """Impression events in the raw upstream schema."""
    ev = read_table(spark, sf_dir, "events")
    if sf_dir is None:
        return ev
    return impressions_from_events(ev)


def impressions_from_events(ev: DataFrame) -> DataFrame:
    """The fixture mapping alone (works on batch and streaming frames alike)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    return ev.select(
        eid.alias("event_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "click", F.lit(1))
        .when(F.col("event_type") == "view", F.lit(None).cast("int"))
        .otherwise(F.lit(0))
        .alias("click"),
        _case(uid % 7, GENDER_BY_USER_MOD7).alias("profile_gender"),
        F.when(uid % 10 != 9, F.sha2(uid.cast("string"), 256)).alias("profile_emailsha256"),
        F.get_json_object("props", "$.k").alias("campdata_campaignid"),
        F.when(eid % 11 != 0, eid % 13).alias("trafsrc_sourceid"),
        F.when(eid % 17 != 0, F.concat(F.lit("p"), (eid % 5).cast("string"))).alias(
            "trafsrc_trafficpartnerid"
        ),
        _case(uid % 8, OS_BY_USER_MOD8).alias("device_osname"),
        F.when(eid % 9 != 0, (eid % 7 + 1).cast("int")).alias("campdata_flowimpressionposition"),
    )


def identity(spark: SparkSession, sf_dir: str | None, fanout: bool = False) -> DataFrame:
    """Hashed-email identity dimension.

    ``fanout`` adds a second row for every 50th key to exercise the
    duplicate-key semantics of the identity join.
    """
    cu = read_table(spark, sf_dir, "customer")
    if sf_dir is None:
        return cu
    k = F.col("c_custkey")
    base = cu.select(
        F.sha2(k.cast("string"), 256).alias("sha256_email_address"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit("M"))
        .when(F.col("c_nationkey") % 3 == 1, F.lit("F"))
        .alias("gender"),
        F.when(k % 12 == 0, F.lit(-1)).otherwise(18 + k % 60).cast("int").alias("exact_age"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") * 10).alias("est_household_income"),
    )
    if not fanout:
        return base
    extra = cu.where(k % 50 == 0).select(
        F.sha2(k.cast("string"), 256).alias("sha256_email_address"),
        F.lit("F").alias("gender"),
        F.lit(99).alias("exact_age"),
        F.lit(1.0).alias("est_household_income"),
    )
    return base.unionByName(extra)


def campaign_features(spark: SparkSession, sf_dir: str | None) -> DataFrame:
    """Campaign feature table keyed by ``campaign_id``."""
    pa = read_table(spark, sf_dir, "part")
    if sf_dir is None:
        return pa.select("campaign_id", "vertical", "subvertical")
    return pa.where(F.col("p_partkey") % 10 != CAMPAIGN_MISSING_MOD10).select(
        F.col("p_partkey").cast("string").alias("campaign_id"),
        F.col("p_type").alias("vertical"),
        F.col("p_brand").alias("subvertical"),
    )


def latest_event_time(spark: SparkSession, sf_dir: str | None) -> Column:
    """``as_of`` for tests: MAX(timestamp) of the impressions, as a scalar subquery.

    Production passes the run time instead (``F.localtimestamp()``).
    """
    return impressions(spark, sf_dir).select(F.max("timestamp")).scalar()


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Write a dimension bucketed (and sorted) by its join key.

    A join on ``key`` then reads this side already partitioned: only the
    other side is shuffled, so a daily ingest no longer moves the whole
    identity table.  Trade-off: AQE splits skewed partitions only when both
    sides are shuffled, so with a bucketed side a hot key is not split (NULL
    keys are still spread).  Rewrite when the dimension changes.
    """
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
