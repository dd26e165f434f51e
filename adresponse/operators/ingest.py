"""Training-row query, high-water append and its audit.

Covers P1-P5, P14, F1-F4, J1, J4, A1-A3, K3-K5.  ``training_rows`` is the
single declarative query: filters sit above the scan of the impressions so
Catalyst pushes the time bound into the parquet reader, the identity join
runs with NULL keys spread (see ``joins``) and AQE picks broadcast or
sort-merge from real sizes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import IngestSpec
from .joins import left_join_heavy, left_join_spread_nulls


def as_column(as_of) -> Column:
    """``as_of`` as a Column: a Column, a datetime/ISO text, or None for now()."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    if as_of.tzinfo:  # event times are UTC without a zone
        as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    # as text: a datetime literal would pass through the driver's time zone
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def window_floor(as_of, days: int) -> Column:
    """``as_of - INTERVAL days DAYS`` (not truncated to midnight) -- P14."""
    return as_column(as_of) - F.make_dt_interval(F.lit(days))


# F1-F3 on the raw impression columns
def in_window(as_of, days: int, ts: str = "timestamp") -> Column:
    return F.col(ts) > window_floor(as_of, days)


def position_ok(max_position: int, col: str = "campdata_flowimpressionposition") -> Column:
    c = F.col(col)
    return (c <= max_position) | c.isNull()


def partner_ok(excluded: str, col: str = "trafsrc_trafficpartnerid") -> Column:
    # three-valued logic: a NULL partner fails the test and is dropped
    return F.col(col) != F.lit(excluded)


def filter_impressions(impressions: DataFrame, as_of, spec: IngestSpec = IngestSpec(), newer_than=None) -> DataFrame:
    """F1-F3; a day-partitioned impressions table is also pruned to the window's days.

    ``newer_than`` (an append's high-water mark) prunes to the days from it on.
    """
    rows = recent(impressions, as_of, spec.window_days)
    if newer_than is not None:
        mark = as_column(newer_than)
        rows = rows.where(F.col("timestamp") > mark)
        if PARTITION_COLUMN in rows.columns:
            rows = rows.where(F.col(PARTITION_COLUMN) >= F.to_date(mark))
    return rows.where(
        in_window(as_of, spec.window_days)
        & position_ok(spec.max_position)
        & partner_ok(spec.excluded_partner)
    )


def project_training(joined: DataFrame) -> DataFrame:
    """Renames, label default, gender fallback, hour of day."""
    return joined.select(
        F.col("event_id"),
        F.col("timestamp"),
        F.coalesce(F.col("click"), F.lit(0)).alias("click"),
        F.coalesce(F.col("profile_gender"), F.col("gender")).alias("gender"),
        F.col("campdata_campaignid").alias("campaign_id"),
        F.col("trafsrc_sourceid").alias("traffic_source_id"),
        F.col("trafsrc_trafficpartnerid").alias("traffic_partner_id"),
        F.col("device_osname").alias("os_name"),
        F.col("exact_age").alias("age"),
        F.col("est_household_income").alias("household_income"),
        F.col("campdata_flowimpressionposition").alias("position"),
        F.hour("timestamp").alias("hour"),
    )


def join_identity(impressions: DataFrame, identity: DataFrame, dedup: bool = False, heavy: bool = False) -> DataFrame:
    """Left join on the hashed e-mail; duplicate identity keys fan out.

    With ``heavy`` the hot e-mails are found first and joined apart.
    """
    values = ("gender", "exact_age", "est_household_income")
    ident = identity.select("sha256_email_address", *values)
    if dedup:  # the smallest row of a key, so that every run keeps the same one
        ident = ident.groupBy("sha256_email_address").agg(F.min(F.struct(*values)).alias("v"))
        ident = ident.select("sha256_email_address", "v.*")
    join = left_join_heavy if heavy else left_join_spread_nulls
    return join(
        impressions, ident, "profile_emailsha256", "sha256_email_address", spread_by="event_id"
    )


def with_event_id(impressions: DataFrame) -> DataFrame:
    """Impressions with a key: a hash of all their columns where the source has none."""
    if "event_id" in impressions.columns:
        return impressions
    return impressions.withColumn("event_id", F.xxhash64(*[F.col(f"`{c}`") for c in impressions.columns]))


def training_rows(
    impressions: DataFrame, identity: DataFrame, as_of=None, spec: IngestSpec = IngestSpec(), newer_than=None
) -> DataFrame:
    """The training-row query (flagship): filter -> identity join -> projection."""
    rows = filter_impressions(with_event_id(impressions), as_of, spec, newer_than)
    return project_training(join_identity(rows, identity, spec.dedup_identity, spec.heavy_emails))


def query_text(spec: IngestSpec = IngestSpec(), newer_than=None) -> str:
    """The training-row query as SQL text, for the audit (K5)."""
    mark = "" if newer_than is None else f" AND a.timestamp > TIMESTAMP_NTZ '{newer_than}'"
    return (
        "SELECT a.event_id, a.timestamp, COALESCE(a.click, 0) AS click, COALESCE(a.profile_gender, b.gender) AS gender,"
        " a.campdata_campaignid AS campaign_id, a.trafsrc_sourceid AS traffic_source_id,"
        " a.trafsrc_trafficpartnerid AS traffic_partner_id, a.device_osname AS os_name, b.exact_age AS age,"
        " b.est_household_income AS household_income, a.campdata_flowimpressionposition AS position,"
        " hour(a.timestamp) AS hour FROM impressions a LEFT JOIN identity b"
        f" ON a.profile_emailsha256 = b.sha256_email_address WHERE a.timestamp > now() - INTERVAL {spec.window_days} DAYS"
        f" AND (a.campdata_flowimpressionposition <= {spec.max_position} OR a.campdata_flowimpressionposition IS NULL)"
        f" AND a.trafsrc_trafficpartnerid <> '{spec.excluded_partner}'{mark}"
    )


# ---------------------------------------------------------------------------
# High-water append
# ---------------------------------------------------------------------------
PARTITION_COLUMN = "event_date"


def recent(table: DataFrame, as_of, days: int) -> DataFrame:
    """Only the day partitions that can hold rows newer than the window floor.

    A no-op on unpartitioned frames.  On a day-partitioned table (the
    training table, or impressions stored by day) the predicate on
    ``event_date`` prunes whole partitions at the scan, so neither the
    ingest, the high-water search nor the training load reads old history.
    """
    if PARTITION_COLUMN not in table.columns:
        return table
    return table.where(F.col(PARTITION_COLUMN) >= F.to_date(window_floor(as_of, days)))


def high_water(target: DataFrame, as_of, days: int, ts: str = "timestamp") -> Column:
    """``COALESCE(MAX(ts), as_of - days)`` of the target, as a scalar subquery.

    Rows below the floor cannot change which rows are new (new rows must
    also pass ``ts > floor``), so only recent partitions count; of a
    day-partitioned table only the newest day is read for its times.
    """
    return F.coalesce(max_time(recent(target, as_of, days), ts).scalar(), window_floor(as_of, days))


def max_time(target: DataFrame, ts: str = "timestamp") -> DataFrame:
    """A2: the latest time of a table, as one row."""
    if PARTITION_COLUMN in target.columns:
        newest = target.select(F.max(PARTITION_COLUMN)).scalar()
        target = target.where(F.col(PARTITION_COLUMN) == newest)
    return target.select(F.max(ts).alias("max_ts"))


def new_rows(rows: DataFrame, target: DataFrame, as_of, days: int) -> DataFrame:
    """rows strictly newer than the target's high-water mark (and inside the window)."""
    return rows.where(in_window(as_of, days) & (F.col("timestamp") > high_water(target, as_of, days)))


def ensure_schema(spark: SparkSession, schema: str) -> None:
    """K1."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def ensure_table(spark: SparkSession, table: str, like: DataFrame, partition_by: str | tuple | None = "event_date",
                 path: str | None = None) -> bool:
    """K2 + K3: create an empty table with the query's schema when absent.

    The table is partitioned by event date so the 22-day window prunes whole
    partitions when it is read back.  Returns True when it was created.
    """
    if spark.catalog.tableExists(table):
        return False
    names = (partition_by,) if isinstance(partition_by, str) else partition_by or ()
    for name in names:
        like = _with_partition(like, name)
    w = spark.createDataFrame([], like.schema).write.format("parquet")
    if names:
        w = w.partitionBy(*names)
    if path:  # an external table
        w = w.option("path", path)
    w.saveAsTable(table)
    return True


def _with_partition(df: DataFrame, partition_by: str | None) -> DataFrame:
    if partition_by and partition_by not in df.columns:
        return df.withColumn(partition_by, F.to_date("timestamp"))
    return df


def frozen_mark(spark: SparkSession, target: DataFrame, as_of=None, days: int = 22) -> _dt.datetime:
    """The high-water mark as a value, read once for a whole run."""
    return spark.range(1).select(high_water(target, as_of, days).alias("mark")).first()["mark"]


def append_rows(fresh: DataFrame, table: str, partition_by: str | None = PARTITION_COLUMN, counted: bool = False) -> int | None:
    """One distributed append; each day's rows go to as many files as their size asks for (AQE splits large days).

    With ``counted`` the write itself counts its rows.
    """
    spark = fresh.sparkSession
    fresh = _with_partition(fresh, partition_by).select(*spark.table(table).columns)
    if partition_by:
        fresh = fresh.hint("rebalance", partition_by)
    seen = Observation() if counted else None
    if seen:
        fresh = fresh.observe(seen, F.count(F.lit(1)).alias("rows"))
    fresh.write.insertInto(table)
    spark.catalog.refreshTable(table)
    return int(seen.get.get("rows", 0)) if seen else None


def append_new(spark: SparkSession, rows: DataFrame, table: str, as_of=None, days: int = 22,
               partition_by: str | None = PARTITION_COLUMN, description: str | None = None, mark=None,
               rows_before: int | None = None) -> DataFrame:
    """K4 + K5: append the rows newer than the table's high-water mark; return the audit row.

    ``mark`` is a mark already read for this run, ``rows_before`` the count
    that the last audit left; only without it is the target counted, and a
    table that this call makes holds none.  The inserted rows are counted by
    the insert, one distributed write.  A rerun inserts 0 rows.
    """
    created = ensure_table(spark, table, rows, partition_by)
    target = spark.table(table)
    if created:
        rows_before = 0
    elif rows_before is None:
        rows_before = target.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    mark = frozen_mark(spark, target, as_of, days) if mark is None else mark
    inserted = append_rows(rows.where(in_window(as_of, days) & (F.col("timestamp") > as_column(mark))), table, partition_by, counted=True)
    return spark.createDataFrame(
        [(int(rows_before), int(rows_before + inserted), inserted, description or f"append into {table}", bool(created))],
        "rows_before long, rows_after long, rows_inserted long, data_query string, created boolean",
    )
