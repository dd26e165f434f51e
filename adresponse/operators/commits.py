"""K4 for several writers: optimistic commits on a day-partitioned table.

A table made here has a second partition column, the number of the commit that
brought the rows.  A run

1. reads the number of the last commit, and the high-water mark of the rows
   up to that commit (a snapshot: later commits are pruned away),
2. writes its rows as day folders beside the table, where no reader looks,
3. publishes them with one ``ALTER TABLE ... ADD PARTITION`` of all its days
   and of a claim, a partition without rows that stands for the next commit
   number.

The catalog adds the partitions of one statement together or not at all, and
no partition twice, so of two runs that read the same snapshot one commits.
The other reads again, keeps those of its staged rows that are newer than the
new mark, and retries: nothing is joined again, no row is inserted twice.  A
run that dies before step 3 leaves only a folder that nothing refers to.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ingest import PARTITION_COLUMN, as_column, ensure_table, frozen_mark, in_window

COMMIT_COLUMN = "ingest_commit"
CLAIM_DAY = "0001-01-01"  # the day of the claims: before every window, and without rows


@dataclass(frozen=True)
class Snapshot:
    commit: int  # the last commit that the run has seen, 0 for none
    mark: _dt.datetime


@dataclass(frozen=True)
class Staged:
    path: str
    days: tuple  # as text
    rows: int


def ensure_commit_table(spark: SparkSession, table: str, like: DataFrame, path: str | None = None) -> bool:
    """K2 + K3 with a column for the commit; True when it was created."""
    if spark.catalog.tableExists(table):
        return False
    extra = {PARTITION_COLUMN: F.to_date("timestamp"), COMMIT_COLUMN: F.lit(0).cast("long")}
    try:
        return ensure_table(spark, table, like.withColumns(extra), (PARTITION_COLUMN, COMMIT_COLUMN), path)
    except AnalysisException as e:
        if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":  # another run made it meanwhile
            raise
        return False


def takes_commits(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and COMMIT_COLUMN in spark.table(table).columns


def last_commit(spark: SparkSession, table: str) -> int:
    """The number of the last commit; reads one catalog entry for each commit, no data."""
    claims = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({PARTITION_COLUMN} = '{CLAIM_DAY}')")
    number = F.substring_index("partition", "=", -1).cast("long")
    return claims.agg(F.coalesce(F.max(number), F.lit(0)).alias("n")).first()["n"]


def snapshot(spark: SparkSession, table: str, as_of=None, days: int = 22) -> Snapshot:
    """Step 1: a commit number first, then the mark of the rows up to it."""
    commit = last_commit(spark, table)
    spark.catalog.refreshTable(table)
    return Snapshot(commit, frozen_mark(spark, _until(spark, table, commit), as_of, days))


def _until(spark: SparkSession, table: str, commit: int) -> DataFrame:
    return spark.table(table).where(F.col(COMMIT_COLUMN) <= commit)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def stage(rows: DataFrame, table: str) -> Staged:
    """Step 2: the rows as day folders under the table's own hidden folder, files by the days' sizes."""
    spark = rows.sparkSession
    path = f"{_location(spark, table)}/_staged/{uuid.uuid4().hex}"
    columns = [c for c in spark.table(table).columns if c not in (PARTITION_COLUMN, COMMIT_COLUMN)]
    rows = rows.select(*columns, F.to_date("timestamp").alias(PARTITION_COLUMN))
    rows.hint("rebalance", PARTITION_COLUMN).write.partitionBy(PARTITION_COLUMN).parquet(path)
    day = F.col(PARTITION_COLUMN).cast("string")
    whole = spark.read.schema(rows.schema).parquet(path).agg(F.sort_array(F.collect_set(day)).alias("days"), F.count(F.lit(1)).alias("rows")).first()
    return Staged(path, tuple(whole["days"]), whole["rows"])


def publish(spark: SparkSession, table: str, staged: Staged, seen: Snapshot) -> bool:
    """Step 3: the staged days as the commit after ``seen``; False if another run has made that commit.

    The days of a run, at most its window and one, must go to the catalog in
    one call: more than ``spark.sql.addPartitionInBatch.size`` are refused.
    """
    if not staged.rows:
        return True
    most = int(spark.conf.get("spark.sql.addPartitionInBatch.size", "100"))
    if len(staged.days) + 1 > most:
        raise ValueError(f"{len(staged.days)} days are more than one catalog call adds ({most} partitions)")
    number = seen.commit + 1
    parts = [f"PARTITION ({PARTITION_COLUMN} = '{CLAIM_DAY}', {COMMIT_COLUMN} = {number})"]
    for day in staged.days:
        parts.append(f"PARTITION ({PARTITION_COLUMN} = '{day}', {COMMIT_COLUMN} = {number}) LOCATION '{staged.path}/{PARTITION_COLUMN}={day}'")
    try:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(parts)}")
    except AnalysisException as e:
        if e.getCondition() != "PARTITIONS_ALREADY_EXIST":
            raise
        return False
    spark.catalog.refreshTable(table)
    return True


def newer(rows: DataFrame, mark, as_of=None, days: int = 22) -> DataFrame:
    return rows.where(in_window(as_of, days) & (F.col("timestamp") > as_column(mark)))


def append_committed(spark: SparkSession, rows: DataFrame, table: str, as_of=None, days: int = 22,
                     description: str | None = None, seen: Snapshot | None = None, attempts: int = 20) -> DataFrame:
    """K4 + K5 beside other writers: the audit row of ``append_new`` with the commit's number and the conflicts met.

    ``seen`` is a snapshot already read for this run.  ``rows_before`` counts
    the rows up to the commit before this one, by file footers; a run
    without new rows commits nothing and has the number it has seen.
    """
    created = ensure_commit_table(spark, table, rows)
    seen = seen or snapshot(spark, table, as_of, days)
    staged = stage(newer(rows, seen.mark, as_of, days), table)
    conflicts = 0
    while not publish(spark, table, staged, seen):
        conflicts += 1
        if conflicts == attempts:
            raise RuntimeError(f"{table}: {attempts} commits of other runs came first")
        seen = snapshot(spark, table, as_of, days)
        mine = spark.read.schema(spark.table(table).drop(COMMIT_COLUMN).schema).parquet(staged.path)
        staged = stage(newer(mine, seen.mark, as_of, days), table)
    before = _until(spark, table, seen.commit).count()
    return spark.createDataFrame(
        [(before, before + staged.rows, staged.rows, description or f"append into {table}", bool(created), seen.commit + bool(staged.rows), conflicts)],
        "rows_before long, rows_after long, rows_inserted long, data_query string, created boolean, commit long, conflicts int",
    )
