"""Concurrent ingest runs: each row once, whoever commits first (K4)."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from adresponse.operators import commits, ingest
from adresponse.plans.context import Inputs

SF001 = "/root/testdata/sf0.01"


@pytest.fixture()
def case(spark):
    i = Inputs(spark, SF001)
    as_of = spark.read.parquet(f"{SF001}/events.parquet").agg(F.max("ts")).first()[0]
    return i, as_of, f"commits_{uuid.uuid4().hex}"


def plain(df):
    return sorted(map(str, df.drop("event_date", commits.COMMIT_COLUMN).collect()))


def test_two_runs_at_once_insert_each_row_once(spark, case, monkeypatch):
    i, as_of, table = case
    assert commits.append_committed(spark, i.target_before(5), table, as_of).first().rows_inserted == 2648
    both_staged, first = threading.Barrier(2, timeout=120), threading.local()
    staging = commits.stage

    def stage_then_meet(rows, name):
        out = staging(rows, name)
        if not hasattr(first, "met"):  # both have read and staged before either publishes
            first.met = True
            both_staged.wait()
        return out

    monkeypatch.setattr(commits, "stage", stage_then_meet)
    audits, errors = [], []

    def run():
        try:
            audits.append(commits.append_committed(spark, i.training(), table, as_of).first())
        except Exception as e:  # shown by the assertion below
            errors.append(e)

    threads = [threading.Thread(target=run) for _ in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert sorted((a.rows_inserted, a.conflicts) for a in audits) == [(0, 1), (776, 0)]
    assert all(a.rows_after == 3424 for a in audits)
    assert plain(spark.table(table)) == plain(i.training())
    assert commits.last_commit(spark, table) == 2


def test_loser_keeps_what_the_winner_lacks(spark, case):
    i, as_of, table = case
    commits.ensure_commit_table(spark, table, i.training())
    seen = commits.snapshot(spark, table, as_of)
    assert seen.commit == 0
    late = commits.append_committed(spark, i.target_before(5), table, as_of, seen=seen).first()
    both = commits.append_committed(spark, i.training(), table, as_of, seen=seen).first()
    assert (late.rows_inserted, late.conflicts, late.commit) == (2648, 0, 1)
    assert (both.rows_before, both.rows_inserted, both.rows_after, both.conflicts, both.commit) == (2648, 776, 3424, 1, 2)
    again = commits.append_committed(spark, i.training(), table, as_of).first()
    assert (again.rows_inserted, again.conflicts, again.commit) == (0, 0, 2)
    assert plain(spark.table(table)) == plain(i.training())


def test_claims_meet_where_days_do_not(spark, case):
    """Two commits without a common day still can't both follow the same snapshot."""
    i, as_of, table = case
    commits.ensure_commit_table(spark, table, i.training())
    seen = commits.snapshot(spark, table, as_of)
    rows = i.training().withColumn("event_date", F.to_date("timestamp"))
    days = [r[0] for r in rows.select("event_date").distinct().orderBy("event_date").limit(2).collect()]
    one, two = (commits.stage(rows.where(F.col("event_date") == d), table) for d in days)
    assert commits.publish(spark, table, one, seen) and not commits.publish(spark, table, two, seen)
    assert spark.table(table).count() == one.rows


def test_dead_run_leaves_nothing_to_read(spark, case):
    i, as_of, table = case
    commits.ensure_commit_table(spark, table, i.training())
    commits.stage(i.training(), table)  # never published
    assert spark.table(table).count() == 0 and commits.last_commit(spark, table) == 0
    assert commits.append_committed(spark, i.training(), table, as_of).first().rows_inserted == 3424


def test_too_many_days_are_refused(spark, case):
    i, as_of, table = case
    commits.ensure_commit_table(spark, table, i.training())
    seen = commits.snapshot(spark, table, as_of)
    with pytest.raises(ValueError, match="more than one catalog call"):
        commits.publish(spark, table, commits.Staged("x", tuple(map(str, range(100))), 1), seen)


def test_empty_run_commits_nothing(spark, case):
    i, as_of, table = case
    a = commits.append_committed(spark, i.training().limit(0), table, as_of).first()
    assert (a.rows_before, a.rows_inserted, a.commit) == (0, 0, 0)
    assert not ingest.new_rows(i.training(), spark.table(table), i.as_of(), 22).isEmpty()


def test_ingest_job_on_a_table_that_takes_commits(spark, case):
    from adresponse.plans import jobs
    from adresponse.plans.context import FIXTURE_SPEC

    i, as_of, table = case
    sides = i.impressions(), i.identity()
    log = f"{table}_log"
    one = jobs.ingest_job(spark, *sides, table, log, as_of, FIXTURE_SPEC, concurrent=True).first()
    two = jobs.ingest_job(spark, *sides, table, log, as_of, FIXTURE_SPEC).first()
    assert (one.rows_inserted, one.commit, two.rows_before, two.rows_inserted) == (3424, 1, 3424, 0)
    assert plain(spark.table(table)) == plain(i.training())
    ingest.ensure_table(spark, f"{table}_plain", i.training())
    with pytest.raises(ValueError, match="no ingest_commit"):
        jobs.ingest_job(spark, *sides, f"{table}_plain", log, as_of, FIXTURE_SPEC, concurrent=True)
