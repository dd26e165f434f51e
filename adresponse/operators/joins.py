"""Join helpers (J1, J2) written for skewed keys.

* ``left_join_spread_nulls``: a left equi-join whose probe side may hold many
  NULL keys (anonymous impressions).  NULL keys can never match, but a plain
  shuffle would still send all of them to one reducer.  They get a unique,
  never-matching stand-in key so they spread over all partitions; the extra
  ``isNotNull`` term keeps the result exact.  A hot non-NULL key is split by
  AQE's skew-join (left side of a left outer join is splittable).
* ``left_join_heavy``: the same join where the looked-up side is stored by its
  key (bucketed) and must not move, so that AQE can't split a hot key: a sketch
  finds the hot keys, and only their rows are joined another way.
* ``assert_unique_key``: a dimension that is looked up may hold a key once.

No whole side is broadcast by hint: AQE chooses at run time from real sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH = 10_000  # keys that a task's sketch of hot keys tracks


def assert_unique_key(df: DataFrame, key: str) -> None:
    """Feature tables must be keyed uniquely (one distributed aggregate)."""
    dup = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"feature table key {key!r} is not unique")


def left_join_spread_nulls(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: str,
) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``; NULL keys spread by ``spread_by``."""
    jk = "__jk"
    lk = F.col(left_key)
    probe = left.withColumn(
        jk, F.coalesce(lk, F.concat(F.lit("~null:"), F.col(spread_by).cast("string")))
    )
    cond = (probe[jk] == right[right_key]) & probe[left_key].isNotNull()
    return probe.join(right, cond, "left").drop(jk)


def heavy_keys(df: DataFrame, key: str) -> dict:
    """Keys with more than 1/``HOT_SHARE`` of the rows that have one, and each one's share (fewer than ``HOT_SHARE`` of them).

    By a frequent-items sketch, one aggregate whose state is bounded in every
    task.  A share may be too large by 1/``SKETCH`` or so.
    """
    keys = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    top, rows = keys.agg(F.expr(f"approx_top_k(k, {HOT_SHARE}, {SKETCH})"), F.count("k")).first()
    return {item: n / rows for item, n in top if n * HOT_SHARE > rows} if rows else {}


def left_join_heavy(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: str,
                    small_rows: int | None = None) -> DataFrame:
    """``left_join_spread_nulls`` whose hot keys are joined apart.

    All other rows meet ``right`` as it is stored.  Of ``right``, the rows of
    the hot keys are read alone (bucket and filter pruning); up to
    ``small_rows`` (``SMALL_ROWS``) of them, counted first, go to every task,
    and the hot rows of ``left`` stay where they are.  More are copied, a key's
    as often as its share asks for salted reducers, so all copies together are
    fewer than the reducers and hot keys; the hot rows of ``left`` spread over
    the copies.  The result is the same whatever the sketch says.
    """
    hot = heavy_keys(left, left_key)
    if not hot:
        return left_join_spread_nulls(left, right, left_key, right_key, spread_by)
    limit = SMALL_ROWS if small_rows is None else small_rows
    is_hot = F.coalesce(F.col(left_key).isin(list(hot)), F.lit(False))
    cold = left_join_spread_nulls(left.where(~is_hot), right, left_key, right_key, spread_by)
    probe, held = left.where(is_hot), right.where(F.col(right_key).isin(list(hot)))
    if held.limit(limit + 1).count() <= limit:
        met = probe.join(F.broadcast(held), F.col(left_key) == F.col(right_key), "left")
        return cold.unionByName(met)
    reducers = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = F.create_map(*[F.lit(v) for k, share in hot.items() for v in (k, max(1, round(share * reducers)))])
    salt, copy = "__salt", "__copy"
    probe = probe.withColumn(salt, F.pmod(F.xxhash64(spread_by), copies[F.col(left_key)]).cast("int"))
    held = held.withColumn(copy, F.explode(F.sequence(F.lit(0), copies[F.col(right_key)] - 1)))
    met = probe.join(held, (F.col(left_key) == F.col(right_key)) & (F.col(salt) == F.col(copy)), "left")
    return cold.unionByName(met.drop(salt, copy))


SMALL_ROWS = 20_000  # of a looked-up table that is sent to every task
HOT_SHARE = 64  # a category with more than this part of all rows is hot: fewer than 64 can be


def look_up(df: DataFrame, value, table: DataFrame, rows: int, columns: dict) -> DataFrame:
    """``df`` with the ``columns`` (name in the table -> name of the result) of the table's row for ``value``; NULL where none is.

    ``table`` holds one row for each ``category`` and, as ``n``, how many rows
    it was learnt from.  With at most ``SMALL_ROWS`` rows (``rows`` is the
    count) it goes to every task.  A larger one is joined by shuffle, but for
    its hot categories, of which there are fewer than ``HOT_SHARE``: they are
    sent to every task, and the rows they answer, like those without a value,
    are spread over all reducers.
    """
    key, hit, held = "__value", "__hit", "__columns"
    named = F.struct(*[F.col(c).alias(out) for c, out in columns.items()])
    entries = table.select(F.col("category").alias("__category"), "n", named.alias(held))
    probe = df.withColumn(key, value)
    if rows <= SMALL_ROWS:
        met = probe.join(F.broadcast(entries.drop("n")), probe[key] == F.col("__category"), "left")
        return met.select(*[probe[f"`{c}`"] for c in df.columns], f"{held}.*")
    share = entries.agg((F.sum("n") / HOT_SHARE).alias("share")).scalar()
    is_hot = F.col("n") > share
    hot = entries.where(is_hot).select(F.col("__category").alias("__hot"), F.col(held).alias(hit))
    cold = entries.where(~is_hot).drop("n")
    met = probe.join(F.broadcast(hot), probe[key] == F.col("__hot"), "left").drop("__hot")
    asks = F.col(key).isNotNull() & F.col(hit).isNull()
    # a stand-in that no category equals: the row's own hash behind a prefix
    spread = F.concat(F.lit("\0~"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.monotonically_increasing_id()).cast("string"))
    met = met.withColumn("__asks", asks).withColumn("__join", F.when(asks, F.col(key)).otherwise(spread))
    out = met.join(cold, (F.col("__join") == F.col("__category")) & F.col("__asks"), "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(hit, held).alias(held)).select(*[F.col(f"`{c}`") for c in df.columns], f"{held}.*")
