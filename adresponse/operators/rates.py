"""Target rates in place of codes for categorical features too wide for a tree's bins (M1).

A category becomes the smoothed click rate of its train-side rows.  A train
row must not see its own click, so rows are dealt into folds by their key and
a row takes the sums of the other folds only.  One aggregate (partial before
the shuffle) makes the sums of all categories, fold by fold; a look-up join
brings them to the rows, so the state is a table of any width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import unit
from .encoding import present
from .joins import look_up

FOLDS = 5
FOLD_SEED = 91
PRIOR_ROWS = 20.0  # rows at the common rate that every category starts with
RATE_SUFFIX = "_rate"


def fold(key) -> Column:
    """The fold of a row, from its key alone."""
    return F.pmod(unit(key, FOLD_SEED), F.lit(FOLDS)).cast("int")


def _sums(label: str) -> list:
    here = [F.col("fold") == k for k in range(FOLDS)]
    rows = F.array(*[F.count_if(h) for h in here]).alias("rows")
    clicks = F.array(*[F.coalesce(F.sum(F.when(h, F.col(label).cast("double"))), F.lit(0.0)) for h in here]).alias("clicks")
    return [rows, clicks]


def fit_rates(train: DataFrame, features, label: str, key: str) -> DataFrame:
    """(feature, category, n, rows ARRAY, clicks ARRAY): sums by fold; the row without a category holds those of all rows."""
    feats = present(train, features)
    rows = train.select(label, fold(key).alias("fold"), *feats)
    stack = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category")) for f in feats])
    values = rows.select(label, "fold", F.explode(stack).alias("p")).select(label, "fold", "p.*").where("category is not null")
    each = values.groupBy("feature", "category").agg(F.count("*").alias("n"), *_sums(label))
    every = rows.agg(F.count("*").alias("n"), *_sums(label))
    whole = every.select(F.lit("").alias("feature"), F.lit(None).cast("string").alias("category"), "n", "rows", "clicks")
    return each.unionByName(whole)


def common(state: DataFrame) -> tuple[list, list]:
    """Rows and clicks of all train rows by fold (2 x FOLDS numbers)."""
    r = state.where("feature = '' and category is null").select("rows", "clicks").first()
    return (list(r.rows), list(r.clicks)) if r else ([0] * FOLDS, [0.0] * FOLDS)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda a, b: a + b)


def smoothed(rows: Column, clicks: Column, prior: Column) -> Column:
    return (clicks + PRIOR_ROWS * prior) / (rows + PRIOR_ROWS)


def apply_rates(df: DataFrame, state: DataFrame, sizes: dict, totals: tuple[list, list], key: str, suffix: str = RATE_SUFFIX) -> DataFrame:
    """A rate column for each feature of ``sizes`` (its number of categories).

    Rows of a frame with ``is_test`` that aren't on the test side took part in
    the fit: they see the other folds.  Unseen and missing values get the
    common rate.
    """
    rows, clicks = totals
    n, s = sum(rows), sum(clicks)
    whole = s / n if n else 0.5
    others = [(s - clicks[k]) / (n - rows[k]) if n > rows[k] else whole for k in range(FOLDS)]
    own = ~F.col("is_test") if "is_test" in df.columns else F.lit(False)
    mine = F.when(own, fold(key)) if "is_test" in df.columns else F.lit(None).cast("int")
    prior = F.coalesce(F.get(F.lit(others), mine), F.lit(whole))
    for f, size in sizes.items():
        known = state.where((F.col("feature") == f) & F.col("category").isNotNull())
        known = known.select("category", "n", F.struct("rows", "clicks").alias("sums"))
        df = look_up(df, F.col(f).cast("string"), known, size, {"sums": "__sums"})
        seen_rows, seen_clicks = F.col("__sums.rows"), F.col("__sums.clicks")
        less = lambda whole, numbers: _total(whole) - F.coalesce(F.get(numbers, mine), F.lit(0.0))
        rate = smoothed(less(seen_rows.cast("array<double>"), seen_rows.cast("array<double>")), less(seen_clicks, seen_clicks), prior)
        df = df.withColumn(f + suffix, F.coalesce(rate, prior)).drop("__sums")
    return df
