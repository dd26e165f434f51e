"""Category dictionaries and encoding.

``fit_dictionary`` computes, distributed, the sorted distinct non-NULL values
of each categorical feature of the *train* side: one narrow stack, one
aggregate (partial before the shuffle), one range-partitioned sort.  A code is
a row's place in that order: rows before its partition (a count for each
partition) plus its place in the partition, less the place where its feature
begins, so no task sorts or ranks a whole feature.  Features listed in
``numeric_order`` sort by value (model 1's float/int features), the rest by
text.

``encode`` looks codes up in the dictionary as a table; nothing but the number
of categories of each feature reaches the driver.  Unseen values and NULL
share the extra last index, as in the original encoder.  Categories are
Spark's own text form of the values.
"""

from __future__ import annotations

import logging
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .joins import look_up

log = logging.getLogger(__name__)

CODE_SUFFIX = "_idx"
_PLACE_BITS = 33  # of a row's place within its partition, in monotonically_increasing_id


def present(df: DataFrame, features) -> list:
    """E5: features absent from the frame are reported and skipped."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        log.warning("columns not found, not encoded: %s", missing)
    return [f for f in features if f in df.columns]


def fit_counts(df: DataFrame, features, numeric_order=()) -> DataFrame:
    """(feature, category STRING, code INT, n): as ``fit_dictionary``, with the rows of each category."""
    feats = present(df, features)
    pairs = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("string").alias("category"),
            (F.col(f).cast("double") if f in numeric_order else F.lit(None).cast("double")).alias("num"),
        )
        for f in feats
    ]
    stacked = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    values = stacked.where(F.col("category").isNotNull()).groupBy("feature", "num", "category").agg(F.count("*").alias("n"))
    return dense_codes(values)


def dense_codes(values: DataFrame) -> DataFrame:
    """Distinct (feature, num, category, n) with codes 0.. of each feature in order of (num, category)."""
    checkpoint_dir(values.sparkSession)
    order = [F.col("feature"), F.col("num").asc_nulls_last(), F.col("category")]
    placed = values.repartitionByRange(*order).sortWithinPartitions(*order)
    # written: the counts and the codes below must see the same partitions
    placed = placed.withColumn("place", F.monotonically_increasing_id()).checkpoint()
    part, within = F.shiftright("place", _PLACE_BITS), F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return placed.select("feature", "category", F.lit(None).cast("int").alias("code"), "n")
    # a number for each partition
    before = list(accumulate((sizes.get(i, 0) for i in range(max(sizes) + 1)), initial=0))
    placed = placed.withColumn("at", F.lit(before)[part.cast("int")] + within)
    begins = {r["feature"]: r["first"] for r in placed.groupBy("feature").agg(F.min("at").alias("first")).collect()}
    first = F.create_map(*[F.lit(x) for pair in begins.items() for x in pair])
    return placed.select("feature", "category", (F.col("at") - first[F.col("feature")]).cast("int").alias("code"), "n")


def fit_dictionary(df: DataFrame, features, numeric_order=()) -> DataFrame:
    """(feature, category STRING, code INT), codes 0.. in sort order."""
    return fit_counts(df, features, numeric_order).drop("n")


def dictionary_sizes(dictionary: DataFrame, features) -> dict:
    """Categories of each feature."""
    found = {r["feature"]: r["n"] for r in dictionary.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    return {f: found.get(f, 0) for f in features}


def encode(df: DataFrame, dictionary: DataFrame, sizes: dict, suffix: str = CODE_SUFFIX) -> DataFrame:
    """A code column (double) for each feature of ``sizes``; unseen/NULL -> the last index.

    The column says how many values it has, so that trees treat it as
    categorical.
    """
    for f, size in sizes.items():
        out = f + suffix
        known = dictionary.where(F.col("feature") == f).select("category", "n", F.col("code").cast("double").alias("code"))
        df = look_up(df, F.col(f).cast("string"), known, size, {"code": out})
        kind = {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": out}}
        df = df.withColumn(out, F.coalesce(out, F.lit(float(size))).alias(out, metadata=kind))
    return df
