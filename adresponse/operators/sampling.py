"""Sampling, null-injection augmentation, split, example rows.

All draws are hash draws on the row key (``functions.hashing``): they are
map-only (no shuffle, no sort), do not change when partitioning changes or a
task is retried, and a blanked copy keeps its key, so it lands on the same
side of the split as its original.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    AUGMENT_COLUMNS,
    AUGMENT_FRACTION,
    AUGMENT_SEEDS,
    EXAMPLE_ROWS,
    EXAMPLE_SEED,
    SPLIT_SEED,
    TRAIN_FRACTION,
    VALIDATION_FRACTION,
)
from ..functions.hashing import below, unit
from .features import null_column


def hash_sample(df: DataFrame, fraction: float, seed: int, key: str = "event_id") -> DataFrame:
    """Keep about ``fraction`` of the rows, chosen by key hash."""
    return df.where(below(key, seed, fraction))


def augment_union(
    df: DataFrame,
    columns=AUGMENT_COLUMNS,
    fraction: float = AUGMENT_FRACTION,
    seeds=AUGMENT_SEEDS,
    key: str = "event_id",
) -> DataFrame:
    """U1 + R2, literal form: base rows UNION ALL one blanked sample per column."""
    out = df.withColumn("variant", F.lit(0))
    for i, c in enumerate(columns, start=1):
        part = null_column(hash_sample(df, fraction, seeds[c], key), c).withColumn("variant", F.lit(i))
        out = out.unionByName(part)
    return out


def augment_nulls(
    df: DataFrame,
    columns=AUGMENT_COLUMNS,
    fraction: float = AUGMENT_FRACTION,
    seeds=AUGMENT_SEEDS,
    key: str = "event_id",
) -> DataFrame:
    """R2, single-scan form: each row explodes into itself plus its blanked copies.

    Equal as a multiset to ``augment_union`` but reads the input once; the
    explode is a narrow operator, so no shuffle is added.
    """
    tags = [F.lit(0)] + [F.when(below(key, seeds[c], fraction), F.lit(i)) for i, c in enumerate(columns, 1)]
    ex = df.withColumn("variant", F.explode(F.array_compact(F.array(*tags))))
    types = {f.name: f.dataType for f in df.schema.fields}
    return ex.withColumns(
        {
            c: F.when(F.col("variant") == i, F.lit(None).cast(types[c])).otherwise(F.col(c))
            for i, c in enumerate(columns, 1)
        }
    )


def is_test(key: str = "event_id", seed: int = SPLIT_SEED, train_fraction: float = TRAIN_FRACTION):
    """R3 as a column: True on the test side (about 1 - train_fraction of keys)."""
    return ~below(key, seed, train_fraction)


def is_validation(key: str = "event_id", seed: int = SPLIT_SEED, train_fraction: float = TRAIN_FRACTION,
                  fraction: float = VALIDATION_FRACTION):
    """True in the third hash range, the last ``fraction`` of all keys below the test side's."""
    return below(key, seed, train_fraction) & ~below(key, seed, train_fraction - fraction)


def three_way(key: str = "event_id"):
    """R3 as a column: ``fit``, ``valid`` or ``test``."""
    return F.when(is_test(key), F.lit("test")).when(is_validation(key), F.lit("valid")).otherwise(F.lit("fit"))


def hash_split(df: DataFrame, key: str = "event_id", seed: int = SPLIT_SEED,
               train_fraction: float = TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete train/test split by key hash."""
    flag = is_test(key, seed, train_fraction)
    return df.where(~flag), df.where(flag)


def example_rows(df: DataFrame, n: int = EXAMPLE_ROWS, seed: int = EXAMPLE_SEED,
                 key: str = "event_id", keep=("event_id",)) -> DataFrame:
    """``n`` rows picked by key hash, the first one with every feature blanked.

    ``orderBy(...).limit(n)`` plans as a top-k (each task keeps n rows), so
    no full sort or shuffle of the input happens.
    """
    picked = df.withColumn("__u", unit(key, seed)).orderBy("__u", key).limit(n)
    rank = F.row_number().over(Window.orderBy("__u", key))
    blank = {
        c: F.when(rank == 1, F.lit(None).cast(t)).otherwise(F.col(c))
        for c, t in ((f.name, f.dataType) for f in df.schema.fields)
        if c not in keep
    }
    return picked.withColumns(blank).drop("__u")
