"""Feature preparation: casts, column selection, feature lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..config import LOOKUP_FEATURES, ModelSpec
from .joins import assert_unique_key


def cast_features(df: DataFrame, types: dict) -> DataFrame:
    """Cast the listed columns to their declared types, in place.

    Casting to text is total; casting to numbers uses ``try_cast`` so bad
    input becomes NULL under ANSI mode instead of failing the job.
    """
    out = {}
    for name, t in types.items():
        if name in df.columns:
            c = F.col(name)
            out[name] = c.cast(t) if t == "string" else c.try_cast(t)
    return df.withColumns(out) if out else df


def select_loaded(df: DataFrame, spec: ModelSpec, keys=("event_id",)) -> DataFrame:
    """P7 + P8: the model's loaded features in a fixed order, label cast to its type."""
    loaded = [f for f in spec.features if f not in spec.lookup_features]
    keep = [k for k in keys if k in df.columns]
    return df.select(*keep, *loaded, F.col(spec.label).cast(spec.label_type).alias(spec.label))


def null_column(df: DataFrame, name: str) -> DataFrame:
    """Replace a column by a typed NULL."""
    t = df.schema[name].dataType
    return df.withColumn(name, F.lit(None).cast(t))


def lookup_features(
    df: DataFrame,
    features: DataFrame,
    key: str = "campaign_id",
    names=LOOKUP_FEATURES,
) -> DataFrame:
    """Left join the feature table onto the rows.

    A key that the table holds twice would multiply rows, so it is an error
    (one aggregate over the table).  AQE picks the join from real sizes.  The
    key column of the rows keeps its type; the feature key is cast to it.
    """
    kt = df.schema[key].dataType
    right = features.select(F.col(key).cast(kt).alias(key), *names)
    assert_unique_key(right, key)
    return df.join(right, on=key, how="left")


def null_presence(df: DataFrame, columns) -> DataFrame:
    """One pass -> (feature, null_count, has_null) per column, long form."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stacked = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"stack({len(columns)}, {stacked}) AS (feature, null_count)").withColumn(
        "has_null", F.col("null_count") > 0
    )


def int_to_double_plan(df: DataFrame, columns) -> DataFrame:
    """E2 as data: integer features holding a NULL are promoted to double."""
    types = {f.name: f.dataType for f in df.schema.fields}
    pres = null_presence(df, columns)
    is_int = F.create_map(
        *[x for c in columns for x in (F.lit(c), F.lit(isinstance(types[c], IntegralType)))]
    )
    src = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(types[c].simpleString()))])
    return pres.select(
        "feature",
        src[F.col("feature")].alias("source_type"),
        F.when(is_int[F.col("feature")] & F.col("has_null"), F.lit("double"))
        .otherwise(src[F.col("feature")])
        .alias("target_type"),
    )


def promote_ints_with_nulls(df: DataFrame, columns) -> DataFrame:
    """E2 applied: decide with one aggregate, then cast in place."""
    plan = int_to_double_plan(df, columns).where(F.col("source_type") != F.col("target_type"))
    promote = [r["feature"] for r in plan.collect()]
    return df.withColumns({c: F.col(c).cast("double") for c in promote}) if promote else df
