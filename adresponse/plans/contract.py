"""M7: what a model's requests must hold, learnt from the rows it was trained on.

A contract has a row for each feature that a request brings (looked-up
features come from their table): its kind - ``text``, ``number`` or ``whole``
number, from the model's types - and whether it is ``required``, that is
whether no training row lacks it.  It is saved beside the model as one JSON row.
Checking is declarative: a request table's breaches are rows, its totals one
aggregate.  A value is missing if it is NULL, NaN or one of the text markers.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from ..config import MISSING_TEXT, ModelSpec
from ..functions.cleaning import parse_number_text

BREACHES = ("missing", "not a number", "not a whole number")
KINDS = {"string": "text", "int": "whole", "double": "number"}


@dataclass(frozen=True)
class Field:
    feature: str
    kind: str
    required: bool


def _missing(df: DataFrame, name: str) -> Column:
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, StringType):
        return c.isNull() | c.isin(*MISSING_TEXT)
    return c.isNull() | F.isnan(c) if isinstance(kind, (DoubleType, FloatType)) else c.isNull()


def infer(training: DataFrame, spec: ModelSpec) -> tuple[Field, ...]:
    """The contract by all rows of ``training``, one aggregate; no rows ask for nothing."""
    names = [f for f in spec.features if f not in spec.lookup_features]
    row = training.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(_missing(training, f)).alias(f) for f in names]).first()
    return tuple(Field(f, KINDS[spec.feature_types[f]], bool(row["rows"]) and row[f] == 0) for f in names)


def rows(contract, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([astuple(f) for f in contract], "feature string, kind string, required boolean")


def save(contract, spark: SparkSession, path: str) -> None:
    row = rows(contract, spark).coalesce(1).agg(F.collect_list(F.struct("feature", "kind", "required")).alias("fields"))
    row.write.mode("overwrite").json(f"{path}/contract")


def load(spark: SparkSession, path: str) -> tuple[Field, ...]:
    saved = spark.read.schema("fields array<struct<feature: string, kind: string, required: boolean>>").json(f"{path}/contract")
    return tuple(Field(*f) for f in saved.first()["fields"])


def check_columns(requests: DataFrame, contract) -> None:
    """ValueError for a required feature without a column, and for a column that is neither numbers nor text."""
    absent = [f.feature for f in contract if f.required and f.feature not in requests.columns]
    if absent:
        raise ValueError(f"requests lack the required features {absent}")
    held = [f.feature for f in contract if f.feature in requests.columns]
    wrong = [f for f in held if not isinstance(requests.schema[f].dataType, (NumericType, StringType))]
    if wrong:
        raise ValueError(f"requests hold neither numbers nor text in {wrong}")


def _breach(requests: DataFrame, field: Field) -> Column:
    """What is wrong with a request's value, NULL if nothing is."""
    c = F.col(f"`{field.feature}`")
    missing = _missing(requests, field.feature)
    out = F.when(missing, F.lit("missing") if field.required else F.lit(None))
    if field.kind == "text":
        return out
    number = parse_number_text(c) if isinstance(requests.schema[field.feature].dataType, StringType) else c.cast("double")
    out = out.when(number.isNull(), F.lit("not a number"))
    whole = F.abs(number) < 2**31  # false for infinities
    return out.when(~(whole & (number == F.floor(number))), F.lit("not a whole number")) if field.kind == "whole" else out


def breaches(requests: DataFrame, contract, key: str = "event_id") -> DataFrame:
    """A row (key, feature, breach) for each value that breaks the contract; map-only."""
    check_columns(requests, contract)
    held = [f for f in contract if f.feature in requests.columns]
    each = F.array(*[F.struct(F.lit(f.feature).alias("feature"), _breach(requests, f).alias("breach")) for f in held])
    found = requests.select(key, F.explode(F.filter(each, lambda b: b["breach"].isNotNull())).alias("b"))
    return found.select(key, "b.feature", "b.breach")


def check(requests: DataFrame, contract) -> None:
    """ValueError with the number of breaches of each kind, if there is any; one aggregate without a shuffle of rows."""
    check_columns(requests, contract)
    held = [f for f in contract if f.feature in requests.columns]
    counts = {f"{f.feature} {b}": F.count_if(_breach(requests, f) == b) for f in held for b in BREACHES}
    found = requests.agg(*[c.alias(name) for name, c in counts.items()]).first() if held else []
    told = [f"{name} ({n})" for name, n in zip(counts, found) if n]
    if told:
        raise ValueError("requests break the contract: " + ", ".join(told))
