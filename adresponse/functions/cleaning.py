"""Feature cleaners (C1-C11) as native column expressions.

Each cleaner takes the input column and a ``policy``:

* ``train``  -- model-1 training: unknown OS and NULL become ``Other``;
  gender is mapped to F/M or NULL.
* ``lookup`` -- model-2 (feature-lookup) training and scoring: like train,
  but a NULL OS stays NULL; age/income are parsed from text.
* ``serve``  -- model-1 scoring: missing markers become ``""`` for text and
  NULL for numbers; the traffic source id is parsed as well.

Behaviour that depends on the input type (a number ``-1`` vs the text
``"-1"``) is resolved from the DataFrame schema when the plan is built, so
everything stays inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..config import (
    FEMALE_SPELLINGS,
    KNOWN_OS,
    MALE_SPELLINGS,
    MISSING_NUMBER,
    MISSING_TEXT,
    OTHER_OS,
)

POLICIES = ("train", "lookup", "serve")

# Decimal text as a float parser reads it: sign, digits with single
# underscores between them, optional fraction and exponent, outer blanks
# (Unicode whitespace, hence the (?U) flag).  Digits are ASCII here because
# every Unicode decimal digit is first translated to its ASCII value.
# Whitespace a float parser strips: Unicode White_Space, which is what \s
# means under (?U).  (str.isspace() also counts U+001C..U+001F; float() does
# not strip those, and neither does this pattern.)
WS = r"\s"
NUMBER_PATTERN = (
    rf"(?U)^{WS}*[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)"
    rf"([eE][+-]?[0-9]+(_[0-9]+)*)?{WS}*\z"
)
INFINITY_PATTERN = rf"(?U)^{WS}*[+-]?(inf|infinity){WS}*\z"
DIGITS_PATTERN = r"^[0-9]+\z"  # \z: "$" would also accept a trailing newline
OUTER_SPACE = rf"(?U)^{WS}+|{WS}+\z"
PLAIN_DECIMAL = r"^-?[0-9]*\.?[0-9]*\z"


@functools.lru_cache(maxsize=1)
def decimal_digits() -> tuple[str, str]:
    """All non-ASCII Unicode decimal digits and their ASCII values (built from unicodedata)."""
    src, dst = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.decimal(ch)))
    return "".join(src), "".join(dst)


def ascii_digits(c: Column) -> Column:
    """Unicode decimal digits -> ASCII; ASCII-only text (same char and byte length) skips the table."""
    src, dst = decimal_digits()
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.translate(c, src, dst))


def _check(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"unknown cleaning policy {policy!r}; use one of {POLICIES}")


def _missing_text(c: Column) -> Column:
    return c.isNull() | c.isin(*MISSING_TEXT)


def clean_os(c: Column, policy: str = "train") -> Column:
    """C1 (train), C2 (lookup), C3 (serve)."""
    _check(policy)
    keep = F.when(c.isin(*KNOWN_OS), c).otherwise(F.lit(OTHER_OS))
    if policy == "train":
        return keep
    if policy == "lookup":
        return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(keep)
    return F.when(_missing_text(c), F.lit("")).otherwise(keep)


def clean_gender(c: Column, policy: str = "train") -> Column:
    """C4 (train), C5 (lookup), C6 (serve).  A NULL input gives NULL in train/lookup."""
    _check(policy)
    low = F.lower(c)
    mapped = F.when(low.isin(*FEMALE_SPELLINGS), F.lit("F")).when(low.isin(*MALE_SPELLINGS), F.lit("M"))
    if policy == "serve":
        return F.when(_missing_text(c), F.lit("")).otherwise(F.coalesce(mapped, F.lit("")))
    return mapped


def parse_number_text(c: Column) -> Column:
    """Text -> double the way a float parser reads it; markers and junk -> NULL.

    Plain ``-?digits.digits`` text (nearly all rows) goes straight to the
    cast, where Spark and a float parser agree; only other text pays for the
    Unicode digit/whitespace handling and the full pattern.
    """
    a = ascii_digits(c)
    t = F.regexp_replace(a, OUTER_SPACE, "")
    return (
        F.when(_missing_text(c), F.lit(None).cast("double"))
        .when(c.rlike(PLAIN_DECIMAL), c.try_cast("double"))
        .when(a.rlike(NUMBER_PATTERN), F.regexp_replace(t, "_", "").try_cast("double"))
        .when(F.lower(a).rlike(INFINITY_PATTERN), t.try_cast("double"))
    )


def clean_number(c: Column, dtype, policy: str = "serve") -> Column:
    """C7-C9 (age, household income).

    Typed numbers: the marker -1 becomes NULL.  Text (model 2 casts its input
    to text first): markers become NULL and numbers are parsed, so ``"-1"``
    is -1.0; under ``lookup`` a number that is already parsed stays as it is,
    so that cleaning twice is cleaning once.  NaN is NULL throughout.
    """
    _check(policy)
    if isinstance(dtype, StringType):
        out = parse_number_text(c)
    elif isinstance(dtype, NumericType) and policy == "lookup":
        out = c.cast("double")
    elif isinstance(dtype, NumericType):
        out = F.when(c == F.lit(MISSING_NUMBER), F.lit(None).cast("double")).otherwise(c.cast("double"))
    else:
        raise TypeError(f"cannot clean a number of type {dtype}")
    return F.when(F.isnan(out), F.lit(None).cast("double")).otherwise(out)


def clean_traffic_source(c: Column, dtype) -> Column:
    """Numbers cast to double; text only when all characters are decimal digits.

    Non-decimal numeric characters (fractions, numerals) make the original
    fail outright; here they give NULL.
    """
    if isinstance(dtype, StringType):
        a = ascii_digits(c)
        out = F.when(a.rlike(DIGITS_PATTERN), a.try_cast("double"))
    elif isinstance(dtype, NumericType):
        out = c.cast("double")
    else:
        raise TypeError(f"cannot clean a source id of type {dtype}")
    return F.when(F.isnan(out), F.lit(None).cast("double")).otherwise(out)


# columns each policy cleans (C11)
POLICY_COLUMNS = {
    "train": ("os_name", "gender"),
    "lookup": ("os_name", "gender", "age", "household_income"),
    "serve": ("os_name", "gender", "age", "household_income", "traffic_source_id"),
}


def clean_frame(df: DataFrame, policy: str = "train") -> DataFrame:
    """C11: apply the policy's cleaners in place (absent columns are skipped)."""
    _check(policy)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for name in POLICY_COLUMNS[policy]:
        if name not in types:
            continue
        c = F.col(name)
        if name == "os_name":
            out[name] = clean_os(c, policy)
        elif name == "gender":
            out[name] = clean_gender(c, policy)
        elif name in ("age", "household_income"):
            out[name] = clean_number(c, types[name], policy)
        else:
            out[name] = clean_traffic_source(c, types[name])
    return df.withColumns(out) if out else df
