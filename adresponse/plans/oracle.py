"""DuckDB SQL for every oracle-checked query in ``registry``.

The shared CTEs restate the fixture views and the training-row query in
plain SQL over the driver's tables, so each oracle statement is
self-contained.  Hash draws use the same md5 rule as ``functions.hashing``.
"""

from __future__ import annotations

from ..config import (
    AUGMENT_FRACTION,
    AUGMENT_SEEDS,
    EXAMPLE_SEED,
    MAX_POSITION,
    ROUTE_SEED,
    SPLIT_SEED,
    TRAIN_FRACTION,
    WINDOW_DAYS,
)

TWO32 = 4294967296


def unit(key_sql: str, seed: int) -> str:
    """Integer in [0, 2^32) from the first 8 hex digits of md5(key|seed)."""
    return f"CAST(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{seed}'), 1, 8)) AS BIGINT)"


def below(key_sql: str, seed: int, fraction: float) -> str:
    return f"({unit(key_sql, seed)} < {int(round(fraction * TWO32))})"


IMPRESSIONS = """
impressions AS (
  SELECT event_id,
         ts AS "timestamp",
         CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN NULL ELSE 0 END AS click,
         CASE user_id % 7 WHEN 0 THEN 'F' WHEN 1 THEN 'female' WHEN 2 THEN 'Male'
              WHEN 3 THEN 'm' WHEN 4 THEN 'NA' WHEN 5 THEN '' END AS profile_gender,
         CASE WHEN user_id % 10 <> 9 THEN sha256(CAST(user_id AS VARCHAR)) END AS profile_emailsha256,
         json_extract_string(props, '$.k') AS campdata_campaignid,
         CASE WHEN event_id % 11 <> 0 THEN event_id % 13 END AS trafsrc_sourceid,
         CASE WHEN event_id % 17 <> 0 THEN 'p' || CAST(event_id % 5 AS VARCHAR) END AS trafsrc_trafficpartnerid,
         CASE user_id % 8 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Windows' WHEN 3 THEN 'Mac'
              WHEN 4 THEN 'Linux' WHEN 5 THEN '' WHEN 6 THEN 'null' END AS device_osname,
         CASE WHEN event_id % 9 <> 0 THEN CAST(event_id % 7 + 1 AS INTEGER) END AS campdata_flowimpressionposition
  FROM events)"""

IDENTITY = """
identity AS (
  SELECT sha256(CAST(c_custkey AS VARCHAR)) AS sha256_email_address,
         CASE WHEN c_nationkey % 3 = 0 THEN 'M' WHEN c_nationkey % 3 = 1 THEN 'F' END AS gender,
         CAST(CASE WHEN c_custkey % 12 = 0 THEN -1 ELSE 18 + c_custkey % 60 END AS INTEGER) AS exact_age,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal * 10 END AS est_household_income
  FROM customer)"""

IDENTITY_FANOUT = """
identity AS (
  SELECT sha256(CAST(c_custkey AS VARCHAR)) AS sha256_email_address,
         CASE WHEN c_nationkey % 3 = 0 THEN 'M' WHEN c_nationkey % 3 = 1 THEN 'F' END AS gender,
         CAST(CASE WHEN c_custkey % 12 = 0 THEN -1 ELSE 18 + c_custkey % 60 END AS INTEGER) AS exact_age,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal * 10 END AS est_household_income
  FROM customer
  UNION ALL
  SELECT sha256(CAST(c_custkey AS VARCHAR)), 'F', 99, 1.0
  FROM customer WHERE c_custkey % 50 = 0)"""

CAMPAIGNS = """
campaign_features AS (
  SELECT CAST(p_partkey AS VARCHAR) AS campaign_id, p_type AS vertical, p_brand AS subvertical
  FROM part WHERE p_partkey % 10 <> 9)"""

AS_OF = """
as_of AS (SELECT max(ts) AS as_of, max(ts) - INTERVAL {days} DAY AS floor_ts FROM events)""".format(
    days=WINDOW_DAYS
)

TRAINING = """
training AS (
  SELECT a.event_id,
         a."timestamp",
         COALESCE(a.click, 0) AS click,
         COALESCE(a.profile_gender, b.gender) AS gender,
         a.campdata_campaignid AS campaign_id,
         a.trafsrc_sourceid AS traffic_source_id,
         a.trafsrc_trafficpartnerid AS traffic_partner_id,
         a.device_osname AS os_name,
         b.exact_age AS age,
         b.est_household_income AS household_income,
         a.campdata_flowimpressionposition AS "position",
         CAST(hour(a."timestamp") AS INTEGER) AS hour
  FROM impressions a
  LEFT JOIN identity b ON a.profile_emailsha256 = b.sha256_email_address
  WHERE a."timestamp" > (SELECT floor_ts FROM as_of)
    AND (a.campdata_flowimpressionposition <= {maxpos} OR a.campdata_flowimpressionposition IS NULL)
    AND a.trafsrc_trafficpartnerid <> 'p4')""".format(maxpos=MAX_POSITION)

BASE = [IMPRESSIONS, IDENTITY, CAMPAIGNS, AS_OF, TRAINING]


def with_ctes(*ctes: str, body: str, base=None) -> str:
    parts = list(BASE if base is None else base) + list(ctes)
    return "WITH " + ",".join(parts) + "\n" + body


# ---- cleaners in SQL (C1-C10) ---------------------------------------------
def os_sql(c: str, policy: str) -> str:
    known = "('Android', 'iOS', 'Windows', 'Mac')"
    if policy == "train":
        return f"CASE WHEN {c} IN {known} THEN {c} ELSE 'Other' END"
    if policy == "lookup":
        return f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} IN {known} THEN {c} ELSE 'Other' END"
    return (
        f"CASE WHEN {c} IS NULL OR {c} IN ('null', 'NA', '') THEN '' "
        f"WHEN {c} IN {known} THEN {c} ELSE 'Other' END"
    )


def gender_sql(c: str, policy: str) -> str:
    core = f"WHEN lower({c}) IN ('f', 'female') THEN 'F' WHEN lower({c}) IN ('m', 'male') THEN 'M'"
    if policy == "serve":
        return f"CASE WHEN {c} IS NULL OR {c} IN ('null', 'NA', '') THEN '' {core} ELSE '' END"
    return f"CASE {core} ELSE NULL END"


NUM_RE = r"^\s*[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?\s*$"
INF_RE = r"^\s*[+-]?(inf|infinity)\s*$"


def number_text_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR {c} IN ('null', 'NA', '') THEN NULL "
        f"WHEN regexp_matches({c}, '{NUM_RE}') THEN TRY_CAST(replace(trim({c}), '_', '') AS DOUBLE) "
        f"WHEN regexp_matches(lower({c}), '{INF_RE}') THEN TRY_CAST(trim({c}) AS DOUBLE) "
        f"ELSE NULL END"
    )


def number_typed_sql(c: str) -> str:
    return f"CASE WHEN {c} = -1 THEN NULL ELSE CAST({c} AS DOUBLE) END"


def source_text_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^[0-9]+$') THEN CAST({c} AS DOUBLE) ELSE NULL END"


# ---- hash helpers for the sampling queries ----------------------------------
def augmented_sql(source: str = "training", cols=None) -> str:
    """R2 as SQL: base rows plus three blanked 5 % copies (variant 0..3)."""
    cols = cols or [
        "event_id", '"timestamp"', "click", "gender", "campaign_id", "traffic_source_id",
        "traffic_partner_id", "os_name", "age", "household_income", '"position"', "hour",
    ]
    def sel(variant: int, blank: str | None) -> str:
        out = []
        for c in cols:
            name = c.strip('"')
            if blank and name == blank:
                out.append(f"NULL AS {c}")
            else:
                out.append(c)
        return ", ".join(out) + f", {variant} AS variant"
    parts = [f"SELECT {sel(0, None)} FROM {source}"]
    for i, col in enumerate(("campaign_id", "traffic_source_id", "traffic_partner_id"), start=1):
        parts.append(
            f"SELECT {sel(i, col)} FROM {source} WHERE {below('event_id', AUGMENT_SEEDS[col], AUGMENT_FRACTION)}"
        )
    return "\nUNION ALL\n".join(parts)


def is_test_sql(key: str = "event_id") -> str:
    return f"NOT {below(key, SPLIT_SEED, TRAIN_FRACTION)}"


def route_sql(key: str, pct_model1: float) -> str:
    return f"CASE WHEN {below(key, ROUTE_SEED, pct_model1 / 100.0)} THEN 'MODEL1' ELSE 'MODEL2' END"


def example_order_sql(key: str = "event_id") -> str:
    return unit(key, EXAMPLE_SEED)
