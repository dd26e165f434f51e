"""Registered queries: Spark callables and their DuckDB oracle statements.

Every query reads the driver's tables through the fixture views, so its work
grows with the data.  ``ORACLE`` holds SQL for every query whose rows SQL can
state; model fitting and scoring are checked by row count and by pytest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (
    AUGMENT_FRACTION,
    AUGMENT_SEEDS,
    MAX_POSITION,
    MODEL1,
    MODEL2,
    SEARCH_EVALS,
    SEARCH_SPACE,
    SPLIT_SEED,
    TRAIN_FRACTION,
    VALIDATION_FRACTION,
    VERSION_PREFIX,
    WINDOW_DAYS,
    BoostParams,
    IngestSpec,
)
from ..functions import cleaning as C
from ..operators import commits, encoding, features, ingest, rates, runlog, sampling
from ..session import checkpoint_dir
from . import contract, modeling, scoring, tuning
from . import oracle as O
from .context import FIXTURE_SPEC, Inputs

RUN_ID = "run-0001"
ROUTE_PCT_MODEL1 = 50.0
AUDIT_TEXT = "append training rows newer than the target high-water mark"

TRAIN_COLS = [
    "event_id", '"timestamp"', "click", "gender", "campaign_id", "traffic_source_id",
    "traffic_partner_id", "os_name", "age", "household_income", '"position"', "hour",
]
FEATURE_COLS = [
    "gender", "campaign_id", "traffic_partner_id", "traffic_source_id", "os_name",
    "age", "hour", "household_income", '"position"',
]

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _in(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(spark, sf_dir)


# ---------------------------------------------------------------------------
# scans, projections, filters, joins (S, P, F, J)
# ---------------------------------------------------------------------------
@query("p_train_projection", O.with_ctes(body="SELECT * FROM training"))
def p_train_projection(spark, sf_dir) -> DataFrame:
    """Flagship: filters + identity join + projection."""
    return _in(spark, sf_dir).training()


@query("s3_window_load", O.with_ctes(body="SELECT * FROM training"))
def s3_window_load(spark, sf_dir):
    """The load's own window over training rows of all days."""
    i = _in(spark, sf_dir)
    every = IngestSpec(window_days=36500, excluded_partner=FIXTURE_SPEC.excluded_partner)
    return modeling.load_window(i.training(spec=every), i.as_of())


@query("s4_campaign_scan", O.with_ctes(body="SELECT campaign_id, vertical, subvertical FROM campaign_features"))
def s4_campaign_scan(spark, sf_dir):
    return _in(spark, sf_dir).campaigns().select("campaign_id", "vertical", "subvertical")


@query("p2_label_default", O.with_ctes(
    body="SELECT event_id, click AS click_raw, COALESCE(click, 0) AS click FROM impressions"))
def p2_label_default(spark, sf_dir):
    return _in(spark, sf_dir).impressions().select(
        "event_id", F.col("click").alias("click_raw"), F.coalesce("click", F.lit(0)).alias("click")
    )


_FILTERED_JOIN = f"""
SELECT a.event_id, a.profile_gender, b.gender AS identity_gender,
       COALESCE(a.profile_gender, b.gender) AS gender
FROM impressions a LEFT JOIN identity b ON a.profile_emailsha256 = b.sha256_email_address
WHERE a."timestamp" > (SELECT floor_ts FROM as_of)
  AND (a.campdata_flowimpressionposition <= {MAX_POSITION} OR a.campdata_flowimpressionposition IS NULL)
  AND a.trafsrc_trafficpartnerid <> 'p4'"""


@query("p3_gender_fallback", O.with_ctes(body=_FILTERED_JOIN))
def p3_gender_fallback(spark, sf_dir):
    i = _in(spark, sf_dir)
    imp = ingest.filter_impressions(i.impressions(), i.as_of(), FIXTURE_SPEC)
    j = ingest.join_identity(imp, i.identity())
    return j.select(
        "event_id", "profile_gender", F.col("gender").alias("identity_gender"),
        F.coalesce("profile_gender", "gender").alias("gender"),
    )


@query("p4_hour", O.with_ctes(
    body='SELECT event_id, "timestamp", CAST(hour("timestamp") AS INTEGER) AS hour FROM impressions'))
def p4_hour(spark, sf_dir):
    return _in(spark, sf_dir).impressions().select("event_id", "timestamp", F.hour("timestamp").alias("hour"))


_M2_LOADED = {f: t for f, t in MODEL2.feature_types.items() if f not in MODEL2.lookup_features}
_P6_SQL = "SELECT event_id, " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in FEATURE_COLS) + " FROM training"


@query("p6_cast_features", O.with_ctes(body=_P6_SQL))
def p6_cast_features(spark, sf_dir):
    t = features.cast_features(_in(spark, sf_dir).training(), _M2_LOADED)
    return t.select("event_id", *_M2_LOADED)


_P8_SQL = (
    "SELECT event_id, " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in FEATURE_COLS)
    + ", CAST(click AS FLOAT) AS click FROM training"
)


@query("p8_model2_columns", O.with_ctes(body=_P8_SQL))
def p8_model2_columns(spark, sf_dir):
    t = features.cast_features(_in(spark, sf_dir).training(), _M2_LOADED)
    return features.select_loaded(t, MODEL2)


_P9_SQL = (
    "SELECT " + ", ".join("CAST(NULL AS VARCHAR) AS campaign_id" if c == "campaign_id" else c for c in TRAIN_COLS)
    + f" FROM training WHERE {O.below('event_id', AUGMENT_SEEDS['campaign_id'], AUGMENT_FRACTION)}"
)


@query("p9_null_column", O.with_ctes(body=_P9_SQL))
def p9_null_column(spark, sf_dir):
    t = _in(spark, sf_dir).training()
    s = sampling.hash_sample(t, AUGMENT_FRACTION, AUGMENT_SEEDS["campaign_id"])
    return features.null_column(s, "campaign_id")


@query("p12_version_tag", O.with_ctes(
    body=f"""SELECT event_id, campaign_id, "position",
       '{VERSION_PREFIX}MODEL1 - {RUN_ID}' AS model_version FROM training"""))
def p12_version_tag(spark, sf_dir):
    tag = modeling.ClickModel(MODEL1, None, BoostParams(), RUN_ID).version_tag
    return _in(spark, sf_dir).training().select("event_id", "campaign_id", "position", F.lit(tag).alias("model_version"))


@query("f1_window", O.with_ctes(
    body='SELECT event_id, "timestamp" FROM impressions WHERE "timestamp" > (SELECT floor_ts FROM as_of)'))
def f1_window(spark, sf_dir):
    i = _in(spark, sf_dir)
    return i.impressions().where(ingest.in_window(i.as_of(), WINDOW_DAYS)).select("event_id", "timestamp")


@query("f2_position_cap", O.with_ctes(
    body=f"""SELECT event_id, campdata_flowimpressionposition AS "position" FROM impressions
WHERE campdata_flowimpressionposition <= {MAX_POSITION} OR campdata_flowimpressionposition IS NULL"""))
def f2_position_cap(spark, sf_dir):
    return _in(spark, sf_dir).impressions().where(ingest.position_ok(MAX_POSITION)).select(
        "event_id", F.col("campdata_flowimpressionposition").alias("position")
    )


@query("f3_partner_excluded", O.with_ctes(
    body="""SELECT event_id, trafsrc_trafficpartnerid AS traffic_partner_id FROM impressions
WHERE trafsrc_trafficpartnerid <> 'p4'"""))
def f3_partner_excluded(spark, sf_dir):
    return _in(spark, sf_dir).impressions().where(ingest.partner_ok(FIXTURE_SPEC.excluded_partner)).select(
        "event_id", F.col("trafsrc_trafficpartnerid").alias("traffic_partner_id")
    )


_TARGET = """
target AS (SELECT * FROM training WHERE "timestamp" <= (SELECT as_of - INTERVAL 5 DAY FROM as_of))"""
_HW = """(SELECT COALESCE(max("timestamp"), (SELECT floor_ts FROM as_of)) FROM target)"""


@query("f4_incremental", O.with_ctes(_TARGET, body=f'SELECT * FROM training WHERE "timestamp" > {_HW}'))
def f4_incremental(spark, sf_dir):
    i = _in(spark, sf_dir)
    return ingest.new_rows(i.training(), i.target_before(5), i.as_of(), WINDOW_DAYS)


@query("j4_high_water", O.with_ctes(_TARGET, body=f"SELECT {_HW} AS high_water"))
def j4_high_water(spark, sf_dir):
    i = _in(spark, sf_dir)
    return spark.range(1).select(ingest.high_water(i.target_before(5), i.as_of(), WINDOW_DAYS).alias("high_water"))


def _appended(spark, sf_dir) -> tuple[DataFrame, str]:
    """A table of the rows up to five days ago, then appended to: the audit row and where the table lies."""
    i = _in(spark, sf_dir)
    name = f"adresponse_append_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    ingest.ensure_table(spark, name, i.training(), path=path)
    before = ingest.append_rows(i.target_before(5), name, counted=True)
    audit = ingest.append_new(spark, i.training(), name, i.as_of(), WINDOW_DAYS, description=AUDIT_TEXT, rows_before=before)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return audit, path


@query("k4_append", O.with_ctes(_TARGET, body=f"""
SELECT *, CAST("timestamp" AS DATE) AS event_date FROM target
UNION ALL SELECT *, CAST("timestamp" AS DATE) FROM training WHERE "timestamp" > {_HW}"""))
def k4_append(spark, sf_dir):
    """The table that the append really wrote."""
    return spark.read.parquet(_appended(spark, sf_dir)[1])


@query("k4_two_runs", O.with_ctes(_TARGET, body=f"""
SELECT *, CAST("timestamp" AS DATE) AS event_date,
       CAST(CASE WHEN "timestamp" > {_HW} THEN 2 ELSE 1 END AS BIGINT) AS ingest_commit FROM training"""))
def k4_two_runs(spark, sf_dir):
    """The table after two overlapping runs: both read it empty, the one with the rows up to five days ago commits first."""
    i = _in(spark, sf_dir)
    name = f"adresponse_commits_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    commits.ensure_commit_table(spark, name, i.training(), path)
    seen = commits.snapshot(spark, name, i.as_of(), WINDOW_DAYS)
    for rows in (i.target_before(5), i.training()):
        commits.append_committed(spark, rows, name, i.as_of(), WINDOW_DAYS, seen=seen)
    table = spark.table(name).checkpoint()  # its days' folders are known to the catalog alone
    spark.sql(f"DROP TABLE {name}")
    return table


@query("k5_audit", O.with_ctes(_TARGET, body=f"""
SELECT (SELECT count(*) FROM target) AS rows_before,
       (SELECT count(*) FROM target) + (SELECT count(*) FROM training WHERE "timestamp" > {_HW}) AS rows_after,
       (SELECT count(*) FROM training WHERE "timestamp" > {_HW}) AS rows_inserted,
       '{AUDIT_TEXT}' AS data_query"""))
def k5_audit(spark, sf_dir):
    return _appended(spark, sf_dir)[0].drop("created")


@query("f5_rerun", O.with_ctes(body="""
SELECT CAST(1 AS INTEGER) AS run, CAST(0 AS BIGINT) AS rows_before, count(*) AS rows_after, count(*) AS rows_inserted FROM training
UNION ALL SELECT 2, count(*), count(*), CAST(0 AS BIGINT) FROM training"""))
def f5_rerun(spark, sf_dir):
    """The audit rows of an append into a table made for it, and of the same append again."""
    i = _in(spark, sf_dir)
    name = f"adresponse_rerun_{uuid.uuid4().hex}"
    ingest.ensure_table(spark, name, i.training(), path=f"{checkpoint_dir(spark).rstrip('/')}/{name}")
    audits = [ingest.append_new(spark, i.training(), name, i.as_of(), WINDOW_DAYS).withColumn("run", F.lit(n)) for n in (1, 2)]
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return audits[0].unionByName(audits[1]).select("run", "rows_before", "rows_after", "rows_inserted")


@query("j1_identity_left", O.with_ctes(body="""
SELECT a.event_id, a.profile_emailsha256, b.gender AS identity_gender, b.exact_age AS age,
       b.est_household_income AS household_income
FROM impressions a LEFT JOIN identity b ON a.profile_emailsha256 = b.sha256_email_address"""))
def j1_identity_left(spark, sf_dir):
    i = _in(spark, sf_dir)
    j = ingest.join_identity(i.impressions(), i.identity())
    return j.select(
        "event_id", "profile_emailsha256", F.col("gender").alias("identity_gender"),
        F.col("exact_age").alias("age"), F.col("est_household_income").alias("household_income"),
    )


@query("j1_heavy_keys", O.with_ctes("""
hot AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN sha256('1') ELSE profile_emailsha256 END AS profile_emailsha256
        FROM impressions)""", body="""
SELECT a.event_id, a.profile_emailsha256, b.gender AS identity_gender, b.exact_age AS age,
       b.est_household_income AS household_income
FROM hot a LEFT JOIN identity b ON a.profile_emailsha256 = b.sha256_email_address""",
                                    base=[O.IMPRESSIONS, O.IDENTITY_FANOUT, O.CAMPAIGNS, O.AS_OF, O.TRAINING]))
def j1_heavy_keys(spark, sf_dir):
    """J1 where one e-mail holds a third of all impressions, and the identity has some e-mails twice."""
    i = _in(spark, sf_dir)
    one = F.when(F.col("event_id") % 3 == 0, F.sha2(F.lit("1"), 256)).otherwise(F.col("profile_emailsha256"))
    j = ingest.join_identity(i.impressions().withColumn("profile_emailsha256", one), i.identity(fanout=True), heavy=True)
    return j.select(
        "event_id", "profile_emailsha256", F.col("gender").alias("identity_gender"),
        F.col("exact_age").alias("age"), F.col("est_household_income").alias("household_income"),
    )


@query("j1_fanout", O.with_ctes(body="SELECT * FROM training",
                                base=[O.IMPRESSIONS, O.IDENTITY_FANOUT, O.CAMPAIGNS, O.AS_OF, O.TRAINING]))
def j1_fanout(spark, sf_dir):
    return _in(spark, sf_dir).training(fanout=True)


_J2_SQL = (
    "SELECT t.event_id, " + ", ".join(f"CAST(t.{c} AS VARCHAR) AS {c}" for c in FEATURE_COLS)
    + ", CAST(t.click AS FLOAT) AS click, c.vertical, c.subvertical"
    + " FROM training t LEFT JOIN campaign_features c ON CAST(t.campaign_id AS VARCHAR) = c.campaign_id"
)


@query("j2_campaign_lookup", O.with_ctes(body=_J2_SQL))
def j2_campaign_lookup(spark, sf_dir):
    i = _in(spark, sf_dir)
    t = features.select_loaded(features.cast_features(i.training(), _M2_LOADED), MODEL2)
    return features.lookup_features(t, i.campaigns())


# ---------------------------------------------------------------------------
# aggregates (A)
# ---------------------------------------------------------------------------
@query("a1_row_count", O.with_ctes(body="SELECT count(*) AS row_count FROM training"))
def a1_row_count(spark, sf_dir):
    return _in(spark, sf_dir).training().agg(F.count(F.lit(1)).alias("row_count"))


@query("a2_max_ts", O.with_ctes(
    body='SELECT COALESCE(max("timestamp"), (SELECT floor_ts FROM as_of)) AS max_ts FROM training'))
def a2_max_ts(spark, sf_dir):
    i = _in(spark, sf_dir)
    return ingest.max_time(i.training()).select(
        F.coalesce("max_ts", ingest.window_floor(i.as_of(), WINDOW_DAYS)).alias("max_ts")
    )


_A4_SQL = O.with_ctes(
    f"""
split AS (SELECT *, {O.is_test_sql()} AS is_test FROM training)""",
    """
rates AS (SELECT hour, (sum(click) + 1.0) / (count(*) + 2.0) AS p FROM split WHERE NOT is_test GROUP BY hour)""",
    body="""
SELECT CASE WHEN s.is_test THEN 'test' ELSE 'train' END AS split,
       round(avg(-(s.click * ln(greatest(least(COALESCE(r.p, 0.5), 1 - 1e-15), 1e-15))
               + (1 - s.click) * ln(1 - greatest(least(COALESCE(r.p, 0.5), 1 - 1e-15), 1e-15)))), 6) AS log_loss,
       count(*) AS rows
FROM split s LEFT JOIN rates r ON s.hour = r.hour
GROUP BY 1""",
)


@query("a4_logloss", _A4_SQL)
def a4_logloss(spark, sf_dir):
    """A4 on a SQL-stateable predictor: smoothed click rate per hour (train side)."""
    t = _in(spark, sf_dir).training().withColumn("is_test", sampling.is_test())
    # at most 24 rows by construction (hour of day), so broadcasting is safe
    rates = t.where(~F.col("is_test")).groupBy("hour").agg(
        ((F.sum("click") + 1.0) / (F.count(F.lit(1)) + 2.0)).alias("p")
    )
    scored = t.join(F.broadcast(rates), "hour", "left").withColumn("p", F.coalesce("p", F.lit(0.5)))
    return scored.groupBy(modeling.split_name().alias("split")).agg(
        F.round(F.avg(modeling.log_loss(F.col("click"), F.col("p"))), 6).alias("log_loss"),
        F.count(F.lit(1)).alias("rows"),
    )


# model-1 training frame in SQL: clean (train) -> augment -> split -> caster
_M1_CLEAN = f"""
m1_clean AS (
  SELECT event_id, {O.gender_sql('gender', 'train')} AS gender, campaign_id, traffic_partner_id,
         traffic_source_id, {O.os_sql('os_name', 'train')} AS os_name, age, hour, household_income,
         "position", click
  FROM training)"""
_M1_COLS = ["event_id", "gender", "campaign_id", "traffic_partner_id", "traffic_source_id", "os_name",
            "age", "hour", "household_income", '"position"', "click"]
_M1_AUG = f"""
m1_aug AS ({O.augmented_sql('m1_clean', _M1_COLS)})"""
_M1_TYPED = f"""
m1_typed AS (
  SELECT event_id, variant, gender, campaign_id, traffic_partner_id,
         CAST(traffic_source_id AS DOUBLE) AS traffic_source_id, os_name,
         CAST(age AS DOUBLE) AS age, CAST(hour AS INTEGER) AS hour,
         CAST(household_income AS DOUBLE) AS household_income, CAST("position" AS INTEGER) AS "position",
         click, {O.is_test_sql()} AS is_test
  FROM m1_aug)"""


def _dict_sql(source: str, feats: list, numeric: tuple) -> str:
    parts = []
    for f in feats:
        q = f'"{f}"' if f == "position" else f
        num = f"CAST({q} AS DOUBLE)" if f in numeric else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{f}' AS feature, CAST({q} AS VARCHAR) AS category, {num} AS num FROM {source}")
    union = "\n    UNION ALL ".join(parts)
    return f"""
SELECT feature, category,
       CAST(dense_rank() OVER (PARTITION BY feature ORDER BY num ASC NULLS LAST, category) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT feature, category, num FROM ({union}) v WHERE category IS NOT NULL) d"""


_M1_DICT = f"""
m1_train AS (SELECT * FROM m1_typed WHERE NOT is_test),
m1_dict AS ({_dict_sql('m1_train', list(MODEL1.categorical), MODEL1.numeric_order)})"""


def _m1_prepared(spark, sf_dir):
    i = _in(spark, sf_dir)
    prepared = modeling.prepare(i.training(), MODEL1)
    from .stages import FeatureCaster, RowCleaner

    return FeatureCaster(modeling.model_types(MODEL1)).transform(RowCleaner("train").transform(prepared))


@query("a5_categories", O.with_ctes(_M1_CLEAN, _M1_AUG, _M1_TYPED, _M1_DICT, body="SELECT * FROM m1_dict"))
def a5_categories(spark, sf_dir):
    typed = _m1_prepared(spark, sf_dir)
    return encoding.fit_dictionary(typed.where(~F.col("is_test")), MODEL1.categorical, MODEL1.numeric_order)


# model-2 frame in SQL: cast to text -> lookup -> augment -> split -> clean (lookup policy)
_M2_TEXT = (
    "\nm2_text AS (SELECT t.event_id, "
    + ", ".join(f"CAST(t.{c} AS VARCHAR) AS {c}" for c in FEATURE_COLS)
    + ", CAST(t.click AS FLOAT) AS click, c.vertical, c.subvertical"
    + " FROM training t LEFT JOIN campaign_features c ON t.campaign_id = c.campaign_id)"
)
_M2_COLS = ["event_id", "gender", "campaign_id", "traffic_partner_id", "traffic_source_id", "os_name",
            "age", "hour", "household_income", '"position"', "click", "vertical", "subvertical"]
_M2_AUG = f"""
m2_aug AS ({O.augmented_sql('m2_text', _M2_COLS)})"""
_M2_CLEAN = f"""
m2_clean AS (
  SELECT event_id, variant, {O.gender_sql('gender', 'lookup')} AS gender, campaign_id, traffic_partner_id,
         traffic_source_id, {O.os_sql('os_name', 'lookup')} AS os_name,
         {O.number_text_sql('age')} AS age, hour, {O.number_text_sql('household_income')} AS household_income,
         "position", vertical, subvertical, click, {O.is_test_sql()} AS is_test
  FROM m2_aug)"""
_M2_DICT = f"""
m2_train AS (SELECT * FROM m2_clean WHERE NOT is_test),
m2_dict AS ({_dict_sql('m2_train', list(MODEL2.categorical), ())})"""


def _m2_prepared(spark, sf_dir):
    i = _in(spark, sf_dir)
    prepared = modeling.prepare(i.training(), MODEL2, i.campaigns())
    from .stages import FeatureCaster, RowCleaner

    return FeatureCaster(modeling.model_types(MODEL2)).transform(RowCleaner("lookup").transform(prepared))


@query("a5_categories_model2", O.with_ctes(_M2_TEXT, _M2_AUG, _M2_CLEAN, _M2_DICT, body="SELECT * FROM m2_dict"))
def a5_categories_model2(spark, sf_dir):
    typed = _m2_prepared(spark, sf_dir)
    return encoding.fit_dictionary(typed.where(~F.col("is_test")), MODEL2.categorical)


_M1_FEATS = list(MODEL1.features)


def _a6_sql(source: str) -> str:
    rows = []
    for f in _M1_FEATS:
        q = f'"{f}"' if f == "position" else f
        rows.append(f"SELECT '{f}' AS feature, count(*) FILTER (WHERE {q} IS NULL) AS null_count FROM {source}")
    return "SELECT feature, null_count, null_count > 0 AS has_null FROM (" + " UNION ALL ".join(rows) + ") x"


@query("a6_null_presence", O.with_ctes(_M1_CLEAN, _M1_AUG, _M1_TYPED, body=_a6_sql("m1_typed")))
def a6_null_presence(spark, sf_dir):
    return features.null_presence(_m1_prepared(spark, sf_dir), _M1_FEATS)


# schema facts of the model-1 frame before the caster (training-table types)
_E2_SOURCE_TYPES = {
    "gender": "string", "campaign_id": "string", "traffic_partner_id": "string",
    "traffic_source_id": "bigint", "os_name": "string", "age": "int", "hour": "int",
    "household_income": "double", "position": "int",
}
_E2_SQL = O.with_ctes(
    _M1_CLEAN, _M1_AUG,
    """
m1_split AS (SELECT * FROM m1_aug WHERE NOT (""" + O.is_test_sql() + "))",
    """
presence AS (""" + _a6_sql("m1_split") + ")",
    """
types(feature, source_type) AS (VALUES """ + ", ".join(f"('{k}', '{v}')" for k, v in _E2_SOURCE_TYPES.items()) + ")",
    body="""
SELECT p.feature, t.source_type,
       CASE WHEN t.source_type IN ('int', 'bigint') AND p.has_null THEN 'double' ELSE t.source_type END AS target_type
FROM presence p JOIN types t ON p.feature = t.feature""",
)


@query("e2_int_to_double", _E2_SQL)
def e2_int_to_double(spark, sf_dir):
    i = _in(spark, sf_dir)
    prepared = modeling.prepare(i.training(), MODEL1)
    return features.int_to_double_plan(prepared.where(~F.col("is_test")), _M1_FEATS)


def _sql_name(f: str) -> str:
    return '"position"' if f == "position" else f


_E4_JOIN = "".join(
    f"\nLEFT JOIN m1_dict d{k} ON d{k}.feature = '{f}' AND d{k}.category = CAST(t.{_sql_name(f)} AS VARCHAR)"
    for k, f in enumerate(MODEL1.categorical)
)
_E4_SIZES = """
sizes AS (SELECT feature, CAST(count(*) AS INTEGER) AS n FROM m1_dict GROUP BY feature)"""
_E4_ENC = (
    "SELECT t.event_id, t.variant, "
    + ", ".join(
        f"COALESCE(d{k}.code, (SELECT n FROM sizes WHERE feature = '{f}')) AS {f}_idx"
        for k, f in enumerate(MODEL1.categorical)
    )
    + " FROM m1_typed t" + _E4_JOIN + " WHERE t.is_test"
)
_E4_SQL = O.with_ctes(_M1_CLEAN, _M1_AUG, _M1_TYPED, _M1_DICT, _E4_SIZES, body=_E4_ENC)


def _m1_encoder(spark, sf_dir):
    """The typed frame and the encoder learnt from its train side."""
    from .stages import DictionaryEncoder

    typed = _m1_prepared(spark, sf_dir)
    counts = encoding.fit_counts(typed.where(~F.col("is_test")), MODEL1.categorical, MODEL1.numeric_order)
    return typed, DictionaryEncoder.fitted(counts, MODEL1.categorical)


def _m1_encoded_test(spark, sf_dir):
    typed, encoder = _m1_encoder(spark, sf_dir)
    out = encoder.transform(typed.where(F.col("is_test")))
    return out.select("event_id", "variant", *[F.col(f + "_idx").cast("int").alias(f + "_idx") for f in MODEL1.categorical])


@query("e4_encode", _E4_SQL)
def e4_encode(spark, sf_dir):
    return _m1_encoded_test(spark, sf_dir)


_E4U_SQL = O.with_ctes(
    _M1_CLEAN, _M1_AUG, _M1_TYPED, _M1_DICT, _E4_SIZES, f"\nenc AS ({_E4_ENC})",
    body=" UNION ALL ".join(
        f"SELECT '{f}' AS feature, count(*) FILTER (WHERE {f}_idx = (SELECT n FROM sizes WHERE feature = '{f}'))"
        f" AS keep_index_rows, count(*) AS rows FROM enc"
        for f in MODEL1.categorical
    ),
)


@query("e4_encode_unseen", _E4U_SQL)
def e4_encode_unseen(spark, sf_dir):
    """Test rows that fall in the shared unseen/NULL index, per feature."""
    typed, encoder = _m1_encoder(spark, sf_dir)
    sizes = encoder.sizes
    enc = encoder.transform(typed.where(F.col("is_test")))
    agg = enc.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f + "_idx") == float(sizes[f])).alias(f) for f in MODEL1.categorical],
    )
    stacked = ", ".join(f"'{f}', `{f}`" for f in MODEL1.categorical)
    return agg.selectExpr(f"stack({len(MODEL1.categorical)}, {stacked}) AS (feature, keep_index_rows)", "rows")


_RATED = ("campaign_id", "traffic_source_id")


def _rates_sql() -> str:
    """Every row's smoothed click rate per feature: of the other folds' train rows, or of all for the test side."""
    whole = "(SELECT sum(click) / count(*) FROM folded WHERE NOT is_test)"
    ctes = [f"""
folded AS (SELECT *, CAST({O.unit('event_id', rates.FOLD_SEED)} % {rates.FOLDS} AS INTEGER) AS fold FROM m1_typed)""", """
every AS (SELECT f.fold, (SELECT count(*) FROM folded t WHERE NOT t.is_test AND t.fold <> f.fold) AS n,
                 (SELECT sum(click) FROM folded t WHERE NOT t.is_test AND t.fold <> f.fold) AS s
          FROM (SELECT DISTINCT fold FROM folded) f)"""]
    joins, out = "", []
    for k, f in enumerate(_RATED):
        value = f"CAST({f} AS VARCHAR)"
        ctes.append(f"""
own{k} AS (SELECT {value} AS category, fold, count(*) AS n, sum(click) AS s FROM folded WHERE NOT is_test AND {f} IS NOT NULL GROUP BY 1, 2),
all{k} AS (SELECT category, sum(n) AS n, sum(s) AS s FROM own{k} GROUP BY 1)""")
        joins += f"""
LEFT JOIN all{k} ON all{k}.category = CAST(t.{f} AS VARCHAR)
LEFT JOIN own{k} ON own{k}.category = all{k}.category AND own{k}.fold = t.fold AND NOT t.is_test"""
        prior = f"CASE WHEN t.is_test THEN {whole} ELSE e.s / e.n END"
        out.append(f"""round((COALESCE(all{k}.s, 0) - COALESCE(own{k}.s, 0) + {rates.PRIOR_ROWS} * ({prior}))
       / (COALESCE(all{k}.n, 0) - COALESCE(own{k}.n, 0) + {rates.PRIOR_ROWS}), 9) AS {f}_rate""")
    return O.with_ctes(_M1_CLEAN, _M1_AUG, _M1_TYPED, *ctes, body=f"""
SELECT t.event_id, t.variant, {", ".join(out)}
FROM folded t JOIN every e ON e.fold = t.fold{joins}""")


@query("m1_target_rates", _rates_sql())
def m1_target_rates(spark, sf_dir):
    """M1's form of a wide feature: out-of-fold smoothed click rates, all rows of model 1's frame."""
    from .stages import RateEncoder

    checkpoint_dir(spark)
    # written once: the sizes, the sums and the rows to encode would each join the identity table again
    typed = _m1_prepared(spark, sf_dir).checkpoint()
    train = typed.where(~F.col("is_test"))
    sizes = encoding.dictionary_sizes(encoding.fit_counts(train, _RATED, MODEL1.numeric_order), _RATED)
    encoder = RateEncoder.fitted(rates.fit_rates(train, _RATED, MODEL1.label, modeling.KEY), sizes, modeling.KEY)
    return encoder.transform(typed).select("event_id", "variant", *[F.round(f + rates.RATE_SUFFIX, 9).alias(f + rates.RATE_SUFFIX) for f in _RATED])


# ---------------------------------------------------------------------------
# run log (K9, A7, O1, O2)
# ---------------------------------------------------------------------------
_REPLAY = """
daily AS (SELECT CAST("timestamp" AS DATE) AS day, count(*) AS rows_inserted, max("timestamp") AS end_time
          FROM training GROUP BY 1),
runs AS (SELECT 'ingest-' || strftime(day, '%Y%m%d') AS run_id, end_time, rows_inserted,
                CAST(sum(rows_inserted) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
                  - rows_inserted AS rows_before
         FROM daily),
runlog AS (
  SELECT run_id, 'ingest' AS model, 'rows_before' AS key, CAST(rows_before AS VARCHAR) AS value, end_time FROM runs
  UNION ALL SELECT run_id, 'ingest', 'rows_after', CAST(rows_before + rows_inserted AS VARCHAR), end_time FROM runs
  UNION ALL SELECT run_id, 'ingest', 'rows_inserted', CAST(rows_inserted AS VARCHAR), end_time FROM runs)"""


def _logged(spark, *appends: DataFrame) -> DataFrame:
    """The log table that these appends wrote."""
    name = f"adresponse_runlog_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    for rows in appends:
        runlog.append_metrics(spark, name, rows, path)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return spark.read.parquet(path)


def _ingest_log(spark, sf_dir) -> DataFrame:
    """The daily ingest runs, written in two appends."""
    rows = runlog.ingest_replay(_in(spark, sf_dir).training())
    odd = F.dayofmonth("end_time") % 2 == 1
    return _logged(spark, rows.where(odd), rows.where(~odd))


@query("k9_run_log", O.with_ctes(_REPLAY, body="SELECT * FROM runlog"))
def k9_run_log(spark, sf_dir):
    return _ingest_log(spark, sf_dir)


@query("a7_latest_params", O.with_ctes(_REPLAY, body="""
SELECT key, arg_max(value, end_time) AS value, arg_max(run_id, end_time) AS run_id, max(end_time) AS end_time
FROM runlog GROUP BY key"""))
def a7_latest_params(spark, sf_dir):
    return runlog.latest_values(_ingest_log(spark, sf_dir))


@query("o2_top1", O.with_ctes(_REPLAY, body="""
SELECT * FROM runlog WHERE run_id = (SELECT run_id FROM runlog ORDER BY end_time DESC, run_id DESC LIMIT 1)"""))
def o2_top1(spark, sf_dir):
    return runlog.latest_run(_ingest_log(spark, sf_dir))


@query("m2_logged_params", O.with_ctes(_REPLAY, body="""
SELECT 50 + rows_inserted % 100 AS n_estimators, 3 + rows_inserted % 5 AS max_depth,
       CAST(0.05 + (rows_inserted % 8) / 16 AS DOUBLE) AS learning_rate
FROM runs ORDER BY end_time DESC LIMIT 1"""))
def m2_logged_params(spark, sf_dir):
    """M2: what retraining reads from a log of a search a day and of training runs that ended after them."""
    n = F.col("value").cast("long")
    days = runlog.ingest_replay(_in(spark, sf_dir).training()).where("key = 'rows_inserted'")

    def runs(prefix: str, more: int, later: str) -> DataFrame:
        tuned = F.struct((50 + n % 100 + more).alias("n_estimators"), (3 + n % 5 + more).alias("max_depth"),
                         (0.05 + (n % 8) / 16 + more).alias("learning_rate"))
        return days.select(F.concat(F.lit(prefix), "run_id").alias("run_id"), F.lit(MODEL1.name).alias("model"),
                           F.lit(f"{MODEL1.name}_hyperparams").alias("key"), F.to_json(tuned).alias("value"),
                           (F.col("end_time") + F.expr(later)).alias("end_time"))

    log = _logged(spark, runs(runlog.TUNE_RUN, 0, "INTERVAL 0 HOURS"), runs("retrain-", 1, "INTERVAL 1 HOUR"))
    p = runlog.tuned_params(log, MODEL1.name)
    return spark.createDataFrame([(p.n_estimators, p.max_depth, p.learning_rate)], "n_estimators long, max_depth long, learning_rate double")


# ---------------------------------------------------------------------------
# sampling, augmentation, split (R, U)
# ---------------------------------------------------------------------------
_AUG_TRAINING = O.augmented_sql("training")


@query("r1_hash_sample", O.with_ctes(
    body=f"SELECT * FROM training WHERE {O.below('event_id', AUGMENT_SEEDS['campaign_id'], AUGMENT_FRACTION)}"))
def r1_hash_sample(spark, sf_dir):
    return sampling.hash_sample(_in(spark, sf_dir).training(), AUGMENT_FRACTION, AUGMENT_SEEDS["campaign_id"])


@query("u1_union", O.with_ctes(body=_AUG_TRAINING))
def u1_union(spark, sf_dir):
    return sampling.augment_union(_in(spark, sf_dir).training())


@query("r2_null_augment", O.with_ctes(body=_AUG_TRAINING))
def r2_null_augment(spark, sf_dir):
    return sampling.augment_nulls(_in(spark, sf_dir).training())


@query("r3_hash_split", O.with_ctes(
    f"\naug AS ({_AUG_TRAINING})",
    body=f"SELECT event_id, variant, CASE WHEN {O.is_test_sql()} THEN 'test' ELSE 'train' END AS split FROM aug"))
def r3_hash_split(spark, sf_dir):
    a = sampling.augment_nulls(_in(spark, sf_dir).training()).withColumn("is_test", sampling.is_test())
    return a.select("event_id", "variant", modeling.split_name().alias("split"))


@query("r3_three_way", O.with_ctes(body=f"""
SELECT event_id, CASE WHEN {O.is_test_sql()} THEN 'test'
       WHEN NOT {O.below('event_id', SPLIT_SEED, TRAIN_FRACTION - VALIDATION_FRACTION)} THEN 'valid' ELSE 'fit' END AS split
FROM training"""))
def r3_three_way(spark, sf_dir):
    """The sides of a fit: the trees' rows, those that stop it, the test side."""
    return _in(spark, sf_dir).training().select("event_id", sampling.three_way().alias("split"))


_R4_SQL = O.with_ctes(
    f"""
picked AS (SELECT event_id, {', '.join(FEATURE_COLS)},
                  row_number() OVER (ORDER BY {O.example_order_sql()}, event_id) AS rn
           FROM training ORDER BY {O.example_order_sql()}, event_id LIMIT 5)""",
    body="SELECT event_id, "
    + ", ".join(f"CASE WHEN rn = 1 THEN NULL ELSE {c} END AS {c}" for c in FEATURE_COLS)
    + " FROM picked",
)


@query("r4_example_rows", _R4_SQL)
def r4_example_rows(spark, sf_dir):
    t = _in(spark, sf_dir).training().select("event_id", *MODEL1.features)
    return sampling.example_rows(t)


# ---------------------------------------------------------------------------
# cleaners (C1-C11)
# ---------------------------------------------------------------------------
def _cleaner_query(name, column, sql_expr, spark_fn, text_input=False):
    in_sql = f"CAST({column} AS VARCHAR)" if text_input else column
    sql = O.with_ctes(
        body=f"SELECT event_id, {in_sql} AS input, {sql_expr(in_sql)} AS cleaned FROM training"
    )

    def fn(spark, sf_dir):
        t = _in(spark, sf_dir).training()
        c = F.col(column).cast("string") if text_input else F.col(column)
        inp = t.select("event_id", c.alias("input"))
        return inp.select("event_id", "input", spark_fn(F.col("input"), inp.schema["input"].dataType).alias("cleaned"))

    fn.__name__ = name
    query(name, sql)(fn)


_cleaner_query("c1_os_train", "os_name", lambda c: O.os_sql(c, "train"), lambda c, t: C.clean_os(c, "train"))
_cleaner_query("c2_os_lookup", "os_name", lambda c: O.os_sql(c, "lookup"), lambda c, t: C.clean_os(c, "lookup"))
_cleaner_query("c3_os_serve", "os_name", lambda c: O.os_sql(c, "serve"), lambda c, t: C.clean_os(c, "serve"))
_cleaner_query("c4_gender_train", "gender", lambda c: O.gender_sql(c, "train"), lambda c, t: C.clean_gender(c, "train"))
_cleaner_query("c5_gender_lookup", "gender", lambda c: O.gender_sql(c, "lookup"), lambda c, t: C.clean_gender(c, "lookup"))
_cleaner_query("c6_gender_serve", "gender", lambda c: O.gender_sql(c, "serve"), lambda c, t: C.clean_gender(c, "serve"))
_cleaner_query("c7_age_serve", "age", O.number_typed_sql, lambda c, t: C.clean_number(c, t, "serve"))
_cleaner_query("c8_age_lookup", "age", O.number_text_sql, lambda c, t: C.clean_number(c, t, "lookup"), text_input=True)
_cleaner_query("c9_income_serve", "household_income", O.number_typed_sql, lambda c, t: C.clean_number(c, t, "serve"))
_cleaner_query("c9_income_lookup", "household_income", O.number_text_sql,
               lambda c, t: C.clean_number(c, t, "lookup"), text_input=True)
_cleaner_query("c10_source_serve", "traffic_source_id", lambda c: f"CAST({c} AS DOUBLE)",
               lambda c, t: C.clean_traffic_source(c, t))
_cleaner_query("c10_source_text", "traffic_source_id", O.source_text_sql,
               lambda c, t: C.clean_traffic_source(c, t), text_input=True)


def _c11_sql(policy: str) -> str:
    cols = []
    for c in TRAIN_COLS:
        n = c.strip('"')
        if n == "os_name":
            cols.append(f"{O.os_sql('os_name', policy)} AS os_name")
        elif n == "gender":
            cols.append(f"{O.gender_sql('gender', policy)} AS gender")
        elif n in ("age", "household_income") and policy == "serve":
            cols.append(f"{O.number_typed_sql(n)} AS {n}")
        elif n == "traffic_source_id" and policy == "serve":
            cols.append(f"CAST({n} AS DOUBLE) AS {n}")
        else:
            cols.append(c)
    return O.with_ctes(body="SELECT " + ", ".join(cols) + " FROM training")


@query("c11_clean_train", _c11_sql("train"))
def c11_clean_train(spark, sf_dir):
    return C.clean_frame(_in(spark, sf_dir).training(), "train")


@query("c11_clean_serve", _c11_sql("serve"))
def c11_clean_serve(spark, sf_dir):
    return C.clean_frame(_in(spark, sf_dir).training(), "serve")


_C11_LOOKUP_SQL = O.with_ctes(
    _M2_TEXT,
    body=f"""SELECT event_id, {O.gender_sql('gender', 'lookup')} AS gender, campaign_id, traffic_partner_id,
       traffic_source_id, {O.os_sql('os_name', 'lookup')} AS os_name, {O.number_text_sql('age')} AS age, hour,
       {O.number_text_sql('household_income')} AS household_income, "position", click FROM m2_text""",
)


@query("c11_clean_lookup", _C11_LOOKUP_SQL)
def c11_clean_lookup(spark, sf_dir):
    t = features.select_loaded(features.cast_features(_in(spark, sf_dir).training(), _M2_LOADED), MODEL2)
    return C.clean_frame(t, "lookup")


# ---------------------------------------------------------------------------
# routing (M9)
# ---------------------------------------------------------------------------
@query("m9_route", O.with_ctes(
    body=f"SELECT event_id, {O.route_sql('event_id', ROUTE_PCT_MODEL1)} AS served_model FROM training"))
def m9_route(spark, sf_dir):
    return scoring.route(_in(spark, sf_dir).training(), ROUTE_PCT_MODEL1).select("event_id", "served_model")


# ---------------------------------------------------------------------------
# model fitting, evaluation, scoring (their properties as SQL; pytest covers quality)
# ---------------------------------------------------------------------------
_MODELS: dict = {}


def _session_key(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # remote session
        return f"session-{id(spark)}"


def fitted(spark: SparkSession, sf_dir: str, spec) -> modeling.ClickModel:
    """Fit once per (session, data, model) and reuse across the model queries."""
    key = (_session_key(spark), sf_dir, spec.name)
    if key not in _MODELS:
        i = _in(spark, sf_dir)
        prepared = modeling.materialize(
            modeling.prepare(i.training(), spec, i.campaigns() if spec.lookup_features else None)
        )
        _MODELS[key] = (modeling.fit(prepared, spec, run_id=RUN_ID), prepared)
    return _MODELS[key][0]


def prepared_for(spark: SparkSession, sf_dir: str, spec) -> DataFrame:
    """The materialized training frame the cached model was fitted on."""
    fitted(spark, sf_dir, spec)
    return _MODELS[(_session_key(spark), sf_dir, spec.name)][1]


@query("e8_clean_encode_twice", O.with_ctes(
    _M1_CLEAN, _M1_AUG,
    body="SELECT count(*) AS rows, " + ", ".join(f"count(*) AS {f}" for f in MODEL1.categorical) + " FROM m1_aug"))
def e8_clean_encode_twice(spark, sf_dir):
    """Cleaning + encoding applied twice equals once (model 1), per feature.

    The second pass runs on the first pass's output row by row, so the
    comparison needs no join and no shuffle.  The oracle states the property:
    every augmented row agrees in every feature.
    """
    m = fitted(spark, sf_dir, MODEL1)
    stages = m.pipeline.stages[:3]
    once = prepared_for(spark, sf_dir, MODEL1)
    for s in stages:
        once = s.transform(once)
    twice = once.withColumnsRenamed({f + "_idx": "a_" + f for f in MODEL1.categorical})
    for s in stages:
        twice = s.transform(twice)
    return twice.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col("a_" + f) == F.col(f + "_idx")).alias(f) for f in MODEL1.categorical],
    )


def _fit_sql(model: str, frame: str, *ctes: str) -> str:
    """What a good fit's summary says, from the training frame alone."""
    return O.with_ctes(*ctes, body=f"""
SELECT '{model}' AS model, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, count(*) AS rows,
       TRUE AS loss_is_finite, CASE WHEN NOT any_value(is_test) THEN TRUE END AS not_above_constant
FROM {frame} GROUP BY is_test""")


def _fit_check(spark, sf_dir, spec) -> DataFrame:
    """Rows of each split; whether the loss is finite and, on the train side, at or below that of the constant rate."""
    m, prepared = fitted(spark, sf_dir, spec), prepared_for(spark, sf_dir, spec)
    label = F.col(spec.label)
    rate = prepared.where(~F.col("is_test")).agg(F.avg(label).alias("r")).select("r").scalar()
    constant = prepared.groupBy(modeling.split_name().alias("split")).agg(F.avg(modeling.log_loss(label, rate)).alias("constant"))
    summary = modeling.fit_summary(m, modeling.evaluate(m, prepared)).join(constant, "split")
    finite = F.col("log_loss").isNotNull() & ~F.isnan("log_loss") & (F.col("log_loss") < float("inf"))
    return summary.select(
        "model", "split", "rows", finite.alias("loss_is_finite"),
        F.when(F.col("split") == "train", F.col("log_loss") <= F.col("constant") + 1e-6).alias("not_above_constant"),
    )


@query("m1_fit_summary", _fit_sql("MODEL1", "m1_typed", _M1_CLEAN, _M1_AUG, _M1_TYPED))
def m1_fit_summary(spark, sf_dir):
    return _fit_check(spark, sf_dir, MODEL1)


@query("m4_eval", _fit_sql("MODEL2", "m2_clean", _M2_TEXT, _M2_AUG, _M2_CLEAN))
def m4_eval(spark, sf_dir):
    return _fit_check(spark, sf_dir, MODEL2)


def _trials(spark, sf_dir) -> DataFrame:
    prepared = modeling.materialize(modeling.prepare(_in(spark, sf_dir).training(), MODEL1))
    return tuning.search(spark, prepared, MODEL1)


@query("m3_search", O.with_ctes(body=f"""
SELECT CAST(range AS INTEGER) AS trial, (SELECT count(*) FROM training) > 0 AS in_range, TRUE AS loss_is_finite
FROM range({SEARCH_EVALS})"""))
def m3_search(spark, sf_dir):
    """Trials of the search: values within their ranges, a finite loss."""
    inside = F.lit(True)
    for name, (low, high, _) in SEARCH_SPACE.items():
        inside = inside & F.col(name).between(low - 0.5 if name.endswith("rounds") else low - 1e-9, high + 0.5)
    return _trials(spark, sf_dir).select("trial", inside.alias("in_range"), (F.greatest("valid_log_loss", "test_log_loss") < float("inf")).alias("loss_is_finite"))


def _scored(scored: DataFrame) -> DataFrame:
    """Scores as a property that SQL can state: a probability strictly between 0 and 1."""
    return scored.withColumn("is_probability", (F.col("model_ctr") > 0) & (F.col("model_ctr") < 1)).drop("model_ctr")


def _score_sql(model: str, text: bool = False) -> str:
    cast = (lambda c: f"CAST({c} AS VARCHAR)") if text else (lambda c: c)
    return f"""SELECT event_id, {cast("campaign_id")} AS campaign_id, {cast('"position"')} AS "position",
       '{VERSION_PREFIX}{model} - {RUN_ID}' AS model_version, TRUE AS is_probability FROM training"""


@query("m5_score", O.with_ctes(body=_score_sql("MODEL1")))
def m5_score(spark, sf_dir):
    return _scored(scoring.score(fitted(spark, sf_dir, MODEL1), _in(spark, sf_dir).training()))


@query("m6_score_lookup", O.with_ctes(body=_score_sql("MODEL2", text=True)))
def m6_score_lookup(spark, sf_dir):
    i = _in(spark, sf_dir)
    return _scored(scoring.score(fitted(spark, sf_dir, MODEL2), i.training(), i.campaigns()))


def _routed(spark, sf_dir, capture: bool = False) -> DataFrame:
    i = _in(spark, sf_dir)
    models = fitted(spark, sf_dir, MODEL1), fitted(spark, sf_dir, MODEL2)
    return scoring.score_routed(i.training(), *models, i.campaigns(), ROUTE_PCT_MODEL1, capture=capture)


_ROUTED_SQL = f"""
SELECT event_id, campaign_id, "position", '{VERSION_PREFIX}' || served_model || ' - {RUN_ID}' AS model_version,
       served_model, TRUE AS is_probability
FROM (SELECT *, {O.route_sql('event_id', ROUTE_PCT_MODEL1)} AS served_model FROM training)"""


@query("m10_score_routed", O.with_ctes(body=_ROUTED_SQL))
def m10_score_routed(spark, sf_dir):
    return _scored(_routed(spark, sf_dir))


@query("k8_inference_log", O.with_ctes(body=f"SELECT *, TRUE AS has_request, TRUE AS is_stamped FROM ({_ROUTED_SQL})"))
def k8_inference_log(spark, sf_dir):
    """The log's rows; each holds its request, by key, and a stamp."""
    log = scoring.inference_log(_scored(_routed(spark, sf_dir, capture=True)))
    own = F.get_json_object("request", "$.event_id") == F.col("event_id").cast("string")
    return log.select("*", own.alias("has_request"), F.col("scored_at").isNotNull().alias("is_stamped")).drop("request", "scored_at")


@query("k8_retried_run", O.with_ctes(body=f"SELECT *, 'run-1' AS run_id FROM ({_ROUTED_SQL}) UNION ALL SELECT *, 'run-2' FROM ({_ROUTED_SQL})"))
def k8_retried_run(spark, sf_dir):
    """The log table that two runs left, the first of them repeated under its id."""
    name = f"adresponse_log_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    scored = _scored(_routed(spark, sf_dir))
    for run_id in ("run-1", "run-2", "run-1"):
        scoring.append_inference_log(spark, scored, name, run_id, path)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return spark.read.parquet(path).drop("scored_at")


# ---------------------------------------------------------------------------
# schema-only table creation (K3/O3) and the scoring-side lookup
# ---------------------------------------------------------------------------
@query("o3_schema_only", O.with_ctes(body="SELECT * FROM training LIMIT 0"))
def o3_schema_only(spark, sf_dir):
    """The empty frame ``CREATE TABLE ... AS <query> LIMIT 0`` is built from."""
    return _in(spark, sf_dir).training().limit(0)


_J3_SQL = (
    "SELECT t.event_id, " + ", ".join(f"CAST(t.{c} AS VARCHAR) AS {c}" for c in FEATURE_COLS)
    + ", c.vertical, c.subvertical"
    + " FROM training t LEFT JOIN campaign_features c ON CAST(t.campaign_id AS VARCHAR) = c.campaign_id"
)


@query("j3_scoring_lookup", O.with_ctes(body=_J3_SQL))
def j3_scoring_lookup(spark, sf_dir):
    """Model-2 requests as the scorer sees them: text features plus looked-up campaign features."""
    i = _in(spark, sf_dir)
    req = features.cast_features(i.training(), _M2_LOADED).select("event_id", *_M2_LOADED)
    return features.lookup_features(req, i.campaigns())


@query("m2_tuned_params")
def m2_tuned_params(spark, sf_dir):
    """M2: the search logs its best values; retraining reads the latest back (defaults if none)."""
    import datetime as _dt

    best = tuning.best(_trials(spark, sf_dir))
    log = runlog.metric_rows(spark, f"{runlog.TUNE_RUN}{RUN_ID}", MODEL1.name, {f"{MODEL1.name}_hyperparams": best.as_dict()},
                             _dt.datetime(2024, 2, 1))
    p = runlog.tuned_params(log, MODEL1.name)
    return spark.createDataFrame([tuple(p.as_dict().values())], list(p.as_dict().keys()))


_E7_SQL = O.with_ctes(
    body=f"""SELECT event_id, {O.gender_sql('gender', 'serve')} AS gender, campaign_id, traffic_partner_id,
       CAST(traffic_source_id AS DOUBLE) AS traffic_source_id, {O.os_sql('os_name', 'serve')} AS os_name,
       {O.number_typed_sql('age')} AS age, CAST(hour AS INTEGER) AS hour,
       {O.number_typed_sql('household_income')} AS household_income, CAST("position" AS INTEGER) AS "position"
FROM training""",
)


@query("e7_serve_cast", _E7_SQL)
def e7_serve_cast(spark, sf_dir):
    """Serving rows cleaned (serve policy) and cast to model 1's feature types."""
    from .stages import FeatureCaster

    served = C.clean_frame(_in(spark, sf_dir).training(), "serve")
    return FeatureCaster(modeling.model_types(MODEL1)).transform(served).select("event_id", *MODEL1.features)


_M1_FRAME_COLS = ["event_id", "variant", *MODEL1.features, "click", "is_test"]
_M2_FRAME_COLS = ["event_id", "variant", *MODEL2.features, "click", "is_test"]


@query("e1_model1_frame", O.with_ctes(
    _M1_CLEAN, _M1_AUG, _M1_TYPED, body="SELECT " + ", ".join(_sql_name(c) for c in _M1_FRAME_COLS) + " FROM m1_typed"))
def e1_model1_frame(spark, sf_dir):
    """Model 1's training frame: clean -> augment -> split flag -> feature types."""
    return _m1_prepared(spark, sf_dir).select(*_M1_FRAME_COLS)


@query("e1_model2_frame", O.with_ctes(
    _M2_TEXT, _M2_AUG, _M2_CLEAN, body="SELECT " + ", ".join(_sql_name(c) for c in _M2_FRAME_COLS) + " FROM m2_clean"))
def e1_model2_frame(spark, sf_dir):
    """Model 2's training frame: text cast -> lookup -> augment -> split flag -> clean -> types."""
    return _m2_prepared(spark, sf_dir).select(*_M2_FRAME_COLS)


@query("k7_reloaded_scores", O.with_ctes(body="SELECT event_id, TRUE AS same_score, TRUE AS same_version FROM training"))
def k7_reloaded_scores(spark, sf_dir):
    """K6, K7: a saved and loaded model scores every row as the fitted one does."""
    i, model = _in(spark, sf_dir), fitted(spark, sf_dir, MODEL1)
    path = f"{checkpoint_dir(spark).rstrip('/')}/adresponse_model_{uuid.uuid4().hex}"
    modeling.save(model, spark, path)
    was, now = scoring.score(model, i.training()), scoring.score(modeling.load(spark, path, MODEL1), i.training())
    now = now.select("event_id", F.col("model_ctr").alias("ctr"), F.col("model_version").alias("version"))
    return was.join(now, "event_id", "left").select(
        "event_id", F.coalesce(F.col("ctr") == F.col("model_ctr"), F.lit(False)).alias("same_score"),
        F.coalesce(F.col("version") == F.col("model_version"), F.lit(False)).alias("same_version"))


def _json_texts(training: DataFrame) -> DataFrame:
    """The training rows as JSON requests whose number columns hold numbers, marks, fractions and text."""
    def pick(*ways):  # JSON of a value, by the row's key
        c = F
        for n, way in enumerate(ways):
            c = c.when(F.col("event_id") % len(ways) == n, way)
        return F.coalesce(c, F.lit("null"))

    quoted = lambda c, none: F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit(none)), F.lit('"'))
    plain = lambda c: F.col(c).cast("string")
    age = pick(plain("age"), quoted("age", "NA"), F.lit("-1"), F.lit('"-1"'), F.concat(plain("age"), F.lit(".5")))
    source = pick(plain("traffic_source_id"), quoted("traffic_source_id", ""), F.lit('"-3"'), F.lit('"1.5"'), F.lit("2.25"), F.lit("true"))
    income = pick(plain("household_income"), quoted("household_income", "null"), F.lit('{"a": 1}'))
    rest = F.to_json(F.struct("event_id", "gender", "campaign_id", "traffic_partner_id", "os_name", "hour", "position"))
    parts = [F.expr("substr(rest, 1, length(rest) - 1)")]
    for name in ("age", "traffic_source_id", "household_income"):
        parts += [F.lit(f',"{name}":'), F.col(f"json_{name}")]
    rows = training.select("event_id", rest.alias("rest"), age.alias("json_age"), source.alias("json_traffic_source_id"), income.alias("json_household_income"))
    return rows.select("event_id", F.concat(*parts, F.lit("}")).alias("request"))


_M8_SQL = O.with_ctes(body=f"""
SELECT event_id, {O.gender_sql('gender', 'serve')} AS gender, campaign_id, traffic_partner_id,
       CASE event_id % 6 WHEN 0 THEN CAST(traffic_source_id AS DOUBLE) WHEN 1 THEN CAST(traffic_source_id AS DOUBLE)
            WHEN 4 THEN 2.25 END AS traffic_source_id,
       {O.os_sql('os_name', 'serve')} AS os_name,
       CASE event_id % 5 WHEN 0 THEN {O.number_typed_sql('age')} WHEN 1 THEN CAST(age AS DOUBLE) WHEN 3 THEN -1
            WHEN 4 THEN CAST(CAST(age AS VARCHAR) || '.5' AS DOUBLE) END AS age,
       CAST(hour AS INTEGER) AS hour,
       CASE event_id % 3 WHEN 0 THEN {O.number_typed_sql('household_income')} WHEN 1 THEN CAST(household_income AS DOUBLE) END AS household_income,
       CAST("position" AS INTEGER) AS "position"
FROM training""")


@query("m8_json_requests", _M8_SQL)
def m8_json_requests(spark, sf_dir):
    """JSON requests with numbers, marks, fractions and text in one column, each value cleaned by its own kind."""
    from .stages import FeatureCaster

    served = scoring.json_requests(_json_texts(_in(spark, sf_dir).training()), MODEL1)
    return FeatureCaster(modeling.model_types(MODEL1)).transform(served).select("event_id", *MODEL1.features)


_M7_KINDS = {f: contract.KINDS[t] for f, t in MODEL1.feature_types.items()}


def _m7_missing(f: str) -> str:
    marks = f" OR {_sql_name(f)} IN ('null', 'NA', '')" if _M7_KINDS[f] == "text" else ""
    return f"({_sql_name(f)} IS NULL{marks})"


@query("m7_contract", O.with_ctes(body=" UNION ALL ".join(
    f"SELECT '{f}' AS feature, '{kind}' AS kind, count(*) > 0 AND count(*) FILTER (WHERE {_m7_missing(f)}) = 0 AS required FROM training"
    for f, kind in _M7_KINDS.items())))
def m7_contract(spark, sf_dir):
    """M7: kinds of model 1's features, and which no training row lacks."""
    return contract.rows(contract.infer(_in(spark, sf_dir).training(), MODEL1), spark)


@query("m7_breaches", O.with_ctes("""
asked AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 'NA' ELSE campaign_id END AS campaign_id,
       CASE WHEN event_id % 4 = 0 THEN 'old' WHEN event_id % 4 = 1 THEN NULL ELSE CAST(age AS VARCHAR) END AS age,
       hour + CASE WHEN event_id % 3 = 0 THEN 0.5 ELSE 0.0 END AS hour FROM training),
full_columns AS (SELECT count(*) > 0 AND count(*) FILTER (WHERE campaign_id IS NULL OR campaign_id IN ('null', 'NA', '')) = 0 AS campaign FROM training)""",
    body="""
SELECT event_id, 'campaign_id' AS feature, 'missing' AS breach FROM asked
WHERE (campaign_id IS NULL OR campaign_id IN ('null', 'NA', '')) AND (SELECT campaign FROM full_columns)
UNION ALL SELECT event_id, 'age', 'not a number' FROM asked WHERE age = 'old'
UNION ALL SELECT event_id, 'hour', 'not a whole number' FROM asked WHERE hour <> floor(hour)"""))
def m7_breaches(spark, sf_dir):
    """M7: the values of requests with planted faults that break the contract of the training rows."""
    t, n = _in(spark, sf_dir).training(), F.col("event_id")
    asked = t.select(
        n, "gender", "traffic_partner_id", "traffic_source_id", "os_name", "household_income", "position",
        F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, F.lit("NA")).otherwise(F.col("campaign_id")).alias("campaign_id"),
        F.when(n % 4 == 0, F.lit("old")).when(n % 4 == 1, F.lit(None)).otherwise(F.col("age").cast("string")).alias("age"),
        (F.col("hour") + F.when(n % 3 == 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("hour"))
    return contract.breaches(asked, contract.infer(t, MODEL1))
