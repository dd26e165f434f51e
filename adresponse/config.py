"""Settings for the ad-response package.

Everything a job needs is passed explicitly; these dataclasses only carry
defaults.  Values that must equal the original pipeline's for right results
are grouped below under FIXED VALUES.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original pipeline's behaviour)
# ---------------------------------------------------------------------------
# Operating systems kept as-is by the OS cleaner; anything else is "Other".
KNOWN_OS = ("Android", "iOS", "Windows", "Mac")
OTHER_OS = "Other"
# Lower-cased spellings mapped to the two gender codes.
FEMALE_SPELLINGS = ("f", "female")
MALE_SPELLINGS = ("m", "male")
# Text markers that the serving cleaners treat as "missing".
MISSING_TEXT = ("null", "NA", "")
# Numeric marker for a missing age / income in typed input.
MISSING_NUMBER = -1
# Training window and ingest filters.
WINDOW_DAYS = 22
MAX_POSITION = 4
# Traffic partner whose impressions never enter the training table.
EXCLUDED_PARTNER = "1ac29301-78ac-46c6-a79d-0632ad980e3a"
# Augmentation: fraction of rows copied per blanked column, and the columns.
AUGMENT_FRACTION = 0.05
AUGMENT_COLUMNS = ("campaign_id", "traffic_source_id", "traffic_partner_id")
# Train share of the train/test split and the split seed.
TRAIN_FRACTION = 0.8
SPLIT_SEED = 1234
# Example rows for the input contract: count and seed.
EXAMPLE_ROWS = 5
EXAMPLE_SEED = 42
# Version tag prefix of scored rows.
VERSION_PREFIX = "adflow_click_"
# Default booster settings (used when no tuned values exist).
DEFAULT_HYPERPARAMS = {
    "colsample_bytree": 0.6421218939603257,
    "early_stopping_rounds": 9,
    "learning_rate": 0.03711165197308055,
    "max_depth": 8,
    "n_estimators": 369,
    "subsample": 0.9173736479523668,
}
# Search ranges of the tuner: name -> (low, high, kind).
SEARCH_SPACE = {
    "learning_rate": (0.01, 0.1, "loguniform"),
    "colsample_bytree": (0.5, 0.7, "uniform"),
    "subsample": (0.6, 1.0, "uniform"),
    "early_stopping_rounds": (1, 10, "quniform"),
    "n_estimators": (300, 400, "quniform"),
    "max_depth": (5, 8, "quniform"),
}
SEARCH_EVALS = 2
SEARCH_PARALLELISM = 4
# ---------------------------------------------------------------------------

# The last part of the train side's hash range that no tree sees: it says when boosting stops and which trial wins.
VALIDATION_FRACTION = 0.1

# Seeds of the independent hash draws (one per purpose).
AUGMENT_SEEDS = {"campaign_id": 11, "traffic_source_id": 12, "traffic_partner_id": 13}
ROUTE_SEED = 77

# Column order of the training table (plus our row key ``event_id``).
TRAINING_COLUMNS = (
    "event_id",
    "timestamp",
    "click",
    "gender",
    "campaign_id",
    "traffic_source_id",
    "traffic_partner_id",
    "os_name",
    "age",
    "household_income",
    "position",
    "hour",
)

LOOKUP_FEATURES = ("vertical", "subvertical")


@dataclass(frozen=True)
class ModelSpec:
    """Feature contract of one click model."""

    name: str
    # feature -> Spark SQL type the model reads it as
    feature_types: dict
    categorical: tuple
    # categorical features whose dictionary sorts by number, not by text
    numeric_order: tuple = ()
    # cleaning policy used on both the training and the scoring side
    clean_policy: str = "train"
    lookup_features: tuple = ()
    label: str = "click"
    label_type: str = "int"

    @property
    def features(self) -> tuple:
        return tuple(self.feature_types)

    @property
    def numeric(self) -> tuple:
        return tuple(f for f in self.feature_types if f not in self.categorical)


MODEL1 = ModelSpec(
    name="MODEL1",
    feature_types={
        "gender": "string",
        "campaign_id": "string",
        "traffic_partner_id": "string",
        "traffic_source_id": "double",
        "os_name": "string",
        "age": "double",
        "hour": "int",
        "household_income": "double",
        "position": "int",
    },
    categorical=(
        "gender",
        "campaign_id",
        "traffic_partner_id",
        "traffic_source_id",
        "os_name",
        "hour",
        "position",
    ),
    numeric_order=("traffic_source_id", "hour", "position"),
    clean_policy="train",
)

MODEL2 = ModelSpec(
    name="MODEL2",
    feature_types={
        "gender": "string",
        "campaign_id": "string",
        "traffic_partner_id": "string",
        "traffic_source_id": "string",
        "os_name": "string",
        "age": "string",
        "hour": "string",
        "household_income": "string",
        "position": "string",
        "vertical": "string",
        "subvertical": "string",
    },
    categorical=(
        "gender",
        "campaign_id",
        "traffic_partner_id",
        "traffic_source_id",
        "os_name",
        "hour",
        "position",
        "vertical",
        "subvertical",
    ),
    clean_policy="lookup",
    lookup_features=LOOKUP_FEATURES,
    label_type="float",
)


@dataclass(frozen=True)
class IngestSpec:
    """Filters of the training-row query."""

    window_days: int = WINDOW_DAYS
    max_position: int = MAX_POSITION
    excluded_partner: str = EXCLUDED_PARTNER
    dedup_identity: bool = False
    heavy_emails: bool = False  # join hot e-mails apart: for an identity table that is bucketed by e-mail


@dataclass(frozen=True)
class BoostParams:
    """Booster settings in the original names, mapped to Spark's boosted trees."""

    n_estimators: int = DEFAULT_HYPERPARAMS["n_estimators"]
    max_depth: int = DEFAULT_HYPERPARAMS["max_depth"]
    learning_rate: float = DEFAULT_HYPERPARAMS["learning_rate"]
    subsample: float = DEFAULT_HYPERPARAMS["subsample"]
    colsample_bytree: float = DEFAULT_HYPERPARAMS["colsample_bytree"]
    early_stopping_rounds: int = DEFAULT_HYPERPARAMS["early_stopping_rounds"]
    seed: int = 42
    extra: dict = field(default_factory=dict)

    @classmethod
    def from_dict(cls, d: dict | None) -> "BoostParams":
        if not d:
            return cls()
        known = {k: d[k] for k in cls.__dataclass_fields__ if k in d and k != "extra"}
        for k in ("n_estimators", "max_depth", "early_stopping_rounds", "seed"):
            if k in known:
                known[k] = int(round(float(known[k])))
        for k in ("learning_rate", "subsample", "colsample_bytree"):
            if k in known:
                known[k] = float(known[k])
        return cls(**known)

    def as_dict(self) -> dict:
        return {
            "n_estimators": self.n_estimators,
            "max_depth": self.max_depth,
            "learning_rate": self.learning_rate,
            "subsample": self.subsample,
            "colsample_bytree": self.colsample_bytree,
            "early_stopping_rounds": self.early_stopping_rounds,
            "seed": self.seed,
        }
