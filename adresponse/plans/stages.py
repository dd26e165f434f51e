"""Pipeline stages written in Python (plan-building only).

Each stage's ``_transform`` only adds native column expressions and look-up
joins to the plan; no Python runs per row.  They persist with Spark ML's
default params writer, those with a table as their state together with the
table, so a saved ``PipelineModel`` reloads with them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import clean_frame
from ..operators.encoding import dictionary_sizes, encode
from ..operators.rates import apply_rates, common
from ..session import checkpoint_dir


class RowCleaner(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """C11 as a pipeline stage (policy = train | lookup | serve)."""

    policy = Param(Params._dummy(), "policy", "cleaning policy", typeConverter=TypeConverters.toString)

    def __init__(self, policy: str = "train"):
        super().__init__()
        self._setDefault(policy="train")
        self._set(policy=policy)

    def _transform(self, df: DataFrame) -> DataFrame:
        return clean_frame(df, self.getOrDefault(self.policy))


class FeatureCaster(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Cast features to the model's types before encoding."""

    typesJson = Param(Params._dummy(), "typesJson", "feature -> type (JSON)", typeConverter=TypeConverters.toString)

    def __init__(self, types: dict | None = None):
        super().__init__()
        self._setDefault(typesJson="{}")
        if types is not None:
            self._set(typesJson=json.dumps(types, sort_keys=True))

    def _transform(self, df: DataFrame) -> DataFrame:
        types = json.loads(self.getOrDefault(self.typesJson))
        out = {}
        for name, t in types.items():
            if name not in df.columns:
                continue
            c = F.col(name)
            out[name] = c.cast(t) if t == "string" else c.try_cast(t)
        return df.withColumns(out) if out else df


class MissingFill(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric features: NULL/NaN -> ``fill`` plus a 0/1 ``<name>_missing`` flag.

    Spark's trees take no missing values; the flag keeps "missing" apart
    from the fill value.
    """

    inputCols = Param(Params._dummy(), "inputCols", "numeric columns", typeConverter=TypeConverters.toListString)
    fill = Param(Params._dummy(), "fill", "fill value", typeConverter=TypeConverters.toFloat)

    def __init__(self, inputCols=None, fill: float = -1.0):
        super().__init__()
        self._setDefault(inputCols=[], fill=-1.0)
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        self._set(fill=float(fill))

    def _transform(self, df: DataFrame) -> DataFrame:
        fill = self.getOrDefault(self.fill)
        out = {}
        for c in self.getOrDefault(self.inputCols):
            v = F.col(c).cast("double")
            miss = v.isNull() | F.isnan(v)
            out[c + "_missing"] = miss.cast("double")
            out[c + "_filled"] = F.when(miss, F.lit(fill)).otherwise(v)
        return df.withColumns(out) if out else df


class _TableWriter(MLWriter):
    """Params as metadata, the state table beside them."""

    def __init__(self, stage: "TableStage"):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.table().write.partitionBy("feature").parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> "TableStage":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage._set(tablePath=f"{path}/table")
        return stage


class TableStage(Transformer, MLWritable, MLReadable):
    """A stage whose state is a Parquet table by feature, joined when it transforms."""

    tablePath = Param(Params._dummy(), "tablePath", "folder of the state table", typeConverter=TypeConverters.toString)
    sizesJson = Param(Params._dummy(), "sizesJson", "feature -> number of categories (JSON)", typeConverter=TypeConverters.toString)

    def __init__(self, state: DataFrame | None = None, sizes: dict | None = None):
        super().__init__()
        self._setDefault(sizesJson="{}")
        if state is not None:
            path = f"{checkpoint_dir(state.sparkSession).rstrip('/')}/{type(self).__name__}-{uuid.uuid4().hex}"
            state.write.partitionBy("feature").parquet(path)
            self._set(tablePath=path, sizesJson=json.dumps(sizes))

    @property
    def sizes(self) -> dict:
        """Categories of each feature, in the order of the features."""
        return json.loads(self.getOrDefault(self.sizesJson))

    def table(self) -> DataFrame:
        spark = SparkSession.getActiveSession()
        return spark.read.schema(self.schema).parquet(self.getOrDefault(self.tablePath))

    def write(self) -> _TableWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> _TableReader:
        return _TableReader(cls)


class DictionaryEncoder(TableStage):
    """Codes of categorical features from a dictionary table; unseen and missing values share the last index."""

    schema = "category string, code int, n bigint, feature string"

    @classmethod
    def fitted(cls, counts: DataFrame, features) -> "DictionaryEncoder":
        """From ``encoding.fit_counts``, for the given features."""
        return cls(counts.select("category", "code", "n", "feature"), dictionary_sizes(counts, features))

    def _transform(self, df: DataFrame) -> DataFrame:
        return encode(df, self.table(), self.sizes)


class RateEncoder(TableStage):
    """M1: smoothed click rates of wide categorical features; rows that took part in the fit see the other folds."""

    schema = "category string, n bigint, rows array<bigint>, clicks array<double>, feature string"
    totalsJson = Param(Params._dummy(), "totalsJson", "rows and clicks by fold (JSON)", typeConverter=TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "row key", typeConverter=TypeConverters.toString)

    @classmethod
    def fitted(cls, state: DataFrame, sizes: dict, key: str) -> "RateEncoder":
        """From ``rates.fit_rates`` and the number of categories of each feature."""
        stage = cls(state.where("feature <> ''").select("category", "n", "rows", "clicks", "feature"), sizes)
        return stage._set(totalsJson=json.dumps(common(state)), keyCol=key)

    def _transform(self, df: DataFrame) -> DataFrame:
        totals = json.loads(self.getOrDefault(self.totalsJson))
        return apply_rates(df, self.table(), self.sizes, totals, self.getOrDefault(self.keyCol))
