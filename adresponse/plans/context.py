"""Inputs shared by the registered queries: fixture views, as_of, training rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import IngestSpec
from ..operators.ingest import training_rows, window_floor
from ..sources import tables


# Ingest filters of the fixture views (their partner ids are p0..p4).
FIXTURE_SPEC = IngestSpec(excluded_partner=tables.FIXTURE_EXCLUDED_PARTNER)


@dataclass
class Inputs:
    spark: SparkSession
    sf_dir: str

    def impressions(self) -> DataFrame:
        return tables.impressions(self.spark, self.sf_dir)

    def identity(self, fanout: bool = False) -> DataFrame:
        return tables.identity(self.spark, self.sf_dir, fanout)

    def campaigns(self) -> DataFrame:
        return tables.campaign_features(self.spark, self.sf_dir)

    def as_of(self) -> Column:
        return tables.latest_event_time(self.spark, self.sf_dir)

    def training(self, fanout: bool = False, spec: IngestSpec = FIXTURE_SPEC) -> DataFrame:
        return training_rows(self.impressions(), self.identity(fanout), self.as_of(), spec)

    def target_before(self, days_back: int = 5) -> DataFrame:
        """Incremental fixture: the target holds rows up to as_of - days_back."""
        t = self.training()
        return t.where(F.col("timestamp") <= window_floor(self.as_of(), days_back))
