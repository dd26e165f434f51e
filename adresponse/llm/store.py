"""Tables written between the steps of an operator, and the input tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from adresponse.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table; Spark alone opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor never makes an earlier step run
    again, and every later reader sees the same rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    w = df.write.partitionBy(*by) if by else df.write
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete a table made by ``keep`` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns that an operator works on; others may have any name."""
    return df.select(*[df[f"`{n}`"].alias(n) for n in names])
