"""Reading the given tables, and storing intermediate ones in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landgate.workspace import workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps start from these rows.

    Unlike a cache the files survive the loss of any executor, and row numbers or samples taken
    before the write can't change when a task is repeated.
    """
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
