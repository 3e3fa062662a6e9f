"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least as many partitions as the session has cores.

    A file with one row group is read by one task, and everything up to the
    first shuffle (tokenizing, in-row bags) would then run on one core.  Large
    inputs already have many splits and are returned unchanged, so this never
    adds a shuffle at scale.  Call it on a plain scan only.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_table(spark: SparkSession, path: str, spread_small: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return spread(df) if spread_small else df
