"""Intermediate tables in the cluster's shared folder.

Every table an operator reuses is written once as Parquet under
``spark.checkpoint.dir`` and read back: lineage is cut, and a lost executor
costs at most the tasks it ran, never the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.session import scratch_dir


def save(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, from ``names``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
        taken.add(name.lower())
    return found


def row_key(id_col: str, text_col: str, seed: int = 7) -> Column:
    """What tells a row apart: its id and a hash of its text, either may be null.  Rows equal in both get one verdict."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col), F.lit(seed)).alias("text"))


def without_rows(docs: DataFrame, id_col: str, text_col: str, keys: DataFrame, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` isn't in ``keys`` (one column)."""
    gone, = fresh(docs, "gone")
    return docs.join(keys.select(F.col(keys.columns[0]).alias(gone)).distinct(),
                     row_key(id_col, text_col, seed) == F.col(gone), "left_anti")
