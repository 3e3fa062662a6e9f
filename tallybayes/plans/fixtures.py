"""Datasets the query plans run on, derived from the driver tables.

Fixed values shared by the Spark plans and their SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.operators.sampling import hash_fold
from tallybayes.sources.tables import read_table

# Fixed values for the plans (mirrored in the SQL oracles).
SEED = 42
K = 5              # folds for hold-out splits and text cross-validation
TEST_FOLD = 0      # fold held out as the test set
K_TAB = 6          # folds for tabular cross-validation
N_BINS = 5
ALPHA = 1.0
FACTORS = (1, 2, 4, 8)

# Tabular fixture: lineitem, label l_returnflag, attribute order below.
LINEITEM_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# The 4-column key repeats once at sf0.001; with the ship date it is unique at
# every scale, so rows are identified by LINEITEM_ROW (folds hash LINEITEM_ID).
LINEITEM_ROW = LINEITEM_ID + ["l_shipdate"]
LINEITEM_ATTRS = ["l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_CONTINUOUS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# Tables with heavy per-row work before the first shuffle (tokenizing whole
# texts; one binned copy per fold in tabular cross-validation): a scan with
# fewer splits than cores is spread first (see sources.spread).
SPREAD_TABLES = {"documents", "pages", "conversations", "benchmark", "lineitem", "embeddings"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet",
                      spread_small=name in SPREAD_TABLES)


def lang_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as ``(doc_id, label=lang, text, fold)``."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("label"), "text",
        hash_fold("doc_id", K, SEED).alias("fold"))


def quality_docs(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """labeled documents as ``(doc_id, label=quality|toxic, text, fold)``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col(target).cast("string").alias("label"))
    return labels.join(docs, "doc_id").withColumn("fold", hash_fold("doc_id", K, SEED))


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with ``label`` and ``fold`` (5-fold hash on the 4-column key)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LINEITEM_ROW, F.col("l_returnflag").alias("label"), *LINEITEM_ATTRS,
                     hash_fold(LINEITEM_ID, K, SEED).alias("fold"))
