"""Reproducible sampling: stratified split, k-fold assignment, replication
and ordered head/tail split.  All decisions come from ``split_hash``, so a
row lands in the same place on every run and every engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.functions.hashing import split_hash
from tallybayes.operators.ranking import bucketed_rank, range_rank

# Buckets for exact ranking: top bits of the 32-bit split hash.
RANK_BITS = 16


def _key_cols(key) -> list:
    """Key as a list of column names or Column expressions (e.g. ``md5(text)``
    to keep exact copies on one side of a split)."""
    return [key] if isinstance(key, (str, Column)) else list(key)


def _as_col(k) -> Column:
    return F.col(k) if isinstance(k, str) else k


def kfold_assign(df: DataFrame, key: Sequence[str] | str, k: int = 5, seed: int = 42,
                 fold_col: str = "fold") -> DataFrame:
    """``fold = hash(seed, key) mod k``: no shuffle, no ranking, sizes ~n/k."""
    return df.withColumn(fold_col, F.pmod(split_hash(seed, *_key_cols(key)), F.lit(k)))


def _hash_rank(df: DataFrame, key: list[str], seed: int, group: Sequence[str] = ()) -> DataFrame:
    h = split_hash(seed, *key)
    with_h = df.withColumn("_h", h)
    ranked = bucketed_rank(
        with_h, F.shiftright(F.col("_h"), 32 - RANK_BITS),
        [F.col("_h")] + [_as_col(c) for c in key], group=group, rank_col="_rank")
    return ranked.drop("_h")


def kfold_balanced(df: DataFrame, key: Sequence[str] | str, k: int = 5, seed: int = 42,
                   fold_col: str = "fold") -> DataFrame:
    """Shuffle by hash, then fold = position mod k: fold sizes differ by <= 1."""
    ranked = _hash_rank(df, _key_cols(key), seed)
    return ranked.withColumn(fold_col, F.pmod(F.col("_rank") - 1, F.lit(k))).drop("_rank")


def stratified_split(df: DataFrame, key: Sequence[str] | str, label_col: str = "label",
                     test_size: float = 0.2, seed: int = 42, flag_col: str = "is_test") -> DataFrame:
    """Stratified train/test split with exact class quotas.

    Test gets ``ceil(test_size * n)`` rows; each class gets
    ``floor(test_size * n_c)`` plus one for the classes with the largest
    remainders (ties by label; rows without a label are a class), and inside a class the rows with the smallest
    hash go to test.  ``flag_col`` is 1 for test, 0 for train.
    """
    key = _key_cols(key)
    classes = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    ts = F.lit(float(test_size))
    exact = F.col("_nc") * ts
    all_rows = Window.partitionBy()
    quota = (
        classes.withColumn("_base", F.floor(exact).cast("bigint"))
        .withColumn("_rem", exact - F.col("_base"))
        .withColumn("_target", F.ceil(F.sum("_nc").over(all_rows) * ts).cast("bigint"))
        .withColumn("_deficit", F.col("_target") - F.sum("_base").over(all_rows))
        .withColumn("_order", F.row_number().over(
            Window.orderBy(F.col("_rem").desc(), F.col(label_col))))
        .select(F.col(label_col).alias("_label"), (F.col("_base") + F.when(F.col("_order") <= F.col("_deficit"), 1)
                            .otherwise(0)).alias("_quota"))
    )
    ranked = _hash_rank(df, key, seed, group=[label_col])
    return (ranked.join(quota, ranked[label_col].eqNullSafe(quota["_label"]))
            .withColumn(flag_col, F.when(F.col("_rank") <= F.col("_quota"), 1).otherwise(0)
                        .cast("bigint"))
            .drop("_rank", "_quota", "_label"))


def replicate(df: DataFrame, factor: int, replica_col: str = "replica") -> DataFrame:
    """Each row ``factor`` times (factor <= 1: identity), tagged 0..factor-1.

    A generator per row, not a join: the copies are made where the row is.
    """
    f = max(int(factor), 1)
    return df.withColumn(replica_col, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                           F.lit(f - 1).cast("bigint"))))


def ordered_split(df: DataFrame, order_col: str, n_train: int, flag_col: str = "is_test",
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """First ``n_train`` rows by ``order_col`` are train (0), the rest test (1).

    Rows without a key come first.  Exact rank over sampled ranges of the key (``range_rank``).
    """
    ranked = range_rank(df, [order_col, *tiebreak], rank_col="_rank")
    return ranked.withColumn(flag_col, F.when(F.col("_rank") > n_train, 1).otherwise(0)
                             .cast("bigint")).drop("_rank")


def hash_fold(key: Sequence[str] | str, k: int, seed: int = 42) -> Column:
    """The ``kfold_assign`` fold as a bare column expression."""
    return F.pmod(split_hash(seed, *_key_cols(key)), F.lit(k))
