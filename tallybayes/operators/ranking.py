"""Exact global / per-group ranking without a single-task window.

``row_number() over (order by k)`` moves every row into one task.  Here rows
are first placed in ordered buckets; per-bucket counts (a table whose size is
fixed by the bucket count, not by the data) give each bucket an offset, and
rows are numbered only inside their bucket.  With hash-derived buckets each
bucket holds ~n/2^bits rows whatever the key distribution (``bucketed_rank``).

Where the order is that of the data itself, no fixed bucket is safe: values share prefixes, one outlier stretches
a numeric range, one attribute has most values.  There ranges are bounded by quantiles of a sample
(``range_rank``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.session import scratch_dir


def bucketed_rank(df: DataFrame, bucket: Column, order: Sequence[Column],
                  group: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """Add a 1-based ``rank_col``: position by ``order`` within ``group``.

    ``bucket`` must be monotone in ``order`` (bucket(a) < bucket(b) implies
    a sorts before b).  The offset table has one row per (group, bucket).
    """
    group = list(group)
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    keys = [*group, "_bucket"]
    offsets = counts.select(
        *[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_offset"))
    w_in = Window.partitionBy(*keys).orderBy(*order)
    # a NULL group or bucket is a group or bucket of its own (buckets: before all others)
    same = [b[k].eqNullSafe(offsets[f"_o{i}"]) for i, k in enumerate(keys)]
    return (
        b.join(offsets, reduce(and_, same))
        .withColumn(rank_col, (F.col("_offset") + F.row_number().over(w_in)).cast("bigint"))
        .drop("_bucket", "_offset", *[f"_o{i}" for i in range(len(keys))])
    )


def range_rank(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (),
               rank_col: str = "rank", parts: int | None = None) -> DataFrame:
    """Add a 1-based ``rank_col``: position by ``order`` within ``group`` (NULLs first), in ranges of like size.

    Spark draws the ranges' bounds from a sample of the rows, so no range depends on how the keys are spread; rows
    of equal keys are told apart by their place in the input, so a key that a third of all rows
    have is cut like any other.  The sorted rows are written once under the shared checkpoint folder: counts and positions
    then belong to the same ranges, whatever is computed again.  Pass narrow rows.
    """
    spark = df.sparkSession
    group = list(group)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = [F.col(g) for g in group] + [F.col(o) if isinstance(o, str) else o for o in order]
    path = scratch_dir(spark, "ranges")
    df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, "_tie") \
        .sortWithinPartitions(*keys, "_tie") \
        .select(*df.columns, F.spark_partition_id().alias("_part"),
                F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")).write.parquet(path)
    placed = spark.read.parquet(path)
    # one row per range
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    ranked = placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_at") + 1).cast("bigint").alias(rank_col))
    if not group:
        return ranked
    starts = ranked.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(F.min(rank_col).alias("_start"))
    same = reduce(and_, [ranked[g].eqNullSafe(starts[f"_g{i}"]) for i, g in enumerate(group)])
    return ranked.join(starts, same).select(*df.columns, (F.col(rank_col) - F.col("_start") + 1).alias(rank_col))
