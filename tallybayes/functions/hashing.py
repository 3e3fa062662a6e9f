"""Portable split hash: same value in Spark and in any SQL engine with md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_hash(seed: int, *keys: Column | str) -> Column:
    """First 32 bits of ``md5('<seed>|k1|k2…')`` as a bigint in [0, 2^32).

    Deterministic, engine-independent and uniform: the base of every
    split, fold and sampling decision, so that reruns (and recomputation of
    lost partitions) always land rows in the same place.
    """
    parts = [F.lit(str(seed))] + [
        (F.col(k) if isinstance(k, str) else k).cast("string") for k in keys
    ]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
