"""Log-probability helpers.

Scores are sums of many log-probabilities.  Summing doubles in shuffle order
makes the last bits depend on partitioning; we therefore keep every model
log-probability as a fixed-point integer (``LOG_SCALE`` units per nat).
Integer sums are exact, so a score is the same on 8 or 8,000 tasks and in
any SQL engine.  Quantization moves a per-token log-probability by at most
5e-10, far below any difference an argmax could act on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: fixed-point scale of stored log-probabilities (1e-9 nat).
LOG_SCALE = 1_000_000_000

NEG_INF = float("-inf")


def safe_ln(x: Column) -> Column:
    """ln(x) for x > 0, -inf otherwise (Spark's ln gives NULL for x <= 0)."""
    return F.when(x > 0, F.ln(x)).otherwise(F.lit(NEG_INF))


def fixed_log(x: Column) -> Column:
    """Fixed-point log-probability (bigint); NULL stands for -inf."""
    return F.when(x > 0, F.round(F.ln(x) * F.lit(float(LOG_SCALE))).cast("bigint"))


def from_fixed(q: Column) -> Column:
    """Fixed-point score back to a double; NULL (-inf) -> -inf."""
    return F.coalesce(q.cast("double") / F.lit(float(LOG_SCALE)), F.lit(NEG_INF))
