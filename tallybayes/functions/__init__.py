"""Column-expression building blocks (all JVM-side built-ins)."""

from tallybayes.functions.hashing import split_hash
from tallybayes.functions.logmath import LOG_SCALE, fixed_log, safe_ln
from tallybayes.functions.text import bag_rows, tokens

__all__ = ["LOG_SCALE", "bag_rows", "fixed_log", "safe_ln", "split_hash", "tokens"]
