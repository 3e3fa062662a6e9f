"""Counting aggregates of the multinomial model (N_c, total_c, count_{w,c}).

All are ``groupBy`` aggregations with partial (map-side) combine: a class or
a term with a third of all rows still sends one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybayes.operators.model import class_term_counts

__all__ = ["class_doc_counts", "class_term_counts", "class_token_totals"]


def class_doc_counts(train: DataFrame, label_col: str = "label") -> DataFrame:
    """``(label, n_docs)``: documents per class, empty documents included."""
    return train.groupBy(F.col(label_col).cast("string").alias("label")) \
        .agg(F.count(F.lit(1)).alias("n_docs"))


def class_token_totals(counts: DataFrame) -> DataFrame:
    """``(label, n_tokens)`` from ``class_term_counts`` (after any vocabulary filter)."""
    return counts.groupBy("label").agg(F.sum("cnt").alias("n_tokens"))
