"""Evaluation: accuracy, dense confusion matrix, per-class and macro
precision/recall/F1, and the prediction-equality check.

Input is a predictions DataFrame ``(label, prediction)`` plus, optionally,
the class domain (a DataFrame with a ``label`` column, e.g. the model's
classes); by default the domain is every value seen as label or prediction.
Zero denominators give 0.0; macro averages run over the whole domain, so a
class that is never predicted pulls them down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _domain(pred: DataFrame, classes: DataFrame | None) -> DataFrame:
    if classes is not None:
        return classes.select(F.col("label").cast("string").alias("label")).distinct()
    return pred.select(F.col("label").cast("string").alias("label")).union(
        pred.select(F.col("prediction").cast("string"))).distinct()


def _ratio(num, den):
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def _w(weight: str | None):
    """Row weight: 1 per prediction, or the count column of pre-aggregated
    ``(…, label, prediction, n)`` confusion counts."""
    return F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")


def confusion_counts(pred: DataFrame, by=()) -> DataFrame:
    """Sparse ``(by…, label, prediction, n)``: one aggregation of the
    predictions; every metric can be derived from this small table."""
    return pred.groupBy(*by, F.col("label").cast("string").alias("label"),
                        F.col("prediction").cast("string").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def accuracy(pred: DataFrame, weight: str | None = None) -> DataFrame:
    """One row ``(n, n_correct, accuracy)``; accuracy 0.0 on empty input."""
    w = _w(weight)
    return pred.agg(
        F.coalesce(F.sum(w), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.sum(F.when(F.col("label") == F.col("prediction"), w)), F.lit(0))
        .cast("bigint").alias("n_correct"),
    ).withColumn("accuracy", _ratio(F.col("n_correct"), F.col("n")))


def confusion_matrix(pred: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Dense ``(label, prediction, n)`` over domain x domain (zeros included)."""
    dom = _domain(pred, classes).agg(F.sort_array(F.collect_list("label")).alias("_all"))
    pairs = dom.select(F.explode("_all").alias("label"), "_all") \
        .select("label", F.explode("_all").alias("prediction"))
    counts = pred.groupBy(F.col("label").cast("string").alias("label"),
                          F.col("prediction").cast("string").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(counts, ["label", "prediction"], "left") \
        .withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


def class_metrics(pred: DataFrame, classes: DataFrame | None = None,
                  weight: str | None = None) -> DataFrame:
    """``(label, tp, fp, fn, support, precision, recall, f1)`` per class.

    ``weight`` names a count column when ``pred`` holds confusion counts."""
    # One pass: each (label, prediction, n) pair counts once for its true class
    # (actual, and tp when right) and once for its predicted class; a single
    # aggregation by class then gives tp, actual and predicted together.
    pairs = pred.select(F.col("label").cast("string").alias("label"),
                        F.col("prediction").cast("string").alias("prediction"),
                        _w(weight).alias("_n"))
    z = F.lit(0).cast("bigint")
    views = F.array(
        F.struct(F.col("label").alias("label"), F.col("_n").alias("_actual"), z.alias("_pred"),
                 F.when(F.col("label") == F.col("prediction"), F.col("_n")).otherwise(z).alias("tp")),
        F.struct(F.col("prediction").alias("label"), z.alias("_actual"), F.col("_n").alias("_pred"),
                 z.alias("tp")))
    per = pairs.select(F.inline(views)).groupBy("label").agg(
        F.sum("_actual").alias("_actual"), F.sum("_pred").alias("_pred"), F.sum("tp").alias("tp"))
    m = (_domain(pred, classes).join(per, "label", "left")
         .select("label", F.coalesce("tp", z).alias("tp"),
                 (F.coalesce("_pred", z) - F.coalesce("tp", z)).alias("fp"),
                 (F.coalesce("_actual", z) - F.coalesce("tp", z)).alias("fn"),
                 F.coalesce("_actual", z).alias("support")))
    m = m.withColumn("precision", _ratio(F.col("tp"), F.col("tp") + F.col("fp"))) \
        .withColumn("recall", _ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return m.withColumn("f1", F.when(
        F.col("precision") + F.col("recall") > 0,
        F.lit(2) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
    ).otherwise(F.lit(0.0)))


def macro_metrics(per_class: DataFrame) -> DataFrame:
    """One row ``(n_classes, macro_precision, macro_recall, macro_f1)``."""
    return per_class.agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("macro_precision"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("macro_recall"),
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"),
    )


def strategy_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``(n_rows, only_wide, only_sparse)``: rows of ``a`` and of ``b``
    missing from the other (multiset difference, both ways).

    Both sides are read once: equal rows are counted together, those of ``a`` as 1 and those of ``b`` as -1.
    """
    one = F.lit(1).cast("bigint")
    signed = a.select("*", one.alias("_a"), one.alias("_sign")).union(
        b.select(*a.columns, F.lit(0).cast("bigint").alias("_a"), (-one).alias("_sign")))
    rows = signed.groupBy(*a.columns).agg(F.sum("_a").alias("_a"), F.sum("_sign").alias("_left"))
    zero = F.lit(0).cast("bigint")
    return rows.agg(F.coalesce(F.sum("_a"), zero).alias("n_rows"),
                    F.coalesce(F.sum(F.greatest("_left", zero)), zero).alias("only_wide"),
                    F.coalesce(F.sum(F.greatest(-F.col("_left"), zero)), zero).alias("only_sparse"))
