"""Attribute files described by one object, from the scan to the cross-validation report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.operators import metrics
from tallybayes.operators.sampling import hash_fold
from tallybayes.operators.tabular import TabularSpec
from tallybayes.operators.validation import cross_validate_categorical, fold_accuracy, mean_std
from tallybayes.sources.files import read_attribute_csv


@dataclass(frozen=True)
class DatasetSpec:
    """An attribute file: where the label stands, which attributes are continuous, which classes count.

    ``continuous``: places among the attributes (the label left out); ``classes``: rows of other classes are
    dropped (None: all stay); ``n_attrs``: known number of attributes.
    """

    name: str
    label: str = "last"
    continuous: Sequence[int] = field(default_factory=tuple)
    classes: Sequence[str] | None = None
    n_attrs: int | None = None
    n_bins: int = 5

    def __post_init__(self):
        if self.label not in ("first", "last"):
            raise ValueError("label must be 'first' or 'last'")

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """``(label, a0 … a{M-1})``: continuous attributes as doubles (other text there fails), the rest as strings."""
        return self._typed(read_attribute_csv(spark, path, self.label, self.n_attrs))

    def _typed(self, rows: DataFrame) -> DataFrame:
        if self.classes is not None:
            rows = rows.filter(F.col("label").isin(list(self.classes)))
        names = [c for c in rows.columns if c not in ("label", "fold")]
        if any(not 0 <= i < len(names) for i in self.continuous):
            raise ValueError(f"{self.name}: continuous {list(self.continuous)} of {len(names)} attributes")
        typed = {c: F.col(c).cast("double") for i, c in enumerate(names) if i in self.continuous}
        return rows.withColumns(typed)

    def tabular(self, rows: DataFrame) -> TabularSpec:
        attrs = [c for c in rows.columns if c not in ("label", "fold")]
        return TabularSpec([], attrs, [attrs[i] for i in self.continuous], "label", self.n_bins)

    def folded(self, spark: SparkSession, path: str, k: int, seed: int = 42) -> DataFrame:
        """``read`` with a ``fold`` by a hash of the label and the attributes: equal rows share a fold."""
        rows = read_attribute_csv(spark, path, self.label, self.n_attrs)
        names = [c for c in rows.columns if c != "label"]
        return self._typed(rows.withColumn("fold", hash_fold(["label", *names], k, seed)))

    def report(self, spark: SparkSession, path: str, k: int = 6, alpha: float = 1.0, seed: int = 42) -> DataFrame:
        """One row: ``(dataset, n_instances, n_classes, folds, acc_mean, acc_std, macro_precision,
        macro_recall, macro_f1)``, accuracy by fold and the rest pooled over all folds."""
        rows = self.folded(spark, path, k, seed)
        pred = cross_validate_categorical(rows, self.tabular(rows), k, alpha=alpha, labels=self.classes)
        # folds x classes^2 rows at most, read by every figure
        counts = metrics.confusion_counts(pred, by=["fold"]).persist()
        classes = spark.createDataFrame([(c,) for c in self.classes], "label string") if self.classes is not None else counts.select("label")
        macro = metrics.macro_metrics(metrics.class_metrics(counts, classes, weight="n"))
        n = counts.select(F.coalesce(F.sum("n"), F.lit(0))).scalar()
        return mean_std(fold_accuracy(counts, weight="n")).join(macro, how="inner").select(
            F.lit(self.name).alias("dataset"), n.cast("bigint").alias("n_instances"), F.col("n_classes").cast("bigint").alias("n_classes"),
            F.col("folds").cast("bigint").alias("folds"), *[F.round(F.col(c), 4).alias(a) for c, a in (
                ("mean", "acc_mean"), ("std", "acc_std"), ("macro_precision", "macro_precision"),
                ("macro_recall", "macro_recall"), ("macro_f1", "macro_f1"))])
