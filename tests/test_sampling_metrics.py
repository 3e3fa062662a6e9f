"""Splits, folds, replication, binning and metrics."""

import math

from pyspark.sql import functions as F

from tallybayes.operators import metrics as M
from tallybayes.operators.sampling import (
    kfold_assign,
    kfold_balanced,
    ordered_split,
    replicate,
    stratified_split,
)
from tallybayes.operators.tabular import bin_value
from tests.conftest import SF_SMALL


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.col("lang").alias("label"))


def test_stratified_split_quotas(spark):
    d = _docs(spark)
    s = stratified_split(d, "doc_id", "label", test_size=0.2).collect()
    n = len(s)
    assert sum(r["is_test"] for r in s) == math.ceil(0.2 * n)
    by = {}
    for r in s:
        by.setdefault(r["label"], []).append(r["is_test"])
    for lab, flags in by.items():
        assert abs(sum(flags) - 0.2 * len(flags)) < 1.0


def test_folds_partition_ids(spark):
    d = _docs(spark)
    a = kfold_assign(d, "doc_id", 5).collect()
    assert {r["fold"] for r in a} <= set(range(5)) and len(a) == d.count()
    b = kfold_balanced(d, "doc_id", 5).groupBy("fold").count().collect()
    sizes = [r["count"] for r in b]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1 and sum(sizes) == d.count()


def test_replicate_and_ordered_split(spark):
    d = _docs(spark)
    assert replicate(d, 3).count() == 3 * d.count()
    assert replicate(d, 0).count() == d.count()
    o = ordered_split(d, "doc_id", 50).filter(F.col("is_test") == 0).collect()
    assert sorted(r["doc_id"] for r in o) == sorted(r["doc_id"] for r in d.collect())[:50]


def test_binning_by_hand(spark):
    vals = [0.0, 1.99, 2.0, 10.0, -3.0, 99.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(bin_value(F.col("v"), F.lit(0.0), F.lit(10.0), 5)).collect()]
    assert got == ["bin0", "bin0", "bin1", "bin4", "bin0", "bin4"]
    same = df.select(bin_value(F.col("v"), F.lit(5.0), F.lit(5.0), 5)).collect()
    assert {r[0] for r in same} == {"bin0"}


def test_metrics_by_hand(spark):
    rows = ([("ham", "ham")] * 963 + [("ham", "spam")] * 3 + [("spam", "ham")] * 14
            + [("spam", "spam")] * 135)
    pred = spark.createDataFrame(rows, "label string, prediction string")
    pc = {r["label"]: r for r in M.class_metrics(pred).collect()}
    assert round(pc["ham"]["precision"], 3) == 0.986 and round(pc["ham"]["recall"], 3) == 0.997
    assert round(pc["spam"]["precision"], 3) == 0.978 and round(pc["spam"]["recall"], 3) == 0.906
    assert round(pc["spam"]["f1"], 3) == 0.941
    mm = M.macro_metrics(M.class_metrics(pred)).first()
    assert round(mm["macro_f1"], 3) == 0.966
    cm = {(r["label"], r["prediction"]): r["n"] for r in M.confusion_matrix(pred).collect()}
    assert cm == {("ham", "ham"): 963, ("ham", "spam"): 3, ("spam", "ham"): 14, ("spam", "spam"): 135}
    assert M.accuracy(pred).first()["n"] == 1115


def test_never_predicted_class(spark):
    pred = spark.createDataFrame([("a", "a"), ("b", "a")], "label string, prediction string")
    classes = spark.createDataFrame([("a",), ("b",), ("c",)], "label string")
    pc = {r["label"]: r for r in M.class_metrics(pred, classes).collect()}
    assert pc["b"]["precision"] == 0.0 and pc["b"]["f1"] == 0.0 and pc["c"]["support"] == 0
    mm = M.macro_metrics(M.class_metrics(pred, classes)).first()
    assert mm["n_classes"] == 3
    assert math.isclose(mm["macro_recall"], 1.0 / 3)
    empty = spark.createDataFrame([], "label string, prediction string")
    assert M.accuracy(empty).first()["accuracy"] == 0.0
    cm = M.confusion_matrix(pred, classes).collect()
    assert len(cm) == 9 and sum(r["n"] for r in cm) == 2
