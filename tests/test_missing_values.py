"""Missing and extreme values: nothing is dropped or invented."""

import pytest
from pyspark.sql import functions as F

from tallybayes.operators.model import MultinomialModel, fit_multinomial
from tallybayes.operators.sampling import kfold_balanced, ordered_split, stratified_split
from tallybayes.operators.tabular import TabularSpec, attribute_domains, bin_value, column_minmax


def test_splits_keep_rows_without_label_or_key(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "ab"[i % 2], None if i % 4 == 0 else i) for i in range(40)],
                               "id long, label string, k long")
    split = stratified_split(df, "id", "label", 0.25).collect()
    assert len(split) == 40 and sum(r["is_test"] for r in split) == 10
    assert {r["label"] for r in split if r["is_test"]} == {None, "a", "b"}
    ordered = ordered_split(df, "k", 15, tiebreak=["id"]).collect()
    assert len(ordered) == 40 and sum(r["is_test"] for r in ordered) == 25
    assert all(r["is_test"] == 0 for r in ordered if r["k"] is None)
    assert kfold_balanced(df, "id", 5).count() == 40


def test_ordered_split_over_extreme_keys(spark):
    keys = [-2**63, -5, 0, 7, 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert {r["k"]: r["is_test"] for r in ordered_split(df, "k", 3).collect()} == dict(zip(keys, (0, 0, 0, 1, 1)))


def test_missing_continuous_value_fails(spark):
    for v in (None, float("nan")):
        df = spark.createDataFrame([(1.0,), (v,)], "v double")
        with pytest.raises(Exception, match="NULL or NaN"):
            df.select(bin_value(F.col("v"), F.lit(0.0), F.lit(10.0), 5)).collect()


def test_no_continuous_attribute_and_null_category(spark):
    df = spark.createDataFrame([("x", "a")], "label string, a0 string")
    assert column_minmax(df, TabularSpec(["label"], ["a0"])).collect() == []
    feats = spark.createDataFrame([(0, "u"), (0, None), (1, "v")], "attr long, value string")
    assert {r["attr"]: r["n_values"] for r in attribute_domains(feats).collect()} == {0: 1, 1: 1}


def test_null_label_is_refused_and_loaded_model_keeps_its_scalars(spark, tmp_path):
    rows = [("a", "red green"), ("b", "blue blue red")]
    with pytest.raises(ValueError, match="without a label"):
        fit_multinomial(spark.createDataFrame([*rows, (None, "red")], "label string, text string"))
    model = fit_multinomial(spark.createDataFrame(rows, "label string, text string"), alpha=0.1)
    model.save(str(tmp_path / "m"))
    again = MultinomialModel.load(spark, str(tmp_path / "m"))
    assert (again.alpha, again.min_df, again.vocab_size) == (0.1, 1, model.vocab_size)
    assert (again.vocab_bytes, again.total_df) == (model.vocab_bytes, model.total_df)
