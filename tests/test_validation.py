"""One-pass cross-validation equals retraining per fold; replication."""

from pyspark.sql import functions as F

from tallybayes.operators.model import fit_multinomial
from tallybayes.operators.sampling import hash_fold
from tallybayes.operators.validation import cross_validate_multinomial, replication_study
from tests.conftest import SF_SMALL


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.col("lang").alias("label"), "text", hash_fold("doc_id", 3).alias("fold"))


def test_cv_subtraction_equals_retraining(spark):
    docs = _docs(spark)
    for min_df in (1, 2):
        cv = {r["doc_id"]: (r["prediction"], r["score"]) for r in
              cross_validate_multinomial(docs, ["doc_id"], 3, min_df=min_df).collect()}
        labels = sorted(r[0] for r in docs.select("label").distinct().collect())
        ref = {}
        for f in range(3):
            m = fit_multinomial(docs.filter(F.col("fold") != f), min_df=min_df, labels=labels)
            for r in m.transform(docs.filter(F.col("fold") == f), ["doc_id"]).collect():
                ref[r["doc_id"]] = (r["prediction"], r["score"])
        assert cv == ref


def test_replication_factor_one_is_plain_accuracy(spark):
    docs = _docs(spark)
    m = fit_multinomial(docs.filter(F.col("fold") != 0))
    test = docs.filter(F.col("fold") == 0)
    pred = m.transform(test, ["doc_id"], keep=["label"]).collect()
    acc = sum(r["label"] == r["prediction"] for r in pred) / len(pred)
    rs = {r["factor"]: r for r in replication_study(m, test, ["doc_id"], [1, 2]).collect()}
    assert abs(rs[1]["accuracy"] - acc) < 1e-12
    assert rs[2]["n_train"] == 2 * rs[1]["n_train"] and rs[2]["n_test"] == 2 * len(pred)
