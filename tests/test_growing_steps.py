"""Steps that must not grow faster than their input: the stream's model join, index arrays."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tallybayes.functions.text import distinct_terms
from tallybayes.operators.model import BINARY, fit_multinomial
from tallybayes.operators.text import prepare_text, vectorize_arrays, vocabulary
from tallybayes.plans import stream_plans, text_plans
from tallybayes.streaming import batch_bytes, score_stream, stream_scores

LIMIT = "spark.tallybayes.modelBroadcastBytes"


def _texts(classes=3):
    """Frequent words in all texts, rare ones in a few, null and shared ids, exact copies, texts without a known word."""
    rows = [(i, f"c{i % classes:02d}", f"the of the w{i % 9} u{i} Pair{i // 2} of", i % 4) for i in range(80)]
    return rows + [(90, "c00", None, 0), (91, "c01", "", 1), (None, "c02", "the w1 new", 2), (None, "c02", "of w2 u7", 0),
                   (92, "c00", "the w3 w3 of", 3), (92, "c00", "the w3 w3 of", 3), (92, "c01", "u5 u6 zz yy", 0)]


def _docs(spark, classes=3):
    return spark.createDataFrame(_texts(classes), "doc_id long, label string, text string, fold int").repartition(4)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def limit(spark):
    yield lambda n: spark.conf.set(LIMIT, str(n))
    spark.conf.unset(LIMIT)


@pytest.mark.parametrize("classes,broadcast", [(3, 1), (3, 2500), (40, 20000)])
def test_stream_with_frequent_terms_broadcast_equals_batch(spark, tmp_path, limit, classes, broadcast):
    docs = _docs(spark, classes)
    m = fit_multinomial(docs.filter("fold > 0"))
    want = _rows(m.transform(docs, ["doc_id"], strategy="sparse"))
    docs.write.parquet(str(tmp_path / "in"))
    limit(broadcast)
    assert ("_frequent" in m.known_terms(docs, ["doc_id"], "text", [])._jdf.queryExecution().toString()) == (broadcast > 1)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    score_stream(m, stream, ["doc_id"], str(tmp_path / "out")).awaitTermination()
    assert _rows(stream_scores(m, spark, str(tmp_path / "out"), ["doc_id"])) == want and len(want) == len(_texts())
    # one row a known token and a marker a text: no row per class, none for unknown words
    known = {w for _, _, t, f in _texts(classes) if f > 0 for w in re.findall(r"\w{2,}", (t or "").lower())}
    tokens = [w for _, _, t, _ in _texts(classes) for w in re.findall(r"\w{2,}", (t or "").lower())]
    assert spark.read.parquet(str(tmp_path / "out" / "scored")).count() == sum(w in known for w in tokens) + len(_texts())


def test_stream_keeps_a_laws_weight(spark, tmp_path, limit):
    docs = _docs(spark)
    m = fit_multinomial(docs.filter("fold > 0"), law=BINARY)
    docs.write.parquet(str(tmp_path / "in"))
    limit(2500)
    score_stream(m, spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in")), ["doc_id"], str(tmp_path / "out")).awaitTermination()
    assert _rows(stream_scores(m, spark, str(tmp_path / "out"), ["doc_id"])) == _rows(m.transform(docs, ["doc_id"], strategy="sparse"))


def test_small_files_share_a_micro_batch(spark, tmp_path, monkeypatch):
    rows = [(i, f"w{i % 3} common x{i}", "en", "s", 9) for i in range(24)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    monkeypatch.setattr(stream_plans, "scratch_dir", lambda *_: str(tmp_path / "out"))
    found = _rows(stream_plans.QUERIES["nb_predict_stream"](spark, str(tmp_path)))
    assert found == _rows(text_plans.QUERIES["nb_predict_new"](spark, str(tmp_path))) and len(found) == 12
    assert [x for x in os.listdir(tmp_path / "out" / "_checkpoints" / "scored" / "commits") if x.isdigit()] == ["0"]


def test_a_micro_batch_has_at_least_the_models_bytes(spark):
    m = fit_multinomial(_docs(spark))
    small = batch_bytes(m, spark)
    m.vocab_bytes = 1 << 50
    assert batch_bytes(m, spark) > 1 << 50 > small > 0


@pytest.mark.parametrize("broadcast", [1, 4000, 1 << 20])
@pytest.mark.parametrize("start,step", [(0, 1), (-5, 1 << 52)])
def test_index_arrays_with_frequent_terms_broadcast(spark, limit, broadcast, start, step):
    docs = _docs(spark)
    vocab = vocabulary(distinct_terms(docs.filter("fold > 0"), "text")).withColumn("idx", F.col("idx") * F.lit(step) + F.lit(start))
    index = {r["term"]: r["idx"] for r in vocab.collect()}
    limit(broadcast)
    got = vectorize_arrays(docs, vocab, ["doc_id"], keep=["label"])
    want = [(d, c, [index[w] for w in re.findall(r"\w{2,}", (t or "").lower()) if w in index]) for d, c, t, _ in _texts()]
    assert _rows(got) == sorted(want, key=repr)
    # a text is shuffled whole, not a row a term with its places
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "sort_array(transform(" not in plan


def test_training_and_scoring_on_index_arrays_without_sorted_bags(spark, limit):
    rows = prepare_text(_docs(spark).withColumn("is_test", (F.col("fold") == 0).cast("bigint")), ["doc_id"])
    train, test = rows.filter("is_test = 0"), rows.filter("is_test = 1")
    want = _rows(fit_multinomial(_docs(spark).filter("fold > 0")).transform(_docs(spark).filter("fold = 0"), ["doc_id"], keep=["label"]))
    m = fit_multinomial(train, words_col="words")
    for broadcast in (1, 4000, 1 << 20):
        limit(broadcast)
        got = m.transform(test, ["doc_id"], keep=["label"], words_col="words")
        assert ("_frequent" in got._jdf.queryExecution().toString()) == (broadcast == 4000)
        assert _rows(got) == want
