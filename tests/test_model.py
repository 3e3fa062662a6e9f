"""Multinomial and categorical models against hand-computed values and a
plain per-token Python loop."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybayes.functions.text import tokens
from tallybayes.operators.model import fit_categorical, fit_multinomial
from tallybayes.operators.sampling import hash_fold
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def hand_model(spark):
    train = spark.createDataFrame([("A", "aa bb aa"), ("A", "aa cc"), ("B", "bb bb")],
                                  "label string, text string")
    return fit_multinomial(train, alpha=1.0)


def test_multinomial_hand_values(hand_model):
    m = hand_model
    assert m.vocab_size == 3 and m.n_docs == 3 and m.labels == ["A", "B"]
    cs = {r["label"]: r for r in m.class_stats.collect()}
    assert cs["A"]["n_tokens"] == 5 and cs["B"]["n_tokens"] == 2
    assert math.isclose(cs["A"]["log_prior"], math.log(2 / 3))
    assert math.isclose(cs["B"]["log_default"], math.log(1 / 5))
    ll = {(r["label"], r["term"]): r["log_likelihood"] for r in m.term_stats.collect()}
    assert math.isclose(ll[("A", "aa")], math.log(4 / 8))
    assert math.isclose(ll[("A", "bb")], math.log(2 / 8))
    assert math.isclose(ll[("B", "bb")], math.log(3 / 5))
    assert ("B", "aa") not in ll  # sparse: zero counts use the default


@pytest.mark.parametrize("strategy", ["wide", "sparse"])
def test_multinomial_hand_predictions(spark, hand_model, strategy):
    test = spark.createDataFrame([(1, "bb"), (2, "aa"), (3, "zz"), (4, ""), (5, None)],
                                 "doc_id int, text string")
    got = {r["doc_id"]: r["prediction"] for r in
           hand_model.transform(test, ["doc_id"], strategy=strategy).collect()}
    assert got == {1: "B", 2: "A", 3: "A", 4: "A", 5: "A"}


def test_likelihoods_sum_to_one(hand_model):
    m = hand_model
    for r in m.class_stats.collect():
        seen = m.term_stats.filter(F.col("label") == r["label"]).collect()
        total = sum(math.exp(x["log_likelihood"]) for x in seen)
        total += (m.vocab_size - len(seen)) * math.exp(r["log_default"])
        assert math.isclose(total, 1.0)


def _python_nb(train_rows, test_rows):
    """Plain per-token loop (the textbook algorithm), alpha = 1."""
    import re
    tok = re.compile(r"(?u)\b\w\w+\b")
    docs = [(lab, tok.findall((t or "").lower())) for lab, t in train_rows]
    vocab = sorted({w for _, ws in docs for w in ws})
    labels = sorted({lab for lab, _ in docs})
    n = len(docs)
    n_c = Counter(lab for lab, _ in docs)
    cnt = Counter((lab, w) for lab, ws in docs for w in ws)
    tot = Counter()
    for lab, ws in docs:
        tot[lab] += len(ws)
    vs = set(vocab)
    out = {}
    for i, t in test_rows:
        ws = [w for w in tok.findall((t or "").lower()) if w in vs]
        best, best_s = 0, float("-inf")
        for c, lab in enumerate(labels):
            d = tot[lab] + len(vocab)
            s = math.log(n_c[lab] / n) + sum(math.log((cnt[(lab, w)] + 1) / d) for w in ws)
            if s > best_s:
                best, best_s = c, s
        out[i] = (labels[best], best_s)
    return out


def test_multinomial_matches_python_loop(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet") \
        .withColumn("fold", hash_fold("doc_id", 4))
    rows = docs.select("doc_id", "lang", "text", "fold").collect()
    train = [(r["lang"], r["text"]) for r in rows if r["fold"] != 0]
    test = [(r["doc_id"], r["text"]) for r in rows if r["fold"] == 0]
    expect = _python_nb(train, test)
    model = fit_multinomial(docs.filter(F.col("fold") != 0).withColumnRenamed("lang", "label"))
    got = {r["doc_id"]: (r["prediction"], r["score"]) for r in
           model.transform(docs.filter(F.col("fold") == 0), ["doc_id"]).collect()}
    assert set(got) == set(expect)
    for k, (lab, s) in expect.items():
        assert got[k][0] == lab
        assert math.isclose(got[k][1], s, rel_tol=1e-9, abs_tol=1e-4)


def test_scores_do_not_depend_on_partitioning(spark, hand_model):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", "text")
    m = fit_multinomial(docs.withColumnRenamed("lang", "label"))
    a = m.transform(docs, ["doc_id"]).collect()
    b = m.transform(docs.repartition(13), ["doc_id"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_categorical_hand_case(spark):
    """Five berries by colour and size: D = (3, 2), three are edible."""
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(["eat", "eat", "eat", "leave", "leave"])], "id int, label string")
    seen = [("blue", "small"), ("blue", "large"), ("red", "small"), ("red", "large"), ("white", "large")]
    labels = ["eat", "eat", "eat", "leave", "leave"]
    feats = spark.createDataFrame([(i, labels[i], a, v) for i, pair in enumerate(seen) for a, v in enumerate(pair)],
                                  "id int, label string, attr bigint, value string")
    m = fit_categorical(feats, rows)
    ll = {(r["label"], r["attr"], r["value"]): r["log_likelihood"] for r in m.log_likelihood().collect()}
    assert len(ll) == 10
    for key, p in {("eat", 0, "blue"): 3 / 6, ("eat", 0, "red"): 2 / 6, ("eat", 0, "white"): 1 / 6,
                   ("leave", 0, "blue"): 1 / 5, ("leave", 0, "white"): 2 / 5,
                   ("eat", 1, "small"): 3 / 5, ("leave", 1, "small"): 1 / 4}.items():
        assert math.isclose(ll[key], math.log(p)), key
    # white and small: 3/5 * 1/6 * 3/5 against 2/5 * 2/5 * 1/4; red and large: 3/5 * 2/6 * 2/5 against 2/5 * 2/5 * 3/4
    test_rows = spark.createDataFrame([(5,), (6,), (7,)], "id int")
    test_feats = spark.createDataFrame([(5, 0, "white"), (5, 1, "small"), (6, 0, "red"), (6, 1, "large"), (7, 0, "green")],
                                       "id int, attr bigint, value string")
    got = {r["id"]: (r["prediction"], round(math.exp(r["score"]), 6)) for r in m.transform(test_feats, test_rows, ["id"]).collect()}
    assert got == {5: ("eat", 0.06), 6: ("leave", 0.12), 7: ("eat", 0.6)}
    for lab in ("eat", "leave"):
        for attr in (0, 1):
            assert math.isclose(sum(math.exp(v) for (l, a, _), v in ll.items() if (l, a) == (lab, attr)), 1.0)


def test_unseen_class_gets_minus_infinity_prior(spark):
    train = spark.createDataFrame([("A", "aa bb")], "label string, text string")
    m = fit_multinomial(train, labels=["A", "Z"])
    cs = {r["label"]: r["log_prior"] for r in m.class_stats.collect()}
    assert cs["Z"] == float("-inf")
    test = spark.createDataFrame([(1, "aa")], "doc_id int, text string")
    assert m.transform(test, ["doc_id"]).first()["prediction"] == "A"


def test_tokens_null_safe(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert df.select(F.size(tokens("text"))).first()[0] == 0


@pytest.mark.parametrize("threshold,salt", [("-1", 4), ("1", 3), ("1", 1)])
def test_join_strategies_agree(spark, threshold, salt):
    """Broadcast, salted shuffle and plain shuffle joins give the same rows."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.col("lang").alias("label"), "text")
    m = fit_multinomial(docs)
    base = sorted(map(tuple, m.transform(docs, ["doc_id"]).collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        m.salt = salt
        got = sorted(map(tuple, m.transform(docs, ["doc_id"]).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        m.salt = None
    assert got == base


def test_save_and_load_round_trip(spark, tmp_path, hand_model):
    path = str(tmp_path / "model")
    hand_model.save(path)
    from tallybayes.operators.model import MultinomialModel
    loaded = MultinomialModel.load(spark, path)
    test = spark.createDataFrame([(1, "bb"), (2, "aa"), (3, "zz")], "doc_id int, text string")
    a = sorted(map(tuple, hand_model.transform(test, ["doc_id"]).collect()))
    b = sorted(map(tuple, loaded.transform(test, ["doc_id"]).collect()))
    assert a == b and loaded.vocab_size == 3


def test_checkpoint_materialization(spark):
    train = spark.createDataFrame([("A", "aa bb aa"), ("A", "aa cc"), ("B", "bb bb")],
                                  "label string, text string")
    m = fit_multinomial(train, materialize_as="checkpoint")
    test = spark.createDataFrame([(1, "bb"), (2, "aa")], "doc_id int, text string")
    got = {r["doc_id"]: r["prediction"] for r in m.transform(test, ["doc_id"]).collect()}
    assert got == {1: "B", 2: "A"}


@pytest.fixture
def no_model_broadcast(spark):
    spark.conf.set("spark.tallybayes.modelBroadcastBytes", "1")
    yield
    spark.conf.unset("spark.tallybayes.modelBroadcastBytes")


@pytest.mark.parametrize("strategy", ["wide", "sparse"])
def test_hot_keys_are_dealt_over_slots(spark, no_model_broadcast, strategy):
    """A known and an unknown term in every document: same rows as with a broadcast model."""
    rows = [(i, f"tide {'moon ' * (i % 3)} unseen{i} zzz w{i % 40}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    m = fit_multinomial(spark.createDataFrame(
        [("a", "tide moon w1 w2"), ("b", "tide w3 w4 w5 w6"), ("c", "moon moon w7")], "label string, text string"))
    got = sorted(map(tuple, m.transform(docs, ["doc_id"], strategy=strategy).collect()))
    spark.conf.set("spark.tallybayes.modelBroadcastBytes", str(1 << 20))
    assert got == sorted(map(tuple, m.transform(docs, ["doc_id"]).collect())) and len(got) == 400


@pytest.mark.parametrize("strategy", ["wide", "sparse"])
def test_rows_sharing_an_id_or_without_one_are_scored_alone(spark, strategy):
    m = fit_multinomial(spark.createDataFrame([("a", "oak oak elm"), ("b", "ant bee bee")],
                                              "label string, text string"))
    rows = [(1, "oak"), (1, "bee bee bee"), (1, "bee bee bee"), (None, "elm"), (None, "ant"), (2, None)]
    got = m.transform(spark.createDataFrame(rows, "doc_id int, text string"), ["doc_id"], keep=["text"],
                      strategy=strategy).collect()
    assert sorted(((r["doc_id"] or 0, r["text"] or "", r["prediction"]) for r in got)) == [
        (0, "ant", "b"), (0, "elm", "a"), (1, "bee bee bee", "b"), (1, "bee bee bee", "b"), (1, "oak", "a"),
        (2, "", "a")]
    alone = m.transform(spark.createDataFrame([(7, "bee bee bee")], "doc_id int, text string"), ["doc_id"]).first()
    assert {r["score"] for r in got if r["text"] == "bee bee bee"} == {alone["score"]}


def test_many_classes(spark):
    """2,000 classes: nothing in the plan has a column per class."""
    n = 2000
    train = spark.range(n).selectExpr("format_string('c%04d', id) AS label",
                                      "concat('own', id, ' shared ', IF(id % 2 = 0, 'even', 'odd')) AS text")
    m = fit_multinomial(train)
    test = spark.createDataFrame([(1, "own1234 shared"), (2, "nothing known"), (3, "odd")],
                                 "doc_id int, text string")
    got = {r["doc_id"]: r["prediction"] for r in m.transform(test, ["doc_id"]).collect()}
    assert m.n_classes == n and got == {1: "c1234", 2: "c0000", 3: "c0001"}


def test_categorical_rows_sharing_an_id_fail(spark):
    rows = spark.createDataFrame([(1, "p"), (2, "n")], "id int, label string")
    feats = spark.createDataFrame([(1, "p", 0, "a"), (2, "n", 0, "b")],
                                  "id int, label string, attr bigint, value string")
    m = fit_categorical(feats, rows)
    assert m.transform(feats, rows, ["id"]).count() == 2
    with pytest.raises(Exception, match="share an id"):
        m.transform(feats, rows.union(rows), ["id"]).collect()


def test_theta_matches_spark_ml_naive_bayes(spark):
    """pyspark.ml's multinomial NaiveBayes theta equals our log-likelihoods
    (its priors are smoothed, so only theta is compared)."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.linalg import SparseVector
    from tallybayes.operators.text import doc_term_counts, vocabulary

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.col("lang").alias("label"), "text")
    m = fit_multinomial(docs)
    vocab = {r["term"]: r["idx"] for r in vocabulary(doc_term_counts(docs, ["doc_id"])).collect()}
    labels = {l: i for i, l in enumerate(m.labels)}
    bags = doc_term_counts(docs, ["doc_id"], keep=["label"]).collect()
    per_doc = {}
    for r in bags:
        per_doc.setdefault((r["doc_id"], r["label"]), {})[vocab[r["term"]]] = float(r["tf"])
    rows = [(float(labels[lab]), SparseVector(len(vocab), dict(sorted(f.items()))))
            for (_, lab), f in per_doc.items()]
    ml = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(
        spark.createDataFrame(rows, ["label", "features"]))
    theta = ml.theta.toArray()
    ours = {(r["label"], r["term"]): r["log_likelihood"] for r in m.term_stats.collect()}
    for (lab, term), ll in list(ours.items())[:2000]:
        assert math.isclose(theta[labels[lab]][vocab[term]], ll, rel_tol=1e-9, abs_tol=1e-12)
    cs = {r["label"]: r["log_default"] for r in m.class_stats.collect()}
    for lab, c in labels.items():
        unseen = [i for t, i in vocab.items() if (lab, t) not in ours][:50]
        for i in unseen:
            assert math.isclose(theta[c][i], cs[lab], rel_tol=1e-9)


def test_estimator_front_end(spark):
    from tallybayes import NaiveBayes
    train = spark.createDataFrame([("A", "aa bb aa"), ("A", "aa cc"), ("B", "bb bb")],
                                  "label string, text string")
    m = NaiveBayes("multinomial", alpha=1.0).fit(train)
    assert m.labels == ["A", "B"] and m.vocab_size == 3
    rows = spark.createDataFrame([(1, "p"), (2, "n")], "id int, label string")
    feats = spark.createDataFrame([(1, "p", 0, "a"), (2, "n", 0, "b")],
                                  "id int, label string, attr bigint, value string")
    c = NaiveBayes("categorical").fit(feats, rows=rows)
    assert c.labels == ["n", "p"]
    with pytest.raises(ValueError):
        NaiveBayes("gaussian")
