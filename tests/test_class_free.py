"""Plans without a column per class, fold or factor; laws; prepared arrays; one-pass parity."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybayes import NaiveBayes
from tallybayes.operators import tabular as T
from tallybayes.operators import validation as V
from tallybayes.operators.metrics import strategy_parity
from tallybayes.operators.model import Law, MultinomialModel, fit_categorical, fit_multinomial
from tallybayes.operators.sampling import hash_fold
from tallybayes.operators.text import prepare_text
from tallybayes.streaming import score_stream, stream_scores
from tests.conftest import SF_SMALL


def _rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.col("lang").alias("label"), "text", hash_fold("doc_id", 3).alias("fold"))


def test_many_classes_of_a_categorical_model(spark):
    n = 2000
    rows = spark.range(n).selectExpr("id", "format_string('c%04d', id) AS label", "concat('own', id) AS a",
                                     "IF(id % 2 = 0, 'even', 'odd') AS b")
    spec = T.TabularSpec(["id"], ["a", "b"])
    m = fit_categorical(T.tabular_features(rows, spec, ["label"], markers=True))
    test = spark.createDataFrame([(1, "own1234", "even"), (2, "new", "odd"), (3, "new", "new"), (4, "own7", "even")],
                                 "id long, a string, b string")
    feats = T.tabular_features(test.withColumn("_row", T.row_hash(spec)), spec, ["_row"], markers=True)
    got = {r["id"]: r["prediction"] for r in m.transform(feats, None, ["id"]).collect()}
    # own7 is odd: its class has the first value, which has 2,000 in its domain, the even ones the second;
    # both score 1/2001 * 2/3 and 2/2001 * 1/3, so the lower index wins
    assert got == {1: "c1234", 2: "c0001", 3: "c0000", 4: "c0000"}


@pytest.mark.parametrize("values", [3, 40])
def test_categorical_strategies_agree_with_plain_scoring(spark, values):
    rows = [(i, "klm"[i * 7 % 3], f"u{i * i % values}", f"v{i % 5}" if i % 6 else None, f"w{i % 2}") for i in range(90)]
    df = spark.createDataFrame(rows, "id long, label string, a string, b string, c string").withColumn("_row", F.xxhash64("a", "b", "c"))
    spec = T.TabularSpec(["id"], ["a", "b", "c"])
    feats = T.tabular_features(df, spec, ["label", "_row"], markers=True)
    train, test = feats.filter("id % 3 > 0"), feats.filter("id % 3 = 0 OR id % 5 = 0")
    m = fit_categorical(train, alpha=0.5)
    fit = [r for r in rows if r[0] % 3]
    n_c, cnt = Counter(r[1] for r in fit), Counter((r[1], i, v) for r in fit for i, v in enumerate(r[2:]) if v)
    size = Counter(i for i, _ in {(i, v) for r in fit for i, v in enumerate(r[2:]) if v})
    seen = {(i, v) for _, i, v in cnt}
    want = []
    for r in rows:
        if r[0] % 3 == 0 or r[0] % 5 == 0:
            score = {c: math.log(n_c[c] / len(fit)) + sum(math.log((cnt[c, i, v] + 0.5) / (n_c[c] + 0.5 * size[i]))
                                                          for i, v in enumerate(r[2:]) if (i, v) in seen) for c in sorted(n_c)}
            best = max(score, key=lambda c: (round(score[c], 7), -ord(c)))
            want.append((r[0], best, round(score[best], 6)))
    for strategy in ("wide", "sparse"):
        got = [(a, b, round(s, 6)) for a, b, s in _rows(m.transform(test, None, ["id"], strategy=strategy), "id", "prediction", "score")]
        assert got == sorted(want, key=repr)


def test_tabular_rows_sharing_an_id_are_scored_alone(spark):
    spec = T.TabularSpec(["id"], ["a"])
    rows = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (None, "x"), (2, None)], "id long, a string")
    m = fit_categorical(T.tabular_features(spark.createDataFrame([(1, "p", "x"), (2, "n", "y")], "id long, label string, a string"),
                                           spec, ["label"], markers=True))
    feats = T.tabular_features(rows.withColumn("_row", T.row_hash(spec)), spec, ["_row"], markers=True)
    for strategy in ("wide", "sparse"):
        assert _rows(m.transform(feats, None, ["id"], strategy=strategy), "id", "prediction") == sorted(
            [(1, "p"), (1, "n"), (1, "n"), (None, "p"), (2, "n")], key=repr)


@pytest.mark.parametrize("broadcast", [None, "1"])
def test_text_cv_strategies_agree_and_keep_a_row_per_term(spark, broadcast, monkeypatch):
    tables = []
    keep = V.materialize
    monkeypatch.setattr(V, "materialize", lambda df, *a: tables.append(keep(df, *a)) or tables[-1])
    if broadcast:
        spark.conf.set("spark.tallybayes.modelBroadcastBytes", broadcast)
    try:
        found = [_rows(V.cross_validate_multinomial(_docs(spark), ["doc_id"], 3, min_df=2, strategy=s),
                       "doc_id", "fold", "label", "prediction", "score") for s in ("wide", "sparse")]
    finally:
        spark.conf.unset("spark.tallybayes.modelBroadcastBytes")
    assert found[0] == found[1] and len(found[0]) == 200
    assert all(t.count() == t.select("term").distinct().count() for t in tables)


def test_categorical_cv_equals_retraining(spark):
    """Outliers in two folds move the bounds; one attribute's extremes lie in one fold, another's in two."""
    rows = [(i, i % 4, "ab"[i * 5 % 7 % 2], f"c{i % 3}" if i % 11 else f"only{i}", float(i * 37 % 101), float(i % 13)) for i in range(200)]
    rows[4] = (4, 0, "a", "c1", -500.0, 3.0)
    rows[9] = (9, 1, "b", None, 900.0, 700.0)
    rows[13] = (13, 1, "b", "c2", 5.0, -50.0)
    schema = "id long, fold int, label string, cat string, x double, y double"
    df = spark.createDataFrame(rows, schema)
    spec = T.TabularSpec(["id"], ["cat", "x", "y"], ["x", "y"])
    want = []
    for h in range(4):
        train, test = df.filter(F.col("fold") != h), df.filter(F.col("fold") == h)
        bounds = T.literal_bounds(T.minmax_values(train, spec))
        binned = [T.discretize(x, spec, bounds) for x in (train, test)]
        m = fit_categorical(T.tabular_features(binned[0], spec, ["label"], markers=True), labels=["a", "b"])
        feats = T.tabular_features(binned[1], spec, ["label"], markers=True)
        want += [(r["id"], h, r["label"], r["prediction"], r["score"]) for r in m.transform(feats, None, ["id"], keep=["label"]).collect()]
    for strategy in ("wide", "sparse"):
        got = V.cross_validate_categorical(df, spec, 4, strategy=strategy)
        assert _rows(got, "id", "fold", "label", "prediction", "score") == sorted(want, key=repr)


def test_held_out_bounds(spark):
    rows = [(0, 1.0), (0, 9.0), (1, 3.0), (1, 4.0), (2, 2.0), (2, 5.0)]
    spec = T.TabularSpec([], ["x"], ["x"])
    b = T.held_out_bounds(spark.createDataFrame(rows, "fold int, x double"), spec)
    cls = {f: b.select(T.bounds_class(F.lit(f)).alias("c"), "lo", "hi").first() for f in range(3)}
    assert {f: (r["lo"][r["c"]], r["hi"][r["c"]]) for f, r in cls.items()} == {0: (2.0, 5.0), 1: (1.0, 9.0), 2: (1.0, 9.0)}


def test_a_law_of_ones_own(spark, tmp_path):
    """A law with even priors and halved counts, against its formulas by hand."""
    def even():
        return Law("even", prior=lambda n_c, n, classes: F.when(n_c > 0, 1.0 / classes),
                   likelihood=lambda count, total, v, a: (count / 2 + a) / (total / 2 + a * v),
                   default=lambda total, v, a: a / (total / 2 + a * v))

    train = spark.createDataFrame([("k", "oak oak elm"), ("k", "fir"), ("k", "fir"), ("l", "elm")], "label string, text string")
    m = NaiveBayes(even, alpha=2.0).fit(train)
    test = spark.createDataFrame([(1, "oak elm elm zzz"), (2, "")], "doc_id int, text string")
    k = math.log(1 / 2) + math.log((2 / 2 + 2) / (5 / 2 + 6)) + 2 * math.log((1 / 2 + 2) / (5 / 2 + 6))
    l = math.log(1 / 2) + math.log(2 / (1 / 2 + 6)) + 2 * math.log((1 / 2 + 2) / (1 / 2 + 6))
    want = {1: ("k" if k > l else "l", round(max(k, l), 6)), 2: ("k", round(math.log(1 / 2), 6))}
    m.save(str(tmp_path / "m"))
    with pytest.raises(ValueError, match="even"):
        MultinomialModel.load(spark, str(tmp_path / "m"))
    for model in (m, MultinomialModel.load(spark, str(tmp_path / "m"), law=even())):
        for strategy in ("wide", "sparse"):
            got = model.transform(test, ["doc_id"], strategy=strategy).collect()
            assert {r["doc_id"]: (r["prediction"], round(r["score"], 6)) for r in got} == want


def test_binary_law_counts_documents(spark):
    docs = _docs(spark)
    m = NaiveBayes("binary").fit(docs.filter("fold > 0"))
    once = docs.withColumn("text", F.array_join(F.array_distinct(F.regexp_extract_all(
        F.lower("text"), F.lit(r"([\p{L}\p{N}_]{2,})"), 1)), " "))
    plain = fit_multinomial(once.filter("fold > 0"))
    assert _rows(m.transform(docs.filter("fold = 0"), ["doc_id"]), "doc_id", "prediction", "score") == \
        _rows(plain.transform(once.filter("fold = 0"), ["doc_id"]), "doc_id", "prediction", "score")


def test_release_drops_the_caches(spark):
    m = fit_multinomial(spark.createDataFrame([("k", "oak elm")], "label string, text string"))
    test = spark.createDataFrame([(1, "oak")], "doc_id int, text string")
    first = m.transform(test, ["doc_id"]).collect()
    assert m.terms.is_cached
    m.release()
    assert not m.terms.is_cached and m.transform(test, ["doc_id"]).collect() == first


def test_prepared_arrays_and_unseen_labels(spark):
    rows = [(1, "k", "oak elm, oak", 0), (2, "l", "fir", 0), (3, "k", "elm new oak", 1), (4, "z", "oak", 1), (4, "z", "fir", 1), (None, "k", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id int, label string, text string, is_test int")
    kept = prepare_text(docs, ["doc_id"], handle_unknown="keep")
    assert sorted(((r["doc_id"] or 0, r["label_idx"], r["words"]) for r in kept.collect()), key=repr) == sorted(
        [(1, 0, [2, 0, 2]), (2, 1, [1]), (3, 0, [0, 2]), (4, None, [2]), (4, None, [1]), (0, 0, [])], key=repr)
    assert prepare_text(docs, ["doc_id"], handle_unknown="skip").count() == 4
    bad = prepare_text(docs, ["doc_id"])
    for act in (lambda: bad.collect(), lambda: bad.count(), lambda: bad.select("doc_id").collect()):
        with pytest.raises(Exception, match="unseen in train: z"):
            act()


def test_training_on_arrays_equals_training_on_text(spark):
    docs = _docs(spark).withColumn("is_test", (F.col("fold") == 0).cast("int"))
    rows = prepare_text(docs, ["doc_id"])
    a = fit_multinomial(rows.filter("is_test = 0"), words_col="words").transform(rows.filter("is_test = 1"), ["doc_id"], words_col="words")
    b = fit_multinomial(docs.filter("is_test = 0")).transform(docs.filter("is_test = 1"), ["doc_id"])
    assert _rows(a, "doc_id", "prediction", "score") == _rows(b, "doc_id", "prediction", "score")


def test_parity_counts_both_ways(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "i int, s string")
    b = spark.createDataFrame([("x", 1), (None, 2), (None, 2), ("z", 4)], "s string, i int").select("i", "s")
    assert tuple(strategy_parity(a, b).first()) == (4, 2, 2)
    assert tuple(strategy_parity(a, a).first()) == (4, 0, 0)
    assert tuple(strategy_parity(a.limit(0), a.limit(0)).first()) == (0, 0, 0)


def test_stream_of_many_classes_equals_batch(spark, tmp_path):
    n = 200
    train = spark.range(n).selectExpr("format_string('c%03d', id) AS label", "concat('own', id, ' shared ', 'p', id % 7) AS text")
    m = fit_multinomial(train)
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('own', id * 3, ' p', id % 5, ' shared zzz') AS text") \
        .union(spark.createDataFrame([(100, None), (101, ""), (101, "own5")], "doc_id long, text string"))
    docs.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))
    score_stream(m, stream, ["doc_id"], str(tmp_path / "out")).awaitTermination()
    assert _rows(stream_scores(m, spark, str(tmp_path / "out"), ["doc_id"]), "doc_id", "prediction", "score") == \
        _rows(m.transform(docs, ["doc_id"]), "doc_id", "prediction", "score")
