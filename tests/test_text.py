"""Tokenizer, in-row bags, vocabulary index and vectorization."""

import random
import re

from pyspark.sql import functions as F

from tallybayes.functions.text import bag_rows, tokens
from tallybayes.operators.text import dense_index, label_index, vectorize, vocabulary

PY_TOKEN = re.compile(r"(?u)\b\w\w+\b")


def _toks(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return [r["t"] for r in df.select("id", tokens("text").alias("t")).orderBy("id").collect()]


def test_tokenize_hand_cases(spark):
    got = _toks(spark, ["Rain at 7 o'clock; BRING boots...", None, "", "a b c", "x² a_b __"])
    assert got == [["rain", "at", "clock", "bring", "boots"], [], [], [], ["x²", "a_b", "__"]]


def test_tokenize_matches_python_rule(spark):
    texts = ["Ünïcødé wörds ½ and 2x faster", "日本語のテキスト と 漢字", "naïve café – résumé",
             "tab\tseparated\nlines   here", "ÀÉÎ ÕÜ Ǆ ǅ", "x_y __init__ a1 1a"]
    assert _toks(spark, texts) == [PY_TOKEN.findall(t.lower()) for t in texts]


def test_bag_rows_counts_and_empty(spark):
    df = spark.createDataFrame([(1, "b a b c b"), (2, ""), (3, None), (4, "zz zz")],
                               "id int, text string")
    got = sorted(tuple(r) for r in bag_rows(df, "text", ["id"]).collect())
    assert got == [(4, "zz", 2)]  # single letters are not tokens
    df = spark.createDataFrame([(1, "bb aa bb cc bb"), (2, ""), (3, None), (4, "zz zz")],
                               "id int, text string")
    got = sorted(tuple(r) for r in bag_rows(df, "text", ["id"]).collect())
    assert got == [(1, "aa", 1), (1, "bb", 3), (1, "cc", 1), (4, "zz", 2)]


def test_dense_index_is_code_point_order(spark):
    rnd = random.Random(7)
    alphabet = "abcxyzéüß日本ǅ_01"
    words = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(2, 6)))
                    for _ in range(400)})
    df = spark.createDataFrame([(w,) for w in words], "term string")
    got = {r["term"]: r["idx"] for r in dense_index(df, "term").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


def test_vectorize_drops_oov_keeps_repeats(spark):
    vocab = spark.createDataFrame([("fern", 0), ("moss", 1), ("reed", 2)], "term string, idx bigint")
    docs = spark.createDataFrame([(1, "reed bark fern reed reed moss")], "doc_id int, text string")
    got = [r["idx"] for r in vectorize(docs, vocab, ["doc_id"]).orderBy("pos").collect()]
    assert got == [2, 0, 2, 2, 1]


def test_vocabulary_min_df_and_labels(spark):
    docs = spark.createDataFrame([(1, "aa bb aa", "x"), (2, "aa cc", "y"), (3, "bb bb", "x")],
                                 "doc_id int, text string, label string")
    from tallybayes.operators.text import doc_term_counts
    bags = doc_term_counts(docs, ["doc_id"])
    v1 = {r["term"]: (r["df"], r["idx"]) for r in vocabulary(bags).collect()}
    assert v1 == {"aa": (2, 0), "bb": (2, 1), "cc": (1, 2)}
    v2 = {r["term"]: r["idx"] for r in vocabulary(bags, min_df=2).collect()}
    assert v2 == {"aa": 0, "bb": 1}
    labs = {r["label"]: r["idx"] for r in label_index(docs).collect()}
    assert labs == {"x": 0, "y": 1}
    assert docs.select(F.lit(1)).count() == 3


def test_prepare_text_handle_unknown(spark):
    from tallybayes.operators.text import prepare_text
    docs = spark.createDataFrame(
        [(1, "aa bb", "x", 0), (2, "bb cc", "y", 0), (3, "aa zz", "x", 1), (4, "cc", "new", 1)],
        "doc_id int, text string, label string, is_test int")
    keep = {r["doc_id"]: (r["label_idx"], r["n_words"], r["sum_idx"]) for r in
            prepare_text(docs, ["doc_id"], handle_unknown="keep").collect()}
    assert keep == {1: (0, 2, 1), 2: (1, 2, 3), 3: (0, 1, 0), 4: (None, 1, 2)}
    skip = prepare_text(docs, ["doc_id"], handle_unknown="skip").collect()
    assert sorted(r["doc_id"] for r in skip) == [1, 2, 3]
    import pytest
    with pytest.raises(Exception):
        prepare_text(docs, ["doc_id"], handle_unknown="error").collect()
