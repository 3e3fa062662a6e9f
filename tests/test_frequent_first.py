"""Tokens counted as they come; frequent keys broadcast before the shuffle join of the others."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybayes.operators import scoring
from tallybayes.operators import validation as V
from tallybayes.operators.model import class_term_counts, fit_multinomial

LIMIT = "spark.tallybayes.modelBroadcastBytes"


def _texts():
    """Frequent words in all texts, rare ones in a few, some in one fold or text only, and odd rows."""
    rows = [(i, "abc"[i % 3], f"the of the w{i % 9} u{i} Pair{i // 2} {'abc'[i % 3] * 4} fold{i % 4}only x", i % 4) for i in range(80)]
    return rows + [(90, "a", None, 0), (91, "b", "", 1), (None, "c", "the w1 new", 2), (None, "c", "of w2", 2),
                   (92, "a", "the w3 w3 of", 3), (92, "a", "the w3 w3 of", 3), (92, "b", "u5 u6", 3)]


def _docs(spark):
    return spark.createDataFrame(_texts(), "doc_id long, label string, text string, fold int").repartition(3)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def limit(spark):
    yield lambda n: spark.conf.set(LIMIT, str(n))
    spark.conf.unset(LIMIT)


def test_frequent_keys_fit_the_limit(spark):
    t = spark.createDataFrame([("a", 9), ("b", 8), ("c", 3), ("d", 2), ("e", 1), ("f", 1)], "term string, df long")
    assert [scoring.frequent_keys(t, "df", 6, 600, n) for n in (600, 450, 250, 199, 0)] == [1, 2, 8, None, None]


@pytest.mark.parametrize("broadcast", [1, 3000, 8000, 1 << 20])
def test_cross_validation_by_tokens_equals_the_sparse_plan(spark, limit, broadcast):
    want = _rows(V.cross_validate_multinomial(_docs(spark), ["doc_id"], 4, strategy="sparse"))
    limit(broadcast)
    got = V.cross_validate_multinomial(_docs(spark), ["doc_id"], 4)
    assert ("_frequent" in _plan(got)) == (1 < broadcast < 1 << 20)
    assert ("sort_array(coalesce(regexp" in _plan(got)) == (broadcast == 1)
    assert _rows(got) == want and len(want) == len(_texts())


@pytest.mark.parametrize("broadcast", [1, 2000, 8000, 1 << 20])
def test_wide_scoring_equals_the_sparse_plan(spark, limit, broadcast):
    m = fit_multinomial(_docs(spark).filter("fold > 0"))
    want = _rows(m.transform(_docs(spark), ["doc_id"], keep=["label"], strategy="sparse"))
    limit(broadcast)
    got = m.transform(_docs(spark), ["doc_id"], keep=["label"])
    assert ("_frequent" in _plan(got)) == (1 < broadcast < 1 << 20)
    assert _rows(got) == want and len(want) == len(_texts())


def test_training_counts_without_sorted_bags(spark):
    cnt, df_c = Counter(), Counter()
    for _, label, text, _ in _texts():
        words = re.findall(r"\w{2,}", (text or "").lower())
        cnt.update((label, w) for w in words)
        df_c.update((label, w) for w in set(words))
    got = class_term_counts(_docs(spark))
    assert {(r["label"], r["term"]): (r["cnt"], r["df_c"]) for r in got.collect()} == {x: (cnt[x], df_c[x]) for x in cnt}
    assert "sort_array" not in _plan(got)
