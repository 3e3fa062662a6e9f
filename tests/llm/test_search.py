"""Ranked lexical search against plain scoring of every document (and, in test_queries, against DuckDB)."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybayes.llm import search

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def terms(text):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", fold)


def plain(docs, items, k):
    found = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in found]
    n_all, l_all = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for (i, c), n in zip(found, sizes):
            m = 75 + 25 * n * n_all // max(l_all, 1)
            s = sum(math.floor(1000 * math.log((2.0 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text))
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def random_docs(rng, n):
    words = ["the", "The", "of", "a1", "É", "é", "日本", "x", "zebra", "b2b", "q"] + [f"w{i}" for i in range(40)]
    shape = [1 / (i + 1) for i in range(len(words))]
    glue = [" ", "\n", ", ", "-", "_", "' "]
    texts = ["".join(w + rng.choice(glue) for w in rng.choices(words, shape, k=rng.choice([0, 1, 5, 30, 200]))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[3]) for i in range(40)] + [(None, texts[3]), (7, texts[5]), (2000, None)]


@pytest.mark.parametrize("seed", range(2))
def test_matches_plain_scoring(spark, seed, monkeypatch):
    monkeypatch.setattr(search, "FIRST_BATCH", 2)
    rng = random.Random(seed)
    docs = random_docs(rng, 120)
    rng.shuffle(docs)
    items = [(i, t) for i, t in random_docs(rng, 12)[:12]] + [(1, "zebra zebra the"), (1, "zebra zebra the"), (2, "nowhere"), (3, None), (None, "日本 x")]
    args = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    index = search.build_index(args[0], shard_bytes=2000)
    assert index.select("shard").distinct().count() > 3
    want = plain(docs, items, 20)
    for blocks in (200_000, 20):
        found = search.ranked_search(*args, index=index, block_terms=blocks).collect()
        assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found), key=repr) == want


def test_posting_lists_bound_and_split():
    rng = np.random.default_rng(4)
    lists = [np.sort(rng.choice(500, size=n, replace=False)) for n in (1, 3, 80, 500)]
    starts = np.r_[0, np.cumsum([len(x) for x in lists])]
    index = search.PostingLists(starts, np.concatenate(lists), rng.integers(1, 9, int(starts[-1])), 500)
    for _ in range(50):
        i = rng.integers(4)
        lo, hi = np.sort(rng.integers(0, len(lists[i]) + 1, 2)) + starts[i]
        at = index.greatest(np.array([[lo]]), np.array([[hi]]))[0, 0]
        assert at == -1 if lo == hi else index.impacts[at] == index.impacts[lo:hi].max() and lo <= at < hi
    weights = np.array([5, 3, 2, 1])
    scores = np.zeros(500, int)
    for x, a, b, w in zip(lists, starts, starts[1:], weights):
        scores[x] += w * index.impacts[a:b]
    order = np.lexsort((np.arange(500), -scores))[:20]
    docs, found = index.search(np.arange(4), weights, 20)
    assert docs.tolist() == order.tolist() and found.tolist() == scores[order].tolist()


def test_defined_cases(spark):
    docs = spark.createDataFrame([(2, "a b"), (1, "a b"), (None, "a b"), (5, "c d e")], DOCS).withColumn("score", F.lit("x")).withColumn("q", F.lit(0))
    items = spark.createDataFrame([(1, "a"), (2, "")], ITEMS).withColumn("rank", F.lit(0))
    found = search.ranked_search(docs, items).orderBy("rank").collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in found] == [(1, 1, 1), (1, 2, 2), (1, 3, None)]
    assert search.ranked_search(docs.limit(0), items).collect() == []
    assert search.ranked_search(docs, items.limit(0)).collect() == []
    assert len(search.ranked_search(docs, items, k=2).collect()) == 2
