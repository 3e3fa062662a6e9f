"""Near-duplicates, components, line dedup and fingerprints against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallybayes.llm import fingerprint, graph, linededup, minhash, textnum

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k, 0) + 1))


def components(edges, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def brute_force(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[:x]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    comp = components(links, ids)
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_documents_like_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(minhash.near_duplicates(docs, k=4, percent=80)) == brute_force(rows, 4, 80)


def test_family_of_random_edits_like_brute_force(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(90)]
    other = [f"v{rng.randrange(500)}" for _ in range(60)]
    rows = []
    for i in range(160):
        words = list(base if i % 4 else base[:45] + other)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(60)}"
        if i % 5 == 0:
            words = words[:rng.randrange(60, len(words))]
        rows.append((i, " ".join(words)))
    want = brute_force(rows, 4, 80)
    assert len({c for _, c, _ in want.values()}) > 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(minhash.near_duplicates(df, k=4, percent=80)) == want


def family(rng, n, n_outliers):
    """Outliers with small ids (similarity about 0.6 to the base), then near copies of the base."""
    base = [f"w{i}" for i in range(200)]

    def edited(at):
        words = list(base)
        for i in at:
            words[i] = f"e{rng.randrange(10 ** 6)}"
        return " ".join(words)

    outliers = [edited(range(rng.randrange(13), 200, 13)) for _ in range(n_outliers)]
    return list(enumerate(outliers + [edited(rng.sample(range(200), rng.randrange(1, 4))) for _ in range(n)]))


@pytest.mark.parametrize("rounds", [0, 1])
def test_pairs_grow_with_rows_where_outliers_have_small_ids(spark, monkeypatch, rounds):
    listed = []
    verify, link = minhash._verify, minhash.link_classes

    def counted(pairs, sets, percent):
        listed.append(pairs.count())
        return verify(pairs, sets, percent)

    monkeypatch.setattr(minhash, "_verify", counted)
    monkeypatch.setattr(minhash, "link_classes", lambda *a: link(*a, hub_rounds=rounds))
    totals = {}
    for n in (60, 240):
        listed.clear()
        rows = family(random.Random(n), n, 20)
        got = found(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=5, percent=80))
        if n == 60:
            assert got == brute_force(rows, 5, 80)
        assert len({c for _, c, _ in got.values()}) == 21
        totals[n] = sum(listed)
    assert totals[240] < 6 * totals[60]


def test_families_in_slots_like_brute_force(spark, monkeypatch):
    """All links through the comparison of families, each of them in several slots."""
    monkeypatch.setattr(minhash, "SLOT_ROWS", 7)
    monkeypatch.setattr(minhash, "DEALS", 4)
    link = minhash.link_classes
    monkeypatch.setattr(minhash, "link_classes", lambda *a: link(*a, hub_rounds=0))
    rng = random.Random(11)
    base = [f"w{rng.randrange(400)}" for _ in range(80)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(words[:rng.randrange(50, 81)])))
    want = brute_force(rows, 4, 80)
    assert len({c for _, c, _ in want.values()}) > 3
    assert found(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4, percent=80)) == want


def test_near_duplicate_edge_cases(spark):
    long = " ".join(f"x{i}" for i in range(3000))
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "One two", "d"), (5, "one  TWO", "e"), (5, "one  TWO", "e"),
            (6, long, "f"), (7, long + " y", "g"), (None, "one two", "h"), (8, "é È", "i"), (9, "É È", "j"), (10, "three", "k"),
            (10, "one two", "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in
                  minhash.near_duplicates(df, k=4).collect()), key=str)
    assert got == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False),
        (6, 2997, 6, True), (7, 2998, 6, False), (None, 1, None, True), (8, 1, 8, True), (9, 1, 9, True),
        (10, 1, 4, False), (10, 1, 4, False)], key=str)
    left = minhash.drop_near_duplicates(df, k=4)
    assert left.columns == ["doc_id", "text", "gone"]
    assert sorted(r["gone"] for r in left.collect()) == ["a", "b", "c", "d", "f", "i", "j", "k"]
    unique = df.filter("doc_id < 10 and doc_id != 5")
    assert sorted(r["gone"] for r in minhash.drop_near_duplicates(unique, k=4).collect()) == ["a", "b", "c", "d", "f", "i", "j"]
    assert minhash.near_duplicates(df.limit(0)).collect() == []


def test_superminhash_ranks_and_estimate():
    rng = np.random.default_rng(1)
    m = 64
    shared, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (300, 100, 100))
    sets = [np.unique(np.r_[shared, a]), np.unique(np.r_[shared, b]), a[:1], np.unique(a[:5])]
    slots = minhash.superminhash(sets, m)
    assert abs((slots[0] == slots[1]).mean() - 0.6) < 0.2
    assert sorted(slots[2] >> np.uint64(48)) == list(range(m))  # one element visits every slot once
    # early stopping changes nothing: the minimum over elements taken one by one
    alone = np.min([minhash.superminhash([np.array([e])], m)[0] for e in sets[3]], axis=0)
    assert (slots[3] == alone).all()


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    import pyarrow as pa
    texts = ["a b  c", "", "B\tA", "c a b", "x" * 50 + " y"]
    want = {}
    for size in (1 << 20, 3):
        monkeypatch.setattr(textnum, "PIECE", size)
        off, data = textnum.text_buffers(pa.array(texts))
        want[size] = [textnum.word_hashes(off, data, i, i + 1)[0].tolist() for i in range(len(texts))]
        h, ends = textnum.word_hashes(off, data, 0, len(texts))
        assert [h[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want[size]
    assert want[3] == want[1 << 20]
    assert want[3][0][0] == want[3][2][1] == want[3][3][1]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_like_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 130)]
    want = components(edges, {x for e in edges for x in e})
    got = {r["node"]: r["comp"] for r in graph.connected_components(
        spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    assert got == {n: c for n, c in want.items() if n != c}


def test_line_dedup_cases(spark):
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    posted = "Posted on the board by {} at noon in the main hall today"
    rows = [(1, f"own line one here\n{long}\nAs."), (2, f"{long}\nanother own line here\nAs."), (3, long), (4, None), (5, ""),
            (6, f"  {long.replace(' ', '  ')}\nkeep these four words"), (None, f"{long}\nand my own words here")]
    rows += [(10 + i, posted.format(n) + f"\nunique words of document {chr(97 + i)} {n}") for i, n in
             enumerate(["anna", "bert", "carl", "7", "42"])]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, n_dropped int, lines string")
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in linededup.drop_recurring_lines(df).collect()}
    assert got[1] == (rows[0][1], 0)
    assert got[2] == ("another own line here\nAs.", 1)
    assert got[3] == ("", 1) and got[4] == (None, 0) and got[5] == ("", 0)
    assert got[6] == ("keep these four words", 1)
    assert got[None] == ("and my own words here", 1)
    assert got[10][1] == 0 and all(got[10 + i][1] == 1 and got[10 + i][0].startswith("unique") for i in range(1, 5))
    kept = linededup.clean_lines(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {3}
    assert linededup.drop_recurring_lines(df.limit(0)).collect() == []


def test_leaf_with_three_templates_and_unrelated_lines(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    head = "sent from the office"
    frames = [" ".join(word() for _ in range(4)) + " {} " + " ".join(word() for _ in range(3)) for _ in range(3)]
    rows = [f"{head} {f.format(word())}" for f in frames for _ in range(6)]
    # one line of the first template has a word that is more frequent in its place than the template
    rows.append(f"{head} {frames[0].format('often')}")
    rows += [f"{head} " + " ".join(word() for _ in range(4)) + " often " + " ".join(word() for _ in range(3)) for _ in range(40)]
    rows += [f"{head} " + " ".join(word() for _ in range(8)) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    gone = {r["doc_id"] for r in linededup.drop_recurring_lines(df).collect() if r["n_dropped"]}
    assert gone == set(range(19)) - {0, 6, 12}


def test_short_and_unspaced_lines_recur(spark):
    own = [f"own {'abcdefghij'[i // 10]} {'abcdefghij'[i % 10]} words of this document" for i in range(40)]
    rows = [(i, f"{'Les.' if i < 39 else 'x'}\n{w} a\nAnd.\n\n{w} b\n{'All rights reserved.' if i < 14 else 'y'}\n"
                f"{w} c\n{'Not quite enough.' if i < 13 else 'z'}\n{w}") for i, w in enumerate(own)]
    passage = "\u8fd9\u662f\u4e00\u4e2a\u6ca1\u6709\u7a7a\u683c\u7684\u6bb5\u843d" * 2
    rows += [(50, f"{passage}\n{passage[:5]}"), (51, f"{passage}\nx\n{passage[:5]}"), (52, passage[:19]), (53, passage[:19])]
    rows += [(100 + i, f"{i}\n{chr(0x4e00 + i) * 9}2020{chr(0x4e50 + i) * 9}") for i in range(45)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.drop_recurring_lines(df).collect()}
    assert got[0] == rows[0][1]
    assert all(got[i] == t for i, t in rows if i >= 100)
    assert got[1] == f"Les.\n{own[1]} a\n\n{own[1]} b\n{own[1]} c\nNot quite enough.\n{own[1]}"
    assert got[39] == f"x\n{own[39]} a\n\n{own[39]} b\ny\n{own[39]} c\nz\n{own[39]}"
    assert (got[50], got[51]) == (rows[40][1], f"x\n{passage[:5]}") and got[53] == passage[:19]


def test_wrapped_passage_in_two_documents(spark):
    word = lambda i: f"w{chr(97 + i % 26)}{chr(97 + i // 26)}"
    passage = [word(i) for i in range(55)]
    wrapped = [" ".join(passage[i:i + 11]) for i in range(0, 55, 11)]
    short = [" ".join(word(100 + i) for i in range(j, j + 6)) for j in (0, 6, 12)]
    tail = [" ".join(word(200 + i) for i in range(a, b)) for a, b in ((0, 19), (19, 21), (21, 25))]
    rows = [(1, "mine alone\n" + "\n".join(wrapped) + "\nend one"), (2, "\n\n".join(wrapped) + "\nother words"),
            (3, "\n".join(short) + "\nthree"), (4, "\n".join(short) + "\nfour"),
            # the same lines, but no two documents share enough of them in a row
            (5, f"{wrapped[0]}\nbetween here\n{wrapped[1]}"), (6, "\n".join(tail)), (7, "seven\n" + "\n".join(tail) + "\nlast"),
            (None, "\n".join(tail) + "\nno id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.drop_recurring_lines(df).collect()}
    assert got[1] == rows[0][1] and got[2] == "\n\n\n\nother words"
    assert (got[3], got[4], got[5], got[6]) == (rows[2][1], rows[3][1], rows[4][1], rows[5][1])
    assert got[7] == "seven\nlast" and got[None] == "no id"


def test_fingerprints_like_plain_text_edits(spark):
    rows = [(3, "a b c d\ne f g h\n\nlast line"), (1, None), (7, "é😀x" * 40), (5, "q"), (5, "other text"), (9, "a b c d\ne f g h\n\nlast line"),
            (9, "a b c d\ne f g h\n\nlast line"), (None, "no id at all here")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_chars int")
    got = fingerprint.edited_fingerprints(df).collect()
    assert len(got) == len(rows)
    key = {r["doc_id"]: r for r in got}
    texts = {i: t or "" for i, t in rows}
    for i, following in ((1, texts[3]), (None, texts[1]), (7, texts[9]), (9, texts[None])):
        t = texts[i]
        q = len(t) // 4
        edited = t[:len(t) - q] + following[:q]
        assert key[i]["n_chars"] == len(t)
        assert key[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= key[i]["near_edited"] <= 1 and 0 <= key[i]["near_next"] <= 1
    assert key[3]["fingerprint"] == key[9]["fingerprint"] != key[7]["fingerprint"]
    assert fingerprint.edited_fingerprints(df.limit(0)).collect() == []
    one = fingerprint.edited_fingerprints(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one["near_next"] == 1


def test_fingerprints_are_homomorphic(spark):
    df = spark.createDataFrame([(1, "one two\nthree"), (2, "three\none two"), (3, "one two"), (4, "three")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(df).collect()}
    assert got[1]["fingerprint"] == got[2]["fingerprint"]
    pair = spark.createDataFrame([(got[3]["lanes"], got[4]["lanes"], got[1]["lanes"])], "a array<int>, b array<int>, c array<int>")
    from pyspark.sql import functions as F
    r = pair.select(fingerprint.combine(F.col("a"), F.col("b")).alias("add"), fingerprint.combine(F.col("c"), F.col("b"), -1).alias("sub")).first()
    assert r["add"] == got[1]["lanes"] and r["sub"] == got[3]["lanes"]
