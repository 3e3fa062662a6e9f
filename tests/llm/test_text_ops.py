"""Quality, language, packing, decontamination, chat, licences and WARC."""

import base64
import gzip
import hashlib
import os
import math
import random
from collections import Counter
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallybayes.llm import chat, decontam, langid, license, packing, quality, queries, textnum, warc

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_best_fit_decreasing_takes_the_tightest_window():
    rng = random.Random(3)
    lengths = [rng.randrange(1, 65) for _ in range(300)]
    want: list[list[int]] = []
    for i in sorted(range(300), key=lambda i: (-lengths[i], i)):
        rooms = [(64 - sum(lengths[j] for j in w), -k) for k, w in enumerate(want)]
        fit = [r for r in rooms if r[0] >= lengths[i]]
        want[-min(fit)[1]].append(i) if fit else want.append([i])
    got = packing.best_fit_decreasing(lengths, 64)
    fill = lambda ws: sorted(sum(lengths[i] for i in w) for w in ws)
    assert sorted(i for w in got for i in w) == list(range(300))
    assert fill(got) == fill(want)


def test_pack_covers_each_token_once_with_little_padding():
    rng = random.Random(4)
    n = [rng.randrange(1, 700) for _ in range(200)] + [64 * 5, 1, 64]
    seen = [np.zeros(x, int) for x in n]
    padding = 0
    for window in packing.pack(n, 64, 1):
        used = sum(length for _, _, length in window)
        assert 0 < used <= 64
        padding += 0 if used & (used - 1) == 0 else 64 - used
        for d, start, length in window:
            seen[d][start:start + length] += 1
    assert all((s == 1).all() for s in seen)
    assert padding <= 0.01 * sum(n)


def test_packed_documents_round_trip(spark):
    texts = ["", None, "word " * 3000, "a<|endoftext|>b", "日本語 😀", " " * 3000 + "x"] + [f"text {i} " * i for i in range(60)]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, id string").repartition(3)
    rows = packing.pack_documents(df, TOKENIZER).collect()
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for s in {r["sequence_id"] for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r["sequence_id"] == s), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert packing.pack_documents(df.limit(0), TOKENIZER).collect() == []


def test_fast_ids_equal_those_of_tokenizers(spark):
    tokens = packing.Tokens(TOKENIZER)
    assert tokens.fast is not None
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        assert tokens.ids(r["text"]) == tokens.slow.encode(r["text"], add_special_tokens=False).ids
    tokens.fast = None
    assert tokens.ids("plain text") == tokens.slow.encode("plain text", add_special_tokens=False).ids


def slow_tiles(item, doc, least):
    """Greedy string tiling as defined: the longest free common run again and again."""
    a_used, b_used, covered = [False] * len(item), [False] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] \
                        and not a_used[i + n] and not b_used[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        for x in range(n):
            a_used[i + x] = b_used[j + x] = True
        covered += n


@pytest.mark.parametrize("seed", range(6))
def test_tiles_like_the_definition(seed):
    rng = random.Random(seed)
    item = [rng.randrange(30) for _ in range(24)]
    parts = [item[0:8], item[8:14], item[14:24], [rng.randrange(30) for _ in range(9)], item[3:12]]
    rng.shuffle(parts)
    doc = [x for p in parts for x in p]
    seeds = [(i, j) for i in range(len(item) - 2) for j in range(len(doc) - 2) if item[i:i + 3] == doc[j:j + 3]]
    tiles = decontam.tile(np.array(item), np.array(doc), seeds, 3)
    assert sum(t[2] for t in tiles) == slow_tiles(item, doc, 3)


def test_decontamination_query_like_the_definition(spark):
    """Every document against every item of planted tables, tiled by the definition."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    stock = [rng.choice(words) for _ in range(6)]
    items = [[rng.choice(words) for _ in range(rng.randrange(5, 18))] + stock for _ in range(12)] + [stock[:3], stock[:5], stock]
    docs = []
    for i in range(40):
        item = rng.choice(items)
        cut = rng.randrange(1, len(item))
        docs.append([rng.choice(words) for _ in range(rng.randrange(20))] + item[cut:] + stock * (i % 3) + item[:cut])
    text = lambda w: " ".join(w)
    df = spark.createDataFrame([(i, text(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, text(d)) for i, d in enumerate(items)] + [(None, text(items[0]))], "item_id long, text string")
    want = set()
    for i, d in enumerate(docs):
        for j, item in [*enumerate(items), (None, items[0])]:
            covered = slow_tiles(item, d, min(5, len(item)))
            if covered >= 0.5 * len(item):
                want.add((i, j, len(item), covered))
    for block in (2_000_000, 60):
        got = decontam.contaminated(df, bench, block_words=block).collect()
        assert len(got) == len(want)
        assert {(r["doc_id"], r["item_id"], r["item_words"], r["covered_words"]) for r in got} == want


def test_a_phrase_that_many_items_share_lists_no_pairs():
    """Items whose found seeds can't cover half of them are counted, not tiled."""
    rng = np.random.default_rng(1)
    stock = rng.integers(0, 2 ** 63, 5).astype(np.uint64)
    items = [np.r_[stock, rng.integers(0, 2 ** 63, 25).astype(np.uint64)] for _ in range(300)]
    g = [decontam._runs(h, 5) for h in items]
    value = np.concatenate(g)
    order = np.argsort(value, kind="stable")
    grams = {5: (value[order], np.repeat(np.arange(300), [len(x) for x in g])[order],
                 np.concatenate([np.arange(len(x)) for x in g])[order])}
    sizes = np.array([len(h) for h in items])
    doc = np.concatenate([stock, rng.integers(0, 2 ** 63, 9).astype(np.uint64), stock, items[7][3:20]])
    found = dict(decontam._hits(doc, grams, sizes, 0.5))
    assert list(found) == [7]
    assert (0, 0) in found[7] and (0, 14) in found[7] and (3, 19) in found[7]


def test_decontamination_cases(spark):
    rng = random.Random(1)
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    item = [rng.choice(words) for _ in range(40)]
    moved = item[20:] + [rng.choice(words) for _ in range(30)] + item[:20]
    rest = [rng.choice(words) for _ in range(300)]
    docs = [(1, " ".join(rest + item).upper()), (2, ", ".join(moved)), (3, " ".join(rest)), (4, None), (5, ""),
            (6, " ".join(item[:15])), (7, "so short an item"), (None, " ".join(item)), (1, " ".join(item))]
    items = [(10, " ".join(item)), (11, "short an"), (12, None), (13, "")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, tiles string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (2_000_000, 3):
        got = decontam.contaminated(df, bench, block_words=block).collect()
        assert sorted(((r["doc_id"], r["item_id"], r["covered_words"], r["item_words"]) for r in got), key=str) == sorted(
            [(1, 10, 40, 40), (1, 10, 40, 40), (2, 10, 40, 40), (None, 10, 40, 40), (7, 11, 2, 2)], key=str)
    left = decontam.drop_contaminated(df, bench)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["3", "4", "5", "6"]
    shared = spark.createDataFrame([(3, " ".join(item)), (3, " ".join(rest)), (None, " ".join(rest)), (None, None)],
                                   "doc_id long, text string")
    left = decontam.drop_contaminated(shared, bench).collect()
    assert sorted(((r["doc_id"], r["text"] is None) for r in left), key=str) == [(3, False), (None, False), (None, True)]
    assert decontam.contaminated(df, bench.limit(0)).collect() == []
    assert decontam.contaminated(df.limit(0), bench).collect() == []


def test_language_of_held_out_documents(spark):
    rows = queries.op4_langid(spark, SF2).join(spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_cases(spark):
    docs = [(i, "the cat and the dog", "en", None) for i in range(30)] + [(100 + i, "der hund und die katze", "de", None) for i in range(30)]
    odd = [(200, None, "en", None), (201, "", None, None), (202, "123 !?", "de", None), (203, "und der", None, None),
           (204, "the dog " * 20_000, None, None), (None, "the", "en", None), (203, "und der", None, None)]
    df = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string, score double")
    got = {}
    for r in langid.identify(df, F.col("doc_id") < 200).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["accepted"]))
    assert [got[i][0][0] for i in (200, 201, 202)] == ["und"] * 3
    assert [p for p, _ in got[203]] == ["de", "de"] and got[204][0][0] == "en" and got[None][0][0] == "en"
    none = langid.identify(df, F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"], r["accepted"]) for r in none} == {("und", 0.0, False)}
    assert langid.identify(df.limit(0), F.lit(True)).collect() == []


def test_quality_keeps_clean_and_drops_toxic(spark):
    docs, labels = (spark.read.parquet(f"{SF2}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.importance_resample(docs, labels).join(labels, "doc_id").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    poor = [r["kept"] for r in rows if r["quality"] == 0]
    toxic = [r["kept"] for r in rows if r["toxic"] == 1]
    assert sum(clean) >= 0.98 * len(clean) and sum(poor) <= 0.05 * len(poor) and sum(toxic) <= 0.4 * len(toxic)


def test_quality_of_junk_that_no_label_shows(spark):
    """Words said again and again go; random words weigh less than most clean documents, but with so few labels
    that isn't under the threshold (see the README)."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("qxzjkvwy0123") for _ in range(rng.randrange(3, 9)))
    odd = [(10_000_000 + i, " ".join(word() for _ in range(rng.randrange(20, 200)))) for i in range(50)]
    again = [(20_000_000 + i, " ".join(rng.choice(["zorp", "klim", "BUYNOW!!", "vextra"]) for _ in range(rng.randrange(20, 200)))) for i in range(50)]
    docs = spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame(odd + again, "doc_id long, text string"))
    rows = {r["doc_id"]: r for r in quality.importance_resample(docs, spark.read.parquet(f"{SF2}/labels.parquet")).collect()}
    assert not any(rows[i]["kept"] for i, _ in again)
    clean = sorted(r["weight"] for i, r in rows.items() if i < 10_000_000 and r["kept"])
    assert all(rows[i]["weight"] < clean[len(clean) // 2] for i, _ in odd)


def test_quality_query_matches_plain_version(spark):
    """Weights, threshold and draw from plain counts of the same hashed n-grams."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    batch = quality.pa.RecordBatch.from_arrays([quality.pa.array(c) for c in zip(*texts)], ["id", "text"])
    grams = {}
    for lo, _, bucket, row in quality._ngrams(batch, 1):
        for b, r in zip(bucket.tolist(), row.tolist()):
            grams.setdefault(texts[lo + r][0], Counter())[b] += 1
    told = {}
    for r in labels.collect():
        told[r["doc_id"]] = int(r["quality"] == 1 and r["toxic"] == 0)
    by_text = {}
    for i, t in texts:
        if i in told:
            by_text.setdefault(t, []).append(i)
    told = {min(ids): told[min(ids)] for ids in by_text.values()}
    raw, target, good, bad = Counter(), Counter(), Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in told:
            (good if told[i] else bad).update(set(g))
            if told[i]:
                target.update(g)
    n_raw, n_target, n_good = sum(raw.values()), sum(target.values()), sum(told.values())
    n_bad, weight = len(told) - sum(told.values()), {}
    for i, t in texts:
        g = grams.get(i, Counter())
        own, total = (g, n_target - sum(g.values())) if told.get(i) else (Counter(), n_target)
        w = 0.0
        for b, c in g.items():
            have = good[b] + bad[b]
            chi = (n_good + n_bad) * (bad[b] * (n_good - good[b]) - good[b] * (n_bad - bad[b])) ** 2 / max(
                have * (n_good + n_bad - have) * n_good * n_bad, 1)
            mark = chi >= 25 and bad[b] * n_good > good[b] * n_bad and target[b] < raw[b] / n_raw * n_target
            x, e = target[b] - own[b], raw[b] / n_raw * total
            w += c * (math.log((x + 4) / (e + 4)) + (20 * math.log((x + 1) / (e + 1)) if mark else 0))
        weight[i] = w / math.sqrt(max(sum(g.values()), 1))
    rows = {r["doc_id"]: r for r in quality.importance_resample(docs, labels).collect()}
    assert rows.keys() == weight.keys()
    for i, r in rows.items():
        assert r["n_grams"] == sum(grams.get(i, {}).values()) and math.isclose(r["weight"], weight[i], rel_tol=1e-9, abs_tol=1e-9)
    classes = [sorted(weight[i] for i, g in told.items() if g == c) for c in (1, 0)]
    cut = quality._threshold(*map(quality.np.array, classes))
    k = sum(w >= cut for w in weight.values())
    best = sorted((r["gumbel_key"] for r in rows.values()), reverse=True)[k - 1]
    assert all(r["kept"] == (r["gumbel_key"] >= best) for r in rows.values())
    noise = sorted(r["gumbel_key"] - r["weight"] for r in rows.values())
    assert abs(noise[len(noise) // 2] - 0.3665) < 0.3  # the median of a Gumbel variable


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, "good words", 0.5), (2, None, 0.5), (3, "", 0.5), (None, "bad", 0.5), (1, "good words", 0.5)],
                                 "doc_id long, text string, weight double")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for told in (labels.limit(0), labels.filter("doc_id = 1"), labels.filter("doc_id = 2")):
        rows = quality.importance_resample(docs, told).collect()
        assert len(rows) == 5 and all(r["kept"] for r in rows)
    # with labels of both kinds, however few, rows are told apart; copies of one id alike
    rows = quality.importance_resample(docs, labels).collect()
    assert len(rows) == 5 and all(r["weight"] == 0 for r in rows if r["doc_id"] in (2, 3))
    assert len({(r["weight"], r["gumbel_key"], r["kept"]) for r in rows if r["doc_id"] == 1}) == 1
    assert quality.importance_resample(docs.limit(0), labels).collect() == []
    assert quality.keep_quality(docs, labels).columns == docs.columns


def test_quality_judges_rows_with_ids_of_any_type(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    want = {str(r["doc_id"]): r["weight"] for r in quality.importance_resample(docs, labels).collect()}
    named = docs.withColumn("doc_id", quality.F.col("doc_id").cast("string"))
    got = {r["doc_id"]: r["weight"] for r in quality.importance_resample(named, labels).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9, abs_tol=1e-9) for i in want)
    # a clean row that shares its id with rejected ones stays, and so do clean ones without an id
    rows = {r["doc_id"]: r["kept"] for r in quality.importance_resample(docs, labels).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = max((i for i in rows if rows[i] and texts[i]), key=lambda i: want[str(i)])
    bad = min((i for i in rows if not rows[i] and texts[i]), key=lambda i: want[str(i)])
    more = spark.createDataFrame([(10 ** 8, texts[clean]), (10 ** 8, texts[bad]), (None, texts[clean]), (None, texts[bad])],
                                 "doc_id long, text string")
    left = quality.keep_quality(docs.select("doc_id", "text").union(more), labels).collect()
    assert {(r["doc_id"], r["text"]) for r in left if r["doc_id"] in (None, 10 ** 8)} == {
        (10 ** 8, texts[clean]), (None, texts[clean])}


def test_kth_largest_key(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(-4000, 900), 0.5]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 17, 1500, 3000):
        assert quality._kth_largest(df, k, bins=16) == sorted(values, reverse=True)[k - 1]


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "a </s> \\ <\\/s> [INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (2, 0, "tool[/ROLE]", "[/ROLE]x\n"),
            (2, 1, None, None), (2, 2, "user", ""), (3, 0, "system", "s"), (3, 1, "user", "é😀"), (3, 2, "assistant", None),
            (None, 0, "user", "z"), (4, 1, "assistant", "b"), (4, 0, "assistant", "a"), (5, None, "user", "first"), (5, 0, "assistant", "x"),
            (5, 0, "assistant", "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id int, turn int, role string, text string, formatted int")
    chats = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chats.select("*", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [tuple(t) for t in r["turns"]] for c, r in got.items()} == want
    assert {c: (r["valid"], r["bad_turn"]) for c, r in got.items()} == {
        1: (True, None), 2: (False, 0), 3: (True, None), None: (False, 1), 4: (False, 0), 5: (False, 2)}
    for c, r in got.items():
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    said = {r["conv_id"]: r for r in chat.conversation_digests(chats).collect()}
    assert said[1]["loss_sha256"] == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest() and said[1]["loss_chars"] == 21
    assert said[4]["loss_sha256"] == hashlib.sha256(b"ab").hexdigest()
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_license_texts_and_notices(spark):
    mit = license.KNOWN["MIT"][0].replace("\n\nPermission", "\n\nCopyright (c) 2020 Some One\n\nPermission", 1)
    rows = [(1, mit.upper().replace("\n", "\n * ")), (2, mit + " More."), (3, None), (4, ""), (5, "Copyright 2001 A\nAll rights reserved."),
            (6, "text\n  Licenced under the Apache Licence, Version 2.0.\nReleased under the MIT License\nreleased under the MIT licence!"),
            (None, license.KNOWN["ISC"][1]), (1, "x")]
    df = spark.createDataFrame([(*r, "d") for r in rows], "doc_id long, text string, digest string")
    got = sorted(((r["doc_id"], r["license_id"], r["n_notices"], r["notices"]) for r in license.scan(df).collect()), key=str)
    assert got == sorted([(1, "MIT", 0, ""), (2, None, 0, ""), (3, None, 0, ""), (4, None, 0, ""), (5, None, 0, ""),
                          (6, None, 3, "Apache-2.0,MIT"), (None, "ISC", 0, ""), (1, None, 0, "")], key=str)
    assert license.scan(df.limit(0)).collect() == []


def test_license_ids_and_further_texts(spark):
    named = {"Apache-2.0": "Apache-2.0", "BSD-3-Clause": "BSD-3-Clause", "BSD-2-Clause": "BSD-2-Clause", "ISC": "ISC", "0BSD": "0BSD",
             "GPL-3.0-only": "GPL-3.0", "GPL-3.0-or-later": "GPL-3.0", "GPL-2.0+": "GPL-2.0", "LGPL-2.1-only": "LGPL-2.1", "CC0-1.0": "CC0-1.0"}
    rows = [(i, f"// SPDX-License-Identifier: {n}") for i, n in enumerate(named)] + [
        (50, "Licensed under Apache 2.0"), (51, "My Terms.\nCopyright (c) 2020 A\nAll may read."), (52, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in license.scan(df).collect()}
    assert [got[i]["notices"] for i in range(len(named))] == list(named.values()) and got[50]["notices"] == "Apache-2.0"
    texts = spark.createDataFrame([("Mine", "My terms\nAll may read"), ("Yours", "my terms all may read"), ("Empty", "")], "license_id string, text string")
    more = {r["doc_id"]: r["license_id"] for r in license.scan(df, texts=texts).collect()}
    assert got[51]["license_id"] is None and more[51] == "Mine" and more[52] is None and len(more) == len(rows)


def test_license_texts_known_by_digest(spark):
    root = "/usr/share/common-licenses"
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
             "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all(os.path.exists(f"{root}/{f}") for f in files):
        pytest.skip("no licence texts on this machine")
    rows = [(f, Path(root, f).read_text(encoding="utf8")) for f in files]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert {r["doc_id"]: r["license_id"] for r in license.scan(df).collect()} == files


def test_warc_archives_and_index(spark):
    big = "".join(map(chr, np.random.default_rng(1).integers(40, 2000, 200_000)))
    rows = [(5, "http://a/\r\nX: y", "<p>é</p>"), (3, None, "<p>é</p>"), (9, "u", None), (10, "u", ""), (None, "u", "<p>é</p>"), (7, "u", big),
            (8, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (8, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    target = warc.archive_pages(pages)
    got = warc.read_records(spark, target).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    for i, _, html in rows:
        body = (html or "").encode()
        assert (by_id[i]["bytes"], by_id[i]["digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
    assert {i: (r["kind"], r["refers_to"]) for i, r in by_id.items()} == {
        5: ("revisit", 3), 3: ("response", None), None: ("revisit", 3), 9: ("response", None), 10: ("revisit", 9),
        7: ("response", None), 8: ("response", None)}
    assert bytes(by_id[7]["payload"]).decode() == big
    # the files are plain multi-member gzip, and the index points at each member
    files = {r["part"]: bytes(r["content"]) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(target)
             .filter("path like '%kind=warc%part-%'").select(F.regexp_extract("path", r"/(part-\d+)", 1).alias("part"), "content").collect()}
    whole = b"".join(gzip.decompress(f) for f in files.values())
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)
    index = warc.read_index(spark, target).collect()
    assert len(index) == len(rows)
    for r in index:
        record = gzip.decompress(files[r["part"]][r["offset"]:r["offset"] + r["length"]])
        assert record.startswith(b"WARC/1.1\r\n") and r["record_id"].encode() in record and record.endswith(b"\r\n\r\n")
    empty = warc.archive_pages(pages.limit(0))
    assert warc.read_records(spark, empty).collect() == [] and warc.read_index(spark, empty).collect() == []


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["kind"], r["refers_to"]) for r in warc.with_roles(pages, least=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_prefix_hashes():
    import pyarrow as pa
    off, data = textnum.text_buffers(pa.array(["abcdefgh abcdefxy abcdeX"]))
    h, _ = textnum.word_hashes(off, data, 0, 1, textnum.WORD_PUNCT, 6)
    assert h[0] == h[1] != h[2]
