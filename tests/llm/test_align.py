"""Cross-tokenizer alignment against a plain version over whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallybayes.llm import align, queries
from tallybayes.llm.storage import documents

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", *align.MEASURES, "groups_sha256"]


def plain_groups(text, a, b):
    """Groups and links of one text, token by token, or None."""
    if not text:
        return None
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    stand_in = byte_of()
    a_bytes = [bytes(stand_in[c] for c in a.id_to_token(i)) for i in a_ids]
    pieces = [b.id_to_piece(i) for i in b_ids]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in zip(b_ids, pieces)]
    want = (" " + text).encode()
    if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return None

    def spans(parts):
        at, out = 0, []
        for x in parts:
            out.append((at, at + len(x)))
            at += len(x)
        return out

    sa, sb = spans(a_bytes), spans(b_bytes)
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    groups = [([i for i, (_, e) in zip(a_ids, sa) if lo < e <= hi], [i for i, (_, e) in zip(b_ids, sb) if lo < e <= hi])
              for lo, hi in zip([0, *cuts], cuts)]
    links = [(i, j) for i, (s, e) in zip(a_ids, sa) for j, (t, u) in zip(b_ids, sb) if s < u and t < e]
    return a_ids, b_ids, groups, links


def byte_of():
    """Byte of each stand-in of a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}


def plain(rows):
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    found = {t: plain_groups(t, a, b) for _, t in rows}
    count = Counter(p for _, t in rows if found[t] for p in set(found[t][3]))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(n, best.get(i, 0))
    out = []
    for doc, t in rows:
        if not found[t]:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        x, y, groups, links = found[t]
        written = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((doc, len(x), len(y), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(written.encode()).hexdigest()))
    return sorted(out, key=repr)


def collected(df):
    return sorted(((*(r[c] for c in COLUMNS),) for r in df.collect()), key=repr)


def test_query_matches_plain_version(spark, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).filter("n_chars < 1500").collect()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = plain(rows)
    assert collected(align.align(df, A, B)) == want
    assert collected(align.align(df, A, B, chunk=300)) == want  # many chunks


def test_query_takes_the_whole_table(spark):
    found = queries.op11_align(spark, SF)
    assert found.columns == COLUMNS
    docs = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect()}
    rows = found.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    model = SentencePieceProcessor(model_file=B)
    assert all(r["n_b"] == len(model.encode(docs[r["doc_id"]])) for r in rows)


@pytest.mark.parametrize("seed", range(2))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    parts = ["the ", "The", " ", "  ", "\n", "\t", "日本", "é", "e\u0301", "<|endoftext|>", "</s>", "<0x41>", "\u2581", "\x00", "a", "zz9", "🙂", "\u200d", "ing"]
    texts = ["".join(rng.choices(parts, k=rng.choice([1, 2, 5, 60]))) for _ in range(60)]
    rows = [*enumerate(texts), (100, texts[0]), (100, texts[0]), (None, texts[1]), (101, None), (102, ""), (103, "a\u2581b")]
    rows += [(200 + i, "hot copies") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_a", F.lit("x")).withColumn("key", F.lit(1))
    assert collected(align.align(df, A, B)) == plain(rows)


def test_groups_give_the_text_back(spark):
    rows = [(1, "Reading aloud <|endoftext|> é日本"), (2, None), (3, "")]
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    got = {r["doc_id"]: r["groups"] for r in align.aligned_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), A, B).collect()}
    assert got[2] == got[3] == []
    assert b.decode([j for g in got[1] for j in g["b"]]) == rows[0][1]
    assert a.decode([i for g in got[1] for i in g["a"]], skip_special_tokens=False) == " " + rows[0][1]


def test_empty_table(spark):
    assert align.align(spark.createDataFrame([], "doc_id bigint, text string"), A, B).collect() == []
