"""Quality rules against a plain version, and their defined cases."""

import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from tallybayes.llm import queries, rules
from tallybayes.llm.storage import documents

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    inside = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    base = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    raw = text.encode()
    press = zstandard.ZstdCompressor(level=3, write_content_size=False)

    def bad(part):
        low, high = [b[1:] for b in rules.BANDS if b[0] <= len(part)][-1]
        return not low <= len(press.compress(part)) / len(part) <= high

    parts = [raw[i:i + 4096] for i in range(0, len(raw) - len(raw) % 4096, 4096)]
    if parts:
        parts[-1] = raw[4096 * (len(parts) - 1):]
    fine = bool(raw) and not bad(raw) and (len(parts) < 2 or sum(map(bad, parts)) <= 0.25 * len(parts))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), base, not base and fine)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_query_matches_plain_version(spark):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect()}
    found = queries.op13_rules(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r[c] for c in COLUMNS) == plain(texts[r["doc_id"]]), r["doc_id"]


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    alphabet = ["a", "A", "bc", "é", "日本", "#", "$%", "<|>", " ", " ", "\n", "\t", "\x0b", "\xa0", " "]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.choice([0, 1, 3, 40, 400, 9000])))) for i in range(60)]
    found = rules.text_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found} == {i: plain(t) for i, t in rows}


def test_a_text_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(rules.textnum, "PIECE", 64)
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abc", k=rng.choice([1, 2, 90]))) for _ in range(300))
    offsets, data = rules.textnum.text_buffers(rules.pa.array([text]))
    assert [int(x[0]) for x in rules.word_counts(offsets, data, 0, 1)] == [plain(text)[i] for i in (0, 1, 2, 4)]


def test_bands_tell_repetition_and_noise_from_language(spark):
    rng = random.Random(1)
    clean = documents(spark, SF).filter("doc_id = 3").first()["text"]
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(6)) for _ in range(200))
    texts = sorted({r["text"] for r in documents(spark, SF).filter("n_chars between 2000 and 4000 and lang = 'en'").collect()})
    long = "\n".join(texts)[:16_000]
    stretch = long + " and again" * 800
    assert not rules.outside(rules.compression(stretch.encode(), zstandard.compress)[0], len(stretch))
    rows = [(1, clean), (2, noise), (3, stretch), (4, "again and " * 200), (5, None), (6, ""), (7, " \n\n "), (8, long)]
    kept = {r["doc_id"]: r["kept"] for r in rules.text_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: False, 8: True}


def test_defined_cases(spark):
    rows = spark.createDataFrame([(None, "x"), (1, "y"), (1, "y")], SCHEMA).withColumn("kept", F.lit("own")).withColumn("id", F.lit(0))
    found = rules.text_rules(rows)
    assert found.columns[0] == "doc_id" and sorted((r["doc_id"] or 0, r["n_words"]) for r in found.collect()) == [(0, 1), (1, 1), (1, 1)]
    assert rules.text_rules(rows.limit(0)).collect() == []
