"""Ranks over sampled ranges, CSV files read in splits, dataset specs."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tallybayes.operators.datasets import DatasetSpec
from tallybayes.operators.ranking import range_rank
from tallybayes.operators.sampling import ordered_split
from tallybayes.operators.tabular import feature_vocabulary
from tallybayes.operators.text import dense_index
from tallybayes.sources.files import csv_records, read_attribute_csv, read_labeled_csv


def _largest_share(df, path):
    placed = df.sparkSession.read.parquet(path)
    counts = [r["count"] for r in placed.groupBy("_part").count().collect()]
    return max(counts) / sum(counts)


@pytest.fixture
def written(monkeypatch, tmp_path):
    """Where ``range_rank`` writes its ranges."""
    path = str(tmp_path / "ranges")
    monkeypatch.setattr("tallybayes.operators.ranking.scratch_dir", lambda spark, name: path)
    return path


def test_skewed_prefix_in_like_ranges(spark, written):
    words = [f"zz{i:05d}" for i in range(4000)] + ["a", "é", "日本", None]
    random.Random(1).shuffle(words)
    df = spark.createDataFrame([(w,) for w in words], "term string").repartition(6)
    got = {r["term"]: r["idx"] for r in dense_index(df, "term").collect()}
    want = sorted((w for w in words if w), key=lambda w: w.encode())
    assert got == {None: 0} | {w: i + 1 for i, w in enumerate(want)}
    assert _largest_share(df, written) < 0.25  # of 8 ranges


def test_id_like_attribute_in_like_ranges(spark, written):
    rows = [(0, f"id{i % 1500:04d}") for i in range(3000)] + [(1, "x"), (2, "y")]
    feats = spark.createDataFrame(rows, "attr long, value string").repartition(5)
    got = [(r["attr"], r["value"], r["cnt"], r["idx"]) for r in feature_vocabulary(feats).orderBy("idx").collect()]
    assert got == [(0, f"id{i:04d}", 2, i) for i in range(1500)] + [(1, "x", 1, 1500), (2, "y", 1, 1501)]
    assert _largest_share(feats, written) < 0.25


def test_outlier_and_equal_keys_in_like_ranges(spark, written):
    keys = [2**62] + [7] * 900 + list(range(900)) + [None] * 3
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k long").repartition(4)
    split = {r["id"]: r["is_test"] for r in ordered_split(df, "k", 1000, tiebreak=["id"]).collect()}
    order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] or 0, i))
    assert split == {i: int(at >= 1000) for at, i in enumerate(order)}
    assert _largest_share(df, written) < 0.25


def test_identical_rows_and_groups(spark, written):
    rows = [("g", 1)] * 500 + [("h", 2), ("h", 1), (None, 5), (None, 4)]
    ranked = range_rank(spark.createDataFrame(rows, "g string, k int"), ["k"], group=["g"]).collect()
    assert sorted(r["rank"] for r in ranked if r["g"] == "g") == list(range(1, 501))
    assert {(r["g"], r["k"]): r["rank"] for r in ranked if r["g"] != "g"} == {("h", 1): 1, ("h", 2): 2, (None, 4): 1, (None, 5): 2}
    assert _largest_share(spark.range(0), written) < 0.25


def test_ranks_of_an_empty_table(spark):
    assert range_rank(spark.createDataFrame([], "k int"), ["k"]).collect() == []


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_one_large_csv_is_read_by_several_tasks(spark, tmp_path, newline):
    rng = random.Random(3)
    pieces = ["word", " ", ",", '"', "\n", "\r\n", "\n\n", "é", "日本", '""', "'", "\t", "label,text"]
    rows = [(rng.choice(["ham", "spam", 'a "b", c', ""]), "".join(rng.choices(pieces, k=rng.choice([0, 1, 5, 60, 600])))) for _ in range(800)]
    rows = [r for r in rows if r != ("", "")]
    path = tmp_path / "one.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=newline)
        w.writerow(["label", "text"])
        w.writerows(rows)
        f.write(newline)  # a blank line
    with open(path, newline="", encoding="utf-8") as f:
        want = [(r["label"], r["text"]) for r in csv.DictReader(f)]
    assert want == rows
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // 7))
    try:
        df = read_labeled_csv(spark, str(path))
        splits = spark.read.option("lineSep", "\n").text(str(path)).select(F.col("_metadata")["file_block_start"]).distinct().count()
        assert splits >= 6
        assert sorted(map(tuple, df.collect())) == sorted(want)
        numbers = [r["rec"] for r in csv_records(spark, str(path)).collect()]
        assert sorted(numbers) == list(range(1, len(numbers) + 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_ragged_lines_fail_whichever_columns_are_read(spark, tmp_path):
    path = tmp_path / "bad.data"
    path.write_text("a,b,c\na,b\n", encoding="utf-8")
    df = read_attribute_csv(spark, str(path))
    for act in (df.count, df.collect, df.select("label").collect):
        with pytest.raises(Exception, match="expected 3 fields, got 2"):
            act()


def test_dataset_specs(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), str(rng.randrange(50)), rng.choice("xyz")) for _ in range(300)]
    (tmp_path / "first.data").write_text("".join(f"{l}, {n} ,{c}\n" for l, n, c in rows) + "skipped, 1, x\n", encoding="utf-8")
    (tmp_path / "last.data").write_text("".join(f"{c},{n},{l}\n" for l, n, c in rows), encoding="utf-8")
    first = DatasetSpec("first", "first", continuous=(0,), classes=("a", "b"), n_bins=3)
    last = DatasetSpec("last")
    read = first.read(spark, str(tmp_path / "first.data"))
    assert dict(read.dtypes) == {"label": "string", "a0": "double", "a1": "string"} and read.count() == 300
    reports = [s.report(spark, str(tmp_path / f"{s.name}.data"), k=3).collect() for s in (first, last)]
    for (r,), name in zip(reports, ("first", "last")):
        assert (r["dataset"], r["n_instances"], r["n_classes"], r["folds"]) == (name, 300, 2, 3)
        assert 0 < r["acc_mean"] < 1 and 0 <= r["macro_f1"] <= 1
    with pytest.raises(ValueError, match="continuous"):
        DatasetSpec("bad", continuous=(5,)).read(spark, str(tmp_path / "last.data"))
    with pytest.raises(ValueError, match="first"):
        DatasetSpec("bad", label="middle")
