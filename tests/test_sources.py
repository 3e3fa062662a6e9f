"""File sources and sinks on tiny files in a temporary directory."""

import os

import pytest

from tallybayes.sources.files import (
    read_attribute_csv,
    read_label_tab_text,
    read_labeled_csv,
    read_results,
    write_results,
)


def test_labeled_csv(spark, tmp_path):
    p = tmp_path / "sms.csv"
    p.write_text('label,text\nham,"hello, ""world"""\nspam,"two\nlines"\nham,\n', encoding="utf-8")
    got = [tuple(r) for r in read_labeled_csv(spark, str(p)).collect()]
    assert got == [("ham", 'hello, "world"'), ("spam", "two\nlines"), ("ham", "")]


def test_label_tab_text(spark, tmp_path):
    p = tmp_path / "raw.txt"
    p.write_text(" ham \tsee you\tlater \n\nspam\tWIN now\nnolabel\n", encoding="utf-8")
    got = [tuple(r) for r in read_label_tab_text(spark, str(p)).collect()]
    assert got == [("ham", "see you\tlater "), ("spam", "WIN now"), ("nolabel", "")]


def test_attribute_csv_label_first_and_last(spark, tmp_path):
    p = tmp_path / "uci.data"
    p.write_text("p, x ,s\n\n e,y,f \n", encoding="utf-8")
    first = [tuple(r) for r in read_attribute_csv(spark, str(p), label="first").collect()]
    assert first == [("p", "x", "s"), ("e", "y", "f")]
    last = [tuple(r) for r in read_attribute_csv(spark, str(p), label="last").collect()]
    assert last == [("s", "p", "x"), ("f", "e", "y")]


def test_attribute_csv_ragged_row_fails(spark, tmp_path):
    p = tmp_path / "bad.data"
    p.write_text("a,b,c\na,b\n", encoding="utf-8")
    with pytest.raises(Exception):
        read_attribute_csv(spark, str(p), n_attrs=2).collect()


def test_results_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("mushroom", 8124, 0.9531), ("car", 1728, 0.8576)],
                               "dataset string, n_instances bigint, acc_mean double")
    out = os.path.join(str(tmp_path), "res")
    write_results(df, out)
    back = read_results(spark, out, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
