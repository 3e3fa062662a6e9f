"""Inputs that grow: folders of files, long texts."""

from tallybayes.operators.text import doc_term_counts, vectorize_arrays, vocabulary
from tallybayes.plans import stream_plans, text_plans
from tallybayes.sources.files import read_attribute_csv


def _tables(spark, base, n_files):
    """documents and labels; the documents as one file or as a folder of files."""
    docs = spark.createDataFrame([(i, f"w{i % 3} w{i % 3} common x{i}", "en", "s", 9) for i in range(12)] + [(12, None, "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = base / "documents.parquet"
    if n_files == 1:
        docs.coalesce(1).write.parquet(str(base / "parts"))
        next((base / "parts").glob("part-*.parquet")).rename(out)
    else:
        docs.repartition(n_files).write.parquet(str(out))
    spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id long, quality int, toxic int").write.parquet(str(base / "labels.parquet"))
    return str(base)


def test_stream_reads_documents_from_a_file_or_a_folder(spark, tmp_path):
    for n_files in (1, 3):
        (tmp_path / str(n_files)).mkdir()
        path = _tables(spark, tmp_path / str(n_files), n_files)
        found = stream_plans.QUERIES["nb_predict_stream"](spark, path).collect()
        wanted = text_plans.QUERIES["nb_predict_new"](spark, path).collect()
        assert len(found) == 7 and sorted(map(tuple, found)) == sorted(map(tuple, wanted))


def test_indices_of_long_texts_compare_no_pairs_of_places(spark):
    long = " ".join(f"t{i * 7919 % 5000:04d} again" for i in range(5000))
    docs = spark.createDataFrame([(1, long), (1, long), (1, "again t0000"), (2, None)], "doc_id long, text string")
    vocab = vocabulary(doc_term_counts(docs, ["doc_id"]))
    rows = vectorize_arrays(docs, vocab, ["doc_id"])
    assert "array_distinct" not in rows._jdf.queryExecution().optimizedPlan().toString()
    index = {r["term"]: r["idx"] for r in vocab.collect()}
    wanted = [[index[w] for w in long.split()]] * 2 + [[index["again"], index["t0000"]], []]
    assert sorted((r["words"] for r in rows.collect()), key=len) == sorted(wanted, key=len)


def test_fields_are_stripped_without_patterns_and_only_where_read(spark, tmp_path):
    spaces = "".join(map(chr, (9, 11, 12, 32, 0x85, 0xa0, 0x1680, 0x2000, 0x200a, 0x2028, 0x2029, 0x202f, 0x205f, 0x3000)))
    (tmp_path / "a.txt").write_text(f" x , {spaces}a b{spaces},c{chr(0x200b)}\n{spaces}\n{spaces}y,,d{spaces}\n", encoding="utf-8", newline="")
    rows = read_attribute_csv(spark, str(tmp_path / "a.txt"), "first")
    assert sorted(map(tuple, rows.collect())) == [("x", "a b", "c" + chr(0x200b)), ("y", "", "d")]
    assert "regexp_replace" not in rows._jdf.queryExecution().optimizedPlan().toString()
