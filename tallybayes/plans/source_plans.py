"""Source/sink plans: driver tables written in each file format under the
shared checkpoint folder and read back through the matching reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybayes.plans.fixtures import table
from tallybayes.session import scratch_dir
from tallybayes.sources.files import (
    read_attribute_csv,
    read_label_tab_text,
    read_labeled_csv,
    read_results,
    write_labeled_csv,
    write_results,
)

QUERIES: dict = {}
ORACLE: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@register("read_labeled_csv", "SELECT lang AS label, coalesce(text, '') AS text FROM documents")
def q_read_labeled_csv(spark, sf_dir):
    """documents as ``label,text`` CSV (quotes, newlines kept), read back."""
    docs = table(spark, sf_dir, "documents").select(F.col("lang").alias("label"), "text")
    path = scratch_dir(spark, "labeled-csv")
    write_labeled_csv(docs, path)
    return read_labeled_csv(spark, path)


@register("read_label_tab_text", r"""SELECT lang AS label, line AS text
FROM (SELECT lang, unnest(regexp_split_to_array(coalesce(text, ''), '\r\n|\r|\n')) AS line FROM documents)""")
def q_read_label_tab_text(spark, sf_dir):
    """Every line of every document as ``lang<TAB>line``, read back."""
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("lang", F.explode(F.split(F.coalesce("text", F.lit("")), r"\r\n|\r|\n", -1))
                        .alias("line"))
    path = scratch_dir(spark, "label-tab")
    lines.select(F.concat("lang", F.lit("\t"), "line").alias("value")).write.mode("overwrite").text(path)
    return read_label_tab_text(spark, path)


@register("read_attribute_csv", """SELECT l_returnflag AS label, l_linestatus AS a0,
  CAST(l_linenumber AS VARCHAR) AS a1, CAST(l_orderkey AS VARCHAR) AS a2 FROM lineitem""")
def q_read_attribute_csv(spark, sf_dir):
    """lineitem as attribute lines ``a0, a1, a2, label`` (label last), read back."""
    li = table(spark, sf_dir, "lineitem")
    path = scratch_dir(spark, "attr-csv")
    li.select(F.concat_ws(" , ", "l_linestatus", F.col("l_linenumber").cast("string"),
                          F.col("l_orderkey").cast("string"), "l_returnflag").alias("value")) \
        .write.mode("overwrite").text(path)
    return read_attribute_csv(spark, path, label="last")


@register("write_results", """SELECT lang AS label, count(*)::BIGINT AS n_docs,
  round(avg(n_chars), 6) AS mean_chars FROM documents GROUP BY lang""")
def q_write_results(spark, sf_dir):
    """A per-class results table written as CSV with header and read back."""
    docs = table(spark, sf_dir, "documents")
    res = docs.groupBy(F.col("lang").alias("label")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.round(F.avg("n_chars"), 6).alias("mean_chars"))
    path = scratch_dir(spark, "results-csv")
    write_results(res, path)
    return read_results(spark, path, res.schema)
