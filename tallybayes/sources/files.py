"""File sources and sinks for labeled text and attribute rows.

* labeled CSV ``label,text`` with header, quoted fields, embedded newlines;
* raw lines ``label<TAB>text``: split at the first tab, label stripped, text
  kept as is (no tab: empty text), blank lines skipped;
* attribute lines (UCI style): stripped, blank lines skipped, split on every
  comma (no quoting), each field stripped, label first or last;
* CSV result sink with header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: whitespace stripped from labels and fields (Unicode's White_Space, what the pattern (?U)\s takes).
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"

_CSV_OPTS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
             "encoding": "UTF-8"}


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, rec, record)``: whole records of quoted CSV files, numbered from 1 in each file, also where quoted
    fields hold line breaks.

    Files are read as lines, in as many splits as their size gives.  A line begins a record if an even number of
    quotes comes before it in its file: each split's parity of quotes, summed over the splits before it, tells
    whether the split begins inside a quoted field, and the lines' own parities do the rest within the split.
    Only what a split has of a record that began before it moves on, to that record.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    odd = F.pmod(F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit(""))), F.lit(2)).cast("bigint")
    lines = lines.withColumn("odd", odd)
    # one row per split: whether it begins inside quotes
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd")).select(
        "file", "block", F.coalesce(F.sum("odd").over(earlier), F.lit(0)).alias("before"))
    in_split = Window.partitionBy("file", "block").orderBy("at")
    placed = lines.join(splits, ["file", "block"]).withColumn("open", F.pmod(F.col("before") + F.coalesce(
        F.sum("odd").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(2)))
    placed = placed.withColumn("begun", F.sum((F.col("open") == 0).cast("bigint")).over(in_split))
    begun = placed.groupBy("file", "block").agg(F.max("begun").alias("n")).select(
        "file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("records"))
    numbered = placed.join(begun, ["file", "block"]).withColumn("rec", F.col("records") + F.col("begun"))
    own = Window.partitionBy("file", "block", "rec").orderBy("at")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pieces = numbered.withColumn("nth", F.row_number().over(own)).withColumn("lines", F.collect_list("line").over(whole)) \
        .filter(F.col("nth") == 1).select("file", "block", "rec", "begun", F.array_join("lines", "\n").alias("text"))
    # a split begins with at most one piece of a record that began before it
    rests = pieces.filter(F.col("begun") == 0).groupBy("file", "rec").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n").alias("rest"))
    records = pieces.filter(F.col("begun") > 0).join(rests, ["file", "rec"], "left")
    return records.select("file", "rec", F.regexp_replace(F.concat_ws("\n", "text", "rest"), "\r$", "").alias("record"))


def read_labeled_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(label, text)`` of files with a header; an empty text field reads as '' (never NULL).

    Large files are read by many tasks, line breaks in quoted fields included (``csv_records``).
    """
    records = csv_records(spark, path).filter((F.col("rec") > 1) & (F.col("record") != ""))
    row = F.from_csv("record", F.lit("label string, text string"), {k: v for k, v in _CSV_OPTS.items() if k != "header"})
    return records.select(row.alias("row")).select(F.coalesce("row.label", F.lit("")).alias("label"),
                                                   F.coalesce("row.text", F.lit("")).alias("text"))


def write_labeled_csv(df: DataFrame, path: str) -> None:
    df.select("label", "text").write.mode("overwrite").options(**_CSV_OPTS) \
        .option("quoteAll", "true").csv(path)


def read_label_tab_text(spark: SparkSession, path: str) -> DataFrame:
    """``(label, text)`` from ``label<TAB>text`` lines."""
    lines = spark.read.text(path).filter(F.col("value") != "")
    parts = F.split(F.col("value"), "\t", 2)
    return lines.select(strip(F.element_at(parts, 1)).alias("label"),
                        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("text"))


def read_attribute_csv(spark: SparkSession, path: str, label: str = "last",
                       n_attrs: int | None = None) -> DataFrame:
    """``(label, a0 … a{M-1})`` string columns from comma-separated lines.

    ``n_attrs`` fixes M; without it M is that of the first line found.  A line with another field count
    fails the job with a message, whichever columns are read.
    """
    lines = spark.read.text(path).select(strip(F.col("value")).alias("line")) \
        .filter(F.col("line") != "")
    fields = lines.select(F.split("line", ",", -1).alias("f"))
    if n_attrs is None:
        first = fields.select(F.size("f").alias("n")).first()
        n_attrs = first["n"] - 1 if first else 0
    width = n_attrs + 1
    # a filter, not a column: it is evaluated also where no column is read
    checked = fields.filter(F.when(F.size("f") == width, True).otherwise(F.raise_error(F.concat(
        F.lit(f"expected {width} fields, got "), F.size("f").cast("string"))).cast("boolean")))
    if label == "first":
        lab, start = F.element_at("f", 1), 2
    else:
        lab, start = F.element_at("f", -1), 1
    attrs = [strip(F.element_at("f", start + i)).alias(f"a{i}") for i in range(n_attrs)]
    return checked.select(strip(lab).alias("label"), *attrs)


def write_results(df: DataFrame, path: str) -> None:
    """Results table as CSV with header (one file per partition)."""
    df.write.mode("overwrite").options(**_CSV_OPTS).csv(path)


def read_results(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.options(**_CSV_OPTS).schema(schema).csv(path)
