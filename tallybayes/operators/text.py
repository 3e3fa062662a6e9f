"""Text features: tokens, document frequency, vocabulary, label index,
vectorization and per-document term counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tallybayes.functions.text import bag_rows, distinct_terms, tokens
from tallybayes.operators.ranking import range_rank
from tallybayes.operators.scoring import ROW, broadcast_limit, frequent_keys, model_join


def tokenize(docs: DataFrame, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    """Add ``out_col`` = token array of ``text_col`` (NULL text -> [])."""
    return docs.withColumn(out_col, tokens(text_col))


def token_rows(docs: DataFrame, id_cols: Sequence[str], text_col: str = "text") -> DataFrame:
    """Long form ``(ids…, pos, term)``, pos 0-based in text order."""
    return docs.select(*id_cols, F.posexplode(tokens(text_col)).alias("pos", "term")) \
        .withColumn("pos", F.col("pos").cast("bigint"))


def doc_term_counts(docs: DataFrame, id_cols: Sequence[str], text_col: str = "text",
                    keep: Sequence[str] = ()) -> DataFrame:
    """``(ids…, keep…, term, tf)``: one row per distinct term of a document.

    The bag is built inside each row, so no single token is ever shuffled.
    """
    return bag_rows(docs, text_col, [*id_cols, *keep])


def document_frequency(bags: DataFrame) -> DataFrame:
    """``(term, df)``: number of documents containing the term, from bags."""
    return bags.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def dense_index(df: DataFrame, key: str, idx_col: str = "idx") -> DataFrame:
    """Dense 0-based index of ``key`` in code-point order, computed in parallel over sampled ranges.

    String order in Spark is UTF-8 byte order, which is code-point order.
    """
    return range_rank(df, [key], rank_col="_r").withColumn(idx_col, F.col("_r") - 1).drop("_r")


def vocabulary(bags: DataFrame, min_df: int = 1, with_index: bool = True) -> DataFrame:
    """``(term, df[, idx])`` for terms in at least ``min_df`` documents."""
    vocab = document_frequency(bags)
    if min_df > 1:
        vocab = vocab.filter(F.col("df") >= min_df)
    return dense_index(vocab, "term") if with_index else vocab


def label_index(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``(label, idx)``: sorted distinct labels -> 0..C-1.

    The window runs over the distinct-label table only (one row per class).
    """
    labels = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("_n"))
    return labels.select(
        "label", (F.row_number().over(Window.orderBy("label")) - 1).cast("bigint").alias("idx"))


def _index_parts(vocab: DataFrame) -> tuple[DataFrame | None, DataFrame | None, Row]:
    """``(frequent, rest, size)``: the vocabulary's part for a broadcast, and the other one; either may be None."""
    weighted = "df" in vocab.columns
    table = vocab.select("term", F.col("idx").cast("bigint").alias("idx"), *(["df"] if weighted else []))
    size = table.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("b"),
                     F.coalesce(F.sum("df") if weighted else F.lit(0), F.lit(0)).alias("df"),
                     F.coalesce(F.min("idx"), F.lit(0)).alias("lo"), F.coalesce(F.max("idx"), F.lit(0)).alias("hi")).first()
    table_bytes, limit = int(size["b"]) + 72 * int(size["n"]), broadcast_limit(vocab.sparkSession)
    if table_bytes <= limit:
        return table, None, size
    least = frequent_keys(table, "df", int(size["n"]), table_bytes, limit) if weighted and limit > 0 else None
    if least is None:
        return None, table, size
    return table.filter(F.col("df") >= least), table.filter(F.col("df") < least), size


def vectorize_arrays(docs: DataFrame, vocab: DataFrame, id_cols: Sequence[str], text_col: str = "text",
                     keep: Sequence[str] = (), words_col: str = "words") -> DataFrame:
    """Bag of indices, array form ``(ids…, keep…, words array<bigint>)``, one row per input row: OOV tokens
    dropped, repeats and text order kept.

    Texts are shuffled once, whole, by their row.  Tokens meet the vocabulary's most frequent terms (``df``; as many as may be
    broadcast) in the task that holds their text and are gathered there; only tokens of rarer terms are shuffled, to their term
    and back.  Rows that share their ids are told apart by a hash of the text.
    """
    cols = [*id_cols, *[k for k in keep if k not in id_cols]]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # one column that is never NULL, so that the join of both sides needs no other partitioning
    rows = docs.select(F.struct(*cols, F.xxhash64(F.col(text_col)).alias(ROW)).alias("_row_key"), F.col(text_col).alias("_text")) \
        .repartition(parts, "_row_key")
    # place 0 is the marker of the row itself
    marked = F.concat(F.array(F.lit(None).cast("string")), tokens("_text"))
    found = rows.select("_row_key", F.posexplode(marked).alias("i", "term"))
    frequent, rest, size = _index_parts(vocab)
    if frequent is None:
        found = found.withColumn("idx", F.lit(None).cast("bigint"))
    else:
        found = found.join(F.broadcast(frequent.select("term", "idx")), "term", "left")
    # place and index as one number; a place is under 2^31
    span = int(size["hi"]) - int(size["lo"]) + 1
    kind = "bigint" if span <= 1 << 32 else "decimal(20,0)"
    low, wide = F.lit(int(size["lo"])).cast(kind), F.lit(str(span)).cast(kind)
    at = F.col("i").cast(kind) * wide + (F.col("idx").cast(kind) - low)
    per_row = found.groupBy("_row_key").agg(F.sum(F.col("term").isNull().cast("bigint")).alias("_m"), F.collect_list(at).alias("_w"))
    if rest is not None:
        weight = "df" if "df" in rest.columns else None
        others = found.filter(F.col("term").isNotNull() & F.col("idx").isNull()).select("_row_key", "i", "term")
        rare = model_join(others, rest, ["term"], ["_row_key", "i"], weight=weight, n_keys=int(size["n"]), total=int(size["df"]))
        per_row = per_row.join(rare.groupBy("_row_key").agg(F.collect_list(at).alias("_r")), "_row_key", "left") \
            .withColumn("_w", F.when(F.col("_r").isNull(), F.col("_w")).otherwise(F.concat("_w", "_r")))
    placed = per_row.select("_row_key", "_m", F.sort_array("_w").alias("_p"))
    # exact copies have each place once a copy, side by side once sorted
    once = F.filter("_p", lambda x, j: (j == 0) | (x != F.get("_p", j - 1)))
    words = placed.select(*[F.col("_row_key")[c].alias(c) for c in cols], "_m", F.transform(
        F.when(F.col("_m") > 1, once).otherwise(F.col("_p")), lambda x: (x % wide + low).cast("bigint")).alias(words_col))
    return words.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_m")))).drop("_copy", "_m")


def vectorize(docs: DataFrame, vocab: DataFrame, id_cols: Sequence[str],
              text_col: str = "text") -> DataFrame:
    """Bag of indices, long form ``(ids…, pos, idx)``: ``vectorize_arrays`` with a row per kept token,
    ``pos`` its 0-based position among them."""
    rows = vectorize_arrays(docs, vocab, id_cols, text_col)
    return rows.select(*id_cols, F.posexplode("words").alias("pos", "idx")).withColumn("pos", F.col("pos").cast("bigint"))


def prepare_text(docs: DataFrame, id_cols: Sequence[str], text_col: str = "text",
                 label_col: str = "label", test_flag: str = "is_test", min_df: int = 1,
                 handle_unknown: str = "error") -> DataFrame:
    """Fit vocabulary and label index on train rows (``test_flag`` = 0), apply
    to all rows: ``(ids…, is_test, label, label_idx, words array<bigint>, n_words, sum_idx)``.

    ``n_words`` counts ``words`` and ``sum_idx`` sums them.  ``words`` has the indices of in-vocabulary tokens in text order, what ``fit_multinomial`` and
    ``transform`` take as ``words_col``.  ``handle_unknown`` for a
    label absent from train: ``error`` (fail the job, whichever columns are read), ``skip`` (drop the row)
    or ``keep`` (label_idx NULL).
    """
    train = docs.filter(F.col(test_flag) == 0)
    vocab = vocabulary(distinct_terms(train, text_col), min_df=min_df)
    labels = label_index(train, label_col).withColumnRenamed("idx", "label_idx")
    told = docs.withColumn("label", F.col(label_col).cast("string"))
    words = vectorize_arrays(told, vocab, id_cols, text_col, keep=[test_flag, "label"])
    out = words.join(labels, "label", "inner" if handle_unknown == "skip" else "left")
    if handle_unknown == "error":
        # a filter, not a column: it is evaluated also where no column is read
        out = out.filter(F.when(F.col("label_idx").isNull(), F.raise_error(
            F.concat(F.lit("label unseen in train: "), F.coalesce("label", F.lit("NULL")))).cast("boolean")).otherwise(True))
    return out.select(*id_cols, test_flag, "label", "label_idx", "words", F.size("words").cast("bigint").alias("n_words"),
                      F.aggregate("words", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("sum_idx"))
