"""Tokenizer and per-document bag of words as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a token is a run of two or more word characters (letters,
# digits of any script, underscore) in the lower-cased text.  This is the
# classic ``\b\w\w+\b`` rule written so Java regex, RE2 and Python agree.
TOKEN_PATTERN = r"([\p{L}\p{N}_]{2,})"


def tokens(text: Column | str) -> Column:
    """``array<string>`` of tokens in text order, repeats kept; NULL -> []."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        F.regexp_extract_all(F.lower(col), F.lit(TOKEN_PATTERN), 1),
        F.array().cast("array<string>"),
    )


def bag_rows(df: DataFrame, text_col: str, keep: Sequence[str] = (), markers: bool = False,
             words: Column | None = None) -> DataFrame:
    """``(keep…, term, tf)``: one row per distinct term of each row's text.

    The bag is built inside the row: sort the tokens, mark where a run of equal
    tokens starts, and emit (term, run length).  Counting a document's words
    never leaves the task that read it, so no single token is shuffled.  The
    stages are separate projections because Spark re-evaluates an expression
    referenced inside a lambda once per element.

    ``markers`` adds a row with a NULL term and ``tf`` 0 per input row, so that rows
    without tokens are rows of the result too, from the same scan.  ``words``: an array
    column of terms (of any type) in place of the tokens of ``text_col``.
    """
    keep = list(keep)
    s = df.select(*keep, F.sort_array(_terms(text_col, words)).alias("_s"))
    st = s.select(*keep, "_s", F.filter(
        F.sequence(F.lit(1), F.greatest(F.size("_s"), F.lit(1))),
        lambda i: (i == 1) | (F.try_element_at("_s", i) != F.try_element_at("_s", i - 1)),
    ).alias("_st"))
    b = st.select(*keep, "_s", F.concat("_st", F.array(F.size("_s") + 1)).alias("_b"),
                  F.when(F.size("_s") > 0, F.size("_st")).otherwise(0).alias("_m"))

    def entry(j: Column) -> Column:
        return F.struct(
            F.try_element_at("_s", F.try_element_at("_b", j)).alias("term"),
            (F.try_element_at("_b", j + 1) - F.try_element_at("_b", j)).cast("bigint").alias("tf"))

    if markers:
        # place 1 is the marker; the row's runs follow
        marker = F.struct(F.lit(None).cast(b.schema["_s"].dataType.elementType).alias("term"), F.lit(0).cast("bigint").alias("tf"))
        return b.select(*keep, F.inline(F.transform(
            F.sequence(F.lit(0), F.col("_m")),
            lambda j: F.when(j == 0, marker).otherwise(entry(F.greatest(j, F.lit(1)))))))
    return b.select(*keep, F.inline(F.transform(
        F.sequence(F.lit(1), F.greatest("_m", F.lit(1))), entry))).filter(F.col("term").isNotNull())


def _terms(text_col: str, words: Column | None) -> Column:
    return tokens(text_col) if words is None else F.filter(F.coalesce(words, F.array()), lambda w: w.isNotNull())


def distinct_terms(df: DataFrame, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep…, term)``: one row per distinct term of each row's text, for callers that count documents only."""
    return df.select(*keep, F.explode(F.array_distinct(tokens(text_col))).alias("term"))


def token_marks(df: DataFrame, text_col: str, keep: Sequence[str] = (), words: Column | None = None) -> DataFrame:
    """``(keep…, term, tf)``: a row with ``tf`` 1 per token, repeats kept, and a marker (NULL term, ``tf`` 0) per
    input row: ``bag_rows`` with markers for callers that sum by row and term anyway, without its sort."""
    found = df.select(*keep, _terms(text_col, words).alias("_t"))
    none = F.lit(None).cast(found.schema["_t"].dataType.elementType)
    return found.select(*keep, F.explode(F.concat(F.array(none), "_t")).alias("term")).select(
        *keep, "term", F.when(F.col("term").isNull(), 0).otherwise(1).cast("bigint").alias("tf"))


def counted_tokens(df: DataFrame, text_col: str, keep: Sequence[str] = (), words: Column | None = None) -> DataFrame:
    """``(keep…, term, tf, df)`` for callers that sum both by term: a row with ``tf`` 1 per token, and one
    with ``df`` 1 per distinct token of each row's text."""
    found = df.select(*keep, _terms(text_col, words).alias("_t"))
    both = found.select(*keep, "_t", F.array_distinct("_t").alias("_u"))
    rows = both.select(*keep, F.size("_u").alias("_m"), F.posexplode(F.concat("_u", "_t")).alias("_p", "term"))
    own = (F.col("_p") < F.col("_m")).cast("bigint")
    return rows.select(*keep, "term", (1 - own).alias("tf"), own.alias("df"))
