"""Multinomial text plans: features, counts, model, prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.operators.counts import class_doc_counts, class_token_totals
from tallybayes.operators.metrics import strategy_parity
from tallybayes.operators.model import class_term_counts, fit_multinomial, materialize
from tallybayes.operators.text import (
    doc_term_counts,
    document_frequency,
    label_index,
    prepare_text,
    token_rows,
    vectorize,
    vocabulary,
)
from tallybayes.plans import sql as S
from tallybayes.operators.sampling import hash_fold
from tallybayes.plans.fixtures import ALPHA, K, SEED, TEST_FOLD, lang_docs, quality_docs, table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _lang_split(spark: SparkSession, sf_dir: str):
    docs = lang_docs(spark, sf_dir)
    return docs.filter(F.col("fold") != TEST_FOLD), docs.filter(F.col("fold") == TEST_FOLD)


@register("nb_predict", f"""WITH {S.LANG_DOCS},
train AS (SELECT * FROM docs WHERE fold <> 0),
test AS (SELECT * FROM docs WHERE fold = 0),
{S.multinomial_model()},
{S.multinomial_scores()}
SELECT doc_id, label, prediction, score FROM best""")
def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on folds != 0 of documents (label = lang), predict fold 0."""
    train, test = _lang_split(spark, sf_dir)
    model = fit_multinomial(train, alpha=ALPHA)
    return model.transform(test, ["doc_id"], keep=["label"])


def _r9(c):
    return F.round(c, 9)


# --- B: text features -------------------------------------------------------

@register("tokenize", f"""SELECT doc_id, (generate_subscripts(t, 1) - 1)::BIGINT AS pos, unnest(t) AS term
FROM (SELECT doc_id, {S.tokens('text')} AS t FROM documents)""")
def q_tokenize(spark, sf_dir):
    """Every token of every document: ``(doc_id, pos, term)``."""
    return token_rows(table(spark, sf_dir, "documents"), ["doc_id"])


@register("document_frequency", f"""SELECT term, count(DISTINCT doc_id)::BIGINT AS df
FROM (SELECT doc_id, unnest({S.tokens('text')}) AS term FROM documents) GROUP BY term""")
def q_document_frequency(spark, sf_dir):
    return document_frequency(doc_term_counts(table(spark, sf_dir, "documents"), ["doc_id"]))


@register("doc_term_counts", f"""SELECT doc_id, term, count(*)::BIGINT AS tf
FROM (SELECT doc_id, unnest({S.tokens('text')}) AS term FROM documents) GROUP BY ALL""")
def q_doc_term_counts(spark, sf_dir):
    return doc_term_counts(table(spark, sf_dir, "documents"), ["doc_id"])


def _vocab_sql(min_df: int) -> str:
    return f"""WITH {S.LANG_DOCS},
train AS (SELECT * FROM docs WHERE fold <> 0),
{S.multinomial_model(min_df=min_df)}
SELECT term, df, (row_number() OVER (ORDER BY term) - 1)::BIGINT AS idx FROM vocab"""


@register("vocabulary", _vocab_sql(1))
def q_vocabulary(spark, sf_dir):
    """Train vocabulary (lang split) with dense code-point index."""
    train, _ = _lang_split(spark, sf_dir)
    return vocabulary(doc_term_counts(train, ["doc_id"]), min_df=1)


@register("vocabulary_min_df", _vocab_sql(2))
def q_vocabulary_min_df(spark, sf_dir):
    train, _ = _lang_split(spark, sf_dir)
    return vocabulary(doc_term_counts(train, ["doc_id"]), min_df=2)


@register("label_index", f"""WITH {S.LANG_DOCS}
SELECT label, (row_number() OVER (ORDER BY label) - 1)::BIGINT AS idx
FROM (SELECT DISTINCT label FROM docs WHERE fold <> 0)""")
def q_label_index(spark, sf_dir):
    train, _ = _lang_split(spark, sf_dir)
    return label_index(train)


@register("vectorize", f"""WITH {S.LANG_DOCS},
train AS (SELECT * FROM docs WHERE fold <> 0),
{S.multinomial_model()},
v AS (SELECT term, (row_number() OVER (ORDER BY term) - 1)::BIGINT AS idx FROM vocab),
toks AS (SELECT doc_id, generate_subscripts(t, 1) AS p, unnest(t) AS term
         FROM (SELECT doc_id, {S.tokens('text')} AS t FROM docs WHERE fold = 0))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1)::BIGINT AS pos, v.idx
FROM toks JOIN v USING (term)""")
def q_vectorize(spark, sf_dir):
    """Test documents as vocabulary indices (OOV dropped, repeats kept)."""
    train, test = _lang_split(spark, sf_dir)
    vocab = vocabulary(doc_term_counts(train, ["doc_id"]))
    return vectorize(test, vocab, ["doc_id"])


_PREPARED_SQL = f"""WITH {S.LANG_DOCS},
train AS (SELECT * FROM docs WHERE fold <> 0),
test AS (SELECT * FROM docs WHERE fold = 0),
{S.multinomial_model()},
v AS (SELECT term, (row_number() OVER (ORDER BY term) - 1)::BIGINT AS idx FROM vocab),
toks AS (SELECT doc_id, generate_subscripts(t, 1) AS p, unnest(t) AS term FROM (SELECT doc_id, {S.tokens('text')} AS t FROM docs)),
per_doc AS (SELECT doc_id, count(*)::BIGINT AS n_words, sum(idx)::BIGINT AS sum_idx, string_agg(idx::VARCHAR, ' ' ORDER BY p) AS words
         FROM toks JOIN v USING (term) GROUP BY doc_id)"""


@register("prepare_text", _PREPARED_SQL + """
SELECT d.doc_id, CASE WHEN d.fold = 0 THEN 1 ELSE 0 END::BIGINT AS is_test, c.label_idx,
       coalesce(k.n_words, 0)::BIGINT AS n_words, coalesce(k.sum_idx, 0)::BIGINT AS sum_idx, coalesce(k.words, '') AS words
FROM docs d JOIN cls c USING (label) LEFT JOIN per_doc k USING (doc_id)""")
def q_prepare_text(spark, sf_dir):
    """Fit vocabulary and labels on train, apply to both sides; the index arrays as text."""
    return _prepared(spark, sf_dir).select("doc_id", "is_test", "label_idx", "n_words", "sum_idx",
                                           F.array_join("words", " ").alias("words"))


def _prepared(spark, sf_dir):
    docs = lang_docs(spark, sf_dir).withColumn("is_test", (F.col("fold") == TEST_FOLD).cast("bigint"))
    return prepare_text(docs, ["doc_id"], handle_unknown="error")


@register("nb_predict_prepared", ORACLE["nb_predict"])
def q_nb_predict_prepared(spark, sf_dir):
    """nb_predict trained and scored on the prepared index arrays: the same rows."""
    rows = materialize(_prepared(spark, sf_dir), "cache", "prepared")
    model = fit_multinomial(rows.filter("is_test = 0"), words_col="words", alpha=ALPHA)
    return model.transform(rows.filter("is_test = 1"), ["doc_id"], keep=["label"], words_col="words")


# --- D: counts and model ----------------------------------------------------

def _model_sql(select: str, min_df: int = 1) -> str:
    return f"""WITH {S.LANG_DOCS},
train AS (SELECT * FROM docs WHERE fold <> 0),
{S.multinomial_model(min_df=min_df)}
{select}"""


def _lang_model(spark, sf_dir):
    train, test = _lang_split(spark, sf_dir)
    return fit_multinomial(train, alpha=ALPHA), test


@register("class_doc_counts", _model_sql("SELECT label, n_docs FROM cstats"))
def q_class_doc_counts(spark, sf_dir):
    train, _ = _lang_split(spark, sf_dir)
    return class_doc_counts(train)


@register("class_token_totals", _model_sql("SELECT label, n_tokens FROM cstats"))
def q_class_token_totals(spark, sf_dir):
    train, _ = _lang_split(spark, sf_dir)
    return class_token_totals(class_term_counts(train))


@register("word_class_counts", _model_sql("SELECT label, term, cnt FROM ct"))
def q_word_class_counts(spark, sf_dir):
    train, _ = _lang_split(spark, sf_dir)
    return class_term_counts(train).select("label", "term", "cnt")


@register("nb_log_prior", _model_sql("SELECT label, round(log_prior, 9) AS log_prior FROM cstats"))
def q_nb_log_prior(spark, sf_dir):
    m, _ = _lang_model(spark, sf_dir)
    return m.class_stats.select("label", _r9(F.col("log_prior")).alias("log_prior"))


@register("nb_log_likelihood", _model_sql(
    "SELECT label, term, round(log_likelihood, 9) AS log_likelihood FROM llq2"))
def q_nb_log_likelihood(spark, sf_dir):
    m, _ = _lang_model(spark, sf_dir)
    return m.term_stats.select("label", "term", _r9(F.col("log_likelihood")).alias("log_likelihood"))


@register("nb_class_stats", _model_sql(
    """SELECT label, label_idx, n_docs, n_tokens, round(log_prior, 9) AS log_prior,
       round(log_default, 9) AS log_default FROM cstats"""))
def q_nb_class_stats(spark, sf_dir):
    m, _ = _lang_model(spark, sf_dir)
    return m.class_stats.select(
        "label", F.col("label_idx").cast("bigint").alias("label_idx"), "n_docs", "n_tokens",
        _r9(F.col("log_prior")).alias("log_prior"), _r9(F.col("log_default")).alias("log_default"))


@register("nb_train", _model_sql(
    """SELECT l.label, l.term, l.cnt, round(l.log_likelihood, 9) AS log_likelihood,
       round(c.log_prior, 9) AS log_prior, round(c.log_default, 9) AS log_default
       FROM llq2 l JOIN cstats c USING (label)""", min_df=2))
def q_nb_train(spark, sf_dir):
    """Whole model in one table (min_df = 2: vocabulary pruning path)."""
    train, _ = _lang_split(spark, sf_dir)
    m = fit_multinomial(train, alpha=ALPHA, min_df=2)
    cs = m.class_stats.select("label", "log_prior", "log_default")
    return m.term_stats.join(cs, "label").select(
        "label", "term", "cnt", _r9(F.col("log_likelihood")).alias("log_likelihood"),
        _r9(F.col("log_prior")).alias("log_prior"), _r9(F.col("log_default")).alias("log_default"))


@register("nb_scores", f"""WITH {S.LANG_DOCS},
train AS (SELECT * FROM docs WHERE fold <> 0),
test AS (SELECT * FROM docs WHERE fold = 0),
{S.multinomial_model()},
{S.multinomial_scores()}
SELECT doc_id, cls AS class, {S.from_fixed('score_q')} AS score FROM sc""")
def q_nb_scores(spark, sf_dir):
    """Every class's score for every test document."""
    m, test = _lang_model(spark, sf_dir)
    return m.long_scores(test, ["doc_id"])


@register("nb_predict_sparse", ORACLE["nb_predict"])
def q_nb_predict_sparse(spark, sf_dir):
    """Same as nb_predict through the sparse (class, term) strategy."""
    m, test = _lang_model(spark, sf_dir)
    return m.transform(test, ["doc_id"], keep=["label"], strategy="sparse")


@register("nb_predict_new", f"""WITH {S.quality_docs('quality')},
train AS (SELECT * FROM docs),
test AS (SELECT d.doc_id, NULL::VARCHAR AS label, d.text FROM documents d
         WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)),
{S.multinomial_model()},
{S.multinomial_scores()}
SELECT doc_id, prediction, score FROM best""")
def q_nb_predict_new(spark, sf_dir):
    """Train on every labeled document (quality); score the unlabeled ones."""
    train = quality_docs(spark, sf_dir, "quality")
    model = fit_multinomial(train, alpha=ALPHA)
    docs = table(spark, sf_dir, "documents")
    new = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    return model.transform(new, ["doc_id"]).select("doc_id", "prediction", "score")


@register("strategy_parity", f"""WITH {S.LANG_DOCS}
SELECT count(*)::BIGINT AS n_rows, 0::BIGINT AS only_wide, 0::BIGINT AS only_sparse
FROM docs WHERE fold = 0""")
def q_strategy_parity(spark, sf_dir):
    """Wide and sparse scoring must agree row for row: differing-row counts."""
    m, test = _lang_model(spark, sf_dir)
    a = m.transform(test, ["doc_id"], keep=["label"], strategy="wide")
    b = m.transform(test, ["doc_id"], keep=["label"], strategy="sparse")
    return strategy_parity(a, b)


CONTENT_KEY_SQL = "md5(coalesce(text, ''))"


@register("nb_predict_content_split", f"""WITH docs AS (
  SELECT doc_id, lang AS label, text, {S.fold_of(CONTENT_KEY_SQL)} AS fold FROM documents),
train AS (SELECT * FROM docs WHERE fold <> 0),
test AS (SELECT * FROM docs WHERE fold = 0),
{S.multinomial_model()},
{S.multinomial_scores()}
SELECT doc_id, label, prediction, score FROM best""")
def q_nb_predict_content_split(spark, sf_dir):
    """nb_predict with folds keyed by the text's md5: exact copies of a
    document always land on the same side of the split (no leakage)."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("label"), "text",
        hash_fold(F.md5(F.coalesce(F.col("text"), F.lit(""))), K, SEED).alias("fold"))
    model = fit_multinomial(docs.filter(F.col("fold") != TEST_FOLD), alpha=ALPHA)
    return model.transform(docs.filter(F.col("fold") == TEST_FOLD), ["doc_id"], keep=["label"])
