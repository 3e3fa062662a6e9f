"""Sampling, evaluation and replication plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybayes.operators import metrics as M
from tallybayes.operators.model import fit_multinomial
from tallybayes.operators.sampling import (
    kfold_assign,
    kfold_balanced,
    ordered_split,
    replicate,
    stratified_split,
)
from tallybayes.operators.validation import replication_study
from tallybayes.plans import sql as S
from tallybayes.plans.fixtures import ALPHA, FACTORS, K, SEED, TEST_FOLD, lang_docs, quality_docs, table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _r9(c):
    return F.round(c, 9)


# --- C: sampling -------------------------------------------------------------

@register("stratified_split", f"""WITH d AS (SELECT doc_id, lang AS label, {S.hash_of('doc_id')} AS h FROM documents),
cls AS (SELECT label, count(*) AS nc FROM d GROUP BY label),
q AS (SELECT label, nc, floor(nc * 0.2e0)::BIGINT AS base, nc * 0.2e0 - floor(nc * 0.2e0)::BIGINT AS rem FROM cls),
t AS (SELECT ceil(sum(nc) * 0.2e0)::BIGINT AS target, sum(base)::BIGINT AS sb FROM q),
q2 AS (SELECT q.label, q.base + CASE WHEN row_number() OVER (ORDER BY q.rem DESC, q.label) <= t.target - t.sb
                                   THEN 1 ELSE 0 END AS quota FROM q CROSS JOIN t),
r AS (SELECT d.*, row_number() OVER (PARTITION BY label ORDER BY h, doc_id) AS rk FROM d)
SELECT doc_id, label, (CASE WHEN rk <= quota THEN 1 ELSE 0 END)::BIGINT AS is_test FROM r JOIN q2 USING (label)""")
def q_stratified_split(spark, sf_dir):
    """20% stratified test split of documents by lang."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    return stratified_split(docs, "doc_id", "label", test_size=0.2, seed=SEED)


@register("kfold_assign", f"SELECT doc_id, {S.fold_of('doc_id')} AS fold FROM documents")
def q_kfold_assign(spark, sf_dir):
    return kfold_assign(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", K, SEED)


@register("kfold_balanced", f"""SELECT doc_id,
  ((row_number() OVER (ORDER BY {S.hash_of('doc_id')}, doc_id) - 1) % {K})::BIGINT AS fold FROM documents""")
def q_kfold_balanced(spark, sf_dir):
    return kfold_balanced(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", K, SEED)


@register("replicate", f"""WITH {S.LANG_DOCS}
SELECT doc_id, label, r::BIGINT AS replica FROM docs CROSS JOIN range(3) t(r) WHERE fold <> 0""")
def q_replicate(spark, sf_dir):
    """Training side of the lang split replicated x3 (after the split)."""
    docs = lang_docs(spark, sf_dir).filter(F.col("fold") != TEST_FOLD).select("doc_id", "label")
    return replicate(docs, 3)


@register("ordered_split", """SELECT doc_id,
  (CASE WHEN row_number() OVER (ORDER BY doc_id) > (SELECT count(*) * 4 // 5 FROM documents) THEN 1 ELSE 0 END)::BIGINT AS is_test
FROM documents""")
def q_ordered_split(spark, sf_dir):
    """The first four fifths of the documents by doc_id train, the rest test."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return ordered_split(docs, "doc_id", docs.count() * 4 // 5)


@register("category_filter", """SELECT doc_id, lang AS label FROM documents WHERE lang IN ('de', 'fr')""")
def q_category_filter(spark, sf_dir):
    """Class-subset scan: keep only the listed classes, before anything else."""
    docs = table(spark, sf_dir, "documents")
    return docs.filter(F.col("lang").isin("de", "fr")).select("doc_id", F.col("lang").alias("label"))


# --- F: evaluation on the imbalanced quality label ---------------------------

_QUALITY_PRED = f"""WITH {S.quality_docs('quality')},
train AS (SELECT * FROM docs WHERE fold <> 0),
test AS (SELECT * FROM docs WHERE fold = 0),
{S.multinomial_model()},
{S.multinomial_scores()},
pairs2 AS (SELECT a.label, b.label AS prediction FROM cstats a CROSS JOIN cstats b),
cmx AS (SELECT p.label, p.prediction, count(x.doc_id)::BIGINT AS n FROM pairs2 p
        LEFT JOIN best x ON x.label = p.label AND x.prediction = p.prediction GROUP BY ALL),
per AS (
  SELECT d.label,
    sum(CASE WHEN c.label = d.label AND c.prediction = d.label THEN c.n ELSE 0 END)::BIGINT AS tp,
    sum(CASE WHEN c.prediction = d.label AND c.label <> d.label THEN c.n ELSE 0 END)::BIGINT AS fp,
    sum(CASE WHEN c.label = d.label AND c.prediction <> d.label THEN c.n ELSE 0 END)::BIGINT AS fn
  FROM cstats d CROSS JOIN cmx c GROUP BY d.label),
pm AS (
  SELECT label, tp, fp, fn, (tp + fn)::BIGINT AS support,
    CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0e0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0e0 END AS recall FROM per),
pm2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                  ELSE 0.0e0 END AS f1 FROM pm)"""


def _quality_predictions(spark, sf_dir):
    docs = quality_docs(spark, sf_dir, "quality")
    model = fit_multinomial(docs.filter(F.col("fold") != TEST_FOLD), alpha=ALPHA)
    pred = model.transform(docs.filter(F.col("fold") == TEST_FOLD), ["doc_id"], keep=["label"])
    return pred, model.class_stats.select("label")


@register("accuracy", _QUALITY_PRED + """
SELECT count(*)::BIGINT AS n, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END)::BIGINT AS n_correct,
  CASE WHEN count(*) > 0 THEN sum(CASE WHEN label = prediction THEN 1 ELSE 0 END)::DOUBLE / count(*)
  ELSE 0.0e0 END AS accuracy FROM best""")
def q_accuracy(spark, sf_dir):
    pred, _ = _quality_predictions(spark, sf_dir)
    return M.accuracy(pred)


@register("confusion_matrix", _QUALITY_PRED + "\nSELECT label, prediction, n FROM cmx")
def q_confusion_matrix(spark, sf_dir):
    pred, classes = _quality_predictions(spark, sf_dir)
    return M.confusion_matrix(pred, classes)


@register("class_metrics", _QUALITY_PRED + """
SELECT label, tp, fp, fn, support, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f1, 9) AS f1 FROM pm2""")
def q_class_metrics(spark, sf_dir):
    pred, classes = _quality_predictions(spark, sf_dir)
    m = M.class_metrics(pred, classes)
    return m.select("label", "tp", "fp", "fn", "support", *[_r9(F.col(c)).alias(c)
                                                            for c in ("precision", "recall", "f1")])


@register("macro_metrics", _QUALITY_PRED + """
SELECT count(*)::BIGINT AS n_classes, round(avg(precision), 9) AS macro_precision,
  round(avg(recall), 9) AS macro_recall, round(avg(f1), 9) AS macro_f1 FROM pm2""")
def q_macro_metrics(spark, sf_dir):
    pred, classes = _quality_predictions(spark, sf_dir)
    mm = M.macro_metrics(M.class_metrics(pred, classes))
    return mm.select("n_classes", *[_r9(F.col(c)).alias(c) for c in
                                    ("macro_precision", "macro_recall", "macro_f1")])


# --- F8: replication study ----------------------------------------------------

@register("replication_study", f"""WITH {S.LANG_DOCS},
train AS (SELECT * FROM docs WHERE fold <> 0),
test AS (SELECT * FROM docs WHERE fold = 0),
{S.multinomial_model()},
factors AS (SELECT unnest([{', '.join(str(f) for f in FACTORS)}]) AS factor),
cf AS (SELECT f.factor, c.label, c.label_idx, c.prior_q,
         {S.fixed('1.0e0 / (f.factor * c.n_tokens + 1.0e0 * c.v)')} AS default_q
       FROM factors f CROSS JOIN cstats c),
lf AS (SELECT f.factor, k.label, k.term,
         {S.fixed('(f.factor * k.cnt + 1.0e0) / (f.factor * c.n_tokens + 1.0e0 * c.v)')} AS ll_q
       FROM factors f CROSS JOIN kept k JOIN cstats c USING (label)),
te_tok AS (SELECT doc_id, unnest({S.tokens('text')}) AS term FROM test),
te_tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM te_tok
          WHERE term IN (SELECT term FROM vocab) GROUP BY ALL),
sc AS (
  SELECT p.factor, t.doc_id, t.label, p.label AS cls, p.label_idx,
    (p.prior_q + coalesce(sum(tf.tf * coalesce(l.ll_q, p.default_q)), 0))::BIGINT AS score_q
  FROM test t CROSS JOIN cf p LEFT JOIN te_tf tf ON tf.doc_id = t.doc_id
  LEFT JOIN lf l ON l.factor = p.factor AND l.label = p.label AND l.term = tf.term
  GROUP BY p.factor, t.doc_id, t.label, p.label, p.label_idx, p.prior_q),
bst AS (SELECT *, row_number() OVER (PARTITION BY factor, doc_id ORDER BY score_q DESC NULLS LAST, label_idx) AS rk
        FROM sc)
SELECT factor::BIGINT AS factor, (factor * (SELECT count(*) FROM train))::BIGINT AS n_train,
  (factor * count(*))::BIGINT AS n_test,
  round(sum(CASE WHEN cls = label THEN 1 ELSE 0 END)::DOUBLE / count(*), 9) AS accuracy
FROM bst WHERE rk = 1 GROUP BY factor""")
def q_replication_study(spark, sf_dir):
    docs = lang_docs(spark, sf_dir)
    model = fit_multinomial(docs.filter(F.col("fold") != TEST_FOLD), alpha=ALPHA)
    out = replication_study(model, docs.filter(F.col("fold") == TEST_FOLD), ["doc_id"], FACTORS)
    return out.withColumn("accuracy", _r9(F.col("accuracy")))
