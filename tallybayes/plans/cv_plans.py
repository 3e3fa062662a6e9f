"""Cross-validation plans: text (lang, 5 folds) and tabular (lineitem, 6 folds).

The Spark plans count once and derive each fold's model by subtraction (text)
or bin per held-out fold in-task (tabular); the SQL oracles retrain per fold.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybayes.operators import metrics as M
from tallybayes.operators.datasets import DatasetSpec
from tallybayes.operators.sampling import hash_fold
from tallybayes.operators.validation import (
    cross_validate_categorical,
    cross_validate_multinomial,
    fold_accuracy,
    mean_std,
)
from tallybayes.plans import sql as S
from tallybayes.plans.fixtures import (
    ALPHA,
    K,
    K_TAB,
    LINEITEM_ATTRS,
    LINEITEM_CONTINUOUS,
    LINEITEM_ID,
    LINEITEM_ROW,
    N_BINS,
    SEED,
    lang_docs,
    table,
)
from tallybayes.operators.tabular import TabularSpec
from tallybayes.plans.tabular_plans import SPEC, _bin_sql
from tallybayes.session import scratch_dir

QUERIES: dict = {}
ORACLE: dict = {}
IDS = ", ".join(LINEITEM_ROW)


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _r(c, d=9):
    return F.round(c, d)


_TEXT_CV = f"""WITH {S.LANG_DOCS},
folds AS (SELECT unnest(range({K}))::BIGINT AS f),
train AS (SELECT g.f, d.doc_id, d.label, d.text FROM docs d JOIN folds g ON d.fold <> g.f),
tr_tok AS (SELECT f, doc_id, label, unnest({S.tokens('text')}) AS term FROM train),
ct AS (SELECT f, label, term, count(*)::BIGINT AS cnt FROM tr_tok GROUP BY ALL),
vocab AS (SELECT DISTINCT f, term FROM ct),
vsize AS (SELECT f, count(*)::BIGINT AS v FROM vocab GROUP BY f),
nc AS (SELECT f, label, count(*)::BIGINT AS n_docs FROM train GROUP BY ALL),
ntot AS (SELECT f, sum(n_docs)::BIGINT AS n FROM nc GROUP BY f),
tot AS (SELECT f, label, sum(cnt)::BIGINT AS n_tokens FROM ct GROUP BY ALL),
labs AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::BIGINT AS label_idx
         FROM (SELECT DISTINCT label FROM docs)),
cstats AS (
  SELECT g.f, l.label, l.label_idx, coalesce(nc.n_docs, 0)::BIGINT AS n_docs,
         coalesce(t.n_tokens, 0)::BIGINT AS n_tokens, vs.v, nt.n
  FROM folds g CROSS JOIN labs l
  LEFT JOIN nc ON nc.f = g.f AND nc.label = l.label
  LEFT JOIN tot t ON t.f = g.f AND t.label = l.label
  JOIN vsize vs ON vs.f = g.f JOIN ntot nt ON nt.f = g.f),
cq AS (SELECT *, {S.fixed('n_docs / n')} AS prior_q,
              {S.fixed('1.0e0 / (n_tokens + 1.0e0 * v)')} AS default_q FROM cstats),
llq AS (SELECT k.f, k.label, k.term, {S.fixed('(k.cnt + 1.0e0) / (c.n_tokens + 1.0e0 * c.v)')} AS ll_q
        FROM ct k JOIN cq c ON c.f = k.f AND c.label = k.label),
te_tok AS (SELECT fold AS f, doc_id, unnest({S.tokens('text')}) AS term FROM docs),
te_tf AS (SELECT t.f, t.doc_id, t.term, count(*)::BIGINT AS tf
          FROM te_tok t JOIN vocab v ON v.f = t.f AND v.term = t.term GROUP BY ALL),
sc AS (
  SELECT c.f, d.doc_id, d.label, c.label AS cls, c.label_idx,
         (c.prior_q + coalesce(sum(tf.tf * coalesce(l.ll_q, c.default_q)), 0))::BIGINT AS score_q
  FROM docs d JOIN cq c ON c.f = d.fold
  LEFT JOIN te_tf tf ON tf.f = d.fold AND tf.doc_id = d.doc_id
  LEFT JOIN llq l ON l.f = c.f AND l.label = c.label AND l.term = tf.term
  GROUP BY c.f, d.doc_id, d.label, c.label, c.label_idx, c.prior_q),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score_q DESC NULLS LAST, label_idx) AS rk
      FROM sc),
pred AS (SELECT f AS fold, doc_id, label, cls AS prediction FROM r WHERE rk = 1),
acc AS (SELECT fold::BIGINT AS fold, count(*)::BIGINT AS n,
          sum(CASE WHEN label = prediction THEN 1 ELSE 0 END)::BIGINT AS n_correct FROM pred GROUP BY fold),
acc2 AS (SELECT *, n_correct::DOUBLE / n AS accuracy FROM acc)"""


def _text_cv(spark, sf_dir):
    return cross_validate_multinomial(lang_docs(spark, sf_dir), ["doc_id"], K, alpha=ALPHA)


@register("cv_accuracy", _TEXT_CV + "\nSELECT fold, n, n_correct, round(accuracy, 9) AS accuracy FROM acc2")
def q_cv_accuracy(spark, sf_dir):
    """5-fold CV of the text model (lang): accuracy per fold."""
    return fold_accuracy(_text_cv(spark, sf_dir)).withColumn("accuracy", _r(F.col("accuracy")))


@register("cv_summary", _TEXT_CV + """
SELECT count(*)::BIGINT AS folds, round(avg(accuracy), 9) AS mean_accuracy,
       round(coalesce(stddev_pop(accuracy), 0.0e0), 9) AS std_accuracy FROM acc2""")
def q_cv_summary(spark, sf_dir):
    s = mean_std(fold_accuracy(_text_cv(spark, sf_dir)))
    return s.select(F.col("folds").cast("bigint").alias("folds"),
                    _r(F.col("mean")).alias("mean_accuracy"), _r(F.col("std")).alias("std_accuracy"))


def _tab_cv_sql(source: str = "", row: list | None = None, attrs: list | None = None,
                continuous: list | None = None, k: int = K_TAB) -> str:
    """Per-fold retraining oracle for tabular CV.  ``source`` selects
    ``row…, label, attrs…, fold`` as CTE ``li``; defaults to lineitem."""
    row = row or LINEITEM_ROW
    attrs = attrs or LINEITEM_ATTRS
    continuous = LINEITEM_CONTINUOUS if continuous is None else continuous
    if not source:
        source = f"""SELECT {', '.join(row)}, l_returnflag AS label, {', '.join(attrs)},
       {S.fold_of(*LINEITEM_ID, k=k)} AS fold FROM lineitem"""
    ids = ", ".join(row)
    mm = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in continuous)
    cat = [c for c in attrs if c not in continuous]
    bins = ", ".join(f"{_bin_sql(c, 'lo_' + c, 'hi_' + c, N_BINS)} AS {c}" for c in continuous)
    keep = ", ".join(cat + ([bins] if bins else []))
    unions = "\n  UNION ALL ".join(
        f"SELECT {ids}, label, h, is_test, {i}::BIGINT AS attr, CAST({c} AS VARCHAR) AS value FROM binned"
        for i, c in enumerate(attrs))
    on_ids = " AND ".join(f"f.{c} = t.{c}" for c in row)
    t_ids = ", ".join(f"t.{c}" for c in row)
    return f"""WITH li AS ({source}),
folds AS (SELECT unnest(range({k}))::BIGINT AS h),
mm AS (SELECT g.h, {mm} FROM li JOIN folds g ON li.fold <> g.h GROUP BY g.h),
rows_h AS (SELECT li.*, g.h, (CASE WHEN li.fold = g.h THEN 1 ELSE 0 END) AS is_test FROM li CROSS JOIN folds g),
binned AS (SELECT {ids}, label, h, is_test, {keep} FROM rows_h JOIN mm USING (h)),
feats AS ({unions}),
trf AS (SELECT * FROM feats WHERE is_test = 0),
tef AS (SELECT * FROM feats WHERE is_test = 1),
nc AS (SELECT h, label, count(*)::BIGINT AS n_rows FROM rows_h WHERE is_test = 0 GROUP BY ALL),
labs AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::BIGINT AS label_idx
         FROM (SELECT DISTINCT label FROM li)),
cls AS (SELECT g.h, l.label, l.label_idx, coalesce(nc.n_rows, 0)::BIGINT AS n_rows
        FROM folds g CROSS JOIN labs l LEFT JOIN nc ON nc.h = g.h AND nc.label = l.label),
cq AS (SELECT *, {S.fixed('n_rows / (sum(n_rows) OVER (PARTITION BY h))')} AS prior_q FROM cls),
cnts AS (SELECT h, label, attr, value, count(*)::BIGINT AS cnt FROM trf GROUP BY ALL),
dom AS (SELECT h, attr, count(DISTINCT value)::BIGINT AS n_values FROM trf GROUP BY ALL),
fv AS (SELECT DISTINCT h, attr, value FROM trf),
dense AS (
  SELECT c.h, c.label, fv.attr, fv.value,
         {S.fixed('(coalesce(k.cnt, 0) + 1.0e0) / (c.n_rows + 1.0e0 * d.n_values)')} AS ll_q
  FROM cq c JOIN fv ON fv.h = c.h JOIN dom d ON d.h = fv.h AND d.attr = fv.attr
  LEFT JOIN cnts k ON k.h = c.h AND k.label = c.label AND k.attr = fv.attr AND k.value = fv.value),
sc AS (
  SELECT t.h, {t_ids}, t.label, c.label AS cls, c.label_idx,
         (c.prior_q + coalesce(sum(d.ll_q), 0))::BIGINT AS score_q
  FROM (SELECT * FROM rows_h WHERE is_test = 1) t JOIN cq c ON c.h = t.h
  LEFT JOIN tef f ON f.h = t.h AND {on_ids}
  LEFT JOIN dense d ON d.h = c.h AND d.label = c.label AND d.attr = f.attr AND d.value = f.value
  GROUP BY t.h, {t_ids}, t.label, c.label, c.label_idx, c.prior_q),
r AS (SELECT *, row_number() OVER (PARTITION BY {ids} ORDER BY score_q DESC NULLS LAST, label_idx) AS rk
      FROM sc),
pred AS (SELECT h AS fold, {ids}, label, cls AS prediction FROM r WHERE rk = 1),
acc AS (SELECT fold::BIGINT AS fold, count(*)::BIGINT AS n,
          sum(CASE WHEN label = prediction THEN 1 ELSE 0 END)::BIGINT AS n_correct FROM pred GROUP BY fold),
acc2 AS (SELECT *, n_correct::DOUBLE / n AS accuracy FROM acc),
per AS (
  SELECT l.label,
    sum(CASE WHEN p.label = l.label AND p.prediction = l.label THEN 1 ELSE 0 END) AS tp,
    sum(CASE WHEN p.prediction = l.label THEN 1 ELSE 0 END) AS npred,
    sum(CASE WHEN p.label = l.label THEN 1 ELSE 0 END) AS nact
  FROM labs l CROSS JOIN pred p GROUP BY l.label),
pm AS (SELECT label, CASE WHEN npred > 0 THEN tp::DOUBLE / npred ELSE 0.0e0 END AS precision,
              CASE WHEN nact > 0 THEN tp::DOUBLE / nact ELSE 0.0e0 END AS recall FROM per),
pm2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                  ELSE 0.0e0 END AS f1 FROM pm)"""


def _tab_cv(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(*LINEITEM_ROW, F.col("l_returnflag").alias("label"), *LINEITEM_ATTRS,
                     hash_fold(LINEITEM_ID, K_TAB, SEED).alias("fold"))
    return cross_validate_categorical(rows, SPEC, K_TAB, alpha=ALPHA)


@register("cv_categorical", _tab_cv_sql() + "\nSELECT fold, n, n_correct, round(accuracy, 9) AS accuracy FROM acc2")
def q_cv_categorical(spark, sf_dir):
    """6-fold CV of the categorical model on lineitem: accuracy per fold."""
    return fold_accuracy(_tab_cv(spark, sf_dir)).withColumn("accuracy", _r(F.col("accuracy")))


@register("cv_categorical_report", _tab_cv_sql() + f"""
SELECT (SELECT count(*) FROM li)::BIGINT AS n_instances, (SELECT count(*) FROM labs)::BIGINT AS n_classes,
  {K_TAB}::BIGINT AS folds,
  (SELECT round(avg(accuracy), 4) FROM acc2) AS acc_mean,
  (SELECT round(coalesce(stddev_pop(accuracy), 0.0e0), 4) FROM acc2) AS acc_std,
  round(avg(precision), 4) AS macro_precision, round(avg(recall), 4) AS macro_recall,
  round(avg(f1), 4) AS macro_f1 FROM pm2""")
def q_cv_categorical_report(spark, sf_dir):
    """Results row: per-fold accuracy averaged, P/R/F1 pooled over all folds."""
    # one aggregation of the predictions; every figure comes from this table
    cm = M.confusion_counts(_tab_cv(spark, sf_dir), by=["fold"]).persist()
    cm.count()  # folds x classes^2 rows at most: computed once, read by every figure
    labels = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"))
    acc = mean_std(fold_accuracy(cm, weight="n"))
    macro = M.macro_metrics(M.class_metrics(cm, labels, weight="n"))
    n = cm.select(F.sum("n")).scalar()
    return acc.join(macro, how="inner").select(
        n.cast("bigint").alias("n_instances"), F.col("n_classes").cast("bigint").alias("n_classes"),
        F.col("folds").cast("bigint").alias("folds"),
        _r(F.col("mean"), 4).alias("acc_mean"), _r(F.col("std"), 4).alias("acc_std"),
        _r(F.col("macro_precision"), 4).alias("macro_precision"),
        _r(F.col("macro_recall"), 4).alias("macro_recall"),
        _r(F.col("macro_f1"), 4).alias("macro_f1"))


# --- many continuous attributes: embeddings (64 floats, labels 0-9) ----------

EMB_DIM = 64
EMB_ATTRS = [f"e{i}" for i in range(EMB_DIM)]
EMB_SPEC = TabularSpec(id_cols=["vec_id"], attrs=EMB_ATTRS, continuous=EMB_ATTRS,
                       label_col="label", n_bins=N_BINS)
_EMB_SOURCE = ("SELECT vec_id, CAST(label AS VARCHAR) AS label, "
               + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(EMB_DIM))
               + f", {S.fold_of('vec_id', k=K_TAB)} AS fold FROM embeddings")


@register("cv_embeddings", _tab_cv_sql(_EMB_SOURCE, ["vec_id"], EMB_ATTRS, EMB_ATTRS)
          + "\nSELECT fold, n, n_correct, round(accuracy, 9) AS accuracy FROM acc2")
def q_cv_embeddings(spark, sf_dir):
    """6-fold categorical CV on embeddings: 64 continuous attributes, 5 bins each."""
    emb = table(spark, sf_dir, "embeddings")
    rows = emb.select("vec_id", F.col("label").cast("string").alias("label"),
                      *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(EMB_DIM)],
                      hash_fold("vec_id", K_TAB, SEED).alias("fold"))
    pred = cross_validate_categorical(rows, EMB_SPEC, K_TAB, alpha=ALPHA)
    return fold_accuracy(pred).withColumn("accuracy", _r(F.col("accuracy")))


# --- dataset specs: two attribute files, one of them without continuous attributes ----------

ITEMS_SPEC = DatasetSpec("items", label="last", continuous=(1, 2, 3))
ORDERS_SPEC = DatasetSpec("orders", label="first", classes=("F", "O"))
_ITEMS_FIELDS = ["l_linestatus", "CAST(l_quantity AS BIGINT)", "CAST(round(l_extendedprice * 100) AS BIGINT)",
                 "CAST(round(l_discount * 100) AS BIGINT)"]
_ORDERS_FIELDS = ["o_orderpriority", "o_custkey % 7", "o_orderkey % 5"]


def _fields_sql(table_name: str, label: str, fields: list, label_first: bool, classes: tuple | None) -> str:
    """Rows of a spec in DuckDB: fields as text for the fold, numbers as doubles."""
    names = [f"a{i}" for i in range(len(fields))]
    cast = ", ".join(f"CAST({f} AS VARCHAR) AS {n}" for f, n in zip(fields, names))
    keep = "" if classes is None else f"WHERE {label} IN ({', '.join(repr(c) for c in classes)})"
    return f"SELECT row_number() OVER () AS rid, {label} AS label, {cast} FROM {table_name} {keep}"


def _report_sql(spec: DatasetSpec, source: str, n: int) -> str:
    names = [f"a{i}" for i in range(n)]
    typed = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if i in spec.continuous else c for i, c in enumerate(names))
    rows = f"SELECT rid, label, {typed}, {S.fold_of('label', *names, k=K_TAB)} AS fold FROM ({source})"
    return _tab_cv_sql(rows, ["rid"], names, [names[i] for i in spec.continuous]) + f"""
SELECT '{spec.name}' AS dataset, (SELECT count(*) FROM li)::BIGINT AS n_instances, (SELECT count(*) FROM labs)::BIGINT AS n_classes,
  {K_TAB}::BIGINT AS folds, (SELECT round(avg(accuracy), 4) FROM acc2) AS acc_mean,
  (SELECT round(coalesce(stddev_pop(accuracy), 0.0e0), 4) FROM acc2) AS acc_std,
  round(avg(precision), 4) AS macro_precision, round(avg(recall), 4) AS macro_recall, round(avg(f1), 4) AS macro_f1 FROM pm2"""


@register("dataset_report", "SELECT * FROM (" + _report_sql(ITEMS_SPEC, _fields_sql("lineitem", "l_returnflag", _ITEMS_FIELDS, False, None), 4)
          + ")\nUNION ALL SELECT * FROM (" + _report_sql(ORDERS_SPEC, _fields_sql(
              "orders", "o_orderstatus", _ORDERS_FIELDS, True, ORDERS_SPEC.classes), 3) + ")")
def q_dataset_report(spark, sf_dir):
    """Lineitem and orders written as attribute lines, read and cross-validated by their specs."""
    out = []
    for spec, name, label, fields in ((ITEMS_SPEC, "lineitem", "l_returnflag", _ITEMS_FIELDS),
                                      (ORDERS_SPEC, "orders", "o_orderstatus", _ORDERS_FIELDS)):
        path = scratch_dir(spark, f"attr-{spec.name}")
        cells = [F.expr(f).cast("string") for f in fields]
        line = [F.col(label), *cells] if spec.label == "first" else [*cells, F.col(label)]
        table(spark, sf_dir, name).select(F.concat_ws(", ", *line).alias("value")).write.text(path)
        out.append(spec.report(spark, path, K_TAB, ALPHA, SEED))
    return out[0].union(out[1])
