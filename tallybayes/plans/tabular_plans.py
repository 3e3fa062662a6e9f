"""Categorical Naive Bayes plans over lineitem (label l_returnflag)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybayes.operators.model import fit_categorical
from tallybayes.operators.tabular import (
    TabularSpec,
    attribute_domains,
    bin_features,
    column_minmax,
    feature_vocabulary,
    long_minmax,
    raw_features,
    row_hash,
    tabular_vectorize,
)
from tallybayes.operators.scoring import ROW
from tallybayes.plans import sql as S
from tallybayes.plans.fixtures import (
    ALPHA,
    LINEITEM_ATTRS,
    LINEITEM_CONTINUOUS,
    LINEITEM_ID,
    LINEITEM_ROW,
    N_BINS,
    TEST_FOLD,
    lineitem_rows,
)

QUERIES: dict = {}
ORACLE: dict = {}

SPEC = TabularSpec(id_cols=LINEITEM_ROW, attrs=LINEITEM_ATTRS, continuous=LINEITEM_CONTINUOUS,
                   label_col="label", n_bins=N_BINS)
IDS = ", ".join(LINEITEM_ID)
ROW = ", ".join(LINEITEM_ROW)


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _r9(c):
    return F.round(c, 9)


def _bin_sql(v: str, lo: str, hi: str, n: int = N_BINS) -> str:
    return (f"('bin' || CAST(CASE WHEN {hi} <= {lo} THEN 0 ELSE "
            f"trunc(least(greatest(({v} - {lo}) / ({hi} - {lo}) * {n}, 0.0e0), {float(n - 1)}e0))::INTEGER END AS VARCHAR))")


def _feature_sql() -> str:
    mm = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in LINEITEM_CONTINUOUS)
    bins = ", ".join(f"{_bin_sql(c, 'lo_' + c, 'hi_' + c)} AS {c}" for c in LINEITEM_CONTINUOUS)
    unions = "\n  UNION ALL ".join(
        f"SELECT {ROW}, label, fold, {i}::BIGINT AS attr, CAST({c} AS VARCHAR) AS value FROM binned"
        for i, c in enumerate(LINEITEM_ATTRS))
    cat = [c for c in LINEITEM_ATTRS if c not in LINEITEM_CONTINUOUS]
    return f"""li AS (SELECT {ROW}, l_returnflag AS label, {', '.join(LINEITEM_ATTRS)},
       {S.fold_of(*LINEITEM_ID)} AS fold FROM lineitem),
mm AS (SELECT {mm} FROM li WHERE fold <> 0),
binned AS (SELECT {ROW}, label, fold, {', '.join(cat)}, {bins} FROM li CROSS JOIN mm),
feats AS ({unions}),
trf AS (SELECT * FROM feats WHERE fold <> 0),
tef AS (SELECT * FROM feats WHERE fold = 0)"""


def _model_sql() -> str:
    return f"""{_feature_sql()},
nc AS (SELECT label, count(*)::BIGINT AS n_rows FROM li WHERE fold <> 0 GROUP BY label),
ntot AS (SELECT sum(n_rows)::BIGINT AS n FROM nc),
cls AS (SELECT nc.label, (row_number() OVER (ORDER BY nc.label) - 1)::BIGINT AS label_idx, nc.n_rows, ntot.n,
          {S.lnv('nc.n_rows / ntot.n')} AS log_prior, {S.fixed('nc.n_rows / ntot.n')} AS prior_q,
          {S.lnv('1.0e0 / (nc.n_rows + 1.0e0)')} AS log_default
        FROM nc CROSS JOIN ntot),
cnts AS (SELECT label, attr, value, count(*)::BIGINT AS cnt FROM trf GROUP BY ALL),
dom AS (SELECT attr, count(DISTINCT value)::BIGINT AS n_values FROM trf GROUP BY attr),
fv AS (SELECT DISTINCT attr, value FROM trf),
dense AS (
  SELECT c.label, c.label_idx, fv.attr, fv.value, coalesce(k.cnt, 0)::BIGINT AS cnt,
         (coalesce(k.cnt, 0) + 1.0e0) / (c.n_rows + 1.0e0 * d.n_values) AS p
  FROM cls c CROSS JOIN fv JOIN dom d ON d.attr = fv.attr
  LEFT JOIN cnts k ON k.label = c.label AND k.attr = fv.attr AND k.value = fv.value),
dense2 AS (SELECT *, {S.lnv('p')} AS log_likelihood, {S.fixed('p')} AS ll_q FROM dense)"""


def _cat_split(spark, sf_dir):
    """Long binned features of every row, bounds from the train rows only."""
    rows = lineitem_rows(spark, sf_dir)
    return split_features(rows, SPEC)


def split_features(rows, spec, markers: bool = False):
    """Long binned features of the train and of the test rows (``label``, ``fold``), each with a marker
    per instance if asked for, and with the hash that tells rows of one id apart."""
    rows = rows.withColumn(ROW, row_hash(spec))
    keep = ["label", "fold", ROW]
    raw = raw_features(rows, spec, keep=keep, markers=markers)
    bounds = long_minmax(raw_features(rows.filter(F.col("fold") != TEST_FOLD), spec, attrs=spec.continuous), spec) \
        if spec.continuous else None
    feats = bin_features(raw, bounds, spec, keep=keep)
    return feats.filter(F.col("fold") != TEST_FOLD), feats.filter(F.col("fold") == TEST_FOLD)


def _cat_model(spark, sf_dir):
    trf, tef = split_features(lineitem_rows(spark, sf_dir), SPEC, markers=True)
    return fit_categorical(trf, alpha=ALPHA), tef


@register("column_minmax", f"""WITH {_feature_sql()}
""" + "\nUNION ALL ".join(
    f"SELECT {SPEC.attr_index(c)}::BIGINT AS attr, '{c}' AS name, lo_{c} AS lo, hi_{c} AS hi FROM mm"
    for c in LINEITEM_CONTINUOUS))
def q_column_minmax(spark, sf_dir):
    rows = lineitem_rows(spark, sf_dir)
    return column_minmax(rows.filter(F.col("fold") != TEST_FOLD), SPEC)


@register("discretize", f"""WITH {_feature_sql()}
SELECT {IDS}, attr, value FROM feats WHERE attr > 0""")
def q_discretize(spark, sf_dir):
    """Continuous attributes of every row binned with train-only bounds."""
    trf, tef = _cat_split(spark, sf_dir)
    cont = [SPEC.attr_index(c) for c in LINEITEM_CONTINUOUS]
    return trf.union(tef).filter(F.col("attr").isin(cont)).select(*LINEITEM_ID, "attr", "value")


@register("tabular_features", f"""WITH {_feature_sql()}
SELECT {IDS}, label, attr, value FROM feats""")
def q_tabular_features(spark, sf_dir):
    trf, tef = _cat_split(spark, sf_dir)
    return trf.union(tef).select(*LINEITEM_ID, "label", "attr", "value")


@register("feature_vocabulary", f"""WITH {_feature_sql()}
SELECT attr, value, (row_number() OVER (ORDER BY attr, value) - 1)::BIGINT AS idx
FROM (SELECT DISTINCT attr, value FROM trf)""")
def q_feature_vocabulary(spark, sf_dir):
    trf, _ = _cat_split(spark, sf_dir)
    return feature_vocabulary(trf).select("attr", "value", "idx")


@register("attribute_domains", f"""WITH {_feature_sql()}
SELECT attr, count(DISTINCT value)::BIGINT AS n_values FROM trf GROUP BY attr""")
def q_attribute_domains(spark, sf_dir):
    trf, _ = _cat_split(spark, sf_dir)
    return attribute_domains(trf)


@register("tabular_vectorize", f"""WITH {_feature_sql()},
v AS (SELECT attr, value, (row_number() OVER (ORDER BY attr, value) - 1)::BIGINT AS idx
      FROM (SELECT DISTINCT attr, value FROM trf))
SELECT {IDS}, attr, idx FROM tef JOIN v USING (attr, value)""")
def q_tabular_vectorize(spark, sf_dir):
    trf, tef = _cat_split(spark, sf_dir)
    return tabular_vectorize(tef, feature_vocabulary(trf), LINEITEM_ID)


@register("cat_feature_counts", f"""WITH {_feature_sql()}
SELECT label, attr, value, count(*)::BIGINT AS cnt FROM trf GROUP BY ALL""")
def q_cat_feature_counts(spark, sf_dir):
    trf, _ = _cat_split(spark, sf_dir)
    return trf.groupBy("label", "attr", "value").agg(F.count(F.lit(1)).alias("cnt"))


@register("cat_class_stats", f"""WITH {_model_sql()}
SELECT label, label_idx, n_rows, round(log_prior, 9) AS log_prior, round(log_default, 9) AS log_default
FROM cls""")
def q_cat_class_stats(spark, sf_dir):
    m, _ = _cat_model(spark, sf_dir)
    return m.class_stats.select("label", F.col("label_idx").cast("bigint").alias("label_idx"),
                                "n_rows", _r9(F.col("log_prior")).alias("log_prior"),
                                _r9(F.col("log_default")).alias("log_default"))


@register("cat_log_likelihood", f"""WITH {_model_sql()}
SELECT label, attr, value, cnt, round(log_likelihood, 9) AS log_likelihood FROM dense2""")
def q_cat_log_likelihood(spark, sf_dir):
    m, _ = _cat_model(spark, sf_dir)
    return m.log_likelihood().select("label", "attr", "value", "cnt",
                                     _r9(F.col("log_likelihood")).alias("log_likelihood"))


@register("cat_predict", f"""WITH {_model_sql()},
te AS (SELECT * FROM li WHERE fold = 0),
sc AS (
  SELECT {', '.join('t.' + c for c in LINEITEM_ROW)}, t.label, c.label AS cls, c.label_idx,
         (c.prior_q + coalesce(sum(d.ll_q), 0))::BIGINT AS score_q
  FROM te t CROSS JOIN cls c
  LEFT JOIN tef f ON {' AND '.join(f'f.{k} = t.{k}' for k in LINEITEM_ROW)}
  LEFT JOIN dense2 d ON d.label = c.label AND d.attr = f.attr AND d.value = f.value
  GROUP BY {', '.join('t.' + c for c in LINEITEM_ROW)}, t.label, c.label, c.label_idx, c.prior_q),
r AS (SELECT *, row_number() OVER (PARTITION BY {ROW} ORDER BY score_q DESC NULLS LAST, label_idx) AS rk FROM sc)
SELECT {IDS}, label, cls AS prediction, {S.from_fixed('score_q')} AS score FROM r WHERE rk = 1""")
def q_cat_predict(spark, sf_dir):
    m, tef = _cat_model(spark, sf_dir)
    out = m.transform(tef, None, LINEITEM_ROW, keep=["label"])
    return out.select(*LINEITEM_ID, "label", "prediction", "score")
