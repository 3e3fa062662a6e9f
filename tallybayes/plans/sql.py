"""SQL oracle fragments (DuckDB dialect) for the query plans.

These are written the plain way — per-token rows, dense per-class lookups,
per-fold retraining — so that they check the Spark plans' algebra (sparse
deltas, in-row bags, one-pass cross-validation) rather than repeat it.
"""

from __future__ import annotations

from tallybayes.plans.fixtures import ALPHA, K, SEED

# The token rule and the split hash, written for DuckDB.
TOKEN_RE = r"[\p{L}\p{N}_]{2,}"


def tokens(col: str) -> str:
    return f"regexp_extract_all(lower({col}), '{TOKEN_RE}')"


def hash_of(*keys: str, seed: int = SEED) -> str:
    parts = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(('0x' || substr(md5('{seed}|' || {parts}), 1, 8))::BIGINT)"


def fold_of(*keys: str, k: int = K, seed: int = SEED) -> str:
    return f"({hash_of(*keys, seed=seed)} % {k})"


def fixed(p: str) -> str:
    """Fixed-point log (1e-9 nat units), NULL for -inf."""
    return f"(CASE WHEN ({p}) > 0 THEN round(ln({p}) * 1e9)::BIGINT END)"


def lnv(p: str) -> str:
    return f"(CASE WHEN ({p}) > 0 THEN ln({p}) ELSE '-inf'::DOUBLE END)"


def from_fixed(q: str) -> str:
    return f"coalesce(({q})::DOUBLE / 1e9, '-inf'::DOUBLE)"


LANG_DOCS = f"""docs AS (
  SELECT doc_id, lang AS label, text, {fold_of('doc_id')} AS fold FROM documents)"""


def quality_docs(target: str = "quality") -> str:
    return f"""docs AS (
  SELECT l.doc_id, CAST(l.{target} AS VARCHAR) AS label, d.text, {fold_of('l.doc_id')} AS fold
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""


def multinomial_model(train: str = "train", min_df: int = 1, alpha: float = ALPHA) -> str:
    """CTEs: vocab(term, df), cstats(label, label_idx, n_docs, n_tokens, v, n,
    log_prior, log_default, prior_q, default_q), llq(label, term, cnt, p, ll_q)."""
    a = repr(float(alpha)) + "e0" if "e" not in repr(float(alpha)) else repr(float(alpha))
    return f"""
tr_tok AS (SELECT doc_id, label, unnest({tokens('text')}) AS term FROM {train}),
tr_tf AS (SELECT doc_id, label, term, count(*) AS tf FROM tr_tok GROUP BY ALL),
ct AS (SELECT label, term, sum(tf)::BIGINT AS cnt, count(*)::BIGINT AS df_c FROM tr_tf GROUP BY ALL),
vocab AS (SELECT term, sum(df_c)::BIGINT AS df FROM ct GROUP BY term HAVING sum(df_c) >= {min_df}),
kept AS (SELECT * FROM ct WHERE term IN (SELECT term FROM vocab)),
vsize AS (SELECT count(*)::BIGINT AS v FROM vocab),
nc AS (SELECT label, count(*)::BIGINT AS n_docs FROM {train} GROUP BY label),
ntot AS (SELECT sum(n_docs)::BIGINT AS n FROM nc),
tot AS (SELECT label, sum(cnt)::BIGINT AS n_tokens FROM kept GROUP BY label),
cls AS (
  SELECT nc.label, (row_number() OVER (ORDER BY nc.label) - 1)::BIGINT AS label_idx, nc.n_docs,
         coalesce(tot.n_tokens, 0)::BIGINT AS n_tokens, vsize.v, ntot.n
  FROM nc CROSS JOIN ntot CROSS JOIN vsize LEFT JOIN tot USING (label)),
cstats AS (
  SELECT *, {lnv('n_docs / n')} AS log_prior, {fixed('n_docs / n')} AS prior_q,
         {lnv(f'{a} / (n_tokens + {a} * v)')} AS log_default,
         {fixed(f'{a} / (n_tokens + {a} * v)')} AS default_q
  FROM cls),
llq AS (
  SELECT k.label, c.label_idx, k.term, k.cnt, (k.cnt + {a}) / (c.n_tokens + {a} * c.v) AS p
  FROM kept k JOIN cstats c USING (label)),
llq2 AS (SELECT *, {lnv('p')} AS log_likelihood, {fixed('p')} AS ll_q FROM llq)"""


def multinomial_scores(test: str = "test") -> str:
    """CTEs after ``multinomial_model``: sc(doc_id, label, cls, label_idx, score_q),
    best(doc_id, label, prediction, score)."""
    return f"""
te_tok AS (SELECT doc_id, unnest({tokens('text')}) AS term FROM {test}),
te_tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM te_tok
          WHERE term IN (SELECT term FROM vocab) GROUP BY ALL),
pairs AS (SELECT t.doc_id, t.label, c.label AS cls, c.label_idx, c.prior_q, c.default_q
          FROM {test} t CROSS JOIN cstats c),
sc AS (
  SELECT p.doc_id, p.label, p.cls, p.label_idx,
         (p.prior_q + coalesce(sum(tf.tf * coalesce(l.ll_q, p.default_q)), 0))::BIGINT AS score_q
  FROM pairs p LEFT JOIN te_tf tf ON tf.doc_id = p.doc_id
  LEFT JOIN llq2 l ON l.label = p.cls AND l.term = tf.term
  GROUP BY p.doc_id, p.label, p.cls, p.label_idx, p.prior_q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score_q DESC NULLS LAST, label_idx) AS rk
  FROM sc),
best AS (SELECT doc_id, label, cls AS prediction, {from_fixed('score_q')} AS score
         FROM ranked WHERE rk = 1)"""
