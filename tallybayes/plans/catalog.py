"""All registered plans and oracles."""

from __future__ import annotations

from tallybayes.plans import (
    cv_plans,
    eval_plans,
    source_plans,
    stream_plans,
    tabular_plans,
    text_plans,
)

_MODULES = [text_plans, eval_plans, tabular_plans, cv_plans, source_plans, stream_plans]


def queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
