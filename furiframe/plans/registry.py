"""All registered queries and their DuckDB oracle formulations."""

from __future__ import annotations

from furiframe.plans import annotate_queries, corpus_queries, dataset_queries, eval_queries, image_queries

_MODULES = (corpus_queries, eval_queries, dataset_queries, annotate_queries, image_queries)


def all_queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.ORACLES)
    return out
