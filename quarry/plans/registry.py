"""All registered queries: batch bindings plus streaming and ML ones."""

from __future__ import annotations


def _load():
    import quarry.ml.bindings  # noqa: F401
    import quarry.streaming.bindings  # noqa: F401
    from quarry.plans import bindings
    return bindings


def all_queries():
    return dict(_load().QUERIES)


def all_oracle_sql():
    return dict(_load().ORACLE_SQL)
