"""Composed queries, SQL catalog helpers and the query bindings to the
driver tables."""

from quarry.plans.catalog import (  # noqa: F401
    best_rated_sql, count_by_key_sql, mean_by_key_sql, register_global_view,
    register_views, select_all,
)
from quarry.plans.composed import (  # noqa: F401
    best_rated, count_by_pattern, count_multivalued, mean_with_attributes,
    text_lines, word_count,
)
