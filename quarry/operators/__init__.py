"""Relational operators over DataFrames (joins, cogroup, aggregates,
ordering / top-k, set operations, sampling and reuse)."""

from quarry.operators.aggregates import (  # noqa: F401
    collect_by_key, count_by_key, count_by_value, count_rows, count_where,
    distinct_key_count, distinct_values, global_max, group_count, group_mean,
    mean_by_key, mean_squared_error, sum_by_key, sum_count_mean, total,
)
from quarry.operators.chunks import grouped_lists  # noqa: F401
from quarry.operators.joins import cogroup, join_by_key, join_split  # noqa: F401
from quarry.operators.partitioning import spread  # noqa: F401
from quarry.operators.ordering import first_row, sort_by, top_n  # noqa: F401
from quarry.operators.sampling import (  # noqa: F401
    coalesce_to,
    persisted, random_split, sample_fraction, sample_n_with_replacement,
    tagged_split,
)
from quarry.operators.setops import (  # noqa: F401
    except_distinct, intersect_distinct, subtract_keep_dups, union_all,
)
