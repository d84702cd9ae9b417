"""Generic DataFrame operators, parameterised by table and column names."""

from .calendar import (calendar_dimension, calendar_from_dates, calendar_spanning,
                       date_series, date_series_between, insert_if_absent)
from .contract import cast_with_reasons, conform, project
from .keys import assign_dense_key, latest_per_key, mark_repeats, upsert_type1
from .lookups import (FkCheck, Lookup, accepted, fk_audit, orphans,
                      rejected, resolve_keys, resolve_with_reasons, split_resolved,
                      temporal_violations)
from .profile import (batch_ranges, count_rows, distinct_values, duplicate_keys,
                      outside_domain, rate, rule_counts, uniqueness)

__all__ = [
    "FkCheck", "Lookup", "accepted", "assign_dense_key", "cast_with_reasons", "batch_ranges", 
    "calendar_dimension", "calendar_from_dates", "calendar_spanning", "conform",
    "count_rows", "date_series", "date_series_between", "distinct_values",
    "duplicate_keys", "fk_audit", "insert_if_absent", "latest_per_key",
    "mark_repeats", "orphans",
    "outside_domain", "project", "rate", "rejected", "resolve_keys",
    "resolve_with_reasons", "rule_counts", "split_resolved", "temporal_violations",
    "uniqueness", "upsert_type1",
]
