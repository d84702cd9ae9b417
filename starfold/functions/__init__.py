"""Column -> Column functions.  All are built-in Spark expressions: no UDF,
no I/O, usable in ``select``, ``withColumns`` and SQL alike."""

from .dates import date_key, date_parts, to_date_col
from .text import (
    first_letter,
    label_to_bool,
    map_with_fallback,
    normalize_city,
    normalize_sex,
    strip_ws,
    title_case,
)
from .predicates import is_all_lower, is_all_upper

__all__ = [
    "date_key", "date_parts", "first_letter", "is_all_lower",
    "is_all_upper", "label_to_bool", "map_with_fallback", "normalize_city",
    "normalize_sex", "strip_ws", "title_case", "to_date_col",
]
