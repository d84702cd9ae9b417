"""Row predicates used by quality rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_all_upper(c: Column | str) -> Column:
    """The text equals its upper-case form and is longer than one character."""
    return (_col(c) == F.upper(_col(c))) & (F.length(_col(c)) > 1)


def is_all_lower(c: Column | str) -> Column:
    return (_col(c) == F.lower(_col(c))) & (F.length(_col(c)) > 1)
