"""Dates (G4, F7, F8, F9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month and day names, the default locale of the
# calendar.  Pass another 12 + 7 list for a different language.
MONTH_NAMES_EN = ("January", "February", "March", "April", "May", "June", "July",
                  "August", "September", "October", "November", "December")
DAY_NAMES_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
                "Sunday")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date_col(c: Column | str) -> Column:
    """Any date-like column (date, timestamp, timestamp_ntz, ISO text) to DATE."""
    return F.to_date(_col(c))


def date_key(c: Column | str) -> Column:
    """Integer yyyymmdd; null stays null.  Integer arithmetic, no text."""
    d = to_date_col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def _name_lookup(names: Sequence[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index)


def date_parts(c: Column | str, month_names: Sequence[str] = MONTH_NAMES_EN,
               day_names: Sequence[str] = DAY_NAMES_EN) -> Mapping[str, Column]:
    """Calendar attributes of a date column, ISO weekday 1 = Monday."""
    if len(month_names) != 12 or len(day_names) != 7:
        raise ValueError("need 12 month names and 7 day names")
    d = to_date_col(c)
    iso_dow = F.weekday(d) + 1
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d).cast("smallint"),
        "quarter": F.quarter(d).cast("smallint"),
        "month": F.month(d).cast("smallint"),
        "month_name": _name_lookup(month_names, F.month(d)),
        "day_of_month": F.dayofmonth(d).cast("smallint"),
        "day_of_week": iso_dow.cast("smallint"),
        "day_name": _name_lookup(day_names, iso_dow),
        "is_weekend": iso_dow.isin(6, 7),
    }
