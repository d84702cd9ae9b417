"""Calendar: daily date series (G1), calendar dimension (G2), insert-if-absent
by key (K7)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DAY_NAMES_EN, MONTH_NAMES_EN, date_parts


def _lit_date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return F.to_date(d)
    return F.lit(d if isinstance(d, str) else d.isoformat()).cast("date")


def date_series(spark: SparkSession, start: dt.date | str, end: dt.date | str,
                name: str = "full_date") -> DataFrame:
    """G1: one row per day from ``start`` to ``end``, both included.

    Built on ``spark.range`` so the days are spread over partitions instead of
    being exploded from one array in one task.
    """
    s = dt.date.fromisoformat(start) if isinstance(start, str) else start
    e = dt.date.fromisoformat(end) if isinstance(end, str) else end
    days = (e - s).days + 1
    if days <= 0:
        return spark.range(0).select(F.lit(None).cast("date").alias(name))
    return spark.range(days).select(F.date_add(F.lit(s.isoformat()).cast("date"),
                                               F.col("id").cast("int")).alias(name))


def date_series_between(bounds: DataFrame, start_col: str, end_col: str,
                        name: str = "full_date") -> DataFrame:
    """G1 over bounds computed by Spark (a one-row DataFrame): no driver
    round trip.  A calendar spans years, not rows, so the exploded sequence is
    bounded by the date span."""
    return bounds.select(F.explode(F.sequence(F.to_date(start_col), F.to_date(end_col),
                                              F.expr("interval 1 day"))).alias(name))


def calendar_from_dates(days: DataFrame, date_col: str = "full_date",
                        month_names: Sequence[str] = MONTH_NAMES_EN,
                        day_names: Sequence[str] = DAY_NAMES_EN) -> DataFrame:
    """The calendar dimension row of each date."""
    parts = date_parts(date_col, month_names, day_names)
    return days.select(*[v.alias(k) for k, v in parts.items()])


def calendar_dimension(spark: SparkSession, start: dt.date | str, end: dt.date | str,
                       month_names: Sequence[str] = MONTH_NAMES_EN,
                       day_names: Sequence[str] = DAY_NAMES_EN) -> DataFrame:
    """G2 between literal bounds (the reference's calendar is 2019-2026)."""
    return calendar_from_dates(date_series(spark, start, end), "full_date",
                               month_names, day_names)


def calendar_spanning(df: DataFrame, date_col: str, whole_years: bool = True,
                      month_names: Sequence[str] = MONTH_NAMES_EN,
                      day_names: Sequence[str] = DAY_NAMES_EN) -> DataFrame:
    """G2 over the span of a date column of ``df``, widened to whole years."""
    d = F.to_date(F.col(date_col))
    lo, hi = F.min(d), F.max(d)
    if whole_years:
        lo, hi = F.trunc(lo, "year"), F.date_sub(F.add_months(F.trunc(hi, "year"), 12), 1)
    bounds = df.agg(lo.alias("_lo"), hi.alias("_hi"))
    return calendar_from_dates(date_series_between(bounds, "_lo", "_hi"), "full_date",
                               month_names, day_names)


def insert_if_absent(existing: DataFrame, new: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """K7: rows of ``new`` whose key is not in ``existing`` (and each key once),
    i.e. what ``INSERT ... ON CONFLICT (key) DO NOTHING`` adds."""
    key_cols = list(key_cols)
    fresh = new.dropDuplicates(key_cols)
    return fresh.join(existing.select(*key_cols), key_cols, "left_anti")
