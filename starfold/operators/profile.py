"""Profiling aggregates: counts (A1), conditional counts in one pass (A2),
uniqueness (A3, D2), distinct values (A4), batch key ranges (A5), rates (A6),
domain subset test (O2)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import AT, PART, in_order


def count_rows(df: DataFrame) -> DataFrame:
    """A1: one row, ``total``."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("total"))


def rule_counts(df: DataFrame, predicates: Mapping[str, Column | str]) -> DataFrame:
    """A2: every predicate counted in ONE aggregate (one scan), plus the
    total.  A predicate that is null counts as passing, as in SQL WHERE."""
    aggs = [F.count(F.lit(1)).cast("long").alias("total")]
    for name, p in predicates.items():
        pred = F.expr(p) if isinstance(p, str) else p
        aggs.append(F.count_if(F.coalesce(pred, F.lit(False))).cast("long").alias(name))
    return df.agg(*aggs)


def uniqueness(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Total rows, distinct keys, keys seen more than once and the
    rows beyond the first of each key.  One shuffle on the key, with a
    map-side partial count, so a hot key is combined before the shuffle."""
    per_key = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_sf_c"))
    return per_key.agg(
        F.coalesce(F.sum("_sf_c"), F.lit(0)).cast("long").alias("total"),
        F.count(F.lit(1)).cast("long").alias("distinct_keys"),
        F.count_if(F.col("_sf_c") > 1).cast("long").alias("duplicated_keys"),
        F.coalesce(F.sum(F.col("_sf_c") - 1), F.lit(0)).cast("long").alias("extra_rows"))


def duplicate_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """D2 offenders: each key seen more than once with its count."""
    return (df.groupBy(*key_cols).agg(F.count(F.lit(1)).cast("long").alias("n"))
            .filter(F.col("n") > 1))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A4."""
    return df.select(col).distinct()


def outside_domain(df: DataFrame, col: str, allowed: Iterable, keep_null: bool = True
                   ) -> DataFrame:
    """O2 / D3: the distinct values of ``col`` outside ``allowed``, with their
    row counts.  Null is allowed unless ``keep_null`` is False."""
    allowed = list(allowed)
    c = F.col(col)
    bad = ~c.isin(allowed) if allowed else F.lit(True)
    if keep_null:
        bad = c.isNotNull() & bad
    else:
        bad = c.isNull() | bad
    return df.filter(bad).groupBy(col).agg(F.count(F.lit(1)).cast("long").alias("n"))


def running_max_before(df: DataFrame, order_col: str, value_col: str, out: str) -> DataFrame:
    """``out``: the greatest ``value_col`` of the rows before each in ``order_col``
    order (null for the first), in two levels: inside each range of rows, and over the
    greatest values of the ranges before it, one number per range."""
    stored = in_order(df, [order_col])
    tops = stored.groupBy(PART).agg(F.max(value_col).alias("top")).collect()
    # One row per stored partition, so the driver keeps the running maximum.
    best, before = None, []
    for part, top in sorted((r[0], r[1]) for r in tops):
        before.append((part, best))
        best = top if best is None or (top is not None and top > best) else best
    kind = df.schema[value_col].dataType.simpleString()
    offsets = df.sparkSession.createDataFrame(before, f"{PART} long, _sf_top {kind}")
    earlier = (Window.partitionBy(PART).orderBy(AT)
               .rowsBetween(Window.unboundedPreceding, -1))
    return (stored.join(F.broadcast(offsets), PART)
            .withColumn(out, F.greatest(F.max(value_col).over(earlier), "_sf_top"))
            .drop(PART, AT, "_sf_top"))


def batch_ranges(df: DataFrame, batch_col: str, key_col: str) -> DataFrame:
    """A5: min, max and count of the key per batch, and whether a batch's
    range reaches back into an earlier batch (its min is not above the running
    max of the batches before it)."""
    per = df.groupBy(batch_col).agg(F.min(key_col).alias("min_key"),
                                    F.max(key_col).alias("max_key"),
                                    F.count(F.lit(1)).cast("long").alias("n"))
    ranged = running_max_before(per, batch_col, "max_key", "_sf_before")
    return ranged.withColumn("overlaps_earlier", F.coalesce(
        F.col("min_key") <= F.col("_sf_before"), F.lit(False))).drop("_sf_before")


def rate(numerator: Column, denominator: Column) -> Column:
    """A ratio that is null on an empty table (ANSI mode would raise)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
