"""Dense surrogate keys (G3) and the type-1 dimension upsert.

``assign_dense_key`` numbers rows 1, 2, 3... in the order of a key tuple, the
same numbers a global ``row_number() OVER (ORDER BY ...)`` gives, without
putting the table in one partition, and in the same way at every size:

1. the rows are range-partitioned and sorted by the whole tuple, nulls first
   (one shuffle), and stored in the shared checkpoint folder together with the
   partition and the place in it at which each row was written;
2. the rows of each stored partition are counted: one number per partition;
3. a running sum over these few numbers is each partition's offset, and
   offset + place is the key.

Any orderable type works, alone or in a tuple.  A task holds one range of the
whole tuple, so a hot leading value is split on the columns that follow; only
equal tuples stay together.  The place is stored, not recomputed, so a lost
executor cannot change a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

AT, PART, _OFF = "_sf_at", "_sf_part", "_sf_off"
# ``monotonically_increasing_id`` holds the partition above these bits and the
# place in it below.
_PLACE_BITS = 33


def in_order(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """``df`` stored in the order of a tuple, nulls first, dealt to tasks by its
    ranges: with the stored partition (``PART``, ascending) and the place in it
    (``AT``, ascending inside a partition)."""
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    stored = materialize(df.orderBy(*order).withColumn(AT, F.monotonically_increasing_id()),
                         "ordered")
    return stored.withColumn(PART, F.shiftright(AT, _PLACE_BITS))


def assign_dense_key(df: DataFrame, order_cols: Sequence[str], key_col: str,
                     start: int = 1) -> DataFrame:
    """Add ``key_col`` = start, start+1, ... in ``order_cols`` order.

    The tuple should be unique (run the uniqueness rule first): equal tuples
    get distinct but arbitrary numbers."""
    order_cols = list(order_cols)
    if not order_cols:
        raise ValueError("order_cols is empty")
    stored = in_order(df, order_cols)
    # One row per stored partition, so the driver sums them up.
    counts = sorted((r[0], r[1]) for r in stored.groupBy(PART).count().collect())
    offsets, total = [], start
    for p, n in counts:
        offsets.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(offsets, f"{PART} long, {_OFF} long")
    key = F.col(_OFF) + F.col(AT).bitwiseAND((1 << _PLACE_BITS) - 1)
    return stored.join(F.broadcast(offsets), PART).withColumn(key_col, key).drop(AT, PART, _OFF)


def mark_repeats(df: DataFrame, key_cols: Sequence[str], flag: str) -> DataFrame:
    """``df`` (stored once) with ``flag``: the row is not the first of its key, the
    least row by content, ties by the stored place.  Rows with a null in the key
    repeat nothing, as in SQL's UNIQUE.

    Only keys are shuffled to find the repeated ones, which are few; the rows of
    these alone are compared, by an aggregate that combines before its shuffle, so
    a key holding a third of the rows meets in no task."""
    key_cols = list(key_cols)
    stored = materialize(df.withColumn(AT, F.monotonically_increasing_id()), "numbered")
    known = stored.dropna(subset=key_cols)
    again = known.groupBy(*key_cols).count().filter("count > 1").select(*key_cols)
    rest = [c for c in df.columns if c not in key_cols]
    first = (known.join(again, key_cols).groupBy(*key_cols)
             .agg(F.min(F.struct(*rest, AT))[AT].alias(_OFF)))
    # The first rows are stored: few, so that AQE plans by what they measure.
    first = materialize(first, "first-rows")
    out = stored.join(first, key_cols, "left").withColumn(
        flag, F.coalesce(F.col(_OFF) != F.col(AT), F.lit(False)))
    return out.select(*df.columns, flag)


def latest_per_key(df: DataFrame, key_cols: Sequence[str], version_col: str) -> DataFrame:
    """One row per key, the one with the greatest ``version_col`` (ties: the
    greatest remaining tuple, so the choice is deterministic).

    A ``max`` over a struct is a partial aggregate: rows are combined before
    the shuffle, so a key holding a third of the input costs no single task.
    """
    key_cols = list(key_cols)
    rest = [c for c in df.columns if c not in key_cols and c != version_col]
    packed = F.max(F.struct(F.col(version_col), *[F.col(c) for c in rest])).alias("_sf_r")
    return (df.groupBy(*key_cols).agg(packed)
            .select(*key_cols, *[F.col(f"_sf_r.{c}").alias(c) for c in [version_col] + rest])
            .select(*df.columns))


def upsert_type1(existing: DataFrame, incoming: DataFrame, natural_key: str,
                 surrogate_key: str, version_col: str | None = None,
                 max_key: int | None = None) -> DataFrame:
    """Type-1 dimension upsert.

    One row per natural key; when the key is in ``incoming`` its latest row
    (by ``version_col``) replaces the old values, otherwise the old row stays.
    Existing surrogate keys are kept; new keys are numbered on from the
    current maximum, in natural-key order.  Columns of the result are those of
    ``existing``; ``incoming`` must hold them all except the surrogate key
    (plus, optionally, ``version_col``).  ``max_key``: the greatest key in use,
    where ``existing`` is not the whole table.
    """
    value_cols = [c for c in existing.columns if c not in (natural_key, surrogate_key)]
    if version_col is not None:
        incoming = latest_per_key(incoming, [natural_key], version_col)
    elif not incoming.groupBy(natural_key).count().filter("count > 1").isEmpty():
        raise ValueError(f"several incoming rows share {natural_key!r}: name a version column "
                         "that tells which one is the latest")
    new = incoming.select(F.col(natural_key).alias("_sf_nk"),
                          *[F.col(c).alias(f"_sf_new_{c}") for c in value_cols],
                          F.lit(True).alias("_sf_in_new"))
    old = existing.select(F.col(natural_key).alias("_sf_nk_old"), surrogate_key, *value_cols)
    merged = old.join(new, old["_sf_nk_old"] == new["_sf_nk"], "full_outer")
    picked = merged.select(
        F.coalesce("_sf_nk", "_sf_nk_old").alias(natural_key),
        F.col(surrogate_key),
        *[F.when(F.col("_sf_in_new"), F.col(f"_sf_new_{c}")).otherwise(F.col(c)).alias(c)
          for c in value_cols],
    )
    # One join, read by both branches and by the key passes: written once as
    # parquet in the shared checkpoint folder.
    picked = materialize(picked, "upsert")
    if max_key is None:
        max_key = existing.agg(F.max(surrogate_key)).first()[0] or 0
    kept = picked.filter(F.col(surrogate_key).isNotNull())
    fresh = assign_dense_key(picked.filter(F.col(surrogate_key).isNull()).drop(surrogate_key),
                             [natural_key], surrogate_key, start=max_key + 1)
    sk_type = existing.schema[surrogate_key].dataType
    return (kept.unionByName(fresh.withColumn(surrogate_key, F.col(surrogate_key).cast(sk_type)))
            .select(*existing.columns))
