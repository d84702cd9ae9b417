"""Natural-key -> surrogate-key resolution (J1-J3), rejects with reasons (J8),
orphans (J6), temporal fact join (J7) and the foreign-key audit (J9).

Join strategy: a lookup is planned as a shuffled join, and AQE makes it a
broadcast join when the key map's measured bytes are below the session's
``spark.sql.adaptive.autoBroadcastJoinThreshold``; nothing is counted while a
plan is built.  Fact-to-fact maps, which grow with the facts, are hinted to stay
shuffled; AQE splits their skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASONS = "reject_reasons"


@dataclass
class Lookup:
    """One key to resolve.

    ``key_map`` holds ``natural_key`` and ``surrogate_key``; the fact column
    ``fact_column`` is matched with plain ``=`` (a null never matches).  The
    resolved key is named ``output`` (defaults to ``surrogate_key``), which is
    how one map plays several roles.  ``broadcast``: True for a map of proven
    size, False to stay shuffled, None to leave it to AQE's measured bytes.
    """

    name: str
    key_map: DataFrame
    natural_key: str
    surrogate_key: str
    fact_column: str
    output: str | None = None
    broadcast: bool | None = None

    @property
    def out(self) -> str:
        return self.output or self.surrogate_key


def placed(df: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """The lookup side of a join: broadcast if it was proven small, hinted to
    stay shuffled if it grows with the facts, else left to AQE."""
    if broadcast is None:
        return df
    return F.broadcast(df) if broadcast else df.hint("shuffle_merge")


def spread_nulls(fact: DataFrame, column: str, nk: str, flag: str) -> DataFrame | None:
    """Join key columns for a shuffled lookup: a null key cannot match, so it
    is replaced by a hash of the row (and flagged) to spread null rows over
    all partitions instead of sending them to one task."""
    dtype = fact.schema[column].dataType
    cols = [F.col(c) for c in fact.columns]
    if isinstance(dtype, T.LongType):
        salt = F.xxhash64(*cols)
    elif isinstance(dtype, T.IntegerType):
        salt = F.hash(*cols)
    elif isinstance(dtype, (T.ShortType, T.ByteType)):
        width = 1 << (15 if isinstance(dtype, T.ShortType) else 7)
        salt = F.pmod(F.hash(*cols), F.lit(width)).cast(dtype)
    elif isinstance(dtype, T.StringType):
        salt = F.xxhash64(*cols).cast("string")
    else:
        return None
    return fact.withColumns({nk: F.coalesce(F.col(column), salt),
                             flag: F.col(column).isNull()})


def _attach(fact: DataFrame, lk: Lookup, i: int) -> DataFrame:
    nk, flag = f"_sf_nk{i}", f"_sf_null{i}"
    m = lk.key_map.select(F.col(lk.natural_key).alias(nk), F.col(lk.surrogate_key).alias(lk.out))
    if lk.broadcast:
        return fact.join(F.broadcast(m), fact[lk.fact_column] == F.col(nk), "left").drop(nk)
    spread = spread_nulls(fact, lk.fact_column, f"_sf_fk{i}", f"_sf_fnull{i}")
    if spread is None:
        m = placed(m, lk.broadcast)
        return fact.join(m, fact[lk.fact_column] == F.col(nk), "left").drop(nk)
    m = placed(m.withColumn(flag, F.lit(False)), lk.broadcast)
    cond = (spread[f"_sf_fk{i}"] == m[nk]) & (spread[f"_sf_fnull{i}"] == m[flag])
    return spread.join(m, cond, "left").drop(nk, flag, f"_sf_fk{i}", f"_sf_fnull{i}")


def resolve_with_reasons(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """One pass of left joins; every row gets its surrogate keys and the
    array of lookups that did not resolve (empty = accepted)."""
    out = fact
    for i, lk in enumerate(lookups):
        out = _attach(out, lk, i)
    flags = [F.when(F.col(lk.out).isNull(), F.lit(lk.name)) for lk in lookups]
    return out.withColumn(REASONS, F.filter(F.array(*flags), lambda x: x.isNotNull()))


def accepted(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.size(REASONS) == 0).drop(REASONS)


def rejected(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.size(REASONS) > 0)


def resolve_keys(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Inner-join semantics -- unresolved rows vanish.  Written as
    left joins + a not-null filter, which Catalyst turns into inner joins."""
    out = fact
    for i, lk in enumerate(lookups):
        out = _attach(out, lk, i)
    cond = None
    for lk in lookups:
        c = F.col(lk.out).isNotNull()
        cond = c if cond is None else cond & c
    return out.filter(cond) if cond is not None else out


def split_resolved(fact: DataFrame, lookups: Sequence[Lookup]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) from one resolution plan."""
    r = resolve_with_reasons(fact, lookups)
    return accepted(r), rejected(r)


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
            broadcast: bool | None = None) -> DataFrame:
    """Child rows whose foreign key has no parent row (a null key is an
    orphan, as in ``LEFT JOIN ... WHERE parent.key IS NULL``).  Rows with a
    null key are orphans without being joined, so they never meet in one task;
    an anti-join is set-based, so the parent keys need no de-duplication."""
    p = placed(parent.select(F.col(parent_col).alias("_sf_pk")), broadcast)
    known = child.filter(F.col(child_col).isNotNull())
    lost = known.join(p, known[child_col] == F.col("_sf_pk"), "left_anti")
    return lost.unionByName(child.filter(F.col(child_col).isNull()))


def temporal_violations(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                        later: Column, broadcast_right: bool = False) -> DataFrame:
    """Inner equi-join with a residual inequality, e.g.
    ``reservation.date_key > trip.date_key``; Catalyst folds the inequality
    into the join condition.  Both sides are facts, so the join is a
    sort-merge join unless the caller proved the right side small."""
    right = F.broadcast(right) if broadcast_right else right.hint("shuffle_merge")
    return left.join(right, on, "inner").filter(later)


@dataclass(frozen=True)
class FkCheck:
    child_table: str
    child_column: str
    parent_table: str
    parent_column: str


def fk_audit(tables: dict[str, DataFrame], checks: Sequence[FkCheck]) -> DataFrame:
    """All foreign keys in one report (child_table, child_column, parent_table,
    parent_column, orphans): one scan per table and one shuffle for all of them."""
    from .key_measures import KeyMeasures
    keys = KeyMeasures()
    rows = [(c.child_table, c.child_column, c.parent_table, c.parent_column,
             *keys.orphans(c.child_table, c.child_column, c.parent_table, c.parent_column))
            for c in checks]
    measured = keys.measure(tables)
    asked = measured.sparkSession.createDataFrame(
        rows, "child_table string, child_column string, parent_table string, "
              "parent_column string, domain int, slot int")
    # One row per check on either side.
    return (asked.join(F.broadcast(measured), ["domain", "slot"], "left")
            .select("child_table", "child_column", "parent_table", "parent_column",
                    F.coalesce("violations", F.lit(0)).cast("long").alias("orphans")))
