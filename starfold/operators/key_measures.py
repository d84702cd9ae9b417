"""Uniqueness and foreign keys of many tables in one shuffle.

A *domain* is a column (or tuple) that must be unique, or that foreign keys point at.
Every table is scanned once; a row gives one small record for each key it takes part
in: the domain, the value, and the *slot* that names its role there.  Slot 0 is the
domain's own column, the others are the foreign keys that refer to it, each once
however many rules ask for it.  One aggregate on (domain, value) counts the rows of
every slot; it combines before the shuffle, so a fact's foreign keys shrink to their
distinct values in each task, and a hot value costs one record a task.  A value that
slot 0 holds more than once is a repeated key; a value that it does not hold is an
orphan of every slot that does, and so is a null foreign key.

Values are compared as long integers where the domain's column is one, else as text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class KeyMeasures:
    """Collects what to measure; ``measure`` builds the one plan."""

    def __init__(self) -> None:
        self._domains: dict[tuple[str, tuple[str, ...]], int] = {}
        # domain -> the (table, columns) of its slots
        self._slots: list[list[tuple[str, tuple[str, ...]]]] = []

    def _domain(self, table: str, cols: tuple[str, ...]) -> int:
        if (table, cols) not in self._domains:
            self._domains[table, cols] = len(self._slots)
            self._slots.append([(table, cols)])
        return self._domains[table, cols]

    def unique(self, table: str, cols: Sequence[str]) -> tuple[int, int]:
        """Rows of ``table`` beyond the first of each value of ``cols`` (nulls are a
        value); returns the place (domain, slot) of the count."""
        return self._domain(table, tuple(cols)), 0

    def orphans(self, child: str, col: str, parent: str, parent_col: str) -> tuple[int, int]:
        """Rows of ``child`` whose ``col`` is null or not among ``parent_col``."""
        domain = self._domain(parent, (parent_col,))
        slots = self._slots[domain]
        if (child, (col,)) not in slots[1:]:
            slots.append((child, (col,)))
        return domain, slots.index((child, (col,)), 1)

    def measure(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """``domain, slot, violations`` for every place asked for that has rows."""
        roles: dict[str, list[Column]] = {}
        for domain, slots in enumerate(self._slots):
            kinds = [[tables[t].schema[c].dataType for c in cols] for t, cols in slots]
            whole = all(len(k) == 1 and isinstance(k[0], _WHOLE) for k in kinds)
            for slot, (table, cols) in enumerate(slots):
                number, text = F.lit(None).cast("long"), F.lit(None).cast("string")
                if whole:
                    number = F.col(cols[0]).cast("long")
                elif len(cols) > 1:
                    text = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
                else:
                    text = _text(F.col(cols[0]), kinds[slot][0], kinds[0][0])
                roles.setdefault(table, []).append(F.struct(
                    F.lit(domain).alias("domain"), F.lit(slot).alias("slot"),
                    number.alias("number"), text.alias("text")))
        records = reduce(DataFrame.unionByName, [
            tables[t].select(F.explode(F.array(*r)).alias("_sf")).select("_sf.*")
            for t, r in roles.items()])
        width = max(len(s) for s in self._slots)
        held = records.groupBy("domain", "number", "text").agg(
            *[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(width)])
        lost = (F.col("n0") == 0) | (F.col("number").isNull() & F.col("text").isNull())
        sums = [F.sum(F.greatest(F.col("n0") - 1, F.lit(0))).alias("v0")]
        sums += [F.sum(F.when(lost, F.col(f"n{i}")).otherwise(0)).alias(f"v{i}")
                 for i in range(1, width)]
        cells = ", ".join(f"{i}, v{i}" for i in range(width))
        return held.groupBy("domain").agg(*sums).selectExpr(
            "domain", f"stack({width}, {cells}) AS (slot, violations)")


def _text(value: Column, kind: T.DataType, owner: T.DataType) -> Column:
    """A value as text, in the form its domain's own column gives it."""
    if kind != owner:
        value = value.cast(owner)
    if isinstance(owner, (T.FloatType, T.DoubleType)):
        value = value + 0.0            # the two zeros are one value
    return value.cast("string")
