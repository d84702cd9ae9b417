"""Column contracts (P1), renames (P2), derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, contract: T.StructType | Sequence[str], cast: bool = True) -> DataFrame:
    """Exactly the contract's columns, in its order; extra columns are
    dropped, a missing one raises.  With a StructType, values are cast to the
    contract's types (an impossible cast raises under ANSI mode)."""
    names = [f.name for f in contract.fields] if isinstance(contract, T.StructType) \
        else list(contract)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the contract input: {missing}")
    if isinstance(contract, T.StructType) and cast:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])
    return df.select(*names)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Like ``project`` but a column absent from ``df`` becomes a typed null
    (for sources that do not carry every contract column)."""
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract.fields]
    return df.select(*cols)


def cast_with_reasons(df: DataFrame, contract: T.StructType, reasons: str = "reject_reasons",
                      keep: Sequence[str] = ()) -> DataFrame:
    """F9 feeding J8: cast every contract column with ``try_cast``; a value
    that was present but does not fit the type becomes null and adds
    ``cast:<column>`` to the row's reasons (instead of failing the job, as a
    plain cast does under ANSI mode).  ``keep`` columns pass through."""
    cols, flags = [], []
    for f in contract.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        typed = src.try_cast(f.dataType)
        cols.append(typed.alias(f.name))
        if f.name in df.columns:
            flags.append(F.when(src.isNotNull() & typed.isNull(), F.lit(f"cast:{f.name}")))
    prior = F.col(reasons) if reasons in df.columns else F.array().cast("array<string>")
    found = F.filter(F.array(*flags), lambda x: x.isNotNull()) if flags else \
        F.array().cast("array<string>")
    return df.select(*cols, *keep, F.concat(prior, found).alias(reasons))
