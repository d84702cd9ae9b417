"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from ..session import materialize


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back.  Its lineage ends here, so the shuffle
    files behind it can go as soon as the driver has dropped its plans."""
    out = materialize(df, name)
    del df
    gc.collect()
    out.sparkSession.sparkContext._jvm.System.gc()
    return out
