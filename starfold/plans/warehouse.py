"""The whole warehouse as lazy DataFrames, built from source tables.

Used by the registered queries (nothing published).  The written pipeline
(``pipeline.run``) follows the same steps but publishes each table and reads it
back, which cuts lineage.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.calendar import calendar_spanning
from . import adapter, dims, facts


def dimensions(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The dimensions with their keys.  They do not depend on each other: their
    jobs run side by side."""
    builds = {"dim_client": (dims.dim_client, "client"), "dim_gare": (dims.dim_gare, "gare"),
              "dim_train": (dims.dim_train, "train")}
    with ThreadPoolExecutor(max_workers=len(builds)) as pool:
        steps = {name: pool.submit(copy_context().run, build, sources[source])
                 for name, (build, source) in builds.items()}
        return {name: step.result() for name, step in steps.items()}


def trips(sources: dict[str, DataFrame], dm: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Trip fact and its rejects from ONE resolution, stored once."""
    ok, bad = facts.fact_trajet(sources["trajet"],
                                dims.key_map(dm["dim_train"], schemas.DIM_TRAIN),
                                dims.key_map(dm["dim_gare"], schemas.DIM_GARE))
    return {"fact_trajet": ok, "fact_trajet_rejected": bad}


def reservations(sources: dict[str, DataFrame], dm: dict[str, DataFrame],
                 tr: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Likewise the reservations, over the trips' key map."""
    ok, bad = facts.fact_reservation(sources["reservation"],
                                     dims.key_map(dm["dim_client"], schemas.DIM_CLIENT),
                                     tr["fact_trajet"].select("id_trajet", "trajet_key"))
    return {"fact_reservation": ok, "fact_reservation_rejected": bad}


def build(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimensions, facts (accepted and rejected) and the calendar.

    Each fact is resolved (its lookups, including the shuffled fact-to-fact join) and
    stored once in key order under the shared checkpoint folder; rejects and quality
    rules scan that copy instead of running the joins again."""
    dm = dimensions(sources)
    tr = trips(sources, dm)
    rs = reservations(sources, dm, tr)
    days = (sources["trajet"].select(F.col("date_depart").alias("d"))
            .unionByName(sources["reservation"].select(F.col("date_reservation").alias("d"))))
    out = dict(sources)
    out.update(dm)
    out.update(tr)
    out.update(rs)
    out["dim_date"] = calendar_spanning(days, "d")
    return out


def from_test_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return build(adapter.source_tables(spark, sf_dir))
