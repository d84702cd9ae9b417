"""Uniqueness and orphans of many tables in one aggregate; running maxima."""

import random

import pytest
from pyspark.sql import functions as F

from starfold.operators.key_measures import KeyMeasures
from starfold.operators.lookups import orphans
from starfold.operators.profile import batch_ranges, running_max_before, uniqueness


def _measured(keys, tables):
    return {(r.domain, r.slot): r.violations for r in keys.measure(tables).collect()}


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(7)
    parent = [(i if rnd.random() > 0.05 else None, str(i), i % 4) for i in range(60)]
    parent += [(5, "5", 1), (5, "x", 1), (None, None, None)]
    child = [(rnd.choice([None, 5, 5, 5, 5, rnd.randrange(80)]), str(rnd.randrange(70)),
              float(rnd.randrange(70))) for _ in range(500)]
    return {"p": spark.createDataFrame(parent, "k int, t string, g int"),
            "c": spark.createDataFrame(child, "k long, t string, d double").repartition(5)}


def test_measures_equal_the_single_operators(tables):
    keys = KeyMeasures()
    asked = {keys.unique("p", ["k"]): uniqueness(tables["p"], ["k"]),
             keys.unique("p", ["t"]): uniqueness(tables["p"], ["t"]),
             keys.unique("p", ["t", "g"]): uniqueness(tables["p"], ["t", "g"]),
             keys.unique("c", ["t"]): uniqueness(tables["c"], ["t"])}
    lost = {keys.orphans("c", "k", "p", "k"): orphans(tables["c"], "k", tables["p"], "k"),
            keys.orphans("c", "t", "p", "t"): orphans(tables["c"], "t", tables["p"], "t"),
            # A foreign key of another type is compared in its parent's form.
            keys.orphans("c", "d", "p", "t"): orphans(
                tables["c"].withColumn("d", F.col("d").cast("string")), "d", tables["p"], "t"),
            keys.orphans("p", "g", "c", "k"): orphans(tables["p"], "g", tables["c"], "k")}
    assert keys.orphans("c", "k", "p", "k") in lost      # asked for twice, measured once
    got = _measured(keys, tables)
    for place, df in asked.items():
        assert got[place] == df.first().extra_rows, place
    for place, df in lost.items():
        assert got[place] == df.count() > 0, place


def test_empty_tables_and_doubles(spark, tables):
    empty = {t: df.limit(0) for t, df in tables.items()}
    keys = KeyMeasures()
    keys.unique("p", ["k"]), keys.orphans("c", "k", "p", "k")
    assert _measured(keys, empty) == {}
    got = _measured(keys, {"p": empty["p"], "c": tables["c"]})
    assert got[0, 1] == 500                               # no parent: all are orphans
    two = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "x double")
    keys = KeyMeasures()
    keys.unique("t", ["x"])
    assert _measured(keys, {"t": two}) == {(0, 0): 1}


def test_running_maximum_in_two_levels(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, rnd.randrange(1000)])) for i in range(400)]
    df = spark.createDataFrame(rows, "o int, v long").repartition(7)
    got = {r.o: r.m for r in running_max_before(df, "o", "v", "m").collect()}
    best = None
    for o, v in rows:
        assert got[o] == best, o
        best = v if best is None or (v is not None and v > best) else best
    assert running_max_before(df.limit(0), "o", "v", "m").count() == 0
    batches = spark.createDataFrame([(1, 5), (1, 9), (2, 10), (3, 10), (4, 40)], "b int, k int")
    assert [(r.b, r.overlaps_earlier) for r in batch_ranges(batches, "b", "k").orderBy("b")
            .collect()] == [(1, False), (2, False), (3, True), (4, False)]
