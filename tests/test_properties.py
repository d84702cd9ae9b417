"""Property checks (hypothesis): the dense key is the global rank."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starfold.operators.keys import assign_dense_key
from starfold.operators.lookups import Lookup, split_resolved

keys = st.lists(st.one_of(st.integers(-50, 50), st.integers(-10**15, 10**15)),
                min_size=1, max_size=400, unique=True)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=keys, start=st.integers(1, 1000))
def test_dense_key_equals_global_rank(spark, values, start):
    df = spark.createDataFrame([(v,) for v in values], "k long")
    got = assign_dense_key(df, ["k"], "sk", start=start)
    expected = {v: i + start for i, v in enumerate(sorted(values))}
    assert {r.k: r.sk for r in got.collect()} == expected


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(fact_keys=st.lists(st.one_of(st.none(), st.integers(0, 30)), min_size=1, max_size=200),
       map_keys=st.lists(st.integers(0, 30), unique=True, max_size=30),
       broadcast=st.booleans())
def test_accepted_plus_rejected_is_input(spark, fact_keys, map_keys, broadcast):
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(fact_keys)], "id int, k int")
    m = spark.createDataFrame([(k, k + 100) for k in map_keys], "nk int, sk int")
    ok, bad = split_resolved(fact, [Lookup("m", m, "nk", "sk", "k", broadcast=broadcast)])
    ok_ids = {r.id for r in ok.collect()}
    bad_ids = {r.id for r in bad.collect()}
    assert ok_ids | bad_ids == set(range(len(fact_keys))) and not ok_ids & bad_ids
    assert ok_ids == {i for i, k in enumerate(fact_keys) if k in set(map_keys)}


def test_window_reference_agrees_on_ties_free_input(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 1000).alias("k")).distinct()
    got = assign_dense_key(df, ["k"], "sk")
    exp = df.withColumn("e", F.row_number().over(Window.orderBy("k")))
    assert got.join(exp, "k").filter("sk != e").count() == 0
