import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from starfold.operators.keys import assign_dense_key, latest_per_key, upsert_type1


def _global_rank(df, cols, name="expected"):
    return df.withColumn(name, F.row_number().over(Window.orderBy(*cols)).cast("long"))


def _diff(got, expected_df, key_cols):
    j = got.join(expected_df, key_cols)
    return j.filter(F.col("k") != F.col("expected")).count(), j.count()


def test_dense_key_equals_global_row_number(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    got = assign_dense_key(o, ["o_orderkey"], "k")
    bad, n = _diff(got, _global_rank(o, ["o_orderkey"]), ["o_orderkey"])
    assert (bad, n) == (0, 15000)


def test_keys_are_gapless(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    got = assign_dense_key(o, ["o_orderkey"], "k")
    assert got.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first() == (1, 15000, 15000)


def test_hot_range_is_still_dense(spark):
    # A third of the keys squeezed into a tiny range next to a wide sparse one.
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    skewed = o.select(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey"))
                      .otherwise(F.col("o_orderkey") * 1_000_003 + 10_000_000)
                      .alias("key"))
    got = assign_dense_key(skewed, ["key"], "k")
    bad, n = _diff(got, _global_rank(skewed, ["key"]), ["key"])
    assert (bad, n) == (0, 15000)


def test_composite_order_and_start(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate"]
    got = assign_dense_key(li, cols, "k", start=101)
    exp = _global_rank(li, cols).withColumn("expected", F.col("expected") + 100)
    bad, n = _diff(got, exp, cols)
    assert (bad, n) == (0, 60000)


def test_date_leading_column(spark):
    days = spark.range(0, 500).select(F.date_add(F.lit("2020-01-01").cast("date"),
                                                 F.col("id").cast("int")).alias("d"))
    got = assign_dense_key(days, ["d"], "k")
    bad, n = _diff(got, _global_rank(days, ["d"]), ["d"])
    assert (bad, n) == (0, 500)


def test_empty_input(spark):
    e = spark.createDataFrame([], "id long")
    assert assign_dense_key(e, ["id"], "k").count() == 0


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "2020-01-01", "a"), (1, "2021-01-01", "b"),
                                (2, "2020-05-05", "c"), (1, "2021-01-01", "a")],
                               "id int, mod string, v string")
    got = sorted(tuple(r) for r in latest_per_key(df, ["id"], "mod").collect())
    assert got == [(1, "2021-01-01", "b"), (2, "2020-05-05", "c")]


def test_upsert_type1(spark):
    old = spark.createDataFrame([(1, 10, "x"), (2, 20, "y")], "sk int, nk int, v string")
    new = spark.createDataFrame([(20, "y2", 1), (20, "y3", 2), (5, "n", 1), (30, "m", 1)],
                                "nk int, v string, ver int")
    got = sorted(tuple(r) for r in upsert_type1(old, new, "nk", "sk", "ver").collect())
    assert got == [(1, 10, "x"), (2, 20, "y3"), (3, 5, "n"), (4, 30, "m")]


def test_hot_leading_value_continues_on_next_column(spark):
    # The leading column holds two values, each with half of the rows: the
    # ranges must be cut on l_partkey.
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").withColumn(
        "lead", F.col("l_orderkey") % 2)
    cols = ["lead", "l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate"]
    got = assign_dense_key(li, cols, "k")
    bad, n = _diff(got, _global_rank(li, cols), cols)
    assert (bad, n) == (0, 60000)


def test_timestamp_ntz_leading_column_across_a_dst_gap(spark):
    # Wall-clock times around a spring-forward gap in a zone with DST.
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        import datetime as dt
        base = dt.datetime(2024, 3, 31, 1, 0, 0)
        df = spark.createDataFrame([(base + dt.timedelta(seconds=30 * i),) for i in range(400)],
                                   "t timestamp_ntz")
        got = assign_dense_key(df, ["t"], "k")
        bad, n = _diff(got, _global_rank(df, ["t"]), ["t"])
        assert (bad, n) == (0, 400)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _check(spark, df, cols):
    got = assign_dense_key(df, cols, "k")
    order = [F.col(c).asc_nulls_first() for c in cols]
    exp = df.withColumn("e", F.row_number().over(Window.orderBy(*order)))
    pairs = [got[c].eqNullSafe(exp[c]) for c in cols]
    cond = pairs[0]
    for p in pairs[1:]:
        cond = cond & p
    j = got.join(exp, cond)
    assert j.count() == df.count() and j.filter("k <> e").count() == 0


def test_many_rows_in_one_second(spark):
    import datetime as dt
    base = dt.datetime(2024, 3, 31, 1, 0, 0)
    rows = [(base + dt.timedelta(microseconds=(i * 7919) % 1000), i % 5) for i in range(1000)]
    _check(spark, spark.createDataFrame(rows, "t timestamp_ntz, b int").distinct(), ["t", "b"])


def test_keys_at_both_ends_of_the_long_range(spark):
    rows = [(v,) for v in (-2**63, -2**63 + 1, -1, 0, 1, 2**63 - 2, 2**63 - 1, None)]
    _check(spark, spark.createDataFrame(rows, "k0 long"), ["k0"])


def test_text_double_and_decimal_keys(spark):
    df = spark.range(0, 600).select(
        F.concat(F.lit("né"), (F.col("id") * 7919 % 50).cast("string")).alias("s"),
        F.when(F.col("id") % 11 != 0, F.col("id") / 7).alias("d"),
        (F.col("id") * 31 % 600).cast("decimal(20,2)").alias("m"))
    _check(spark, df, ["s", "d", "m"])


def test_upsert_without_a_version_refuses_duplicates(spark):
    old = spark.createDataFrame([(1, 10, "x")], "sk int, nk int, v string")
    new = spark.createDataFrame([(10, "a"), (10, "b")], "nk int, v string")
    with pytest.raises(ValueError, match="version column"):
        upsert_type1(old, new, "nk", "sk")
    one = upsert_type1(old, new.limit(1), "nk", "sk").collect()
    assert [(r.sk, r.nk) for r in one] == [(1, 10)]
