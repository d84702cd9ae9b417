"""The COPY text format and batch reads."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from starfold import schemas
from starfold.sources import batch_bounds, read_batches, read_copy, write_copy

TEXTS = ["a", "", None, "\\N", "\\", "\\\\n", "tab\there", "line\nbreak\r\n", "\x08\x0b\x0c", "é中😀",
         "\\t\t\\", "N", " lead and trail ", "\"quoted\"", "\x85\u2028"]


def test_copy_text_round_trip(spark, scratch):
    rows = [(i, t, None if i % 3 else dt.date(2020, 1, 1 + i), i / 4, i % 2 == 0)
            for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, t string, d date, x double, b boolean")
    assert write_copy(df.repartition(2), f"{scratch}/c") == len(TEXTS)
    back = read_copy(spark, f"{scratch}/c", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows))
    # One line per row, in the form that COPY reads.
    lines = [x for f in os.listdir(f"{scratch}/c") if f.endswith(".txt")
             for x in open(f"{scratch}/c/{f}", newline="").read().split("\n") if x]
    assert len(lines) == len(TEXTS)
    by_id = {x.split("\t")[0]: x.split("\t")[1] for x in lines}
    assert (by_id["2"], by_id["3"], by_id["6"], by_id["7"]) == (
        "\\N", "\\\\N", "tab\\there", "line\\nbreak\\r\\n")


def test_copy_files_split(spark, scratch):
    df = spark.range(4000).select("id", F.repeat(F.lit("x\n"), 40).alias("t"))
    write_copy(df.coalesce(1), f"{scratch}/c")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        back = read_copy(spark, f"{scratch}/c", df.schema)
        assert back.select(F.spark_partition_id()).distinct().count() > 3
        assert back.exceptAll(df).count() == 0 and back.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    write_copy(df, f"{scratch}/m", max_rows_per_file=100)
    assert len([f for f in os.listdir(f"{scratch}/m") if f.endswith(".txt")]) >= 40


def test_copy_refuses_lines_of_another_width(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    write_copy(df, f"{scratch}/c")
    with pytest.raises(Exception, match="has not 1 fields"):
        read_copy(spark, f"{scratch}/c", df.select("id").schema).collect()


def test_batches_are_the_table_and_push_their_range(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    spec = schemas.TableSpec("orders", o.schema, natural_key=("o_orderkey",))
    parts = list(read_batches(o, spec, 2000))
    assert 7 <= len(parts) <= 9
    sizes = [p.count() for p in parts]
    assert sum(sizes) == o.count() and max(sizes) < 2 * 2000
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    for p in parts:
        plan = p._jdf.queryExecution().explainString(mode)
        pushed = next(x for x in plan.splitlines() if "PushedFilters" in x)
        assert "(o_orderkey," in pushed
    ends = [p.agg(F.min("o_orderkey"), F.max("o_orderkey")).first() for p in parts]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_odd_batches(spark):
    df = spark.createDataFrame([(None,), (1,), (1,), (1,), (1,), (9,)], "k int")
    spec = schemas.TableSpec("t", df.schema, natural_key=("k",))
    parts = list(read_batches(df, spec, 2))
    assert sorted(str(r[0]) for p in parts for r in p.collect()) == ["1"] * 4 + ["9", "None"]
    assert len(list(read_batches(df.limit(0), spec, 2))) == 1
    with pytest.raises(ValueError, match="no ordering key"):
        batch_bounds(df, schemas.TableSpec("t", df.schema), 2)
    named = schemas.TableSpec("t", df.schema, natural_key=("s",))
    with pytest.raises(ValueError, match="quantiles"):
        batch_bounds(df.withColumn("s", F.lit("x")), named, 2)
