import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from starfold import schemas
from starfold.sources import (count_null_markers, jdbc_options, malformed, order_key,
                              publish, read_table, read_tsv, stage_files, with_batches,
                              with_load_ts, write_table, write_tsv)

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("s", T.StringType())])


def test_tsv_round_trip_keeps_null_empty_quote_backslash_tab(spark, scratch):
    rows = [(1, None), (2, ""), (3, 'say "hi"'), (4, "back\\slash"), (5, "tab\there"),
            (6, "plain"), (7, "two\nlines\nand more"), (8, "a\n")]
    df = spark.createDataFrame(rows, SCHEMA)
    path = os.path.join(scratch, "t")
    assert write_tsv(df, path) == 8
    back = sorted(tuple(r) for r in read_tsv(spark, path, SCHEMA).collect())
    assert back == sorted(rows)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path)
                   if f.startswith("part-"))
    assert "1\t\\N" in text and '"say ""hi"""' in text


def test_tsv_refuses_literal_null_marker(spark, scratch):
    df = spark.createDataFrame([(1, "\\N")], SCHEMA)
    assert count_null_markers(df).first()[0] == 1
    with pytest.raises(ValueError, match="read back"):
        write_tsv(df, os.path.join(scratch, "t"))


def test_multi_file_single_scan_with_corrupt_rows(spark, scratch):
    paths = []
    for year, body in ((2021, "1,a\n2,b\n"), (2022, "3,c\nxx,d\n"), (2023, "4,e\n")):
        p = os.path.join(scratch, f"trajet_{year}.csv")
        open(p, "w").write(body)
        paths.append(p)
    df = stage_files(spark, paths, SCHEMA, os.path.join(scratch, "staged"))
    assert df.count() == 5 and malformed(df).count() == 1
    assert malformed(df).first()["_corrupt_record"] == "xx,d"
    assert sorted(r.id for r in df.filter(F.col("_corrupt_record").isNull()).collect()) == \
        [1, 2, 3, 4]


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql://h/db", "trajet", partition_column="id_trajet",
                     lower_bound=0, upper_bound=1000, num_partitions=4, fetch_size=100)
    assert o["dbtable"] == "raw.trajet" and o["numPartitions"] == "4"
    assert o["fetchsize"] == "100" and o["partitionColumn"] == "id_trajet"
    assert jdbc_options("u", "t", schema="other")["dbtable"] == "other.t"
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partition_column="k")


def test_batched_read_needs_an_order_key():
    assert order_key("trajet") == ("id_trajet",)
    with pytest.raises(ValueError, match="no ordering key"):
        order_key("nowhere")


def test_batches_follow_key_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id_trajet int, v string")
    got = {r.id_trajet: r.batch for r in with_batches(df, "trajet", 2).collect()}
    assert got == {1: 0, 2: 0, 3: 1}


def test_write_contract_counts_and_drops_extra(spark, scratch):
    df = spark.createDataFrame([(1, "a", "extra")], "id int, s string, junk string")
    path = os.path.join(scratch, "w")
    assert write_table(df, path, SCHEMA, mode="overwrite") == 1
    assert spark.read.parquet(path).columns == ["id", "s"]
    with pytest.raises(ValueError, match="missing"):
        write_table(df.drop("s"), path, SCHEMA)


def test_empty_write_returns_zero(spark, scratch):
    e = spark.createDataFrame([], SCHEMA)
    assert write_table(e, os.path.join(scratch, "e"), SCHEMA, mode="overwrite") == 0


def test_publish_swaps_and_validation_keeps_target(spark, scratch):
    target = os.path.join(scratch, "tbl")
    publish(spark.createDataFrame([(1, "a")], SCHEMA), target)
    publish(spark.createDataFrame([(2, "b"), (3, "c")], SCHEMA), target)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [2, 3]

    def refuse(staged):
        raise ValueError("nope")
    with pytest.raises(ValueError):
        publish(spark.createDataFrame([(9, "z")], SCHEMA), target, validate=refuse)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [2, 3]


def test_read_table_with_catalog_schema(spark):
    df = read_table(spark, SF001, "orders", suffix=".parquet")
    assert df.count() == 1500
    c = read_table(spark, SF001, schemas.TableSpec("region", T.StructType(
        [T.StructField("r_regionkey", T.LongType())])), suffix=".parquet")
    assert c.columns == ["r_regionkey"] and c.schema[0].dataType == T.LongType()


def test_load_ts(spark):
    df = with_load_ts(spark.range(2), "2024-01-01 00:00:00")
    assert df.select(F.count_distinct("load_ts")).first()[0] == 1


def test_load_ts_is_an_instant_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = with_load_ts(spark.range(1), "2024-01-01T00:00:00+00:00").select(
            F.unix_seconds("load_ts")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == 1704067200


def test_yearly_files_ingest_types_rejects_and_duplicates(spark, scratch):
    from starfold.sources import ingest_files
    body = {2021: "1,10,1,1,2021-01-03,08:00:00,09:00:00,120,OK\n"
                  "2,10,1,2,2021-02-03,08:00:00,09:00:00,abc,OK\n",
            2022: "3,11,2,1,2022-05-06,10:00:00,11:30:00,90,OK\n"
                  "1,11,2,1,2022-05-07,10:00:00,11:30:00,90,OK\n",
            2023: "4,12,1,2,not-a-date,07:00:00,08:00:00,50,OK\n\"unclosed,1\n"}
    paths = []
    for year, text in body.items():
        p = os.path.join(scratch, f"TRAJET_{year}.csv")
        open(p, "w").write(text)
        paths.append(p)
    typed, rep = ingest_files(spark, paths, schemas.TRAJET, os.path.join(scratch, "stg"))
    assert rep == {"rows": 6, "malformed": 1, "cast_failures": 2, "duplicate_keys": 1}
    reasons = {r.id_trajet: list(r.reject_reasons) for r in typed.collect()
               if r.id_trajet is not None}
    assert reasons[2] == ["cast:distance_km"] and reasons[4] == ["cast:date_depart"]
    assert typed.schema["date_depart"].dataType == T.DateType()
