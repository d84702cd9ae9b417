"""Tables in parts: only touched parts are rewritten."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold import schemas
from starfold.operators.keys import upsert_type1
from starfold.sources import Run, create_parts, current, read_version, upsert_parts, vacuum

SPEC = schemas.TableSpec("d", T.StructType([T.StructField("sk", T.IntegerType()),
                                            T.StructField("id", T.IntegerType()),
                                            T.StructField("v", T.StringType())]),
                         natural_key=("id",), surrogate_key="sk")


def _files(target, part):
    folder = f"{target}/{part['folder']}"
    return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def table(spark, scratch):
    rows = [(i + 1, i * 10, f"old{i}") for i in range(200)] + [(201, None, "null key")]
    df = spark.createDataFrame(rows, SPEC.schema)
    run = Run(spark, scratch)
    assert create_parts(run, df, SPEC, 20) == 11
    run.commit()
    assert _rows(read_version(spark, scratch, "d")) == _rows(df)
    return scratch, df


def test_untouched_parts_keep_their_files(spark, table):
    target, df = table
    before = current(spark, target).notes["d"]["parts"]
    held = [_files(target, p) for p in before]
    incoming = spark.createDataFrame([(500, "new", 1), (505, "fresh", 1), (510, "late", 1),
                                      (510, "later", 2), (1005, "fresh", 1)],
                                     "id int, v string, at int")
    run = Run(spark, target)
    touched = upsert_parts(run, incoming, SPEC, "at")
    assert len(touched) == 2
    # Nothing shows before the commit.
    assert _rows(read_version(spark, target, "d")) == _rows(df)
    run.commit()
    want = upsert_type1(df.filter("id IS NOT NULL"), incoming, "id", "sk", "at", max_key=201)
    got = read_version(spark, target, "d")
    assert _rows(got.filter("id IS NOT NULL")) == _rows(want)
    assert got.filter("id IS NULL").count() == 1
    after = current(spark, target).notes["d"]["parts"]
    assert [p for p in range(11) if before[p] != after[p]] == touched
    vacuum(spark, target, keep=1)
    for p in range(11):
        if p not in touched:
            assert _files(target, after[p]) == held[p]
        else:
            assert not os.path.exists(f"{target}/{before[p]['folder']}")
    assert _rows(read_version(spark, target, "d").filter("id IS NOT NULL")) == _rows(want)


def test_only_touched_parts_are_read(spark, table):
    target, _ = table
    parts = current(spark, target).notes["d"]["parts"]
    # The files of all other parts are gone: an upsert that read them would fail.
    for p in range(2, 11):
        for f in os.listdir(f"{target}/{parts[p]['folder']}"):
            os.remove(f"{target}/{parts[p]['folder']}/{f}")
    run = Run(spark, target)
    assert upsert_parts(run, spark.createDataFrame([(200, "x")], "id int, v string"), SPEC) == [1]
    run.abandon()


def test_empty_tables_and_inputs(spark, scratch):
    run = Run(spark, scratch)
    assert create_parts(run, spark.createDataFrame([], SPEC.schema), SPEC, 5) == 1
    run.commit()
    assert read_version(spark, scratch, "d").columns == ["sk", "id", "v"]
    run = Run(spark, scratch)
    assert upsert_parts(run, spark.createDataFrame([], "id int, v string"), SPEC) == []
    assert upsert_parts(run, spark.createDataFrame([(7, "a"), (3, "b")], "id int, v string"),
                        SPEC) == [0]
    run.commit()
    assert _rows(read_version(spark, scratch, "d")) == [(1, 3, "b"), (2, 7, "a")]
    with pytest.raises(ValueError, match="whole-number"):
        named = schemas.TableSpec("d", SPEC.schema, natural_key=("v",), surrogate_key="sk")
        create_parts(Run(spark, scratch), spark.createDataFrame([], SPEC.schema), named, 5)
