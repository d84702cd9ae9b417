"""Incremental loads: keys unique over batches, replays, the key index."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold import schemas
from starfold.operators.keys import mark_repeats
from starfold.operators.lookups import REASONS
from starfold.streaming import KeyIndex, incremental_load, load_report

SOURCE = schemas.TableSpec("t", T.StructType([T.StructField("id", T.IntegerType()),
                                              T.StructField("v", T.StringType())]),
                           natural_key=("id",))
LOADED = schemas.TableSpec("f", T.StructType([T.StructField("k", T.LongType()),
                                              T.StructField("id", T.IntegerType()),
                                              T.StructField("v", T.StringType())]),
                           natural_key=("id",), surrogate_key="k")


def _resolve(batch):
    return batch.withColumn(REASONS, F.when(F.col("v") == "bad", F.array(F.lit("v"))).otherwise(
        F.array().cast("array<string>")))


def _load(spark, base, rows=None, **kwargs):
    if rows is not None:
        spark.createDataFrame(rows, SOURCE.schema).coalesce(1).write.mode("append").parquet(
            f"{base}/in")
    return incremental_load(spark, f"{base}/in", SOURCE.schema, _resolve, f"{base}/out", "k",
                            f"{base}/ckpt", rejected_target=f"{base}/bad", table=SOURCE,
                            spec=LOADED, index_fan_in=2, **kwargs)


def _rows(spark, path, *cols):
    return sorted((tuple(r) for r in spark.read.parquet(path).select("batch_id", *cols).collect()),
                  key=str)


BATCHES = [[(1, "a"), (2, "a"), (2, "z"), (3, "bad"), (None, "n"), (None, "m")],
           [(2, "b"), (3, "b"), (4, "b")],
           [(4, "c"), (5, "c"), (5, "c"), (6, "bad"), (1, "c")],
           [(6, "d"), (3, "d"), (7, "d")]]
OK = [(0, 1, None, "m"), (0, 2, None, "n"), (0, 3, 1, "a"), (0, 4, 2, "a"), (1, 5, 3, "b"),
      (1, 6, 4, "b"), (2, 7, 5, "c"), (3, 8, 6, "d"), (3, 9, 7, "d")]


def _bad(spark, base):
    return sorted((r.batch_id, r.id, r.v, list(r[REASONS]))
                  for r in spark.read.parquet(f"{base}/bad").collect())


BAD = [(0, 2, "z", ["unique:id"]), (0, 3, "bad", ["v"]), (1, 2, "b", ["loaded:id"]),
       (2, 1, "c", ["loaded:id"]), (2, 4, "c", ["loaded:id"]), (2, 5, "c", ["unique:id"]),
       (2, 6, "bad", ["v"]), (3, 3, "d", ["loaded:id"])]


def test_a_key_is_loaded_once_over_all_batches(spark, scratch):
    for batch in BATCHES:
        assert len(_load(spark, scratch, batch)) == 1
    got = [(b, k, i, v) for b, k, i, v in _rows(spark, f"{scratch}/out", "k", "id", "v")]
    # Null keys come first in key order and repeat nothing; their order is the rows' own.
    assert sorted((b, k, i) for b, k, i, _ in got if i) == sorted(
        (b, k, i) for b, k, i, _ in OK if i)
    assert sorted(v for _, _, i, v in got if i is None) == ["m", "n"]
    assert _bad(spark, scratch) == BAD
    report = [tuple(r)[:4] for r in load_report(spark, f"{scratch}/out").orderBy("batch_id")
              .collect()]
    assert report == [(0, 4, 2, 1), (1, 2, 1, 1), (2, 1, 4, 3), (3, 2, 1, 1)]


def test_a_replayed_batch_sees_only_batches_below_its_own(spark, scratch):
    for batch in BATCHES:
        _load(spark, scratch, batch)
    before = _rows(spark, f"{scratch}/out", "k", "id"), _bad(spark, scratch)
    # The last batch was written but its end was never noted: the stream runs it again.
    for f in ("3", ".3.crc"):
        os.remove(f"{scratch}/ckpt/commits/{f}")
    assert [p["batch_id"] for p in _load(spark, scratch)] == [3]
    assert (_rows(spark, f"{scratch}/out", "k", "id"), _bad(spark, scratch)) == before
    assert _load(spark, scratch) == []


def test_copies_of_a_batch_are_removed(spark, scratch):
    from starfold.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    _load(spark, scratch, BATCHES[0])
    assert set(os.listdir(folder)) == before


def test_a_stream_of_a_table_without_an_order_key_is_refused(spark, scratch):
    plain = T.StructType([T.StructField("x", T.StringType())])
    for table in (None, schemas.TableSpec("x", plain), "no_such_table"):
        with pytest.raises(ValueError, match="no ordering key"):
            incremental_load(spark, scratch, plain, None, scratch, "k", scratch, table=table)


def _keys(df):
    return sorted(r[0] for r in df.collect()) if df is not None else []


def test_index_merges_runs_and_prunes_by_bounds(spark, scratch):
    index = KeyIndex(spark, f"{scratch}/i", ["id"], fan_in=2)
    for b in range(7):
        index.compact(b)
        index.add(spark.range(b * 10, b * 10 + 10), b)
        assert len(index.runs()) <= 5
    assert _keys(index.seen(7)) == list(range(70))
    assert _keys(index.seen(3)) == list(range(30))
    assert index.seen(0) is None and index.seen(7, 500, 600) is None
    assert _keys(index.seen(7, 25, 34)) == list(range(25, 35))
    some = index.seen(7, 62, 64)._jdf.queryExecution().toString()
    assert some.count("Relation") <= 2 * len(index.runs())
    # A run is read only if its bounds meet those asked for.
    assert len([n for n in index.runs().values() if not (n["hi"] < 62 or n["lo"] > 64)]) == 1
    sizes = sorted(n["size"] for n in index.runs().values())
    assert sizes[-1] >= 2


def test_index_restarted_at_an_earlier_batch_forgets_what_came_later(spark, scratch):
    index = KeyIndex(spark, f"{scratch}/i", ["id"], fan_in=2)
    for b in range(5):
        index.compact(b)
        index.add(spark.range(b * 10, b * 10 + 10), b)
    index.add(spark.range(900, 903), 1)              # batch 1 again, with other keys
    assert _keys(index.seen(5)) == list(range(10)) + [900, 901, 902]
    index.compact(2)
    index.add(spark.range(20, 22), 2)
    index.compact(3)
    assert _keys(index.seen(3)) == list(range(10)) + [20, 21, 900, 901, 902]
    with pytest.raises(ValueError):
        KeyIndex(spark, scratch, ["id"], fan_in=1)


def test_repeats_are_marked_by_content(spark):
    rows = [(1, "b"), (1, "a"), (1, "a"), (2, "x"), (None, "x"), (None, "x"), (3, "y"), (3, "y")]
    df = spark.createDataFrame(rows, "id int, v string").repartition(3)
    got = sorted((str(r.id), r.v, r.again) for r in mark_repeats(df, ["id"], "again").collect())
    assert got == [("1", "a", False), ("1", "a", True), ("1", "b", True), ("2", "x", False),
                   ("3", "y", False), ("3", "y", True), ("None", "x", False), ("None", "x", False)]
    assert mark_repeats(df.limit(0), ["id"], "again").count() == 0
