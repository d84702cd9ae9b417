from starfold.session import (checkpoint_dir, ensure_checkpoint_dir, materialize,
                              shuffle_partitions_for)


def test_shuffle_partitions_sized_from_volume():
    assert shuffle_partitions_for(100 * 2 ** 40) == 409_600       # 100 TiB / 256 MiB
    assert shuffle_partitions_for(10 ** 6) == 200                 # never below Spark's default


def test_checkpoint_folder_is_the_configured_one_and_stable(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    first = ensure_checkpoint_dir(spark)
    assert configured.rstrip("/") in first
    assert ensure_checkpoint_dir(spark) == first == checkpoint_dir(spark)


def test_materialize_writes_parquet_under_the_checkpoint_folder(spark):
    df = spark.range(0, 100).selectExpr("id", "id * 2 AS v")
    m = materialize(df, "t")
    assert sorted(tuple(r) for r in m.collect()) == [(i, 2 * i) for i in range(100)]
    files = m.inputFiles()
    base = ensure_checkpoint_dir(spark).split(":", 1)[-1].lstrip("/")
    assert files and all(base in f for f in files)
    assert all(f.endswith(".parquet") for f in files)
