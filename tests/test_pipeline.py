import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from starfold import schemas
from starfold.plans import adapter, facts, pipeline, quality
from starfold.plans.pipeline import LoadConfig
from starfold.plans.pipeline import read_table
from starfold.sources import versions
from starfold.sources.writers import PublishRefused
from starfold.streaming import incremental_load

# Expected counts at sf0.001 (FIXTURES.md section 3).
TRIPS_IN, TRIPS_OK, RES_IN, RES_OK = 1500, 1415, 1000, 944
LATE, OFF = 4, 74


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("dw"))
    src = adapter.source_tables(spark, SF001)
    cfg = LoadConfig(target=target, gate="report")
    report = {r.table_name: r for r in pipeline.run(spark, src, cfg).collect()}
    return spark, target, src, report


def test_counts_match_fixtures(loaded):
    spark, target, src, report = loaded
    assert report["fact_trajet"].rows == TRIPS_OK
    assert report["fact_trajet"].rows + report["fact_trajet"].rejected == TRIPS_IN
    assert report["fact_reservation"].rows == RES_OK
    assert report["fact_reservation"].rows + report["fact_reservation"].rejected == RES_IN
    assert report["dim_date"].rows == 2557            # 1995-01-01 .. 2001-12-31


def test_keys_are_dense_in_natural_key_order(loaded):
    spark, target, *_ = loaded
    ft = read_table(spark, str(target), "fact_trajet")
    a = ft.agg(F.min("trajet_key"), F.max("trajet_key"), F.count("*")).first()
    assert tuple(a) == (1, TRIPS_OK, TRIPS_OK)
    rows = ft.orderBy("id_trajet").select("trajet_key").collect()
    assert [r[0] for r in rows] == list(range(1, TRIPS_OK + 1))


def test_quality_report_measures(loaded):
    spark, target, *_ = loaded
    rep = {(r.rule, r.table_name): r for r in read_table(spark, str(target), "_quality").collect()}
    assert rep[("d10_reservation_after_trip", "fact_reservation")].violations == LATE
    assert rep[("d6_total_vs_price", "fact_reservation")].violations == OFF
    assert rep[("d7_negative_amount", "fact_reservation")].violations == 0
    assert rep[("d1_count_match", "fact_trajet")].violations == 0
    # the planted 'Xyz' sex becomes 'X' and the domain rule reports it
    assert rep[("d3_domain:sexe", "dim_client")].violations == 25
    # stations 0, 8, 16, 24 have neither service year: 4/25 > 5 %
    assert rep[("d5_null_service_year", "dim_gare")].violations == 4
    failed = {k[0] for k, r in rep.items() if not r.passed}
    assert failed == {"d3_domain:sexe", "d5_null_service_year"}


def test_full_gate_fails_on_the_planted_domain_error(spark, tmp_path):
    src = adapter.source_tables(spark, SF001)
    with pytest.raises(quality.QualityGateError, match="d3_domain:sexe on dim_client: 25/150.*d5_null_service_year"):
        pipeline.run(spark, src, LoadConfig(target=str(tmp_path), gate="full"))


def test_rerun_gives_identical_tables(loaded, tmp_path):
    spark, target, src, _ = loaded
    cfg = LoadConfig(target=str(tmp_path), gate="off")
    pipeline.run(spark, src, cfg)
    for name in schemas.LOAD_ORDER:
        a = read_table(spark, str(target), name).drop("load_ts")
        b = read_table(spark, str(tmp_path), name).drop("load_ts")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_load_ts_is_one_value_per_run(loaded):
    spark, target, *_ = loaded
    ft = read_table(spark, str(target), "fact_trajet")
    assert ft.columns[-1] == "load_ts"
    assert ft.select(F.count_distinct("load_ts")).first()[0] == 1


def test_step_rerun_replaces_its_table_and_cascades(loaded):
    spark, target, src, _ = loaded
    cfg = LoadConfig(target=target, gate="off")
    pipeline.reload_trips(spark, src, cfg)
    assert read_table(spark, str(target), "fact_trajet").count() == TRIPS_OK
    assert read_table(spark, str(target), "fact_reservation").count() == RES_OK
    assert [r["table_name"] for r in cfg.report] == ["fact_trajet", "fact_reservation"]


def test_quarantine_mode_moves_constraint_violations(spark, tmp_path):
    src = adapter.source_tables(spark, SF001)
    # plant a null trip date: NOT NULL on date_key
    src["trajet"] = src["trajet"].withColumn(
        "date_depart", F.when(F.col("id_trajet") == 1, F.lit(None)).otherwise(F.col("date_depart")))
    cfg = LoadConfig(target=str(tmp_path), gate="off", constraints="quarantine")
    pipeline.run(spark, src, cfg)
    rej = read_table(spark, str(tmp_path), "fact_trajet_rejected")
    hit = rej.filter("id_trajet = 1").first()
    assert list(hit.reject_reasons) == ["not_null:date_key"]
    assert read_table(spark, str(tmp_path), "fact_trajet").count() == TRIPS_OK - 1


def test_fail_mode_refuses_to_publish_a_null_date(spark, tmp_path):
    src = adapter.source_tables(spark, SF001)
    src["trajet"] = src["trajet"].withColumn(
        "date_depart", F.when(F.col("id_trajet") == 1, F.lit(None)).otherwise(F.col("date_depart")))
    from starfold.sources.writers import PublishRefused
    with pytest.raises(PublishRefused, match="d13_not_null:date_key: 1/1415"):
        pipeline.run(spark, src, LoadConfig(target=str(tmp_path), gate="off"))
    assert "fact_trajet" not in versions.current(spark, str(tmp_path)).tables


def test_incremental_batches_equal_full_load(loaded, tmp_path):
    spark, target, src, _ = loaded
    # the trip source split in 3 files by date, picked up one file per batch
    landing = str(tmp_path / "landing")
    t = src["trajet"]
    for i, (lo, hi) in enumerate((("1990-01-01", "1997-01-01"), ("1997-01-01", "1999-06-01"),
                                  ("1999-06-01", "2100-01-01"))):
        (t.filter((F.col("date_depart") >= lo) & (F.col("date_depart") < hi))
         .coalesce(1).write.mode("overwrite").parquet(f"{landing}/part{i}"))
    for i in range(3):
        for f in os.listdir(f"{landing}/part{i}"):
            if f.endswith(".parquet"):
                os.rename(f"{landing}/part{i}/{f}", f"{landing}/{i}_{f}")
    train_map = read_table(spark, str(target), "dim_train").select("id_train", "train_key")
    gare_map = read_table(spark, str(target), "dim_gare").select("id_gare", "gare_key")

    def transform(batch, start):
        return facts.fact_trajet(batch, train_map, gare_map, key_start=start)

    out = str(tmp_path / "inc")
    progress = incremental_load(spark, landing, schemas.TRAJET.schema, transform, out,
                                "trajet_key", str(tmp_path / "ckpt"),
                                rejected_target=str(tmp_path / "inc_rej"))
    assert len(progress) == 3
    meta = spark.read.parquet(f"{out}/_batches").orderBy("batch_id").collect()
    assert [m.last_key for m in meta] == [p["last_key"] for p in progress]
    inc = spark.read.parquet(out)
    full = read_table(spark, str(target), "fact_trajet")
    assert inc.count() == TRIPS_OK
    assert inc.select("id_trajet").exceptAll(full.select("id_trajet")).count() == 0
    k = inc.agg(F.min("trajet_key"), F.max("trajet_key"), F.count_distinct("trajet_key")).first()
    assert tuple(k) == (1, TRIPS_OK, TRIPS_OK)
    # batch key ranges do not overlap
    from starfold.operators.profile import batch_ranges
    assert batch_ranges(inc, "batch_id", "trajet_key").filter("overlaps_earlier").count() == 0


def test_closing_quality_check_alone_and_purge(loaded, tmp_path):
    spark, target, src, _ = loaded
    cfg = LoadConfig(target=target)
    rows = pipeline.quality_check(spark, cfg)       # the three closing checks pass
    assert {r["rule"] for r in rows} == {"d7_negative_amount", "d11_orphan_client",
                                         "d12_not_empty"}
    # an empty reservation fact fails the closing check
    other = LoadConfig(target=str(tmp_path))
    pipeline.run(spark, src, LoadConfig(target=str(tmp_path), gate="off"))
    run = versions.Run(spark, str(tmp_path))
    run.write(run.read("fact_reservation").limit(0), "fact_reservation")
    run.commit()
    with pytest.raises(quality.QualityGateError, match="d12_not_empty on fact_reservation: 1/0"):
        pipeline.quality_check(spark, other)
    pipeline.purge(spark, other)
    left = versions.current(spark, str(tmp_path)).tables
    assert "fact_trajet" not in left and "dim_date" in left


def _with_out_of_calendar_trip(spark):
    src = adapter.source_tables(spark, SF001)
    src["trajet"] = src["trajet"].withColumn(
        "date_depart", F.when(F.col("id_trajet") == 1, F.lit("2030-01-01").cast("date"))
        .otherwise(F.col("date_depart")))
    return src


def test_out_of_calendar_date_is_kept_and_reported(spark, tmp_path):
    src = _with_out_of_calendar_trip(spark)
    cfg = LoadConfig(target=str(tmp_path), gate="report", calendar=("1995-01-01", "2001-12-31"))
    pipeline.run(spark, src, cfg)
    assert read_table(spark, str(tmp_path), "fact_trajet").count() == TRIPS_OK
    rep = {(r.rule, r.table_name): r for r in read_table(spark, str(tmp_path), "_quality").collect()}
    assert rep[("d16_fk:date_key", "fact_trajet")].violations == 1


def test_strict_calendar_rejects_out_of_calendar_date(spark, tmp_path):
    src = _with_out_of_calendar_trip(spark)
    cfg = LoadConfig(target=str(tmp_path), gate="off", calendar=("1995-01-01", "2001-12-31"),
                     strict_calendar=True)
    pipeline.run(spark, src, cfg)
    assert read_table(spark, str(tmp_path), "fact_trajet").count() == TRIPS_OK - 1
    hit = read_table(spark, str(tmp_path), "fact_trajet_rejected").filter("id_trajet = 1").first()
    assert list(hit.reject_reasons) == ["date"]


def test_keys_of_the_warehouse_are_the_global_ranks(loaded):
    spark, target, _, _ = loaded
    for name in schemas.LOAD_ORDER:
        spec = schemas.WAREHOUSE[name]
        df = read_table(spark, str(target), name)
        rank = F.row_number().over(Window.orderBy(*spec.natural_key))
        bad = df.withColumn("e", rank).filter(F.col(spec.surrogate_key) != F.col("e"))
        assert df.count() and bad.count() == 0, name


def _contents(spark, target):
    return {n: sorted(map(str, read_table(spark, str(target), n).drop("load_ts").collect()))
            for n in ("dim_date",) + schemas.LOAD_ORDER}


@pytest.mark.parametrize("fault", ["trip", "gate", "dimension"])
def test_a_refused_run_leaves_the_previous_version_whole(loaded, tmp_path, fault):
    spark, target, src, _ = loaded
    first = LoadConfig(target=str(tmp_path), gate="off")
    pipeline.run(spark, src, first)
    before = _contents(spark, tmp_path)
    bad, gate = dict(src), "off"
    # Client keys shift, so that old facts beside new dimensions would be wrong.
    bad["client"] = src["client"].filter("id_client > 3")
    if fault == "trip":
        bad["trajet"] = src["trajet"].withColumn("date_depart", F.lit(None).cast("date"))
    elif fault == "dimension":
        bad["gare"] = src["gare"].unionByName(src["gare"].limit(1))
    else:
        gate = "full"
    with pytest.raises((PublishRefused, quality.QualityGateError)):
        pipeline.run(spark, bad, LoadConfig(target=str(tmp_path), gate=gate))
    assert _contents(spark, tmp_path) == before
    assert not os.path.exists(f"{tmp_path}/_runs") or not os.listdir(f"{tmp_path}/_runs")
    assert len(os.listdir(f"{tmp_path}/_data")) == 1


def test_duplicate_natural_keys_are_refused_or_quarantined(loaded, tmp_path):
    spark, _, src, _ = loaded
    bad = dict(src)
    again = src["client"].filter("id_client <= 5").withColumn("ville", F.lit("zz"))
    bad["client"] = src["client"].unionByName(again)
    with pytest.raises(PublishRefused, match="dim_client: .* is not unique"):
        pipeline.run(spark, bad, LoadConfig(target=str(tmp_path), gate="off"))
    assert "dim_client" not in versions.current(spark, str(tmp_path)).tables
    pipeline.run(spark, bad, LoadConfig(target=str(tmp_path), gate="off",
                                        constraints="quarantine"))
    assert read_table(spark, str(tmp_path), "fact_reservation").count() == RES_OK
    rej = read_table(spark, str(tmp_path), "dim_client_rejected").collect()
    surplus = src["client"].filter("id_client <= 5").count()
    assert len(rej) == surplus and all(list(r.reject_reasons) == ["unique:id_client"] for r in rej)


def test_quarantine_covers_dimensions_and_lengths(loaded, tmp_path):
    spark, _, src, _ = loaded
    bad = dict(src)
    bad["client"] = src["client"].withColumn(
        "nom", F.when(F.col("id_client") == 2, F.lit("x" * 60)).otherwise(F.col("nom")))
    pipeline.run(spark, bad, LoadConfig(target=str(tmp_path), gate="off",
                                        constraints="quarantine"))
    rej = read_table(spark, str(tmp_path), "dim_client_rejected").collect()
    assert [(r.id_client, list(r.reject_reasons)) for r in rej] == [(2, ["length:nom"])]
    assert read_table(spark, str(tmp_path), "dim_client").filter("length(nom) > 50").count() == 0
