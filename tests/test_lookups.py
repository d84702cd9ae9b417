import datetime as dt

from pyspark.sql import functions as F

from starfold.operators.lookups import (FkCheck, Lookup, fk_audit, orphans, resolve_keys,
                                        resolve_with_reasons,
                                        split_resolved, temporal_violations)
from starfold.plans import facts

TRIP = ("id_trajet int, id_train int, id_gare_depart int, id_gare_arrivee int, "
        "date_depart date, heure_depart string, heure_arrivee_prevue string, "
        "distance_km int, statut_circulation string")
RES = ("id_reservation int, id_client int, id_trajet int, date_reservation date, "
       "tarif_type string, classe_reservee string, prix_unitaire decimal(10,2), "
       "nb_passagers smallint, montant_total decimal(12,2), canal_vente string, "
       "mode_paiement string, statut_reservation string")


def _maps(spark):
    train = spark.createDataFrame([(100, 1)], "id_train int, train_key int")
    gare = spark.createDataFrame([(10, 1), (20, 2)], "id_gare int, gare_key int")
    return train, gare


def test_trip_keys_resolved(spark):
    train, gare = _maps(spark)
    trips = spark.createDataFrame(
        [(1, 100, 10, 20, dt.date(2023, 6, 1), "08:00:00", "10:00:00", 450, "OK")], TRIP)
    ok, bad = facts.fact_trajet(trips, train, gare, with_keys=False)
    r = ok.first()
    assert (r.train_key, r.gare_depart_key, r.gare_arrivee_key, r.date_key) == \
        (1, 1, 2, 20230601)
    assert bad.count() == 0
    assert ok.columns == ["id_trajet", "date_key", "train_key", "gare_depart_key",
                          "gare_arrivee_key", "heure_depart", "heure_arrivee_prevue",
                          "distance_km", "statut_circulation"]


def test_trip_with_unknown_train_is_rejected_with_reason(spark):
    train, gare = _maps(spark)
    trips = spark.createDataFrame(
        [(1, 999, 10, 20, dt.date(2023, 6, 1), None, None, 1, None),
         (2, 100, 10, 30, dt.date(2023, 6, 2), None, None, 1, None),
         (3, 100, 10, 20, dt.date(2023, 6, 3), None, None, 1, None)], TRIP)
    ok, bad = facts.fact_trajet(trips, train, gare)
    assert [r.id_trajet for r in ok.collect()] == [3]
    assert ok.first().trajet_key == 1          # numbered after rejection
    reasons = {r.id_trajet: list(r.reject_reasons) for r in bad.collect()}
    assert reasons == {1: ["train"], 2: ["gare_arrivee"]}


def test_reservation_keys_and_cascade(spark):
    clients = spark.createDataFrame([(50, 5)], "id_client int, client_key int")
    trips = spark.createDataFrame([(1, 7)], "id_trajet int, trajet_key long")
    res = spark.createDataFrame(
        [(1, 50, 1, dt.date(2023, 5, 20), None, None, 10, 1, 10, None, None, None),
         (2, 50, 99, dt.date(2023, 5, 20), None, None, 10, 1, 10, None, None, None)],
        RES.replace("decimal(10,2)", "int").replace("decimal(12,2)", "int")
           .replace("smallint", "int"))
    ok, bad = facts.fact_reservation(res, clients, trips)
    r = ok.first()
    assert (r.client_key, r.trajet_key, r.date_key, r.reservation_key) == (5, 7, 20230520, 1)
    assert [list(x.reject_reasons) for x in bad.collect()] == [["trajet"]]


def test_null_key_never_matches(spark):
    m = spark.createDataFrame([(1, 10)], "nk int, sk int")
    f = spark.createDataFrame([(1,), (None,)], "k int")
    assert resolve_keys(f, [Lookup("x", m, "nk", "sk", "k")]).count() == 1
    assert orphans(f, "k", m, "nk").count() == 1   # the null key is an orphan


def test_duplicate_map_keys_fan_out(spark):
    m = spark.createDataFrame([(1, 10), (1, 11)], "nk int, sk int")
    f = spark.createDataFrame([(1,)], "k int")
    assert resolve_keys(f, [Lookup("x", m, "nk", "sk", "k")]).count() == 2


def test_role_playing_reuses_one_broadcast(spark):
    _, gare = _maps(spark)
    f = spark.createDataFrame([(10, 20), (20, 10)], "a int, b int")
    out = resolve_keys(f, [Lookup("a", gare, "id_gare", "gare_key", "a", "ka"),
                           Lookup("b", gare, "id_gare", "gare_key", "b", "kb")])
    assert sorted(tuple(r) for r in out.collect()) == [(10, 20, 1, 2), (20, 10, 2, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_split_counts_add_up(spark):
    m = spark.range(0, 50).select(F.col("id").alias("nk"), (F.col("id") + 1).alias("sk"))
    f = spark.range(0, 100).select(F.col("id").alias("k"))
    ok, bad = split_resolved(f, [Lookup("x", m, "nk", "sk", "k")])
    assert ok.count() + bad.count() == 100 and bad.count() == 50


def test_temporal_violation(spark):
    r = spark.createDataFrame([(1, 20200102), (2, 20200101)], "k int, d int")
    t = spark.createDataFrame([(1, 20200101), (2, 20200101)], "k int, td int")
    assert temporal_violations(r, t, "k", F.col("d") > F.col("td")).count() == 1


def test_fk_audit(spark):
    tables = {"c": spark.createDataFrame([(1,), (2,), (None,)], "p int"),
              "p": spark.createDataFrame([(1,)], "id int")}
    rows = fk_audit(tables, [FkCheck("c", "p", "p", "id")]).collect()
    assert rows[0].orphans == 2


def test_null_keys_spread_in_shuffled_lookup(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fact = spark.range(0, 3000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 100).alias("k"),
            F.col("id").alias("v"))
        m = spark.range(0, 50).select(F.col("id").alias("nk"), (F.col("id") * 10).alias("sk"))
        r = resolve_with_reasons(fact, [Lookup("x", m, "nk", "sk", "k", broadcast=False)])
        assert r.filter(F.size("reject_reasons") == 0).count() == 1000
        per_task = (r.filter(F.col("k").isNull()).groupBy(F.spark_partition_id()).count()
                    .collect())
        assert len(per_task) > 1 and max(x[1] for x in per_task) < 1000
        o = orphans(fact, "k", m, "nk", broadcast=False)
        assert o.count() == 2000 and o.columns == ["k", "v"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
