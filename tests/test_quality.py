import pytest
from pyspark.sql import functions as F

from starfold.plans import quality
from starfold.plans.quality import (CountMatch, Domain, ForeignKeyRule, Later, NotEmpty,
                                    QualityGateError, RowRule, Unique)


def _tables(spark, bad=False):
    res = spark.createDataFrame(
        [(1, 1, 10, 20230101, 10.0, 2, 20.0), (2, 2, 11, 20230102, 5.0, 1, 5.0),
         (3, 1, 10, 20230101, 7.0, 3, 21.0)],
        "reservation_key long, client_key int, trajet_key long, date_key int, "
        "prix_unitaire double, nb_passagers int, montant_total double")
    if bad:
        res = res.union(spark.createDataFrame(
            [(3, 9, 12, 20230109, -1.0, 0, 99.0)], res.schema))
    trips = spark.createDataFrame([(10, 20230101, 5), (11, 20230105, 7), (12, 20230101, 1)],
                                  "trajet_key long, date_key int, distance_km int")
    clients = spark.createDataFrame([(1, "H"), (2, "F")] + ([(3, "X")] if bad else []),
                                    "client_key int, sexe string")
    src = spark.range(0, 4 if bad else 3)
    cal = spark.range(20230101, 20230106).select(F.col("id").cast("int").alias("date_key"))
    return {"r": res, "t": trips, "c": clients, "src": src, "cal": cal}


RULES = [
    RowRule("d7", "r", "montant_total < 0 OR prix_unitaire < 0"),
    RowRule("d8", "r", "nb_passagers <= 0"),
    RowRule("d6", "r", "abs(montant_total - prix_unitaire * nb_passagers) > 0.01", 0.5),
    Unique("d2", "r", ("reservation_key",)),
    Domain("d3", "c", "sexe", ("H", "F")),
    ForeignKeyRule("d11", "r", "client_key", "c", "client_key"),
    ForeignKeyRule("d16", "r", "date_key", "cal", "date_key"),
    Later("d10", "r", "t", "trajet_key", "date_key", "date_key", 0.5),
    NotEmpty("d12", "r"),
    CountMatch("d1", "r", "src"),
]


def _report(spark, bad):
    rep = quality.evaluate(_tables(spark, bad), RULES)
    return {r.rule: r for r in rep.collect()}


def test_clean_tables_pass(spark):
    rep = _report(spark, False)
    assert all(r.passed for r in rep.values()), [r for r in rep.values() if not r.passed]
    assert rep["d10"].violations == 0 and rep["d6"].violations == 0


def test_one_planted_error_per_rule(spark):
    rep = _report(spark, True)
    for name in ("d7", "d8", "d2", "d11", "d16"):
        assert rep[name].violations == 1, name
        assert not rep[name].passed, name
    assert rep["d3"].violations == 1           # the client table got an 'X'
    assert rep["d10"].violations == 1 and rep["d10"].rate == 0.25
    assert rep["d1"].violations == 0           # 4 rows vs 4 source rows
    assert rep["d12"].passed


def test_gate_raises_with_measure(spark):
    rep = quality.evaluate(_tables(spark, True), RULES)
    with pytest.raises(QualityGateError, match="d7 on r: 1/4"):
        quality.gate(rep)


def test_empty_table_rate_is_null_and_not_empty_fails(spark):
    e = spark.createDataFrame([], "x int")
    rep = {r.rule: r for r in quality.evaluate(
        {"e": e}, [RowRule("r", "e", "x < 0", 0.1), NotEmpty("n", "e")]).collect()}
    assert rep["r"].rate is None and rep["r"].passed
    assert not rep["n"].passed


def test_row_rules_of_a_table_use_one_scan(spark):
    t = _tables(spark, False)
    rep = quality.evaluate(t, [r for r in RULES if isinstance(r, RowRule)])
    plan = rep._jdf.queryExecution().executedPlan().toString()
    # three rules, one aggregate over one scan of the table
    assert plan.count("Scan ExistingRDD") == 1 or plan.count("LocalTableScan") <= 1


def test_constraint_rules_from_catalog():
    from starfold import schemas
    names = [r.rule for r in quality.constraint_rules(schemas.FACT_RESERVATION)]
    assert "d14_check:nb_passagers_positive" in names
    assert "d16_fk:trajet_key" in names and "d13_not_null:date_key" in names
    assert "d15_length:tarif_type" in names
