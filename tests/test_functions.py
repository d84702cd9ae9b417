import datetime as dt

from pyspark.sql import functions as F

from starfold.functions import (date_key, label_to_bool, normalize_city, normalize_sex,
                                strip_ws, title_case)


def _one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_sex_long_and_short_forms(spark):
    assert _one(spark, ["HOMME", "f", "  Femme", "hOmMe ", "h", "F "], normalize_sex) == \
        ["H", "F", "F", "H", "H", "F"]


def test_sex_unknown_falls_back_to_first_letter(spark):
    assert _one(spark, ["other", "né-9"], normalize_sex) == ["O", "N"]


def test_sex_blanks_null_and_empty(spark):
    assert _one(spark, [" m ", "\tf\n", None, ""], normalize_sex) == ["H", "F", None, ""]


def test_city_case_and_blanks(spark):
    assert _one(spark, ["bReSt", "\tLE MANS ", "aix", "DIJON  "], normalize_city) == \
        ["Brest", "Le Mans", "Aix", "Dijon"]


def test_city_python_title_rules(spark):
    got = _one(spark, ["SAINT-ÉTIENNE", "villeneuve d'ascq", "3rd st", "\tlille\n", None,
                       " metz "], normalize_city)
    assert got == ["Saint-Étienne", "Villeneuve D'Ascq", "3Rd St", "Lille", None, "Metz"]


def test_title_case_keeps_non_letters(spark):
    assert _one(spark, ["a1b2 c-d", "ÉCOLE"], title_case) == ["A1B2 C-D", "École"]


def test_strip_unicode_white_space(spark):
    assert _one(spark, ["  x \t", "  "], strip_ws) == ["x", ""]


def test_date_key(spark):
    got = _one(spark, [dt.date(1987, 10, 9), dt.date(2000, 2, 29), None], date_key, "date")
    assert got == [19871009, 20000229, None]


def test_date_key_from_timestamp(spark):
    got = _one(spark, [dt.datetime(1999, 12, 31, 23, 59)], date_key, "timestamp")
    assert got == [19991231]


def test_electrification_labels(spark):
    got = _one(spark, ["Electrifiée", "Non électrifiée", "electrifiée", "Oui", None],
               label_to_bool)
    assert got == [True, False, None, None, None]


def test_service_year_filled(spark):
    df = spark.createDataFrame([(1871, 1999), (None, 2007), (None, None)],
                               "a smallint, b smallint")
    assert [r[0] for r in df.select(F.coalesce("a", "b")).collect()] == [1871, 2007, None]
