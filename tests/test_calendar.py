import datetime as dt

from starfold.operators.calendar import (calendar_dimension, calendar_spanning, date_series,
                                         insert_if_absent)


def test_reference_span_has_2922_days(spark):
    assert date_series(spark, "2019-01-01", "2026-12-31").count() == 2922


def test_calendar_attributes(spark):
    cal = calendar_dimension(spark, "2019-01-01", "2019-01-07")
    rows = {r.date_key: r for r in cal.collect()}
    first = rows[20190101]
    assert (first.full_date, first.year, first.quarter, first.month, first.month_name,
            first.day_of_month, first.day_of_week, first.day_name, first.is_weekend) == \
        (dt.date(2019, 1, 1), 2019, 1, 1, "January", 1, 2, "Tuesday", False)
    assert rows[20190105].is_weekend and rows[20190106].day_of_week == 7
    assert rows[20190106].day_name == "Sunday"


def test_locale_names(spark):
    months = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
              "septembre", "octobre", "novembre", "décembre"]
    days = ["lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche"]
    r = calendar_dimension(spark, "2019-08-01", "2019-08-01", months, days).first()
    assert (r.month_name, r.day_name) == ("août", "jeudi")


def test_insert_if_absent(spark):
    old = calendar_dimension(spark, "2019-01-01", "2019-01-10")
    new = calendar_dimension(spark, "2019-01-05", "2019-01-15").unionByName(
        calendar_dimension(spark, "2019-01-15", "2019-01-15"))
    added = insert_if_absent(old, new, ["date_key"])
    assert sorted(r.date_key for r in added.collect()) == list(range(20190111, 20190116))


def test_calendar_spanning_whole_years(spark):
    df = spark.createDataFrame([(dt.date(2020, 3, 1),), (dt.date(2021, 2, 1),)], "d date")
    assert calendar_spanning(df, "d").count() == 366 + 365
