from __future__ import annotations

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from vitalgauge import functions as X


def one(spark, column, **values):
    """Value of a column expression over one row of typed literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    ("rank", "score"),
    [(0.0, 0), (0.0001, 1), (0.3499, 1), (0.35, 3), (0.6999, 3), (0.70, 4), (0.8999, 4), (0.90, 7), (1.0, 7), (None, 0)],
)
def test_band_score(spark, rank, score):
    assert one(spark, X.band_score(F.lit(rank).cast("double"))) == score


def test_band_score_with_other_bands(spark):
    assert one(spark, X.band_score(F.lit(0.6), bands=((0.5, 2), (0.8, 9)))) == 2


@pytest.mark.parametrize(
    ("a", "b", "scale", "expected"), [(1, 4, 1, 0.25), (1, 4, 100, 25.0), (1, 0, 1, None), (None, 2, 1, None), (0, 5, 1, 0.0)]
)
def test_safe_ratio(spark, a, b, scale, expected):
    assert one(spark, X.safe_ratio(F.lit(a), F.lit(b), scale)) == expected


def test_year_month_label(spark):
    assert one(spark, X.year_month_label(F.lit(2001), F.lit(7))) == "2001-07"
    assert one(spark, X.year_month_label(F.lit(2001), F.lit(12))) == "2001-12"
    assert one(spark, X.year_month_label(F.lit(2001), F.lit(None))) is None


def test_dates(spark):
    day = dt.date(2024, 3, 31)
    assert one(spark, X.months_before(day, 1)) == dt.date(2024, 2, 29)
    assert one(spark, X.days_before(day, 90)) == dt.date(2024, 1, 1)
    assert one(spark, X.format_month(F.lit(day))) == "2024-03"
    year, month = X.date_parts(F.lit(day))
    assert (one(spark, year), one(spark, month)) == (2024, 3)


@pytest.mark.parametrize(
    ("value", "third", "key", "keys"),
    [
        ("plan.com-us.42", "42", "plan.com-us.42", ["plan.com-us.42", "42"]),
        ("plan.com-eu.42", "42", "plan.com-eu.42", ["plan.com-eu.42", "42"]),
        ("42", "", "42", ["42"]),
        ("a.b", "", "a.b", ["a.b"]),
        ("a.b.", "", "a.b.", ["a.b."]),
        ("a.b.c.d", "c", "a.b.c.d", ["a.b.c.d"]),
        ("", "", None, []),
        (None, None, None, []),
    ],
)
def test_plan_ids(spark, value, third, key, keys):
    text = F.lit(value).cast("string")
    assert one(spark, X.third_token(text)) == third
    assert one(spark, X.plan_key(text)) == key
    assert one(spark, X.plan_keys(text)) == keys


@pytest.mark.parametrize(("value", "short"), [("plan.com-us.7", "7"), ("plan.com-eu.7", "7"), ("7", "7"), (None, None)])
def test_strip_id_prefix(spark, value, short):
    assert one(spark, X.strip_id_prefix(F.lit(value).cast("string"))) == short


def test_text(spark):
    assert one(spark, X.normalize_department(F.lit("human res team"))) == "human_res_team"
    assert one(spark, X.text_not_empty(F.lit(""))) is False
    assert one(spark, X.text_not_empty(F.lit(None).cast("string"))) is None
    assert one(spark, X.contains_text(F.lit("Forms,WorkApps"), "WorkApps")) is True
    assert one(spark, X.contains_text(F.lit("workapps"), "WorkApps")) is False
    assert one(spark, X.concat_label(F.lit("n"), F.lit("a, b"))) == "n (a, b)"
    assert one(spark, X.concat_label(F.lit("n"), F.lit(None).cast("string"))) is None


def test_arrays_and_sums(spark):
    assert one(spark, X.array_not_empty(F.array().cast("array<string>"))) is False
    assert one(spark, X.array_not_empty(F.lit(None).cast("array<string>"))) is None
    assert one(spark, X.sum_columns(F.lit(1), F.lit(2), F.lit(3))) == 6
    assert one(spark, X.sum_columns(F.lit(1), F.lit(None).cast("int"))) is None


def test_round_arr_is_half_up(spark):
    assert one(spark, X.round_arr(F.lit(decimal.Decimal("2.50")))) == decimal.Decimal("3")
    assert one(spark, X.round_arr(F.lit(decimal.Decimal("-2.50")))) == decimal.Decimal("-3")


def test_json_path(spark):
    document = F.lit('{"industry": "Energy", "size": 3}')
    assert one(spark, X.json_path(document, "industry")) == "Energy"
    assert one(spark, X.json_path(document, "size")) == "3"
    assert one(spark, X.json_path(document, "subIndustry")) is None


def test_case_and_coalesce(spark):
    assert one(spark, X.case_flag(F.lit(None).cast("boolean"))) == 0
    assert one(spark, X.case_flag(F.lit(True), "x", None)) == "x"
    assert one(spark, X.coalesce_first(F.lit(None).cast("int"), default=4)) == 4
    assert one(spark, X.coalesce_first(F.lit(None).cast("int"), F.lit(2), F.lit(3))) == 2
