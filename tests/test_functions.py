import pytest
from pyspark.sql import functions as F

from fareline.functions import bands, calendar, fares
from fareline.plans.star import dim_date


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_distance_band_sends_null_to_the_top(rows):
    df = rows([(0.0,), (2.99,), (3.0,), (9.99,), (10.0,), (24.99,), (25.0,), (None,)], "m double")
    expected = ["Short"] * 2 + ["Medium"] * 2 + ["Long"] * 2 + ["Very long"] * 2
    assert column(df, bands.distance_band(F.col("m"))) == expected


def test_fare_band_names_missing_fares(rows):
    df = rows([(14.99,), (15.0,), (59.99,), (60.0,), (119.99,), (120.0,), (None,)], "f double")
    assert column(df, bands.fare_band(F.col("f"))) == [
        "Under $15", "$15 to $30", "$30 to $60", "$60 to $120", "$60 to $120", "$120 and over", "Unknown",
    ]


def test_tier_rank(rows):
    df = rows([("UberPOOL",), ("UberX",), ("Uber Comfort",), ("UberXL",), ("Uber Black",), ("Taxi",), (None,)], "t string")
    assert column(df, bands.tier_rank(F.col("t"))) == [1, 2, 3, 4, 5, 99, 99]


def test_minutes_count_crossed_boundaries(rows):
    df = rows([("2026-01-01 10:00:59", "2026-01-01 10:01:00"), ("2026-01-01 10:00:00", "2026-01-01 10:00:59")], "a string, b string")
    times = [F.col(c).cast("timestamp") for c in "ab"]
    assert column(df, calendar.minutes_crossed(*times)) == [1, 0]


def test_guarded_ratios_are_null_without_a_positive_guard(rows):
    df = rows([(10.0, 40), (10.0, 0), (10.0, None), (10.0, -5)], "miles double, minutes int")
    assert column(df, fares.speed_mph(F.col("miles"), F.col("minutes"))) == [15.0, None, None, None]
    df = rows([(10.0, 4.0), (10.0, 0.0)], "fare double, miles double")
    assert column(df, fares.per_mile(F.col("fare"), F.col("miles"))) == [2.5, None]
    df = rows([(1.0, 8.0), (1.0, 0.0)], "tip double, subtotal double")
    assert column(df, fares.tip_percent(F.col("tip"), F.col("subtotal"))) == [12.5, None]


@pytest.mark.parametrize("quantity, rate, total", [(1.15, 2.25, 2.59), (2.5, 1.5, 3.75), (0.01, 0.5, 0.01), (0.01, 0.49, 0.0)])
def test_charges_round_half_up(rows, quantity, rate, total):
    df = rows([(quantity, rate)], "q double, r double")
    assert column(df, fares.charge(F.col("q"), F.col("r"))) == [total]


def test_dim_date_covers_the_spine(spark):
    days = dim_date(spark, F.lit("2024-02-29").cast("date"))
    assert len(days.columns) == 21
    assert days.count() == 2922
    leap = days.where("date_key = '2024-02-29'").first()
    assert (leap.quarter_label, leap.month_label, leap.day_name) == ("Q1 2024", "Feb 2024", "Thursday")
    assert (leap.year_month_number, leap.year_quarter_number) == (202402, 20241)
    assert leap.last_day_of_month == leap.date_key and leap.is_today and leap.is_past
    assert days.where("is_past").count() == 366 * 1 + 365 * 3 + 60
    assert days.where("is_weekend <> (day_name in ('Saturday', 'Sunday'))").count() == 0
