"""Measures and time intelligence against brute force on a small fact."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareline.operators.measures import MEASURES, measure, rides, with_rides_last_24_hours
from fareline.operators.periods import (
    month_over_month,
    month_to_date,
    rolling_days,
    same_day_prior_month,
)
from fareline.plans.star import dim_date

FACT = (
    "g string, date_key date, pickup_timestamp timestamp, total_fare double, tip_amount double, "
    "subtotal double, is_completed boolean, is_cancelled boolean, is_surged boolean, "
    "is_intercity boolean, was_rated boolean, surge_multiplier double, distance_miles double, "
    "duration_minutes int, passenger_rating_given int, _source_system string"
)


def facts():
    rng = random.Random(7)
    out = []
    for i in range(120):
        # Few days and gaps, month ends included, some outside the calendar.
        day = rng.choice([date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31), date(2019, 12, 31)]
                         + [date(2024, 1, 1) + timedelta(rng.randrange(120)) for _ in range(6)])
        done = rng.random() < 0.6
        rating = rng.choice([None, 3, 5]) if done else None
        surge = rng.choice([1.0, 1.5, None])
        city = rng.choice([True, False, None])
        out.append(("ab"[i % 2], day, datetime(day.year, day.month, day.day, rng.randrange(24)), float(rng.randrange(5, 90)),
                    1.0, 10.0, done, not done and rng.random() < 0.5, None if surge is None else surge > 1, city,
                    rating is not None, surge, 2.5, 30, rating, rng.choice(["eventhub", "bulk_file"])))
    return out


@pytest.fixture(scope="module")
def data():
    return facts()


@pytest.fixture
def fact(rows, data):
    return rows(data, FACT)


@pytest.fixture(scope="module")
def days(spark):
    return dim_date(spark)


def test_measures_of_an_empty_context(fact):
    row = measure(fact.where("false")).first().asDict()
    assert row["total_rides"] == 0 and row["completed_rides"] == 0
    for name in ("completion_rate", "tip_rate", "surge_share", "rating_response_rate", "avg_fare", "last_ride_received"):
        assert row[name] is None


def test_ratio_measures(fact, data):
    row = measure(fact).first()
    surged = [r[11] for r in data if r[8]]
    assert row.avg_surge_multiplier == pytest.approx(sum(surged) / len(surged))
    assert row.completion_rate == pytest.approx(sum(r[6] for r in data) / len(data))
    assert row.intercity_share == pytest.approx(sum(bool(r[9]) for r in data) / len(data))
    assert row.rating_response_rate == pytest.approx(sum(r[10] for r in data) / sum(r[6] for r in data))
    assert row.total_hours == 60 and row.tip_rate == pytest.approx(0.1)
    assert row.completed_revenue == sum(r[3] for r in data if r[6])
    assert len(MEASURES) == 23


def test_last_24_hours_ignore_the_context(fact, data):
    now = datetime(2024, 2, 29, 23)
    report = measure(fact, ["total_rides"], ["g"])
    counted = with_rides_last_24_hours(report, fact, F.lit("2024-02-29 23:00:00").cast("timestamp"))
    expected = sum(r[2] >= now - timedelta(days=1) for r in data)
    assert {r.rides_last_24_hours for r in counted.collect()} == {expected}
    # Over everything the same number comes from the report's own scan.
    overall = measure(fact, ["total_rides"], now=F.lit("2024-02-29 23:00:00").cast("timestamp"))
    assert overall.first().rides_last_24_hours == expected
    assert "Subquery" not in overall._jdf.queryExecution().executedPlan().toString()


SPINE = [date(2020, 1, 1) + timedelta(i) for i in range(2922)]


def prior(day):
    first = day.replace(day=1) - timedelta(days=1)
    return first.replace(day=min(day.day, first.day))


@pytest.mark.parametrize("by", [(), ("g",)])
def test_time_intelligence_equals_brute_force(fact, days, data, by):
    groups = {(r[0],) if by else () for r in data}
    per_day = defaultdict(list)
    for r in data:
        if r[1] in set(SPINE):
            per_day[((r[0],) if by else (), r[1])].append(r[3])
    month, week, before = {}, {}, {}
    for g in groups:
        for day in SPINE:
            so_far = [v for d in range(1, day.day + 1) for v in per_day.get((g, day.replace(day=d)), [])]
            recent = [v for i in range(7) for v in per_day.get((g, day - timedelta(i)), [])]
            earlier = per_day.get((g, prior(day)))
            if so_far:
                month[(*g, day)] = sum(so_far)
            if recent:
                week[(*g, day)] = len(recent)
            if earlier:
                before[(*g, day)] = sum(earlier)
    fare = F.sum("total_fare")

    def keyed(df, name):
        return {(*[r[c] for c in by], r.date_key): r[name] for r in df.collect()}

    assert keyed(month_to_date(fact, days, fare, "m", by), "m") == month
    assert keyed(rolling_days(fact, days, rides(), 7, "w", by), "w") == week
    assert keyed(same_day_prior_month(fact, days, fare, "p", by), "p") == before


def test_totals_over_days_use_windows_of_bounded_blocks(fact, days, data):
    """No row is multiplied before it is added up, and long frames have longer blocks."""
    fare = F.sum("total_fare")
    days = days.sparkSession.createDataFrame([(day,) for day in SPINE], "date_key date")
    for total in (month_to_date(fact, days, fare, "m", ["g"]), rolling_days(fact, days, fare, 7, "w", ["g"])):
        text = total._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in text and "Window" in text
    listed = [r for r in data if r[1] in set(SPINE)]
    for length in (1, 31, 32, 33, 90):
        found = {r.date_key: r.w for r in rolling_days(fact, days, rides(), length, "w").collect()}
        expected = {day: n for day in SPINE if (n := sum(day - timedelta(length) < r[1] <= day for r in listed))}
        assert found == expected


def test_month_over_month(rows, days):
    fact = rows([(date(2024, 1, 5), 10.0), (date(2024, 2, 5), 15.0), (date(2024, 4, 5), 4.0), (date(2027, 12, 1), 1.0)],
                "date_key date, total_fare double")
    found = {
        r.first_day_of_month.isoformat()[:7]: (r.current, r.prior, r.change)
        for r in month_over_month(fact, days, F.sum("total_fare")).collect()
    }
    assert found == {
        "2024-01": (10.0, None, None), "2024-02": (15.0, 10.0, 0.5), "2024-03": (None, 15.0, -1.0),
        "2024-04": (4.0, None, None), "2024-05": (None, 4.0, -1.0), "2027-12": (1.0, None, None),
    }
