import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from checks import stand_ins
from tarmac.operators import adhoc, cells, coverage, dashboard, marts
from tests.conftest import one, rows


def flights(spark, *given):
    """(month, dep flag, arr flag, cancelled, dep delay, arr delay, origin, dest)"""
    frame = spark.createDataFrame(
        list(given),
        "MONTH int, IS_DEP_DELAYED boolean, IS_ARR_DELAYED boolean, IS_CANCELLED boolean, DEP_DELAY_MIN double,"
        " ARR_DELAY_MIN double, ORIGIN string, DEST string",
    )
    causes = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]
    return frame.withColumns(
        {
            "YEAR": F.lit(2024), "FLIGHT_DATE": F.make_date(F.lit(2024), "MONTH", F.lit(5)), "DAY_OF_WEEK": F.lit(5),
            "AIRLINE_CODE": F.lit("AA"), "ORIGIN_CITY": F.concat("ORIGIN", F.lit(", ST")), "ORIGIN_STATE": F.lit("ST"),
            "DISTANCE": F.lit(500.0), **{name: F.when(F.col("IS_DEP_DELAYED"), F.lit(10.0)) for name in causes},
        }
    )


MIXED = [
    (1, True, True, False, 30.0, 20.0, "ATL", "LAX"),
    (1, False, False, False, 0.0, 0.0, "ATL", "LAX"),
    (1, None, None, False, None, None, "ATL", "LAX"),
    (1, None, None, True, None, None, "ATL", "LAX"),
    (1, True, None, None, 60.0, None, "ATL", "LAX"),
    (2, None, None, True, None, None, "SEA", "LAX"),
]


def test_null_flags_in_trends(spark):
    mart = marts.delay_trends_monthly(flights(spark, *MIXED))
    assert rows(mart) == [(2024, 1, 3, 1, 0, 33.33, 30.0, 20.0, 33.33, 33.33, 33.33)]
    counted = marts.delay_trends_monthly(flights(spark, *MIXED), count_cancelled=True)
    assert rows(counted.select("TOTAL_FLIGHTS", "TOTAL_CANCELLED")) == [(3, 1)]


def test_on_time_needs_both_flags(spark):
    mart = marts.airline_performance(flights(spark, *MIXED)).orderBy("MONTH")
    shown = mart.select("TOTAL_FLIGHTS", "DELAYED_FLIGHTS", "CANCELLED_FLIGHTS", "ON_TIME_FLIGHTS", "AVG_DEP_DELAY_MIN")
    assert rows(shown) == [(5, 2, 1, 1, 30.0), (1, 0, 1, 0, None)]


def test_no_arrivals_and_zero_denominators(spark):
    mart = marts.airport_stats(flights(spark, *MIXED)).orderBy("MONTH")
    assert rows(mart.select("AIRPORT", "DEP_FLIGHTS", "ARR_FLIGHTS", "ARR_DELAY_RATE")) == [
        ("ATL", 5, None, None),
        ("SEA", 1, None, None),
    ]
    quiet = flights(spark, (1, False, False, False, 0.0, 0.0, "ATL", "LAX"))
    assert one(marts.delay_trends_monthly(quiet))[5:] == (0.0, None, None, None, None, None)


def test_summary_over_all_null_sums(spark):
    mart = marts.airport_stats(flights(spark, *MIXED))
    summary = dashboard.airport_summary(mart, None, None, 0).orderBy("AIRPORT")
    assert rows(summary.select("AIRPORT", "ARR_FLIGHTS", "ARR_DELAY_RATE", "AVG_ARR_DELAY_MIN", "LABEL")) == [
        ("ATL", 0, 0.0, None, "ATL — ATL"),
        ("SEA", 0, 0.0, None, "SEA — SEA"),
    ]


def test_routes_need_ten_flights(spark):
    many = [(1, True, True, False, 30.0, 20.0, "ATL", "LAX")] * 10 + [(1, True, True, False, 30.0, 20.0, "ATL", "SEA")] * 9
    mart = marts.route_performance(flights(spark, *many))
    assert rows(mart.select("ROUTE", "TOTAL_FLIGHTS", "AVG_DISTANCE")) == [("ATL-LAX", 10, 500.0)]


def test_causes_without_rows(spark):
    empty = flights(spark, *MIXED).where("MONTH = 99")
    totals = rows(dashboard.cause_totals(marts.delay_cause_breakdown(empty)))
    assert [row[1:3] for row in totals] == [(0.0, 0.0)] * 5


def test_route_search_is_upper_cased(spark):
    frame = spark.createDataFrame([("LAX-JFK",), ("ATL-LAX",), (None,), ("SEA-BOS",)], "ROUTE string")
    assert sorted(r[0] for r in rows(dashboard.route_search(frame, "lax"))) == ["ATL-LAX", "LAX-JFK"]
    assert sorted(r[0] for r in rows(dashboard.route_search(frame, "^lax|bos$", pattern=True))) == ["LAX-JFK", "SEA-BOS"]
    assert one(dashboard.default_route(frame)) == ("LAX-JFK",)
    assert one(dashboard.default_route(frame.where("ROUTE LIKE '%A-%' OR ROUTE LIKE 'ATL%'"))) == ("ATL-LAX",)


def test_approximate_airline_count(spark):
    mart = marts.airline_performance(flights(spark, *MIXED))
    assert one(dashboard.airline_count(mart, approximate=True)) == (1,)


def test_roll_ups_agree(spark, small):
    rows_in = stand_ins.flights(spark, small)
    monthly = one(marts.delay_trends_monthly(rows_in).agg(F.sum("TOTAL_FLIGHTS"), F.sum("TOTAL_DELAYED")))
    daily = one(marts.delay_trends_daily(rows_in).agg(F.sum("TOTAL_FLIGHTS"), F.sum("TOTAL_DELAYED")))
    routes = one(marts.route_performance(rows_in, min_flights=1).agg(F.sum("TOTAL_FLIGHTS"), F.sum("DELAYED_FLIGHTS")))
    weekdays = one(adhoc.weekday_pattern(rows_in).agg(F.sum("TOTAL_FLIGHTS")))
    airlines = one(marts.airline_performance(rows_in).agg(F.sum("TOTAL_FLIGHTS")))
    assert monthly == daily == routes
    assert weekdays[0] == monthly[0] <= airlines[0] == rows_in.count()


@pytest.mark.parametrize("seed", range(3))
def test_trend_against_brute_force(spark, seed):
    pick = random.Random(seed)
    given = [
        (pick.choice([1, 2]), pick.choice([True, False, None]), None, pick.choice([True, False, None]),
         pick.choice([None, 0.0, 15.0, 31.0, 7.0]), pick.choice([None, 0.0, 3.0]), "ATL", "LAX")
        for _ in range(200)
    ]
    got = {row[1]: row for row in rows(marts.delay_trends_monthly(flights(spark, *given)))}
    for month in (1, 2):
        kept = [row for row in given if row[0] == month and row[3] is False]
        late = [row[4] for row in kept if row[4] is not None and row[4] > 0]
        assert got[month][2:5] == (len(kept), sum(row[1] is True for row in kept), 0)
        assert got[month][5] == pytest.approx(100 * sum(row[1] is True for row in kept) / len(kept), abs=0.00501)
        assert got[month][6] == pytest.approx(sum(late) / len(late), abs=0.00501)


def test_month_sequence_and_coverage(spark):
    bounds = spark.createDataFrame([("2023-11", "2024-02")], "START string, END string")
    requested = coverage.month_sequence(bounds)
    assert sorted(rows(requested)) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    have = flights(spark, *MIXED)
    assert sorted(rows(coverage.missing_months(requested, have))) == [(2023, 11), (2023, 12)]
    assert one(coverage.month_coverage(requested, have)) == (4, 2, 2)


def test_target_date(spark):
    rows_in = flights(spark, *MIXED)
    assert rows(marts.delay_trends_daily(rows_in, dt.date(2024, 1, 5)).select("FLIGHT_DATE")) == [(dt.date(2024, 1, 5),)]
    assert rows(marts.delay_trends_daily(rows_in, dt.date(2024, 1, 6))) == []
    assert rows(marts.airport_stats(rows_in, dt.date(2024, 2, 9)).select("AIRPORT")) == [("SEA",)]


@pytest.mark.parametrize("name", ["delay_trends_monthly", "airline_performance", "airport_stats", "delay_cause_breakdown"])
def test_cells_give_the_same_marts_with_null_flags(spark, name):
    given = flights(spark, *MIXED)
    direct = getattr(marts, name)(given)
    rolled = getattr(cells, name)(cells.flight_cells(given))
    assert rolled.columns == direct.columns
    assert sorted(rows(rolled), key=str) == sorted(rows(direct), key=str)


def test_cells_give_the_same_routes(spark):
    given = flights(spark, *(MIXED * 5))
    direct, rolled = marts.route_performance(given), cells.route_performance(cells.flight_cells(given))
    assert rolled.columns == direct.columns
    assert rows(rolled) == rows(direct) and direct.count() == 1


def test_mean_on_a_half_rounds_up(spark):
    """408.90 / 12 is 34.075; in binary it falls just below."""
    rates = [34.0] * 11 + [34.9]
    mart = spark.createDataFrame([(2024, m + 1, 10, 0, rate) for m, rate in enumerate(rates)],
        "YEAR int, MONTH int, TOTAL_FLIGHTS bigint, TOTAL_CANCELLED bigint, DELAY_RATE double")
    assert one(adhoc.annual_trend(mart))[1] == 34.08
