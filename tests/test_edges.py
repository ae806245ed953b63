import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from ridegauge.functions.occupancy import occupancy_pct, whole_average
from ridegauge.operators.windows import last_window, windowed_counts, without_late
from ridegauge.plans import changelog, reports, state


def test_overbooked(make_routes, make_trips):
    per_route = state.route_state(make_routes([(1, 2, "Bus", "A")]), make_trips([(1, 1, "Bus")] * 3))
    assert values(reports.available_seats_per_route(per_route)) == [(1, -1)]
    assert values(reports.occupancy_per_route(per_route)) == [(1, 150.0)]


def test_route_without_trips_and_trips_without_route(make_routes, make_trips):
    per_route = state.route_state(make_routes([(1, 10, "Bus", "A")]), make_trips([(9, 1, "Bus")]))
    assert values(per_route) == sorted([(1, 10, None), (9, None, 1)], key=repr)
    assert values(reports.passengers_per_route(per_route)) == [(9, 1)]
    assert values(reports.available_seats_per_route(per_route)) == [(1, 10)]
    assert values(reports.occupancy_per_route(per_route)) == []
    assert values(reports.total_passengers(per_route)) == [(0, 1)]
    assert values(reports.total_available_seats(per_route)) == [(0, 10)]


def test_capacity_zero_with_trips(make_routes, make_trips):
    per_route = state.route_state(make_routes([(1, 0, "Bus", "A")]), make_trips([(1, 1, "Bus")]))
    assert values(reports.available_seats_per_route(per_route)) == [(1, -1)]
    assert values(reports.occupancy_per_route(per_route)) == [(1, float("inf"))]


def test_republished_route(make_routes, make_trips):
    routes = make_routes([(1, 10, "Bus", "A"), (1, 20, "Taxi", "B")])
    trips = make_trips([(1, 5, "Bus")])
    assert values(state.route_state(routes, trips)) == [(1, 30, 1)]
    assert values(state.route_capacity(routes)) == [(1, 30)]
    assert values(state.type_routes(routes)) == [("Bus", 1), ("Taxi", 1)]
    latest = state.latest_routes(routes, "passengerCapacity", "transportType").drop("seq")
    assert values(latest) == [(1, 20, "Taxi")]


def test_null_keys_are_skipped(make_routes, make_trips):
    routes = make_routes([(None, 5, None, None), (1, None, "Bus", "A"), (2, 4, None, None)])
    trips = make_trips([(None, None, None), (2, 7, "Bus")])
    assert values(state.route_state(routes, trips)) == sorted(
        [(1, None, None), (2, 4, 1)], key=repr
    )
    assert values(state.type_state(routes, trips)) == [("Bus", 1, 1)]
    assert values(state.passenger_state(trips)) == [(7, 1)]
    assert values(reports.operators_list(routes)) == [("A",)]
    assert values(state.route_capacity(routes)) == [(2, 4)]


def test_counters_hold_the_single_states(make_routes, make_trips):
    routes = make_routes([(1, 5, "Bus", "A"), (1, None, "Taxi", None), (2, 0, None, "A")])
    trips = make_trips([(1, 7, "Bus"), (9, 7, "Bus"), (None, None, None)])
    counted = state.counters(routes, trips)
    assert values(state.routes_counted(counted)) == values(state.route_state(routes, trips))
    assert values(state.types_counted(counted)) == values(state.type_state(routes, trips))
    assert values(state.passengers_counted(counted)) == values(state.passenger_state(trips))
    assert values(state.operators_counted(counted)) == [("A", 2)]


def test_empty_inputs_give_empty_reports(make_routes, make_trips):
    routes, trips = make_routes([]), make_trips([])
    per_route = state.route_state(routes, trips)
    for report in (
        reports.total_passengers, reports.total_available_seats, reports.total_occupancy,
        reports.occupancy_per_route,
    ):
        assert values(report(per_route)) == []
    assert values(reports.total_passengers(state.all_passengers(trips))) == []
    assert values(reports.busiest_transport_type(state.type_state(routes, trips))) == []
    assert values(reports.passenger_with_most_trips(state.passenger_state(trips))) == []
    assert values(changelog.total_available_seats_changelog(routes, trips)) == []
    assert values(changelog.total_occupancy_changelog(routes, trips)) == []
    assert values(changelog.operator_with_max_occupancy_changelog(routes, trips)) == []
    assert values(changelog.most_used_type_changelog(routes)) == []


def test_ties_go_to_the_smallest(make_routes, make_trips):
    routes = make_routes([(2, 4, "Bus", "B"), (1, 4, "Bus", "A")])
    trips = make_trips([(2, 9, "Bus"), (1, 10, "Bus")])
    occupancy = reports.occupancy_per_route(state.route_state(routes, trips))
    named = reports.occupancy_with(occupancy, routes, "operator")
    assert values(reports.operator_with_max_occupancy(named)) == [(1, "A", 25.0)]
    assert values(reports.passenger_with_most_trips(state.passenger_state(trips))) == [("9", 1)]
    # with every update counted, the first to get there stays
    assert values(changelog.operator_with_max_occupancy_changelog(routes, trips)) == [
        (2, "B", 25.0)
    ]


def test_late_rows(spark):
    rows = [(0, "Bus", "00:10"), (1, "Bus", "01:05"), (2, "Bus", "00:50"), (3, "Taxi", "00:20")]
    data = [
        (seq, kind, datetime.datetime.fromisoformat(f"2024-01-01 {at}:00")) for seq, kind, at in rows
    ]
    df = spark.createDataFrame(data, "seq bigint, transportType string, ts timestamp")
    for slice_rows in (1, 1 << 20):
        kept = without_late(df, "transportType", slice_rows=slice_rows)
        assert sorted(row["seq"] for row in kept.collect()) == [0, 1, 3]


def test_last_window_reads_the_latest_hour(spark):
    data = [(datetime.datetime(2024, 1, 1, 9, 59), "Bus"), (datetime.datetime(2024, 1, 1, 10, 1), "Taxi")]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(data, f"ts {kind}, transportType string")
        hourly = windowed_counts(last_window(df), "transportType")
        assert values(hourly.drop("window_start")) == [("Taxi", 1)]


@pytest.mark.parametrize(
    ("passengers", "seats", "expected"),
    [(5, 0, 0.0), (1, 2, 33.333335876464844), (3, -1, 150.0), (3, -3, float("inf")), (3, None, 0.0)],
)
def test_occupancy_pct(spark, passengers, seats, expected):
    df = spark.createDataFrame([(passengers, seats)], "p bigint, s bigint")
    assert df.select(occupancy_pct(F.col("p"), F.col("s"))).first()[0] == expected


def test_full_can_count_as_full(spark):
    df = spark.createDataFrame([(5, 0), (0, 0), (1, 3)], "p bigint, s bigint")
    pct = occupancy_pct(F.col("p"), F.col("s"), full_as_zero=False)
    assert [row[0] for row in df.select(pct).collect()] == [100.0, 0.0, 25.0]


def test_whole_average_cuts(spark):
    df = spark.createDataFrame([(37, 2)], "t bigint, n bigint")
    assert df.select(whole_average(F.col("t"), F.col("n"))).first()[0] == 18


def test_accumulated_totals_can_exceed_a_long(spark):
    passengers = spark.createDataFrame([(1, 10**11)], "routeId bigint, passengers bigint")
    exact = changelog.total_passengers_changelog(passengers, "decimal(38,0)").first()["value"]
    assert int(exact) == 10**11 * (10**11 + 1) // 2
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        changelog.total_passengers_changelog(passengers).collect()
