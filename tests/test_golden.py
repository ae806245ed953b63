"""A fixed scenario of six routes and 403 trips, with the results worked out beforehand."""

import pytest
from conftest import values

from ridegauge.operators.windows import windowed_counts
from ridegauge.plans import changelog, history, reports, state

# The scenario.
ROUTES = [
    (1, 50, "Bus", "FlixBus"),
    (2, 200, "Plane", "TAP"),
    (3, 5, "Taxi", "Bolt"),
    (4, 30, "Bus", "Rede Expresso"),
    (5, 250, "Train", "CP"),
    (6, 10, "Taxi", "Uber"),
]
TRIPS_PER_ROUTE = {1: 25, 2: 140, 3: 5, 4: 12, 5: 212, 6: 9}


@pytest.fixture(scope="module")
def routes(make_routes):
    return make_routes(ROUTES).cache()


@pytest.fixture(scope="module")
def trips(make_trips):
    types = {route[0]: route[2] for route in ROUTES}
    order = [route for route, n in TRIPS_PER_ROUTE.items() for _ in range(n)]
    return make_trips([(r, seq % 100, types[r]) for seq, r in enumerate(order)]).cache()


@pytest.fixture(scope="module")
def per_route(routes, trips):
    return state.route_state(routes, trips)


@pytest.fixture(scope="module")
def named(per_route, routes):
    def by(attribute):
        return reports.occupancy_with(reports.occupancy_per_route(per_route), routes, attribute)

    return by


def test_per_route(per_route):
    assert values(reports.passengers_per_route(per_route)) == sorted(TRIPS_PER_ROUTE.items())
    assert values(reports.available_seats_per_route(per_route)) == [
        (1, 25), (2, 60), (3, 0), (4, 18), (5, 38), (6, 1),
    ]
    assert values(reports.occupancy_per_route(per_route)) == [
        (1, 50.0), (2, 70.0), (3, 0.0), (4, 40.0), (5, 84.79999542236328), (6, 90.0),
    ]


def test_totals(per_route, trips):
    assert values(reports.total_passengers(per_route)) == [(0, 403)]
    assert values(reports.total_passengers(state.all_passengers(trips))) == [(0, 403)]
    assert values(reports.total_available_seats(per_route)) == [(0, 142)]
    assert values(reports.total_occupancy(per_route)) == [(0, 73.94495391845703)]


def test_per_type(routes, trips, named):
    types = state.type_state(routes, trips)
    assert values(reports.avg_passengers_per_type(types)) == [
        ("Bus", 18), ("Plane", 140), ("Taxi", 7), ("Train", 212),
    ]
    assert values(reports.busiest_transport_type(types)) == [("highest", "Train")]
    assert values(reports.least_occupied_route_per_type(named("transportType"))) == [
        (2, "Plane", 70.0), (3, "Taxi", 0.0), (4, "Bus", 40.0), (5, "Train", 84.79999542236328),
    ]
    assert values(reports.least_occupied_transport_type(named("transportType"))) == [
        ("min_occupancy", "Bus")
    ]


def test_leaders(routes, trips, named):
    hourly = windowed_counts(routes, "transportType")
    top = reports.most_used_type_per_hour(hourly).drop("window_start")
    assert values(top) == [("Bus", 2)]
    assert values(reports.most_used_type_last_hour(hourly).drop("window_start")) == [("Bus", 2)]
    assert values(reports.operator_with_max_occupancy(named("operator"))) == [(6, "Uber", 90.0)]
    assert values(reports.passenger_with_most_trips(state.passenger_state(trips))) == [("0", 5)]
    assert values(reports.operators_list(routes)) == sorted((r[3],) for r in ROUTES)


@pytest.mark.parametrize("slice_rows", [3, 1 << 20])
def test_changelog(routes, trips, slice_rows):
    cut = {"slice_rows": slice_rows}
    assert values(changelog.total_passengers_changelog(state.route_passengers(trips))) == [(0, 32911)]
    assert values(changelog.total_available_seats_changelog(routes, trips, **cut)) == [(0, 50359)]
    assert values(changelog.total_occupancy_changelog(routes, trips, **cut)) == [
        (0, 39.52323913574219)
    ]
    assert values(changelog.busiest_transport_type_changelog(trips)) == [("highest", "Taxi")]
    assert values(changelog.least_occupied_route_per_type_changelog(routes, trips, **cut)) == [
        (1, "Bus", 2.0), (2, "Plane", 0.5), (3, "Taxi", 0.0), (5, "Train", 0.4000000059604645),
    ]
    assert values(changelog.most_used_type_changelog(routes, **cut)) == [("Taxi", 2)]
    assert values(changelog.least_occupied_transport_type_changelog(routes, trips, **cut)) == [
        ("min_occupancy", "Train")
    ]
    assert values(changelog.operator_with_max_occupancy_changelog(routes, trips, **cut)) == [
        (6, "Uber", 90.0)
    ]
    assert values(changelog.passenger_with_most_trips_changelog(trips)) == [("0", 5)]


def test_history(routes, trips):
    assert (6, "Uber", 90.0) in values(history.max_occupancy_history(routes, trips))
    assert values(history.most_trips_history(trips)) == [("0", 5)]
