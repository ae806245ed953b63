"""Reports over every update against plain lists of updates, on random inputs.

Inputs hold repeated publications, unknown routes, full and overbooked routes and many ties;
small slices make every key a hot one.
"""

import random
import struct
from itertools import groupby

import pytest
from conftest import values

from ridegauge.plans import changelog, history, state


def float32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def scenario(seed):
    rng = random.Random(seed)
    routes = [
        (rng.randint(0, 6), rng.randint(0, 4), rng.choice("ABC"), rng.choice("xyz"))
        for _ in range(rng.randint(1, 9))
    ]
    trips = [
        (rng.choice([0, 0, 0, *range(8)]), rng.randint(0, 4), rng.choice("ABC"))
        for _ in range(rng.randint(1, 40))
    ]
    return routes, trips


def occupancies(routes, trips):
    """(seq, route id, type, operator, percentage) of each trip on a published route."""
    capacity, latest, ridden, found = {}, {}, {}, []
    for route, places, kind, operator in routes:
        capacity[route] = capacity.get(route, 0) + places
        latest[route] = (kind, operator)
    for seq, (route, _, _) in enumerate(trips):
        ridden[route] = ridden.get(route, 0) + 1
        if route in capacity:
            k, c = ridden[route], capacity[route]
            pct = 0.0 if k == c else float("inf") if c == 0 else float32(float32(k / c) * 100)
            found.append((seq, route, *latest[route], pct))
    return found


def leaders(updates, value, better):
    """The updates that took the lead, in order."""
    led = []
    for update in updates:
        if not led or better(value(update), value(led[-1])):
            led.append(update)
    return led


def by_type(updates):
    ordered = sorted(updates, key=lambda u: (u[2], u[0]))
    return [list(group) for _, group in groupby(ordered, key=lambda u: u[2])]


def counts(trips):
    seen, found = {}, []
    for _, passenger, _ in trips:
        seen[passenger] = seen.get(passenger, 0) + 1
        found.append((str(passenger), seen[passenger]))
    return found


@pytest.mark.parametrize(("seed", "slice_rows"), [(0, 2), (1, 2), (3, 3), (2, 1 << 20)])
def test_against_lists(make_routes, make_trips, seed, slice_rows):
    route_rows, trip_rows = scenario(seed)
    routes, trips = make_routes(route_rows).cache(), make_trips(trip_rows).cache()
    cut = {"slice_rows": slice_rows}
    updates = occupancies(route_rows, trip_rows)

    seats, capacity, ridden, shown = 0, {}, {}, 0
    for route, places, _, _ in route_rows:
        capacity[route] = capacity.get(route, 0) + places
        seats += capacity[route]
    for route, _, _ in trip_rows:
        ridden[route] = ridden.get(route, 0) + 1
        shown += ridden[route]
        seats += capacity[route] - ridden[route] if route in capacity else 0
    assert values(changelog.total_passengers_changelog(state.route_passengers(trips))) == [(0, shown)]
    assert values(changelog.total_available_seats_changelog(routes, trips, **cut)) == [(0, seats)]

    least = [leaders(group, lambda u: u[4], lambda a, b: a < b) for group in by_type(updates)]
    assert values(changelog.least_occupied_route_per_type_changelog(routes, trips, **cut)) == sorted(
        ((u[1], u[2], u[4]) for u in (led[-1] for led in least)), key=repr
    )
    kept = {u[1]: (u[1], u[2], u[4]) for led in least for u in led}
    assert values(history.least_occupied_route_history(routes, trips, **cut)) == sorted(
        kept.values(), key=repr
    )

    top = leaders(updates, lambda u: u[4], lambda a, b: a > b)
    assert values(changelog.operator_with_max_occupancy_changelog(routes, trips, **cut)) == [
        (u[1], u[3], u[4]) for u in top[-1:]
    ]
    kept = {u[1]: (u[1], u[3], u[4]) for u in top}
    assert values(history.max_occupancy_history(routes, trips, **cut)) == sorted(
        kept.values(), key=repr
    )

    averages, sums = [], {}
    for _, _, kind, _, pct in updates:
        total, n = sums.get(kind, (0.0, 0))
        sums[kind] = (total + pct, n + 1)
        averages.append((kind, float32((total + pct) / (n + 1))))
    lowest = leaders(averages, lambda a: a[1], lambda a, b: a <= b)
    assert values(changelog.least_occupied_transport_type_changelog(routes, trips, **cut)) == [
        ("min_occupancy", kind) for kind, _ in lowest[-1:]
    ]

    most = leaders(counts(trip_rows), lambda c: c[1], lambda a, b: a > b)
    assert values(changelog.passenger_with_most_trips_changelog(trips)) == most[-1:]
    assert values(history.most_trips_history(trips, **cut)) == sorted(dict(most).items())

    assert values(changelog.busiest_transport_type_changelog(trips)) == [
        ("highest", trip_rows[-1][2])
    ]

    published = leaders(
        [(kind, n) for kind, n in counts([(0, kind, 0) for _, _, kind, _ in route_rows])],
        lambda c: c[1], lambda a, b: a >= b,
    )
    assert values(changelog.most_used_type_changelog(routes, **cut)) == published[-1:]
    assert values(history.most_used_type_history(routes, **cut)) == sorted(dict(published).items())
