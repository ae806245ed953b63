"""All reports at once, over states that are computed once."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ridegauge.operators.windows import windowed_counts
from ridegauge.plans import reports, state
from ridegauge.session import written


@dataclass(frozen=True)
class States:
    """The keyed states that together answer every report."""

    counts: DataFrame
    latest: DataFrame
    hourly: DataFrame


# How each state follows from routes and trips, and its key.  Trips are read for the first only.
STATES: dict[str, tuple[Callable[[DataFrame, DataFrame], DataFrame], tuple[str, ...]]] = {
    "counts": (state.counters, ("kind", "key")),
    "latest": (lambda routes, trips: state.latest_routes(routes), ("id",)),
    "hourly": (
        lambda routes, trips: windowed_counts(routes, "transportType"),
        ("window_start", "transportType"),
    ),
}


def states(routes: DataFrame, trips: DataFrame) -> States:
    """The states of tables of routes and trips, each written out once."""
    return States(
        **{name: written(build(routes, trips), name) for name, (build, _) in STATES.items()}
    )


def all_reports(current: States) -> dict[str, DataFrame]:
    """Every report by name."""
    routes = state.routes_counted(current.counts)
    types = state.types_counted(current.counts)
    passengers = state.passengers_counted(current.counts)
    occupancy = reports.occupancy_per_route(routes)
    typed = reports.occupancy_with(occupancy, current.latest, "transportType")
    operated = reports.occupancy_with(occupancy, current.latest, "operator")
    last_hour = reports.most_used_type_last_hour(current.hourly)
    return {
        "operators_list": state.operators_counted(current.counts).select("operator"),
        "routes_latest": current.latest.drop("seq", "ts"),
        "passengers_per_route": reports.passengers_per_route(routes),
        "available_seats_per_route": reports.available_seats_per_route(routes),
        "occupancy_per_route": occupancy,
        "total_passengers": reports.total_passengers(routes),
        "total_available_seats": reports.total_available_seats(routes),
        "total_occupancy": reports.total_occupancy(routes),
        "avg_passengers_per_type": reports.avg_passengers_per_type(types),
        "busiest_transport_type": reports.busiest_transport_type(types),
        "least_occupied_route_per_type": reports.least_occupied_route_per_type(typed),
        "most_used_type_last_hour": last_hour.drop("window_start"),
        "least_occupied_transport_type": reports.least_occupied_transport_type(typed),
        "operator_with_max_occupancy": reports.operator_with_max_occupancy(operated),
        "passenger_with_most_trips": reports.passenger_with_most_trips(passengers),
    }
