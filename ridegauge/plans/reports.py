"""Reports over the current state.  Ties go to the smallest id or name."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.functions import exact
from ridegauge.functions.occupancy import available_seats, occupancy_pct, whole_average
from ridegauge.operators.keyed import first_by, known


def _no_id(name: str) -> Column:
    """The id of a report that has one row for everything."""
    return F.lit(0).cast("bigint").alias(name)


def operators_list(routes: DataFrame) -> DataFrame:
    """Operators that run a route, each once."""
    return known(routes, "operator").select("operator").distinct()


def passengers_per_route(state: DataFrame) -> DataFrame:
    return known(state, "passengers").select(
        F.col("routeId").alias("id"), F.col("passengers").alias("value")
    )


def _with_seats(state: DataFrame) -> DataFrame:
    seats = available_seats(F.col("capacity"), F.col("passengers"))
    return known(state, "capacity").withColumn("seats", seats)


def available_seats_per_route(state: DataFrame) -> DataFrame:
    return _with_seats(state).select(F.col("routeId").alias("id"), F.col("seats").alias("value"))


def occupancy_per_route(state: DataFrame) -> DataFrame:
    """Occupancy of routes that are both published and travelled."""
    both = known(_with_seats(state), "passengers")
    pct = occupancy_pct(F.col("passengers"), F.col("seats"))
    return both.select("routeId", pct.alias("occupancyPercentage"))


def total_passengers(state: DataFrame) -> DataFrame:
    total = state.agg(F.sum("passengers").alias("value"))
    return known(total, "value").select(_no_id("id"), "value")


def total_available_seats(state: DataFrame) -> DataFrame:
    total = _with_seats(state).agg(F.sum("seats").alias("value"))
    return known(total, "value").select(_no_id("id"), "value")


def total_occupancy(state: DataFrame) -> DataFrame:
    """Occupancy over all routes; passengers of unknown routes count as travelling."""
    seats = available_seats(F.col("capacity"), F.col("passengers"))
    totals = state.agg(F.sum("passengers").alias("p"), F.sum(seats).alias("s"))
    return known(totals, "p", "s").select(
        _no_id("routeId"), occupancy_pct(F.col("p"), F.col("s")).alias("occupancyPercentage")
    )


def avg_passengers_per_type(types: DataFrame) -> DataFrame:
    both = types.where((F.col("routes") > 0) & (F.col("trips") > 0))
    return both.select(
        F.col("transportType").alias("id"),
        whole_average(F.col("trips"), F.col("routes")).alias("value"),
    )


def busiest_transport_type(types: DataFrame) -> DataFrame:
    top = first_by(
        types.where(F.col("trips") > 0), [],
        [F.col("transportType").alias("value")], [-F.col("trips"), F.col("transportType")],
    )
    return top.select(F.lit("highest").alias("id"), "value")


def occupancy_with(occupancy: DataFrame, latest: DataFrame, attribute: str) -> DataFrame:
    """``routeId, name, occupancyPercentage`` with an attribute of the latest route version."""
    named = latest.select(F.col("id").alias("routeId"), F.col(attribute).alias("name"))
    return occupancy.join(named, "routeId").select("routeId", "name", "occupancyPercentage")


def occupancy_by(travelled: DataFrame, attribute: str) -> DataFrame:
    """The same from ``state.travelled_routes`` or ``route_profile``, which have the attribute already."""
    pct = occupancy_pct(F.col("passengers"), F.col("seats")).alias("occupancyPercentage")
    return known(_with_seats(travelled), "passengers").select("routeId", F.col(attribute).alias("name"), pct)


def least_occupied_route_per_type(typed: DataFrame) -> DataFrame:
    return first_by(
        known(typed, "name"), ["name"],
        [F.col("routeId"), F.col("occupancyPercentage")],
        [F.col("occupancyPercentage"), F.col("routeId")],
    ).select("routeId", "name", "occupancyPercentage")


def avg_occupancy_per_type(typed: DataFrame) -> DataFrame:
    """The mean occupancy of each type, the same however the rows are partitioned."""
    mean = exact.mean(F.col("occupancyPercentage"))
    return (
        known(typed, "name")
        .groupBy(F.col("name").alias("transportType"))
        .agg(mean.alias("occupancyPercentage"))
    )


def least_occupied_transport_type(typed: DataFrame) -> DataFrame:
    top = first_by(
        avg_occupancy_per_type(typed), [],
        [F.col("transportType").alias("value")],
        [F.col("occupancyPercentage"), F.col("transportType")],
    )
    return top.select(F.lit("min_occupancy").alias("id"), "value")


def max_occupancy_per_operator(named: DataFrame) -> DataFrame:
    return first_by(
        known(named, "name"), ["name"],
        [F.col("routeId"), F.col("occupancyPercentage")],
        [-F.col("occupancyPercentage"), F.col("routeId")],
    ).select("routeId", "name", "occupancyPercentage")


def operator_with_max_occupancy(named: DataFrame) -> DataFrame:
    return first_by(
        known(named, "name"), [],
        [F.col("routeId"), F.col("name"), F.col("occupancyPercentage")],
        [-F.col("occupancyPercentage"), F.col("routeId")],
    )


def passenger_with_most_trips(passengers: DataFrame) -> DataFrame:
    return first_by(
        passengers, [],
        [F.col("passengerId").cast("string").alias("id"), F.col("trips").alias("value")],
        [-F.col("trips"), F.col("passengerId")],
    )


def most_used_type_per_hour(hourly: DataFrame) -> DataFrame:
    """The most published transport type of each hour, from ``window_start, transportType, n``."""
    return first_by(
        hourly, ["window_start"],
        [F.col("transportType").alias("id"), F.col("n").alias("value")],
        [-F.col("n"), F.col("transportType")],
    )


def most_used_type_last_hour(hourly: DataFrame) -> DataFrame:
    """The same for the latest hour that holds a record."""
    return first_by(
        hourly, [],
        [F.col("window_start"), F.col("transportType").alias("id"), F.col("n").alias("value")],
        [-F.unix_seconds(F.col("window_start").cast("timestamp")), -F.col("n"), F.col("transportType")],
    )


def trips_enriched(trips: DataFrame, latest: DataFrame) -> DataFrame:
    """Trips with origin, destination and type of their route in place of their own.

    A plain join: adaptive execution broadcasts the routes if they turn out small, and otherwise
    splits routes with many trips.
    """
    route = latest.select(F.col("id").alias("routeId"), "origin", "destination", "transportType")
    bare = trips.drop("origin", "destination", "transportType")
    return known(bare, "routeId").join(route, "routeId")
