"""Reports that accumulate over every intermediate update instead of the current state.

One update per input record: all route publications first, then the trips in ``seq`` order.
``k`` is the running number of a trip on its route (or type, or passenger) and ``n`` the last
``k``.  Where a sum or a leader follows from ``n`` alone nothing is ordered at all.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.functions import exact
from ridegauge.functions.occupancy import available_seats, occupancy_pct
from ridegauge.operators.keyed import first_by, known
from ridegauge.operators.running import SLICE_ROWS, running
from ridegauge.operators.windows import without_late
from ridegauge.plans import state
from ridegauge.session import written

_EXACT = "decimal(38,0)"


def _sum_of_counts(n: str) -> Column:
    """1 + 2 + ... + n, wide enough for any number of rows."""
    wide = F.col(n).cast("decimal(18,0)")
    return F.floor(wide * (wide + 1) / 2).cast(_EXACT)


def _one_number(total: DataFrame, as_type: str) -> DataFrame:
    return known(total, "value").select(
        F.lit(0).cast("bigint").alias("id"), F.col("value").cast(as_type).alias("value")
    )


def total_passengers_changelog(passengers: DataFrame, as_type: str = "bigint") -> DataFrame:
    """Sum of every passenger count ever reported, from ``routeId, passengers``.

    The sum grows with the square of the trips on a route: a result beyond ``bigint`` raises;
    ask for ``decimal(38,0)`` then.
    """
    total = known(passengers, "passengers").agg(F.sum(_sum_of_counts("passengers")).alias("value"))
    return _one_number(total, as_type)


def _capacity_updates(routes: DataFrame, slice_rows: int) -> DataFrame:
    """One row: sum of the running capacity over all publications."""
    published = known(routes, "id", "passengerCapacity").select("id", "seq", "passengerCapacity")
    grown = running(
        published, ["id"], "seq", {"capacity": ("sum", "passengerCapacity")}, slice_rows=slice_rows
    )
    return grown.agg(F.sum(F.col("capacity").cast("decimal(18,0)")).cast(_EXACT).alias("value"))


def _seats_of_trips() -> Column:
    """What the trips of a route report in all: ``capacity * n - (1 + ... + n)``; null without a capacity."""
    places = F.col("capacity").cast("decimal(18,0)") * F.col("passengers").cast("decimal(18,0)")
    return (places - _sum_of_counts("passengers")).cast(_EXACT)


def total_available_seats_changelog(
    routes: DataFrame, trips: DataFrame, as_type: str = "bigint", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Sum of every seat count ever reported.

    Each publication reports the capacity so far; then each trip reports ``capacity - k``, which
    adds up to ``capacity * n - (1 + ... + n)`` per route.
    """
    known_routes = known(state.route_state(routes, trips), "capacity", "passengers")
    per_route = known_routes.select(_seats_of_trips().alias("value"))
    updates = per_route.unionByName(_capacity_updates(routes, slice_rows))
    return _one_number(updates.agg(F.sum("value").alias("value")), as_type)


def total_occupancy_changelog(
    routes: DataFrame, trips: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Occupancy computed from the two accumulated totals."""
    per_route = state.route_state(routes, trips)
    counts = known(per_route, "passengers").select(
        _sum_of_counts("passengers").alias("p"), _seats_of_trips().alias("s")
    )
    grown = _capacity_updates(routes, slice_rows).select(F.col("value").alias("s"))
    each = counts.agg(F.sum("p").alias("p"), F.sum("s").alias("s")).unionByName(grown, allowMissingColumns=True)
    totals = known(each.agg(F.sum("p").alias("p"), F.sum("s").alias("s")), "p", "s")
    return totals.select(
        F.lit(0).cast("bigint").alias("routeId"),
        occupancy_pct(F.col("p"), F.col("s")).alias("occupancyPercentage"),
    )


def busiest_transport_type_changelog(trips: DataFrame) -> DataFrame:
    """Every type reports its own maximum under one key, so the type of the last trip stays."""
    last = first_by(
        known(trips, "transportType"), [], [F.col("transportType").alias("value")], [-F.col("seq")]
    )
    return last.select(F.lit("highest").alias("id"), "value")


def passenger_with_most_trips_changelog(trips: DataFrame) -> DataFrame:
    """The passenger who was first to reach the highest trip count."""
    counted = known(trips, "passengerId").groupBy("passengerId").agg(
        F.count(F.lit(1)).alias("n"), F.max("seq").alias("reached")
    )
    return first_by(
        counted, [],
        [F.col("passengerId").cast("string").alias("id"), F.col("n").alias("value")],
        [-F.col("n"), F.col("reached")],
    )


def numbered_trips(
    routes: DataFrame, trips: DataFrame, *attributes: str, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Trips on published routes as ``seq, routeId, k, capacity, <attributes>``.

    ``attributes`` come from the latest version of the route.
    """
    published = state.published_routes(routes, *attributes)
    travelled = known(trips, "routeId").select("routeId", "seq")
    return running(
        travelled, ["routeId"], "seq", {"k": ("count", "seq")}, attach=published, slice_rows=slice_rows
    )


def _pct_at(k: Column, capacity: str = "capacity") -> Column:
    return occupancy_pct(k, available_seats(F.col(capacity), k))


def occupancy_updates(
    routes: DataFrame, trips: DataFrame, *attributes: str, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Every occupancy ever reported: ``seq, routeId, <attributes>, occupancyPercentage``."""
    numbered = numbered_trips(routes, trips, *attributes, slice_rows=slice_rows)
    pct = _pct_at(F.col("k")).alias("occupancyPercentage")
    return numbered.select("seq", "routeId", *attributes, pct)


def new_lows(
    routes: DataFrame, trips: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Occupancies that may be below all earlier ones of their route, with its transport type.

    Occupancy rises from trip to trip, but a route without a free seat reports 0.  So only the
    first trip and the one that fills the route can be a low; below a capacity of zero, where
    occupancy falls, any can.
    """
    numbered = known(
        numbered_trips(routes, trips, "transportType", slice_rows=slice_rows), "transportType"
    )
    k, capacity = F.col("k"), F.col("capacity")
    lows = numbered.where((k == 1) | (k == capacity) | (capacity < 0))
    return lows.select("seq", "routeId", "transportType", _pct_at(k).alias("occupancyPercentage"))


def least_occupied_route_per_type_changelog(
    routes: DataFrame, trips: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Smallest occupancy each type ever reported, the earliest on ties."""
    return first_by(
        new_lows(routes, trips, slice_rows), ["transportType"],
        [F.col("routeId"), F.col("occupancyPercentage")],
        [F.col("occupancyPercentage"), F.col("seq")],
    ).select("routeId", F.col("transportType").alias("name"), "occupancyPercentage")


def _routes_at_the_top(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """Routes whose largest occupancy ever is the largest of all.

    Apart from the 0 of a full route occupancy only rises (or only falls) with the trips, so a
    route's largest is at its first, last or last but one trip.
    """
    per_route = known(state.travelled_routes(routes, trips, "operator"), "operator")
    first, last = F.lit(1).cast("bigint"), F.col("passengers")
    peak = F.greatest(_pct_at(first), _pct_at(last), _pct_at(F.greatest(first, last - 1)))
    peaks = per_route.select("routeId", peak.alias("peak"))
    return peaks.where(F.col("peak") == peaks.agg(F.max("peak")).scalar()).select("routeId")


def operator_with_max_occupancy_changelog(
    routes: DataFrame, trips: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Largest occupancy ever reported, the earliest on ties.

    The value follows from the trip counts; trips are numbered only on the routes that reach it.
    """
    top = written(_routes_at_the_top(routes, trips), "top-routes")
    on_top = written(trips.join(top, "routeId", "left_semi"), "top-trips")
    updates = occupancy_updates(routes, on_top, "operator", slice_rows=slice_rows)
    return first_by(
        known(updates, "operator"), [],
        [F.col("routeId"), F.col("operator").alias("name"), F.col("occupancyPercentage")],
        [-F.col("occupancyPercentage"), F.col("seq")],
    )


def average_updates(
    routes: DataFrame, trips: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Every average occupancy a type ever reported: ``seq, transportType, average``."""
    updates = known(
        occupancy_updates(routes, trips, "transportType", slice_rows=slice_rows), "transportType"
    )
    pct = F.col("occupancyPercentage")
    parts = updates.select("seq", "transportType", exact.scaled(pct).alias("pct"), exact.beyond(pct).alias("beyond"))
    summed = running(
        written(parts, "updates"), ["transportType"], "seq",
        {"total": ("sum", "pct"), "most": ("max", "beyond"), "k": ("count", "seq")}, slice_rows=slice_rows,
    )
    average = exact.mean_of(F.col("total"), F.col("most"), F.col("k"))
    return summed.select("seq", "transportType", average.alias("average"))


def least_occupied_transport_type_changelog(
    routes: DataFrame, trips: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Type that reported the smallest average ever, the latest on ties."""
    top = first_by(
        average_updates(routes, trips, slice_rows), [],
        [F.col("transportType").alias("value")], [F.col("average"), -F.col("seq")],
    )
    return top.select(F.lit("min_occupancy").alias("id"), "value")


def in_open_hour(routes: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Publications that arrived while their hour was open, with that hour."""
    wanted = routes.select("transportType", "ts", "seq")
    in_time = without_late(wanted, "transportType", slice_rows=slice_rows)
    return in_time.select("transportType", "seq", F.window("ts", "1 hour")["start"].alias("hour"))


def most_used_type_changelog(routes: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Largest hourly count of any hour so far, the latest to reach it on ties."""
    counted = in_open_hour(routes, slice_rows).groupBy("hour", "transportType").agg(
        F.count(F.lit(1)).alias("n"), F.max("seq").alias("reached")
    )
    return first_by(
        counted, [],
        [F.col("transportType").alias("id"), F.col("n").alias("value")],
        [-F.col("n"), -F.col("reached")],
    )
