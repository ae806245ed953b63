"""Every leader there ever was.

The result tables of the leader reports are keyed by the leader, so a former leader keeps the
last row it was reported with.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridegauge.operators.keyed import known, latest_by
from ridegauge.operators.running import SLICE_ROWS, records, running
from ridegauge.plans.changelog import in_open_hour, new_lows, occupancy_updates
from ridegauge.session import written


def least_occupied_route_history(
    routes: DataFrame, trips: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Routes that were ever the least occupied of their type."""
    lows = written(new_lows(routes, trips, slice_rows), "lows")
    led = records(
        lows, ["transportType"], "seq", "occupancyPercentage", lowest=True, slice_rows=slice_rows
    )
    return latest_by(led, ["routeId"], "seq").select(
        "routeId", F.col("transportType").alias("name"), "occupancyPercentage"
    )


def max_occupancy_history(
    routes: DataFrame, trips: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Routes that ever had the largest occupancy of all."""
    updates = known(occupancy_updates(routes, trips, "operator", slice_rows=slice_rows), "operator")
    led = records(
        written(updates, "updates"), [], "seq", "occupancyPercentage", slice_rows=slice_rows
    )
    return latest_by(led, ["routeId"], "seq").select(
        "routeId", F.col("operator").alias("name"), "occupancyPercentage"
    )


def most_used_type_history(routes: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Transport types that ever had the largest hourly count, the latest on ties.

    Counts go up by one, so the largest count is ``k`` from the first row that reaches ``k`` to
    the first that reaches ``k + 1``; whoever reaches ``k`` in between leads.
    """
    numbered = running(
        written(in_open_hour(routes, slice_rows), "in-time"), ["hour", "transportType"], "seq",
        {"k": ("count", "seq")}, slice_rows=slice_rows,
    )
    reached = numbered.groupBy("transportType", "k").agg(F.min("seq").alias("reached"))
    overtaken = reached.groupBy((F.col("k") - 1).alias("k")).agg(
        F.min("reached").alias("overtaken")
    )
    led = reached.join(overtaken, "k", "left").where(
        F.col("overtaken").isNull() | (F.col("reached") < F.col("overtaken"))
    )
    return led.groupBy(F.col("transportType").alias("id")).agg(F.max("k").alias("value"))


def most_trips_history(trips: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Passengers who ever had the most trips.

    Counts go up by one, so the first passenger to reach ``k`` trips takes the lead with it.
    """
    travelled = known(trips, "passengerId").select("passengerId", "seq")
    numbered = running(
        travelled, ["passengerId"], "seq", {"k": ("count", "seq")}, slice_rows=slice_rows
    )
    led = numbered.groupBy("k").agg(F.min_by("passengerId", "seq").alias("passengerId"))
    return led.groupBy("passengerId").agg(F.max("k").alias("value")).select(
        F.col("passengerId").cast("string").alias("id"), "value"
    )
