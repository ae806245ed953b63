"""Where each report goes: its topic, its table, and the keys there."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridegauge.functions.envelope import encode


@dataclass(frozen=True)
class Result:
    """``message`` names the record type; ``message_key`` is an expression over the report.

    A report without a topic is kept in its table only.
    """

    topic: str | None
    table: str
    key: str
    message: str
    message_key: str


# Topics, tables, keys and record names of the reports.
RESULTS = {
    "operators_list": Result("req1-topic", "operators", "operator", "Operator", "null"),
    "routes_latest": Result(None, "req3", "id", "Route", "concat('route_', id)"),
    "passengers_per_route": Result("req4-topic", "req4", "id", "Number", "id"),
    "available_seats_per_route": Result("req5-topic", "req5", "id", "Number", "id"),
    "occupancy_per_route": Result("req6-topic", "req6", "routeId", "RouteOccupancy", "routeId"),
    "total_passengers": Result("req7-topic", "req7", "id", "Number", "'total'"),
    "total_available_seats": Result("req8-topic", "req8", "id", "Number", "'total'"),
    "total_occupancy": Result("req9-topic", "req9", "routeId", "RouteOccupancy", "'total'"),
    "avg_passengers_per_type": Result("req10-topic", "req10", "id", "NameNumber", "id"),
    "busiest_transport_type": Result("req11-topic", "req11", "id", "TransporType", "id"),
    "least_occupied_route_per_type": Result(
        "req12-topic", "req12", "routeId", "RouteOccupancyWithAddedField", "name"
    ),
    "most_used_type_last_hour": Result("req13-topic", "req13", "id", "NameNumber", "'most_used'"),
    "least_occupied_transport_type": Result("req14-topic", "req14", "id", "TransporType", "id"),
    "operator_with_max_occupancy": Result(
        "req15-topic", "req15", "routeId", "RouteOccupancyWithAddedField", "name"
    ),
    "passenger_with_most_trips": Result("req16-topic", "req16", "id", "NameNumber", "'max_trips'"),
}


def as_messages(report: DataFrame, name: str) -> DataFrame:
    """``key, value`` messages of a report."""
    result = RESULTS[name]
    if result.topic is None:
        raise ValueError(f"{name} is kept in table {result.table}, and sent to no topic")
    return encode(report, result.message, F.expr(result.message_key))
