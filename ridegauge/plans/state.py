"""Keyed states that the reports are computed from.

Each is one grouping of the input rows, so the same function works on tables and, as an
update-mode aggregate, on streams.  Counts and sums combine map-side, which also takes the
weight off a key that holds most of the rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridegauge.operators.keyed import known, latest_by
from ridegauge.operators.ordering import order_key, order_of


def route_state(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """``routeId, capacity, passengers`` of every route that is published or travelled.

    Capacity adds up over publications of a route; it is null for trips on an unknown route, as
    passengers is for a route without trips.  Both inputs share one grouping instead of a join.
    """
    published = known(routes, "id").select(
        F.col("id").alias("routeId"),
        F.col("passengerCapacity").alias("capacity"),
        F.lit(None).cast("bigint").alias("trip"),
    )
    travelled = known(trips, "routeId").select(
        "routeId", F.lit(None).cast("bigint").alias("capacity"), F.lit(1).cast("bigint").alias("trip")
    )
    return (
        published.unionByName(travelled)
        .groupBy("routeId")
        .agg(F.sum("capacity").alias("capacity"), F.sum("trip").alias("passengers"))
    )


def route_profile(routes: DataFrame, trips: DataFrame, *attributes: str) -> DataFrame:
    """``route_state`` with attributes of the last published version, null where none is published.

    One grouping too, so a stream keeps one state for every report on occupancies and their names.
    """
    none, order = F.lit(None), order_key(routes)
    newest = F.struct(*attributes)
    published = known(routes, "id").select(
        F.col("id").alias("routeId"), F.col("passengerCapacity").alias("capacity"),
        none.cast("bigint").alias("trip"), newest.alias("version"), order.alias("at"),
    )
    kinds = {name: published.schema[name].dataType for name in ("version", "at")}
    travelled = known(trips, "routeId").select(
        "routeId", none.cast("bigint").alias("capacity"), F.lit(1).cast("bigint").alias("trip"),
        *(none.cast(kind).alias(name) for name, kind in kinds.items()),
    )
    grouped = published.unionByName(travelled).groupBy("routeId").agg(
        F.sum("capacity").alias("capacity"), F.sum("trip").alias("passengers"),
        F.max_by("version", "at").alias("version"),
    )
    return grouped.select("routeId", "capacity", "passengers", "version.*")


def type_state(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """``transportType, routes, trips``: route publications and trips of each type."""
    one, none = F.lit(1).cast("bigint"), F.lit(None).cast("bigint")
    published = known(routes, "transportType").select(
        "transportType", one.alias("route"), none.alias("trip")
    )
    travelled = known(trips, "transportType").select(
        "transportType", none.alias("route"), one.alias("trip")
    )
    return (
        published.unionByName(travelled)
        .groupBy("transportType")
        .agg(F.count("route").alias("routes"), F.count("trip").alias("trips"))
    )


def _counts(df: DataFrame, key: str, name: str) -> DataFrame:
    return known(df, key).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def route_passengers(trips: DataFrame) -> DataFrame:
    """``routeId, passengers`` of travelled routes."""
    return _counts(trips, "routeId", "passengers")


def all_passengers(trips: DataFrame) -> DataFrame:
    """One row with ``passengers``: what ``route_passengers`` adds up to, without grouping."""
    total = known(trips, "routeId").agg(F.count(F.lit(1)).alias("passengers"))
    return total.where(F.col("passengers") > 0)


def type_routes(routes: DataFrame) -> DataFrame:
    """``transportType, routes``."""
    return _counts(routes, "transportType", "routes")


def type_trips(trips: DataFrame) -> DataFrame:
    """``transportType, trips``."""
    return _counts(trips, "transportType", "trips")


def passenger_state(trips: DataFrame) -> DataFrame:
    """``passengerId, trips``."""
    return _counts(trips, "passengerId", "trips")


def route_capacity(routes: DataFrame) -> DataFrame:
    """``routeId, capacity`` of published routes; publications without a capacity add nothing."""
    published = known(routes, "id", "passengerCapacity")
    return published.groupBy(F.col("id").alias("routeId")).agg(
        F.sum("passengerCapacity").alias("capacity")
    )


def published_routes(routes: DataFrame, *attributes: str) -> DataFrame:
    """``routeId, capacity`` and attributes of the last version, of routes that have a capacity."""
    newest = F.max_by(F.struct(*attributes), order_key(routes)).alias("_row")
    grouped = known(routes, "id").groupBy(F.col("id").alias("routeId")).agg(
        F.sum("passengerCapacity").alias("capacity"), newest
    )
    return known(grouped, "capacity").select("routeId", "capacity", "_row.*")


def travelled_routes(routes: DataFrame, trips: DataFrame, *attributes: str) -> DataFrame:
    """Routes that are both published and travelled: ``published_routes`` with ``passengers``."""
    return published_routes(routes, *attributes).join(route_passengers(trips), "routeId")


def latest_routes(routes: DataFrame, *columns: str) -> DataFrame:
    """The last published version of each route; ``columns`` limits what is carried.

    The last is the one of the highest ``seq``, or without that of the latest time, then partition and
    offset, which orders messages of any number of partitions.
    """
    order = order_of(routes)
    wanted = [c for c in routes.columns if not columns or c in columns or c in ("id", *order)]
    return latest_by(known(routes, "id").select(*wanted), ["id"], *order)


def counters(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """All countable states in one grouping: ``kind, key, capacity, routes, trips``.

    Reads either input once, however many states are wanted; kinds are route, type, operator and
    passenger.  The functions below pick one kind.
    """
    capacity, nothing = F.col("passengerCapacity"), F.lit(None).cast("bigint")

    def entry(kind: str, key: str, places: Column = nothing) -> Column:
        named = F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key")
        return F.struct(*named, places.alias("capacity"))

    published = F.inline(
        F.array(entry("route", "id", capacity), entry("type", "transportType"),
                entry("operator", "operator"))
    )
    travelled = F.inline(
        F.array(entry("route", "routeId"), entry("type", "transportType"),
                entry("passenger", "passengerId"))
    )
    one = F.lit(1).cast("bigint")
    rows = routes.select(published).select("*", one.alias("route"), nothing.alias("trip"))
    rows = rows.unionByName(
        trips.select(travelled).select("*", nothing.alias("route"), one.alias("trip"))
    )
    return known(rows, "key").groupBy("kind", "key").agg(
        F.sum("capacity").alias("capacity"),
        F.count("route").alias("routes"),
        F.count("trip").alias("trips"),
    )


def routes_counted(counted: DataFrame) -> DataFrame:
    """``route_state`` out of ``counters``."""
    travelled = F.when(F.col("trips") > 0, F.col("trips"))
    return counted.where(F.col("kind") == "route").select(
        F.col("key").cast("bigint").alias("routeId"), "capacity", travelled.alias("passengers")
    )


def types_counted(counted: DataFrame) -> DataFrame:
    """``type_state`` out of ``counters``."""
    return counted.where(F.col("kind") == "type").select(
        F.col("key").alias("transportType"), "routes", "trips"
    )


def operators_counted(counted: DataFrame) -> DataFrame:
    """``operator`` and its publications out of ``counters``."""
    return counted.where(F.col("kind") == "operator").select(
        F.col("key").alias("operator"), "routes"
    )


def passengers_counted(counted: DataFrame) -> DataFrame:
    """``passenger_state`` out of ``counters``."""
    return counted.where(F.col("kind") == "passenger").select(
        F.col("key").cast("bigint").alias("passengerId"), "trips"
    )
