"""

Two adapters feed the reports.  ``part`` and ``lineitem`` are routes and trips for the reports
over the current state; ``events`` is a log of publications and trips for the reports that
depend on message order (see ``ridegauge.sources.tables``).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegauge.functions import envelope
from ridegauge.operators import windows
from ridegauge.operators.ordering import positions
from ridegauge.plans import changelog, history, reports, state
from ridegauge.schemas import MESSAGE, ROUTE, TRIP
from ridegauge.session import work_folder
from ridegauge.sinks import message_log
from ridegauge.sinks.keyed_table import KeyedTable
from ridegauge.sources import messages, tables
from ridegauge.streaming import live, polling, updates

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Occupancy of every route, the report that most others build on."""
    return queries()["occupancy_per_route"](spark, "/root/testdata/sf0.001")


# --- reports over the current state ------------------------------------------------------


def _on_routes(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(tables.part_routes(spark, folder))


def _on_trips(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(tables.line_trips(spark, folder))


def _on_both(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(
        tables.part_routes(spark, folder), tables.line_trips(spark, folder)
    )


def _on_publications(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(tables.event_publications(spark, folder))


def _on_late_publications(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(tables.order_publications(spark, folder))


def _on_log(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(
        tables.event_routes(spark, folder), tables.event_trips(spark, folder)
    )


def _on_partitions(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """The log dealt over three partitions, put in one order again."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        routes = tables.over_partitions(tables.event_routes(spark, folder))
        trips = tables.over_partitions(tables.event_trips(spark, folder))
        return report(positions(routes), positions(trips))

    return run


def _on_log_trips(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(tables.event_trips(spark, folder))


def _named_occupancy(attribute: str, report: Callable[[DataFrame], DataFrame]):
    def plan(routes: DataFrame, trips: DataFrame) -> DataFrame:
        travelled = state.travelled_routes(routes, trips, attribute)
        return report(reports.occupancy_by(travelled, attribute))

    return plan


def _in_utc(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _operators_from_table(spark: SparkSession, folder: str) -> DataFrame:
    operators = reports.operators_list(tables.part_routes(spark, folder))
    table = KeyedTable(spark, work_folder(spark, "operators"), ("operator",), operators.schema)
    table.upsert(operators, 0)
    table.upsert(operators, 1)
    return table.read()


def _operators_polled(spark: SparkSession, folder: str) -> DataFrame:
    """The operator table, read whole by two polls."""
    place = work_folder(spark, "polled")
    operators = reports.operators_list(tables.part_routes(spark, folder))
    table = KeyedTable(spark, f"{place}/table", ("operator",), operators.schema)
    for _ in range(2):
        polling.poll_into(table, lambda: operators, f"{place}/checkpoint").awaitTermination()
    return table.read()


def _trip_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Trips as messages, the seventh line of each order cut off in the middle."""
    trips = tables.line_trips(spark, folder).select("id", "routeId", "passengerId", "transportType")
    sent = envelope.encode(trips, "Trip", F.col("id")).select("key", "value")
    broken = F.col("key").cast("bigint") % 8 == 7
    return sent.select(F.when(broken, F.substring("value", 1, 20)).otherwise(F.col("value")).alias("value"))


def _trips_from_messages(spark: SparkSession, folder: str) -> DataFrame:
    return messages.split(_trip_messages(spark, folder), TRIP)


def _route_messages(spark: SparkSession, folder: str) -> DataFrame:
    routes = tables.part_routes(spark, folder).select(*ROUTE.fieldNames())
    return envelope.encode(routes, "Route", F.concat(F.lit("route_"), F.col("id")))


def _decoded_messages(spark: SparkSession, folder: str) -> DataFrame:
    return envelope.decode(_route_messages(spark, folder), ROUTE)


STATE_QUERIES: dict[str, Query] = {
    "operators_list": _on_routes(reports.operators_list),
    "operators_from_table": _operators_from_table,
    "operators_polled": _operators_polled,
    "trips_from_messages": _trips_from_messages,
    "routes_latest": lambda spark, folder: state.latest_routes(
        tables.event_routes(spark, folder)
    ).drop("seq", "ts"),
    "partitions_routes_latest": lambda spark, folder: state.latest_routes(
        tables.over_partitions(tables.event_routes(spark, folder))
    ).drop("ts", "partition", "offset"),
    "passengers_per_route": _on_trips(
        lambda trips: reports.passengers_per_route(state.route_passengers(trips))
    ),
    "capacity_per_route": _on_routes(state.route_capacity),
    "available_seats_per_route": _on_both(
        lambda routes, trips: reports.available_seats_per_route(state.route_state(routes, trips))
    ),
    "occupancy_per_route": _on_both(
        lambda routes, trips: reports.occupancy_per_route(state.route_state(routes, trips))
    ),
    "total_passengers": _on_trips(
        lambda trips: reports.total_passengers(state.all_passengers(trips))
    ),
    "total_available_seats": _on_both(
        lambda routes, trips: reports.total_available_seats(state.route_state(routes, trips))
    ),
    "total_occupancy": _on_both(
        lambda routes, trips: reports.total_occupancy(state.route_state(routes, trips))
    ),
    "routes_per_type": _on_routes(state.type_routes),
    "trips_per_type": _on_trips(state.type_trips),
    "avg_passengers_per_type": _on_both(
        lambda routes, trips: reports.avg_passengers_per_type(state.type_state(routes, trips))
    ),
    "busiest_transport_type": _on_trips(
        lambda trips: reports.busiest_transport_type(state.type_trips(trips))
    ),
    "least_occupied_route_per_type": _on_both(
        _named_occupancy("transportType", reports.least_occupied_route_per_type)
    ),
    "avg_occupancy_per_type": _on_both(
        _named_occupancy("transportType", reports.avg_occupancy_per_type)
    ),
    "least_occupied_transport_type": _on_both(
        _named_occupancy("transportType", reports.least_occupied_transport_type)
    ),
    "max_occupancy_per_operator": _on_both(
        _named_occupancy("operator", reports.max_occupancy_per_operator)
    ),
    "operator_with_max_occupancy": _on_both(
        _named_occupancy("operator", reports.operator_with_max_occupancy)
    ),
    "trips_per_passenger": _on_trips(state.passenger_state),
    "passenger_with_most_trips": _on_trips(
        lambda trips: reports.passenger_with_most_trips(state.passenger_state(trips))
    ),
    "hourly_type_counts": _on_publications(
        lambda routes: windows.windowed_counts(routes, "transportType")
    ),
    "most_used_type_per_hour": _on_publications(
        lambda routes: reports.most_used_type_per_hour(
            windows.windowed_counts(routes, "transportType")
        )
    ),
    "most_used_type_last_hour": _on_publications(
        lambda routes: reports.most_used_type_last_hour(
            windows.windowed_counts(windows.last_window(routes), "transportType")
        )
    ),
    "trips_enriched": _on_both(
        lambda routes, trips: reports.trips_enriched(trips, state.latest_routes(routes))
    ),
    "route_messages": _route_messages,
    "envelope_roundtrip": _decoded_messages,
    # the message log: repeated publications, unknown routes, routes without trips
    "log_available_seats_per_route": _on_log(
        lambda routes, trips: reports.available_seats_per_route(state.route_state(routes, trips))
    ),
    "log_occupancy_per_route": _on_log(
        lambda routes, trips: reports.occupancy_per_route(state.route_state(routes, trips))
    ),
    "log_total_occupancy": _on_log(
        lambda routes, trips: reports.total_occupancy(state.route_state(routes, trips))
    ),
    "log_least_occupied_route_per_type": _on_log(
        _named_occupancy("transportType", reports.least_occupied_route_per_type)
    ),
}

# --- reports over every update -----------------------------------------------------------

CHANGELOG_QUERIES: dict[str, Query] = {
    "total_passengers_changelog": _on_log_trips(
        lambda trips: changelog.total_passengers_changelog(state.route_passengers(trips))
    ),
    "total_available_seats_changelog": _on_log(changelog.total_available_seats_changelog),
    "total_occupancy_changelog": _on_log(changelog.total_occupancy_changelog),
    "busiest_transport_type_changelog": _on_log_trips(changelog.busiest_transport_type_changelog),
    "least_occupied_route_per_type_changelog": _on_log(
        changelog.least_occupied_route_per_type_changelog
    ),
    "most_used_type_changelog": _on_publications(changelog.most_used_type_changelog),
    "least_occupied_transport_type_changelog": _on_log(
        changelog.least_occupied_transport_type_changelog
    ),
    "operator_with_max_occupancy_changelog": _on_log(
        changelog.operator_with_max_occupancy_changelog
    ),
    "passenger_with_most_trips_changelog": _on_log_trips(
        changelog.passenger_with_most_trips_changelog
    ),
    "occupancy_updates": _on_log(changelog.occupancy_updates),
    "partitions_occupancy_updates": _on_partitions(changelog.occupancy_updates),
    "partitions_busiest_transport_type_changelog": _on_partitions(
        lambda routes, trips: changelog.busiest_transport_type_changelog(trips)
    ),
    "publications_in_open_hour": _on_late_publications(changelog.in_open_hour),
    "least_occupied_route_history": _on_log(history.least_occupied_route_history),
    "most_used_type_history": _on_publications(history.most_used_type_history),
    "max_occupancy_history": _on_log(history.max_occupancy_history),
    "most_trips_history": _on_log_trips(history.most_trips_history),
}

# --- reports over streams ----------------------------------------------------------------


def _streamed(
    updates: Callable[[DataFrame], DataFrame],
    keys: tuple[str, ...],
    report: Callable[[DataFrame], DataFrame],
) -> Query:
    """Run the log as a stream until it is used up, then report on the table it left."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        log = tables.event_stream(spark, folder)
        return report(live.catch_up(updates(log), *keys).read())

    return run


def _route_updates(log: DataFrame) -> DataFrame:
    return state.route_state(tables.routes_of_events(log), tables.trips_of_events(log))


def _type_updates(log: DataFrame) -> DataFrame:
    return state.type_state(tables.routes_of_events(log), tables.trips_of_events(log))


def _hourly_updates(log: DataFrame) -> DataFrame:
    return live.hourly_updates(tables.publications_of_events(log))


def _profile_updates(log: DataFrame) -> DataFrame:
    return state.route_profile(
        tables.routes_of_events(log), tables.trips_of_events(log), "transportType", "operator"
    )


def _streamed_by(attribute: str, report: Callable[[DataFrame], DataFrame]) -> Query:
    return _streamed(
        _profile_updates, ("routeId",), lambda routes: report(reports.occupancy_by(routes, attribute))
    )


def _stream_trips_enriched(spark: SparkSession, folder: str) -> DataFrame:
    trips = tables.trips_of_events(tables.event_stream(spark, folder)).select(
        "id", "routeId", "transportType"
    )
    kept = work_folder(spark, "enriched")
    attributes = ("transportType", "operator")
    live.enrich(
        trips, lambda: state.latest_routes(tables.event_routes(spark, folder), *attributes), kept, *attributes
    ).awaitTermination()
    return live.enriched(spark, kept)


def _stream_occupancy_updates(spark: SparkSession, folder: str) -> DataFrame:
    """All publications come first, then the trips in two micro-batches."""
    log = tables.table(spark, folder, "events")
    turn = F.when(F.col("event_type") == "signup", 0).otherwise(1 + tables.turns_of(log, "event_id", 2))
    kept = live.in_turns(
        log, turn, 3,
        lambda events, place: updates.follow_occupancy(
            tables.routes_of_events(events), tables.trips_of_events(events), place
        ),
    )
    return updates.occupancy_updates(spark, kept).select("seq", "routeId", "occupancyPercentage")


def _stream_route_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Publications sent as messages in two micro-batches, and read back from the log."""
    routes = tables.event_routes(spark, folder).select("id", "passengerCapacity", "transportType", "operator", "seq")

    def start(stream: DataFrame, place: str):
        sent = envelope.encode(stream.drop("seq"), "Route", F.concat(F.lit("route_"), F.col("id")))
        return message_log.write_log(sent, f"{place}/messages", f"{place}/checkpoint")

    place = live.in_turns(routes, tables.turns_of(routes, "seq", 2), 2, start)
    sent = message_log.read_log(spark, f"{place}/messages", MESSAGE)
    return envelope.decode(sent, ROUTE, keep=("key",)).drop("origin", "destination")


def _stream_publications_in_open_hour(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.order_publications(spark, folder)
    return live.append_in_turns(orders, tables.turns_of(orders, "seq", 4), 4, updates.in_open_hour)


STREAM_QUERIES: dict[str, Query] = {
    "stream_available_seats_per_route": _streamed(
        _route_updates, ("routeId",), reports.available_seats_per_route
    ),
    "stream_occupancy_per_route": _streamed(
        _route_updates, ("routeId",), reports.occupancy_per_route
    ),
    "stream_total_occupancy": _streamed(_route_updates, ("routeId",), reports.total_occupancy),
    "stream_total_passengers_changelog": _streamed(
        _route_updates, ("routeId",), changelog.total_passengers_changelog
    ),
    "stream_avg_passengers_per_type": _streamed(
        _type_updates, ("transportType",), reports.avg_passengers_per_type
    ),
    "stream_passenger_with_most_trips": _streamed(
        lambda log: state.passenger_state(tables.trips_of_events(log)),
        ("passengerId",), reports.passenger_with_most_trips,
    ),
    "stream_routes_latest": _streamed(
        lambda log: state.latest_routes(tables.routes_of_events(log)),
        ("id",), lambda routes: routes.drop("seq", "ts"),
    ),
    "stream_hourly_type_counts": _streamed(
        _hourly_updates, ("window_start", "transportType"), _in_utc
    ),
    "stream_most_used_type_per_hour": _streamed(
        _hourly_updates, ("window_start", "transportType"),
        lambda hourly: _in_utc(reports.most_used_type_per_hour(hourly)),
    ),
    "stream_operator_with_max_occupancy": _streamed_by("operator", reports.operator_with_max_occupancy),
    "stream_least_occupied_route_per_type": _streamed_by(
        "transportType", reports.least_occupied_route_per_type
    ),
    "stream_least_occupied_transport_type": _streamed_by(
        "transportType", reports.least_occupied_transport_type
    ),
    "stream_passengers_per_route": _streamed(
        _route_updates, ("routeId",), reports.passengers_per_route
    ),
    "stream_total_passengers": _streamed(_route_updates, ("routeId",), reports.total_passengers),
    "stream_total_available_seats": _streamed(
        _route_updates, ("routeId",), reports.total_available_seats
    ),
    "stream_busiest_transport_type": _streamed(
        _type_updates, ("transportType",), reports.busiest_transport_type
    ),
    "stream_trips_enriched": _stream_trips_enriched,
    "stream_occupancy_updates": _stream_occupancy_updates,
    "stream_route_messages": _stream_route_messages,
    "stream_publications_in_open_hour": _stream_publications_in_open_hour,
    "stream_hourly_leaders": lambda spark, folder: _in_utc(
        live.current_hourly_leaders(_hourly_updates(tables.event_stream(spark, folder))).read()
    ),
    "stream_counters": _streamed(
        lambda log: state.counters(tables.routes_of_events(log), tables.trips_of_events(log)),
        ("kind", "key"), lambda counted: counted,
    ),
}


# What is missing where the text operators have been taken out, with or without the pipeline.
_TEXT_PARTS = ("ridegauge.llm", "ridegauge.llm.queries", "corpus_pipeline")


def _text_modules() -> list:
    """The modules that hold the text queries and the pipeline, as far as they are there."""
    found = []
    for name in _TEXT_PARTS[1:]:
        try:
            found.append(importlib.import_module(name))
        except ModuleNotFoundError as missing:
            if missing.name not in _TEXT_PARTS:
                raise
            break  # the pipeline is of no use without the operators
    return found


def queries() -> dict[str, Query]:
    found = {**STATE_QUERIES, **CHANGELOG_QUERIES, **STREAM_QUERIES}
    text, pipeline = [*_text_modules(), None, None][:2]
    if text:
        found |= text.QUERIES
    if pipeline:
        found["pipeline"] = pipeline.run
    return found


# --- the same in SQL -----------------------------------------------------------------------

_PART = """
routes AS (
  SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS capacity,
         CONCAT('T', CAST(p_partkey % 25 AS VARCHAR)) AS type, p_type AS operator, p_partkey AS seq
  FROM part),
trips AS (
  SELECT l_partkey AS routeId, l_orderkey AS passengerId, l_orderkey * 8 + l_linenumber AS id,
         CONCAT('T', CAST(l_partkey % 25 AS VARCHAR)) AS type
  FROM lineitem)"""

_LOG = """
routes AS (
  SELECT user_id * 100 + day(ts) AS id, 1 + event_id % 4 AS capacity,
         CONCAT('T', CAST(event_id % 5 AS VARCHAR)) AS type,
         CONCAT('O', CAST(event_id % 4 AS VARCHAR)) AS operator, event_id AS seq
  FROM events WHERE event_type = 'signup'),
trips AS (
  SELECT user_id * 100 + day(ts) AS routeId, event_id % 997 AS passengerId, event_id AS seq,
         CONCAT('T', CAST(user_id % 5 AS VARCHAR)) AS type
  FROM events WHERE event_type <> 'signup')"""

_DEALT = """
log AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type = 'signup'
                               ORDER BY date_trunc('hour', ts), event_id % 3, event_id // 3) - 1 AS place
  FROM events),
routes AS (
  SELECT user_id * 100 + day(ts) AS id, 1 + event_id % 4 AS capacity,
         CONCAT('T', CAST(event_id % 5 AS VARCHAR)) AS type,
         CONCAT('O', CAST(event_id % 4 AS VARCHAR)) AS operator, place AS seq
  FROM log WHERE event_type = 'signup'),
trips AS (
  SELECT user_id * 100 + day(ts) AS routeId, event_id % 997 AS passengerId, place AS seq,
         CONCAT('T', CAST(user_id % 5 AS VARCHAR)) AS type
  FROM log WHERE event_type <> 'signup')"""

_PUBLISHED = """
routes AS (
  SELECT event_type AS type, event_id AS seq, ts, date_trunc('hour', ts) AS hour FROM events)"""

_PUBLISHED_LATE = """
routes AS (
  SELECT o_orderpriority AS type, o_orderkey AS seq, o_orderdate AS ts,
         date_trunc('hour', o_orderdate) AS hour
  FROM orders)"""


def _pct(p: str, s: str) -> str:
    return (
        f"CASE WHEN {s} = 0 THEN CAST(0 AS FLOAT) "
        f"WHEN {p} + {s} = 0 THEN CAST('Infinity' AS FLOAT) "
        f"ELSE CAST({p} AS FLOAT) / CAST({p} + {s} AS FLOAT) * CAST(100 AS FLOAT) END"
    )


_STATE = f"""
cap AS (SELECT id, CAST(SUM(capacity) AS BIGINT) AS c FROM routes GROUP BY id),
pas AS (SELECT routeId AS id, COUNT(*) AS p FROM trips GROUP BY routeId),
seats AS (SELECT cap.id, c - COALESCE(p, 0) AS s FROM cap LEFT JOIN pas ON cap.id = pas.id),
latest AS (SELECT id, arg_max(type, seq) AS type, arg_max(operator, seq) AS operator
           FROM routes GROUP BY id),
occ AS (SELECT pas.id AS routeId, {_pct('p', 's')} AS pct FROM pas JOIN seats ON pas.id = seats.id),
named AS (SELECT routeId, type, operator, pct FROM occ JOIN latest ON routeId = id),
totals AS (SELECT CAST((SELECT SUM(p) FROM pas) AS BIGINT) AS p,
                  CAST((SELECT SUM(s) FROM seats) AS BIGINT) AS s)"""

_UPDATES = f"""
cap AS (SELECT id, CAST(SUM(capacity) AS BIGINT) AS c FROM routes GROUP BY id),
latest AS (SELECT id, arg_max(type, seq) AS type, arg_max(operator, seq) AS operator
           FROM routes GROUP BY id),
ranked AS (SELECT seq, routeId, ROW_NUMBER() OVER (PARTITION BY routeId ORDER BY seq) AS k
           FROM trips),
occ AS (SELECT seq, routeId, type, operator, {_pct('k', '(c - k)')} AS pct
        FROM ranked JOIN cap ON routeId = cap.id JOIN latest ON routeId = latest.id)"""

_OPEN = """
timed AS (SELECT *, MAX(ts) OVER (PARTITION BY type ORDER BY seq
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t
          FROM routes),
in_time AS (SELECT type, seq, hour FROM timed WHERE hour + INTERVAL 1 HOUR > t),
counted AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY type, hour ORDER BY seq) AS k FROM in_time)"""

_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _hourly_leader(extra: str = "") -> str:
    return f"""
hourly AS (SELECT hour, type, COUNT(*) AS n FROM routes GROUP BY hour, type),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY hour ORDER BY n DESC, type) AS place
           FROM hourly)
SELECT hour AS window_start, type AS id, n AS value FROM ranked WHERE place = 1 {extra}"""


def _on(adapter: str, *steps: str, select: str) -> str:
    return "WITH " + ",".join([adapter, *steps]) + "\n" + select


_LEAST_ROUTE = """
SELECT routeId, type AS name, pct AS occupancyPercentage
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY type ORDER BY pct, routeId) AS place FROM named)
WHERE place = 1"""

_MAX_OPERATOR = """
SELECT routeId, operator AS name, pct AS occupancyPercentage FROM named
ORDER BY pct DESC, routeId LIMIT 1"""

_SEATS = "SELECT id, s AS value FROM seats"
_OCCUPANCY = "SELECT routeId, pct AS occupancyPercentage FROM occ"
_TOTAL_OCCUPANCY = (
    f"SELECT CAST(0 AS BIGINT) AS routeId, {_pct('p', 's')} AS occupancyPercentage FROM totals"
)
_AVERAGE = """
SELECT t.type AS id, CAST(floor(t.n / CAST(r.n AS DOUBLE)) AS BIGINT) AS value
FROM (SELECT type, COUNT(*) AS n FROM trips GROUP BY type) t
JOIN (SELECT type, COUNT(*) AS n FROM routes GROUP BY type) r ON t.type = r.type"""
_TOP_PASSENGER = """
SELECT CAST(passengerId AS VARCHAR) AS id, COUNT(*) AS value FROM trips
GROUP BY passengerId ORDER BY value DESC, passengerId LIMIT 1"""
_LATEST = """
SELECT id, arg_max(capacity, seq) AS passengerCapacity, arg_max(type, seq) AS transportType,
       arg_max(operator, seq) AS operator FROM routes GROUP BY id"""
_HOURLY = """
SELECT date_trunc('hour', ts) AS window_start, event_type AS transportType, COUNT(*) AS n
FROM events GROUP BY 1, 2"""
_COUNTERS = """
SELECT kind, key, CAST(SUM(capacity) AS BIGINT) AS capacity, COUNT(route) AS routes,
       COUNT(trip) AS trips
FROM (
  SELECT 'route' AS kind, CAST(id AS VARCHAR) AS key, capacity, 1 AS route, NULL AS trip FROM routes
  UNION ALL SELECT 'type', type, NULL, 1, NULL FROM routes
  UNION ALL SELECT 'operator', operator, NULL, 1, NULL FROM routes
  UNION ALL SELECT 'route', CAST(routeId AS VARCHAR), NULL, NULL, 1 FROM trips
  UNION ALL SELECT 'type', type, NULL, NULL, 1 FROM trips
  UNION ALL SELECT 'passenger', CAST(passengerId AS VARCHAR), NULL, NULL, 1 FROM trips)
GROUP BY kind, key"""
_ALL_COUNTS = "SELECT CAST(0 AS BIGINT) AS id, CAST(SUM(k) AS BIGINT) AS value FROM ranked"
_ALL_SEATS = """(
  SELECT SUM(v) FROM (
    SELECT SUM(capacity) OVER (PARTITION BY id ORDER BY seq
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM routes
    UNION ALL
    SELECT c - k FROM ranked JOIN cap ON routeId = cap.id))"""
_WIRE_ROUTE = ", ".join(
    f"json_object('type', '{kind}', 'optional', false, 'field', '{name}')"
    for name, kind in (
        ("id", "int64"), ("passengerCapacity", "int64"), ("origin", "string"),
        ("destination", "string"), ("transportType", "string"), ("operator", "string"),
    )
)
_MESSAGES = f"""
SELECT CONCAT('route_', CAST(p_partkey AS VARCHAR)) AS key,
  CAST(json_object(
    'schema', json_object('type', 'struct', 'fields', json_array({_WIRE_ROUTE}),
                          'optional', false, 'name', 'Route_record'),
    'payload', json_object('id', p_partkey, 'passengerCapacity', p_size, 'origin', p_name,
      'destination', p_brand, 'transportType', CONCAT('T', CAST(p_partkey % 25 AS VARCHAR)),
      'operator', p_type)) AS VARCHAR) AS value
FROM part"""


def oracle_sql() -> dict[str, str]:
    current = {
        "operators_list": "SELECT DISTINCT p_type AS operator FROM part",
        "operators_from_table": "SELECT DISTINCT p_type AS operator FROM part",
        "operators_polled": "SELECT DISTINCT p_type AS operator FROM part",
        "trips_from_messages": """
SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey * 8 + l_linenumber END AS id,
       CASE WHEN l_linenumber < 7 THEN l_partkey END AS routeId,
       CAST(NULL AS VARCHAR) AS origin, CAST(NULL AS VARCHAR) AS destination,
       CASE WHEN l_linenumber < 7 THEN l_orderkey END AS passengerId,
       CASE WHEN l_linenumber < 7 THEN CONCAT('T', CAST(l_partkey % 25 AS VARCHAR)) END AS transportType,
       CASE WHEN l_linenumber = 7 THEN '{"schema":{"type":"s' END AS unreadable
FROM lineitem""",
        "routes_latest": _on(_LOG, select=_LATEST),
        "partitions_routes_latest": _on(_DEALT, select=_LATEST),
        "passengers_per_route":
            "SELECT l_partkey AS id, COUNT(*) AS value FROM lineitem GROUP BY l_partkey",
        "capacity_per_route":
            "SELECT p_partkey AS routeId, CAST(SUM(p_size) AS BIGINT) AS capacity "
            "FROM part GROUP BY p_partkey",
        "available_seats_per_route": _on(_PART, _STATE, select=_SEATS),
        "occupancy_per_route": _on(_PART, _STATE, select=_OCCUPANCY),
        "total_passengers":
            "SELECT CAST(0 AS BIGINT) AS id, COUNT(*) AS value FROM lineitem",
        "total_available_seats": _on(
            _PART, _STATE, select="SELECT CAST(0 AS BIGINT) AS id, s AS value FROM totals"
        ),
        "total_occupancy": _on(_PART, _STATE, select=_TOTAL_OCCUPANCY),
        "routes_per_type": _on(
            _PART, select="SELECT type AS transportType, COUNT(*) AS routes FROM routes GROUP BY type"
        ),
        "trips_per_type": _on(
            _PART, select="SELECT type AS transportType, COUNT(*) AS trips FROM trips GROUP BY type"
        ),
        "avg_passengers_per_type": _on(_PART, select=_AVERAGE),
        "busiest_transport_type": _on(
            _PART,
            select="SELECT 'highest' AS id, type AS value FROM trips GROUP BY type "
            "ORDER BY COUNT(*) DESC, type LIMIT 1",
        ),
        "least_occupied_route_per_type": _on(_PART, _STATE, select=_LEAST_ROUTE),
        "avg_occupancy_per_type": _on(
            _PART, _STATE,
            select="SELECT type AS transportType, "
            "CAST(AVG(CAST(pct AS DOUBLE)) AS FLOAT) AS occupancyPercentage "
            "FROM named GROUP BY type",
        ),
        "least_occupied_transport_type": _on(
            _PART, _STATE,
            select="SELECT 'min_occupancy' AS id, type AS value FROM named GROUP BY type "
            "ORDER BY CAST(AVG(CAST(pct AS DOUBLE)) AS FLOAT), type LIMIT 1",
        ),
        "max_occupancy_per_operator": _on(
            _PART, _STATE,
            select="SELECT routeId, operator AS name, pct AS occupancyPercentage FROM ("
            "SELECT *, ROW_NUMBER() OVER (PARTITION BY operator ORDER BY pct DESC, routeId) AS place "
            "FROM named) WHERE place = 1",
        ),
        "operator_with_max_occupancy": _on(_PART, _STATE, select=_MAX_OPERATOR),
        "trips_per_passenger":
            "SELECT l_orderkey AS passengerId, COUNT(*) AS trips FROM lineitem GROUP BY l_orderkey",
        "passenger_with_most_trips": _on(_PART, select=_TOP_PASSENGER),
        "hourly_type_counts": _HOURLY,
        "most_used_type_per_hour": _on(_PUBLISHED, select="") + "," + _hourly_leader(),
        "most_used_type_last_hour": _on(_PUBLISHED, select="") + ","
            + _hourly_leader("ORDER BY hour DESC LIMIT 1"),
        "trips_enriched": """
SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey AS routeId, l_orderkey AS passengerId,
       p_name AS origin, p_brand AS destination,
       CONCAT('T', CAST(p_partkey % 25 AS VARCHAR)) AS transportType
FROM lineitem JOIN part ON l_partkey = p_partkey""",
        "route_messages": _MESSAGES,
        "envelope_roundtrip": """
SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS passengerCapacity, p_name AS origin,
       p_brand AS destination, CONCAT('T', CAST(p_partkey % 25 AS VARCHAR)) AS transportType,
       p_type AS operator
FROM part""",
        "log_available_seats_per_route": _on(_LOG, _STATE, select=_SEATS),
        "log_occupancy_per_route": _on(_LOG, _STATE, select=_OCCUPANCY),
        "log_total_occupancy": _on(_LOG, _STATE, select=_TOTAL_OCCUPANCY),
        "log_least_occupied_route_per_type": _on(_LOG, _STATE, select=_LEAST_ROUTE),
    }
    updates = {
        "total_passengers_changelog": _on(_LOG, _UPDATES, select=_ALL_COUNTS),
        "total_available_seats_changelog": _on(
            _LOG, _UPDATES,
            select=f"SELECT CAST(0 AS BIGINT) AS id, CAST({_ALL_SEATS} AS BIGINT) AS value",
        ),
        "total_occupancy_changelog": _on(
            _LOG, _UPDATES,
            f"both_totals AS (SELECT CAST((SELECT SUM(k) FROM ranked) AS BIGINT) AS p, "
            f"CAST({_ALL_SEATS} AS BIGINT) AS s)",
            select=f"SELECT CAST(0 AS BIGINT) AS routeId, {_pct('p', 's')} AS occupancyPercentage "
            "FROM both_totals",
        ),
        "busiest_transport_type_changelog": _on(
            _LOG,
            select="SELECT 'highest' AS id, type AS value FROM trips ORDER BY seq DESC LIMIT 1",
        ),
        "least_occupied_route_per_type_changelog": _on(
            _LOG, _UPDATES,
            select="SELECT routeId, type AS name, pct AS occupancyPercentage FROM ("
            "SELECT *, ROW_NUMBER() OVER (PARTITION BY type ORDER BY pct, seq) AS place FROM occ) "
            "WHERE place = 1",
        ),
        "most_used_type_changelog": _on(
            _PUBLISHED, _OPEN,
            select="SELECT type AS id, k AS value FROM counted ORDER BY k DESC, seq DESC LIMIT 1",
        ),
        "least_occupied_transport_type_changelog": _on(
            _LOG, _UPDATES,
            """averages AS (
  SELECT seq, type, CAST(
    SUM(CAST(pct AS DOUBLE)) OVER (PARTITION BY type ORDER BY seq
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    / ROW_NUMBER() OVER (PARTITION BY type ORDER BY seq) AS FLOAT) AS average
  FROM occ)""",
            select="SELECT 'min_occupancy' AS id, type AS value FROM averages "
            "ORDER BY average, seq DESC LIMIT 1",
        ),
        "operator_with_max_occupancy_changelog": _on(
            _LOG, _UPDATES,
            select="SELECT routeId, operator AS name, pct AS occupancyPercentage FROM occ "
            "ORDER BY pct DESC, seq LIMIT 1",
        ),
        "passenger_with_most_trips_changelog": _on(
            _LOG,
            """numbered AS (
  SELECT seq, passengerId, ROW_NUMBER() OVER (PARTITION BY passengerId ORDER BY seq) AS k
  FROM trips)""",
            select="SELECT CAST(passengerId AS VARCHAR) AS id, k AS value FROM numbered "
            "ORDER BY k DESC, seq LIMIT 1",
        ),
        "occupancy_updates": _on(
            _LOG, _UPDATES, select="SELECT seq, routeId, pct AS occupancyPercentage FROM occ"
        ),
        "partitions_occupancy_updates": _on(
            _DEALT, _UPDATES, select="SELECT seq, routeId, pct AS occupancyPercentage FROM occ"
        ),
        "partitions_busiest_transport_type_changelog": _on(
            _DEALT,
            select="SELECT 'highest' AS id, type AS value FROM trips ORDER BY seq DESC LIMIT 1",
        ),
        "publications_in_open_hour": _on(
            _PUBLISHED_LATE, _OPEN, select="SELECT type AS transportType, seq, hour FROM in_time"
        ),
        "least_occupied_route_history": _on(
            _LOG, _UPDATES,
            f"led AS (SELECT *, MIN(pct) OVER (PARTITION BY type ORDER BY seq {_BEFORE}) AS best "
            "FROM occ)",
            select="SELECT routeId, arg_max(type, seq) AS name, "
            "arg_max(pct, seq) AS occupancyPercentage "
            "FROM led WHERE best IS NULL OR pct < best GROUP BY routeId",
        ),
        "most_used_type_history": _on(
            _PUBLISHED, _OPEN,
            f"led AS (SELECT *, MAX(k) OVER (ORDER BY seq {_BEFORE}) AS best FROM counted)",
            select="SELECT type AS id, arg_max(k, seq) AS value "
            "FROM led WHERE best IS NULL OR k >= best GROUP BY type",
        ),
        "max_occupancy_history": _on(
            _LOG, _UPDATES,
            f"led AS (SELECT *, MAX(pct) OVER (ORDER BY seq {_BEFORE}) AS best FROM occ)",
            select="SELECT routeId, arg_max(operator, seq) AS name, "
            "arg_max(pct, seq) AS occupancyPercentage "
            "FROM led WHERE best IS NULL OR pct > best GROUP BY routeId",
        ),
        "most_trips_history": _on(
            _LOG,
            """numbered AS (
  SELECT seq, passengerId, ROW_NUMBER() OVER (PARTITION BY passengerId ORDER BY seq) AS k
  FROM trips)""",
            f"led AS (SELECT *, MAX(k) OVER (ORDER BY seq {_BEFORE}) AS best FROM numbered)",
            select="SELECT CAST(passengerId AS VARCHAR) AS id, arg_max(k, seq) AS value "
            "FROM led WHERE best IS NULL OR k > best GROUP BY passengerId",
        ),
    }
    streams = {
        "stream_available_seats_per_route": current["log_available_seats_per_route"],
        "stream_occupancy_per_route": current["log_occupancy_per_route"],
        "stream_total_occupancy": current["log_total_occupancy"],
        "stream_least_occupied_route_per_type": _on(_LOG, _STATE, select=_LEAST_ROUTE),
        "stream_least_occupied_transport_type": _on(
            _LOG, _STATE,
            select="SELECT 'min_occupancy' AS id, type AS value FROM named GROUP BY type "
            "ORDER BY CAST(AVG(CAST(pct AS DOUBLE)) AS FLOAT), type LIMIT 1",
        ),
        "stream_passengers_per_route":
            _on(_LOG, select="SELECT routeId AS id, COUNT(*) AS value FROM trips GROUP BY routeId"),
        "stream_total_passengers":
            _on(_LOG, select="SELECT CAST(0 AS BIGINT) AS id, COUNT(*) AS value FROM trips"),
        "stream_total_available_seats": _on(
            _LOG, _STATE, select="SELECT CAST(0 AS BIGINT) AS id, s AS value FROM totals"
        ),
        "stream_busiest_transport_type": _on(
            _LOG,
            select="SELECT 'highest' AS id, type AS value FROM trips GROUP BY type "
            "ORDER BY COUNT(*) DESC, type LIMIT 1",
        ),
        "stream_total_passengers_changelog": updates["total_passengers_changelog"],
        "stream_avg_passengers_per_type": _on(_LOG, select=_AVERAGE),
        "stream_passenger_with_most_trips": _on(_LOG, select=_TOP_PASSENGER),
        "stream_routes_latest": current["routes_latest"],
        "stream_hourly_type_counts": _HOURLY,
        "stream_most_used_type_per_hour": current["most_used_type_per_hour"],
        "stream_operator_with_max_occupancy": _on(_LOG, _STATE, select=_MAX_OPERATOR),
        "stream_hourly_leaders": _on(_PUBLISHED, select="") + ","
            + _hourly_leader(),
        "stream_counters": _on(_LOG, select=_COUNTERS),
        "stream_occupancy_updates": updates["occupancy_updates"],
        "stream_route_messages": _on(
            _LOG,
            select="SELECT CONCAT('route_', CAST(id AS VARCHAR)) AS key, id, "
            "capacity AS passengerCapacity, type AS transportType, operator FROM routes",
        ),
        "stream_publications_in_open_hour": updates["publications_in_open_hour"],
        "stream_trips_enriched": _on(
            _LOG, _UPDATES,
            select="SELECT trips.seq AS id, routeId, latest.type AS transportType, operator "
            "FROM trips JOIN latest ON routeId = latest.id",
        ),
    }
    text, pipeline = [*_text_modules(), None, None][:2]
    piped = {"pipeline": pipeline.ORACLE_SQL} if pipeline and pipeline.ORACLE_SQL else {}
    return {**current, **updates, **streams, **(text.SQL if text else {}), **piped}
