"""Streams over several micro-batches give what the batch reports give."""

import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from ridegauge.functions.envelope import encode
from ridegauge.operators.keyed import first_by
from ridegauge.operators.windows import windowed_counts
from ridegauge.plans import changelog, reports, state, suite
from ridegauge.schemas import ROUTE, TRIP
from ridegauge.sources import messages, tables
from ridegauge.streaming import live

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """The event log as a folder of five files, written in time order."""
    folder = str(tmp_path_factory.mktemp("log"))
    events = tables.table(spark, SF, "events")
    step = events.count() // 5 + 1
    for part in range(5):
        rows = events.where(F.floor(F.col("event_id") / step) == part).coalesce(1)
        rows.write.mode("append").parquet(f"{folder}/events.parquet")
    return folder


def stream(spark, folder):
    parts = spark.readStream.schema(tables.SCHEMAS["events"]).option("maxFilesPerTrigger", 1)
    rows = parts.parquet(f"{folder}/events.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def split(events):
    return tables.routes_of_events(events), tables.trips_of_events(events)


def test_route_state(spark, log):
    live_routes, live_trips = split(stream(spark, log))
    table = live.catch_up(state.route_state(live_routes, live_trips), "routeId")
    routes, trips = split(tables.table(spark, log, "events"))
    expected = state.route_state(routes, trips)
    current = table.read()
    assert values(current) == values(expected)
    for report in (
        reports.occupancy_per_route, reports.total_occupancy, reports.total_available_seats,
        changelog.total_passengers_changelog,
    ):
        assert values(report(current)) == values(report(expected))


def test_types_and_passengers(spark, log):
    live_routes, live_trips = split(stream(spark, log))
    routes, trips = split(tables.table(spark, log, "events"))
    types = live.catch_up(state.type_state(live_routes, live_trips), "transportType").read()
    assert values(types) == values(state.type_state(routes, trips))
    passengers = live.catch_up(state.passenger_state(live_trips), "passengerId").read()
    assert values(reports.passenger_with_most_trips(passengers)) == values(
        reports.passenger_with_most_trips(state.passenger_state(trips))
    )


def test_latest_routes(spark, log):
    live_routes, _ = split(stream(spark, log))
    routes, _ = split(tables.table(spark, log, "events"))
    table = live.catch_up(state.latest_routes(live_routes, "operator"), "id")
    assert values(table.read()) == values(state.latest_routes(routes, "operator"))


def test_hourly(spark, log):
    events = tables.table(spark, log, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    expected = windowed_counts(tables.publications_of_events(events), "transportType")
    updates = live.hourly_updates(tables.publications_of_events(stream(spark, log)))
    counted = live.catch_up(updates, "window_start", "transportType").read()
    assert values(counted) == values(expected)

    leaders = live.hourly_leaders(tables.publications_of_events(stream(spark, log)))
    query = leaders.writeStream.format("memory").queryName("leaders").outputMode("append")
    query.trigger(availableNow=True).start().awaitTermination()
    closed = values(spark.table("leaders"))
    whole = values(reports.most_used_type_per_hour(expected))
    assert closed
    assert set(closed) <= set(whole)
    # windows at the end of the log are still open
    assert max(whole)[0] > max(closed)[0]


def test_late_record_is_dropped(spark, tmp_path):
    times = [["00:10"], ["01:05"], ["00:50"], ["01:20"]]
    folder = str(tmp_path / "routes")
    schema = "transportType string, ts timestamp"
    for i, batch in enumerate(times):
        rows = [("Bus", datetime.datetime.fromisoformat(f"2024-01-01 {at}:00")) for at in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{i}")
    table = None
    for i in range(len(times)):
        routes = spark.readStream.schema(schema).parquet(f"{folder}/[0-{i}]")
        updates = live.hourly_updates(routes)
        table = live.keyed_table(
            spark, updates, str(tmp_path / "table"), "window_start", "transportType"
        )
        live.maintain(updates, table, str(tmp_path / "checkpoint")).awaitTermination()
    counted = sorted((row["window_start"].hour, row["n"]) for row in table.read().collect())
    assert counted == [(0, 1), (1, 2)]


def test_restart_continues(spark, tmp_path):
    """Two runs on one checkpoint, with new files in between."""
    folder, schema = str(tmp_path / "trips"), "routeId bigint"
    counted = None
    for ids in ([1, 1, 2], [2, 3]):
        spark.createDataFrame([(i,) for i in ids], schema).write.mode("append").parquet(folder)
        updates = state.route_passengers(spark.readStream.schema(schema).parquet(folder))
        table = live.keyed_table(spark, updates, str(tmp_path / "table"), "routeId")
        live.maintain(updates, table, str(tmp_path / "checkpoint")).awaitTermination()
        counted = values(table.read())
    assert counted == [(1, 2), (2, 2), (3, 1)]


def test_messages_from_files(spark, tmp_path, make_routes, make_trips):
    """Topics as files of messages: encoded, read back as a stream, reported on."""
    routes = make_routes([(1, 10, "Bus", "A"), (2, 4, "Taxi", "B")]).select(*ROUTE.fieldNames())
    trips = make_trips([(1, 7, "Bus"), (2, 7, "Taxi"), (1, 8, "Bus")])
    trips = trips.withColumn("origin", F.lit("x")).withColumn("destination", F.lit("y"))
    encode(routes, "Route").select("value").write.text(str(tmp_path / "routes"))
    encode(trips.select(*TRIP.fieldNames()), "Trip").select("value").write.text(str(tmp_path / "trips"))
    live_routes = messages.records(
        messages.message_files(spark, str(tmp_path / "routes"), stream=True), ROUTE, "id"
    )
    live_trips = messages.records(
        messages.message_files(spark, str(tmp_path / "trips"), stream=True), TRIP, "id"
    )
    table = live.catch_up(state.route_state(live_routes, live_trips), "routeId")
    assert values(reports.occupancy_per_route(table.read())) == [(1, 20.0), (2, 25.0)]


def test_session_keeps_its_stream_settings(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        spark.createDataFrame([(1,)], "routeId bigint").write.parquet(str(tmp_path / "t"))
        trips = spark.readStream.schema("routeId bigint").parquet(str(tmp_path / "t"))
        live.catch_up(state.route_passengers(trips), "routeId")
        assert "HDFSBacked" in spark.conf.get(name)
    finally:
        spark.conf.set(name, before)


def test_one_file_or_a_folder(spark, log):
    for folder in (SF, log):
        events = tables.event_stream(spark, folder)
        table = live.catch_up(state.route_passengers(tables.trips_of_events(events)), "routeId")
        assert table.read().agg(F.sum("passengers")).first()[0] > 0


def test_reports_follow_each_batch(spark, log, tmp_path):
    """Totals written after every batch: the last is the batch result, earlier ones are smaller."""
    folder = str(tmp_path / "totals")
    live_routes, live_trips = split(stream(spark, log))
    updates = state.route_state(live_routes, live_trips)
    table = live.keyed_table(spark, updates, str(tmp_path / "table"), "routeId")

    def publish(current, batch):
        total = reports.total_passengers(current.read())
        total.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    live.maintain(updates, table, str(tmp_path / "checkpoint"), then=publish).awaitTermination()
    totals = [r["value"] for r in spark.read.parquet(folder).orderBy("batch").collect()]
    _, trips = split(tables.table(spark, log, "events"))
    assert totals == sorted(totals)
    assert len(totals) > 2
    assert totals[-1] == trips.count()


def test_all_states(spark, log, tmp_path):
    """Every report from live states equals the report over tables."""
    events = tables.table(spark, log, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    expected = suite.all_reports(suite.states(*split(events)))
    kept, queries = live.live_states(*split(stream(spark, log)), str(tmp_path))
    for query in queries:
        query.awaitTermination()
    found = suite.all_reports(suite.States(**{name: t.read() for name, t in kept.items()}))
    assert set(found) == set(expected)
    for name in expected:
        assert values(found[name]) == values(expected[name]), name


def test_failed_batch_is_repeated(spark, log, tmp_path):
    """A run that dies after its second batch, and one that takes over."""
    live_routes, live_trips = split(stream(spark, log))
    updates = state.route_state(live_routes, live_trips)
    table = live.keyed_table(spark, updates, str(tmp_path / "table"), "routeId")
    checkpoint = str(tmp_path / "checkpoint")
    seen = []

    def die(current, batch):
        seen.append(batch)
        if batch == 1 and seen.count(1) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        live.maintain(updates, table, checkpoint, then=die).awaitTermination()
    live.maintain(updates, table, checkpoint, then=die).awaitTermination()
    assert seen.count(1) == 2
    assert values(table.read()) == values(
        state.route_state(*split(tables.table(spark, log, "events")))
    )


def route_table(spark, known):
    return lambda: spark.createDataFrame([(i, f"T{i}") for i in known], "id long, transportType string")


def test_a_held_back_trip_comes_out_once(spark, tmp_path):
    trips = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 4)], "id long, routeId long")
    kept, sent = str(tmp_path / "kept"), str(tmp_path / "trips")
    known, seen = [], []
    for route in (1, 2, 3):
        known.append(route)
        trips.withColumn("id", F.col("id") + 10 * route).coalesce(1).write.mode("append").parquet(sent)
        stream = spark.readStream.schema(trips.schema).parquet(sent)
        live.enrich(stream, route_table(spark, known), kept, "transportType").awaitTermination()
        seen.append(values(live.held_back(spark, kept).select("id")))
    found = live.enriched(spark, kept).select("id", "routeId", "transportType")
    assert values(found) == [
        (11, 1, "T1"), (12, 2, "T2"), (21, 1, "T1"), (22, 2, "T2"), (31, 1, "T1"), (32, 2, "T2")
    ]
    assert seen == [[(12,), (14,)], [(14,), (24,)], [(14,), (24,), (34,)]]


def test_enrichment_refuses_a_new_checkpoint(spark, tmp_path):
    trips = spark.createDataFrame([(1, 1), (2, 2)], "id long, routeId long")
    kept, sent = str(tmp_path / "kept"), str(tmp_path / "trips")
    trips.write.parquet(sent)
    stream = spark.readStream.schema(trips.schema).parquet(sent)
    live.enrich(stream, route_table(spark, [1, 2]), kept, "transportType").awaitTermination()
    (tmp_path / "kept/checkpoint").rename(tmp_path / "old")
    with pytest.raises(Exception, match="holds batches of run"):
        live.enrich(stream, route_table(spark, [1, 2]), kept, "transportType").awaitTermination()
    assert live.enriched(spark, kept).count() == 2


def test_enrichment_repeats_a_failed_batch(spark, tmp_path):
    trips = spark.createDataFrame([(1, 1), (2, 2)], "id long, routeId long")
    kept, sent = str(tmp_path / "kept"), str(tmp_path / "trips")
    trips.write.parquet(sent)
    stream = spark.readStream.schema(trips.schema).parquet(sent)

    def lost():
        return route_table(spark, [1])().withColumn("transportType", F.raise_error(F.lit("lost")))

    with pytest.raises(Exception, match="lost"):
        live.enrich(stream, lost, kept, "transportType").awaitTermination()
    with pytest.raises(ValueError, match="no batch"):
        live.enriched(spark, kept)
    live.enrich(stream, route_table(spark, [1]), kept, "transportType").awaitTermination()
    assert values(live.enriched(spark, kept).select("id")) == [(1,)]
    assert values(live.held_back(spark, kept).select("id")) == [(2,)]


def test_leader_of_the_open_hour_moves(spark, tmp_path):
    """After each batch the leaders are those of all records so far, the last hour included."""
    minutes = [("Bus", 5), ("Taxi", 10), ("Taxi", 20), ("Bus", 61), ("Taxi", 62), ("Taxi", 63), ("Bus", 64), ("Bus", 65)]
    start = datetime.datetime(2024, 1, 1)
    sent, schema = str(tmp_path / "sent"), "transportType string, ts timestamp"
    updates = None
    for upto in (1, 4, 6, 8):
        rows = [(kind, start + datetime.timedelta(minutes=m)) for kind, m in minutes[:upto]]
        new = rows[{1: 0, 4: 1, 6: 4, 8: 6}[upto]:]
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(sent)
        updates = live.hourly_updates(spark.readStream.schema(schema).parquet(sent))
        counts = live.grouped_table(spark, updates, str(tmp_path / "counts"), "window_start", "transportType", fold_every=2)
        leaders = live.KeyedTable(
            spark, str(tmp_path / "leaders"), ("window_start",),
            reports.most_used_type_per_hour(spark.createDataFrame([], updates.schema)).schema, fold_every=2,
        )
        live.maintain_groups(
            updates, counts, leaders, reports.most_used_type_per_hour, str(tmp_path / "checkpoint")
        ).awaitTermination()
        expected = windowed_counts(spark.createDataFrame(rows, schema), "transportType")
        assert values(leaders.read()) == values(reports.most_used_type_per_hour(expected))


def test_partial_leaders_look_at_touched_parts_only(spark, log, monkeypatch):
    _, trips = split(tables.table(spark, log, "events"))
    _, live_trips = split(stream(spark, log))
    asked = []
    before = live.KeyedTable.read_like
    monkeypatch.setattr(live.KeyedTable, "read_like", lambda self, rows: asked.append(rows.count()) or before(self, rows))

    def top(rows):
        return first_by(rows, ["part"], [F.col("passengerId"), F.col("trips")], [-F.col("trips"), F.col("passengerId")])

    _, leaders = live.partial_leaders(state.passenger_state(live_trips), "passengerId", top)
    expected = reports.passenger_with_most_trips(state.passenger_state(trips))
    assert values(reports.passenger_with_most_trips(leaders.read())) == values(expected)
    assert leaders.read().count() <= 64 and len(asked) == 5


def test_a_new_checkpoint_needs_a_new_table(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1)], "id long, value long")
    rows.write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
    kept = live.keyed_table(spark, stream, str(tmp_path / "table"), "id")
    live.maintain(stream, kept, str(tmp_path / "a")).awaitTermination()
    with pytest.raises(Exception, match="holds batches of run"):
        live.maintain(stream, kept, str(tmp_path / "b")).awaitTermination()
    assert values(kept.read()) == [(1, 1)]
