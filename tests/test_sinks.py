import json

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridegauge import session
from ridegauge.functions.envelope import decode, encode, schema_literal
from ridegauge.schemas import NUMBER, OPERATOR, ROUTE, wire_type
from ridegauge.plans import suite
from ridegauge.sinks import database
from ridegauge.sinks.keyed_table import KeyedTable
from ridegauge.sinks.results import RESULTS, as_messages
from ridegauge.sources import messages


def test_encode_carries_the_schema(spark):
    df = spark.createDataFrame([(1, 50, "Lisboa", None, "Bus", "FlixBus")], ROUTE)
    row = encode(df, "Route", F.concat(F.lit("route_"), F.col("id"))).first()
    assert row["key"] == "route_1"
    message = json.loads(row["value"])
    assert message["schema"] == {
        "type": "struct",
        "name": "Route_record",
        "optional": False,
        "fields": [
            {"type": kind, "optional": False, "field": name}
            for name, kind in [
                ("id", "int64"), ("passengerCapacity", "int64"), ("origin", "string"),
                ("destination", "string"), ("transportType", "string"), ("operator", "string"),
            ]
        ],
    }
    assert message["payload"] == {
        "id": 1, "passengerCapacity": 50, "origin": "Lisboa", "transportType": "Bus",
        "operator": "FlixBus",
    }


@pytest.mark.parametrize("envelope", [True, False])
def test_roundtrip(spark, envelope):
    rows = [(1, 50, "é \"quoted\"", None, "Bus", "A"), (2, None, "", "b", None, "B")]
    df = spark.createDataFrame(rows, ROUTE)
    back = decode(encode(df, "Route", envelope=envelope), ROUTE, envelope=envelope)
    assert values(back) == values(df)
    assert back.schema == df.schema


@pytest.mark.parametrize("envelope", [True, False])
def test_a_null_record_is_a_null_message(spark, envelope):
    df = spark.createDataFrame([(None,) * 6, (None, None, None, None, None, "B")], ROUTE)
    sent = encode(df, "Route", F.lit("k"), envelope=envelope)
    assert [(r["key"], r["value"] is None) for r in sent.collect()] == [("k", True), ("k", False)]
    assert values(decode(sent, ROUTE, envelope=envelope)) == values(df)


def test_decode_null_missing_and_malformed(spark):
    data = [(0, None), (1, '{"payload":{"id":7}}'), (2, "{broken"), (3, "")]
    df = spark.createDataFrame(data, "seq bigint, value string")
    got = {row["seq"]: row["id"] for row in decode(df, NUMBER, keep=("seq",)).collect()}
    assert got == {0: None, 1: 7, 2: None, 3: None}
    assert [r["seq"] for r in messages.records(df, NUMBER, "id").collect()] == [1]
    with pytest.raises(Exception, match="MALFORMED"):
        decode(df, NUMBER, strict=True).collect()


def test_decode_bytes(spark):
    df = spark.createDataFrame([('{"payload":{"operator":"A"}}',)], "value string")
    binary = df.select(F.col("value").cast("binary").alias("value"))
    assert values(decode(binary, OPERATOR)) == [("A",)]


def test_wire_types():
    kinds = [T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
             T.BooleanType(), T.TimestampType()]
    assert [wire_type(kind) for kind in kinds] == [
        "string", "int32", "int64", "float", "double", "boolean", "string",
    ]


def test_schema_literal_is_constant(spark):
    plan = spark.range(1).select(F.to_json(schema_literal(NUMBER, "Number")).alias("s"))
    assert json.loads(plan.first()["s"])["name"] == "Number_record"


def test_report_messages(spark):
    report = spark.createDataFrame([(3, 9)], NUMBER)
    row = as_messages(report, "passengers_per_route").first()
    assert row["key"] == "3"
    assert json.loads(row["value"])["schema"]["name"] == "Number_record"


def test_every_report_has_a_place(spark, make_routes, make_trips, tmp_path):
    """All reports of one run: message keys, and the tables they are kept in."""
    routes = make_routes([(1, 10, "Bus", "A"), (2, 4, "Taxi", "B")])
    trips = make_trips([(1, 7, "Bus"), (2, 7, "Taxi"), (2, 8, "Taxi")])
    found = suite.all_reports(suite.states(routes, trips))
    assert set(found) == set(RESULTS)
    assert values(found["operators_list"]) == [("A",), ("B",)]
    assert values(found["total_occupancy"]) == [(0, 21.428571701049805)]
    assert values(found["most_used_type_last_hour"]) == [("Bus", 1)]
    sent = {name: df for name, df in found.items() if RESULTS[name].topic}
    keys = {name: values(as_messages(df, name).select("key")) for name, df in sent.items()}
    assert keys["total_passengers"] == [("total",)]
    assert keys["passenger_with_most_trips"] == [("max_trips",)]
    assert keys["operator_with_max_occupancy"] == [("B",)]
    assert set(found) - set(keys) == {"routes_latest"}
    with pytest.raises(ValueError, match="no topic"):
        as_messages(found["routes_latest"], "routes_latest")
    inputs = {messages.ROUTES_TOPIC, messages.TRIPS_TOPIC, messages.OPERATORS_TOPIC}
    assert inputs.isdisjoint(result.topic for result in RESULTS.values())
    for name, df in found.items():
        result = RESULTS[name]
        kept = KeyedTable(spark, f"{tmp_path}/{result.table}", (result.key,), df.schema)
        kept.upsert(df, 0)
        assert values(kept.read().select(*df.columns)) == values(df)


def test_one_batch_with_a_key_twice_keeps_one_row(spark, tmp_path):
    kept = table(spark, tmp_path)
    kept.upsert(numbers(spark, (1, 1), (1, 1), (2, 5)), 0)
    assert values(kept.read()) == [(1, 1), (2, 5)]


def test_readers_keep_records_without_an_id(spark):
    from ridegauge.schemas import TRIP

    payloads = ['{"payload": {"routeId": 1, "passengerId": 7}}', '{"payload": {"id": 3}}', "broken", None]
    sent = spark.createDataFrame([(v, i) for i, v in enumerate(payloads)], "value string, seq long")
    read = messages.records(sent, TRIP)
    assert [(r["seq"], r["id"], r["routeId"]) for r in read.orderBy("seq").collect()] == [(0, None, 1), (1, 3, None)]
    lost = messages.unreadable(sent, TRIP)
    assert [r["seq"] for r in lost.collect()] == [2]
    with pytest.raises(Exception, match="(?i)malformed"):
        messages.records(sent, TRIP, strict=True).collect()


def table(spark, tmp_path, **options):
    return KeyedTable(spark, str(tmp_path / "table"), ("id",), NUMBER, **options)


def numbers(spark, *rows):
    return spark.createDataFrame(list(rows), NUMBER)


def test_upsert_keeps_the_last_row(spark, tmp_path):
    kept = table(spark, tmp_path)
    assert values(kept.read()) == []
    kept.upsert(numbers(spark, (1, 10), (2, 20)), 0)
    kept.upsert(numbers(spark, (2, 21), (3, 30)), 1)
    assert values(kept.read()) == [(1, 10), (2, 21), (3, 30)]
    assert kept.read().columns == ["id", "value"]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    kept = table(spark, tmp_path)
    kept.upsert(numbers(spark, (1, 10)), 0)
    kept.upsert(numbers(spark, (1, 11)), 1)
    kept.upsert(numbers(spark, (1, 10)), 0)
    assert values(kept.read()) == [(1, 11)]


def test_unfinished_batch_is_not_seen(spark, tmp_path):
    kept = table(spark, tmp_path)
    kept.upsert(numbers(spark, (1, 10)), 0)
    kept.upsert(numbers(spark, (1, 11)), 1)
    partial = tmp_path / "table/rows/0/upsert_batch=2"
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        numbers(spark, (1, 12)).write.parquet(str(partial))
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert not (partial / "_SUCCESS").exists()
    assert values(kept.read()) == [(1, 11)]
    kept.upsert(numbers(spark, (1, 13)), 2)
    assert values(kept.read()) == [(1, 13)]


def test_folding(spark, tmp_path):
    kept = table(spark, tmp_path, fold_every=2)
    for batch in range(5):
        kept.upsert(numbers(spark, (batch % 3, batch), (9, batch)), batch)
    assert values(kept.read()) == [(0, 3), (1, 4), (2, 2), (9, 4)]
    assert {p.name for p in (tmp_path / "table/folds").iterdir()} == {"1", "2"}
    kept.upsert(numbers(spark, (0, -1)), 1)
    assert values(kept.read()) == [(0, 3), (1, 4), (2, 2), (9, 4)]
    for batch in range(5, 10):
        kept.upsert(numbers(spark, (batch % 3, batch), (9, batch)), batch)
    assert values(kept.read()) == [(0, 9), (1, 7), (2, 8), (9, 9)]
    # the fold before the last and what it took from older ones stay for readers
    kept_folds = {p.name for p in (tmp_path / "table/folds").iterdir()}
    assert {"3", "4"} <= kept_folds <= {"2", "3", "4"}
    assert {p.name for p in (tmp_path / "table/rows").iterdir()} == {"3", "4"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_folded_rows_are_read_without_an_exchange(spark, tmp_path):
    kept = table(spark, tmp_path, fold_every=2, buckets=8)
    kept.upsert(numbers(spark, *[(i, i) for i in range(100)]), 0)
    kept.upsert(numbers(spark, *[(i, -i) for i in range(50)]), 1)
    assert "Exchange" in plan_of(kept.read())
    kept.upsert(numbers(spark), 2)
    assert "Exchange" not in plan_of(kept.read())
    assert values(kept.read()) == sorted(((i, -i if i < 50 else i) for i in range(100)), key=repr)


def test_a_fold_writes_touched_buckets_only(spark, tmp_path):
    kept = table(spark, tmp_path, fold_every=1, buckets=32)
    kept.upsert(numbers(spark, *[(i, i) for i in range(200)]), 0)
    kept.upsert(numbers(spark, (7, 1)), 1)
    kept.upsert(numbers(spark, (8, 2)), 2)
    folded = {p.name: len(list(p.glob("upsert_bucket=*"))) for p in (tmp_path / "table/folds").iterdir()}
    assert folded["1"] > 20 and folded["2"] == 1
    assert values(kept.read().where("id IN (7, 8, 9)")) == [(7, 1), (8, 2), (9, 9)]
    assert kept.read().count() == 200
    like = kept.read_like(numbers(spark, (8, 0)))
    assert values(like.where("id = 8")) == [(8, 2)] and like.count() < 50
    for batch in range(3, 9):
        kept.upsert(numbers(spark, (batch, -batch)), batch)
    assert kept.read().count() == 200
    assert values(kept.read().where("id BETWEEN 6 AND 9")) == [(6, -6), (7, -7), (8, -8), (9, 9)]


def test_rows_of_a_batch(spark, tmp_path):
    kept = table(spark, tmp_path)
    kept.upsert(numbers(spark, (1, 10), (2, 20)), 0)
    kept.upsert(numbers(spark), 1)
    assert values(kept.rows_of(0)) == [(1, 10), (2, 20)] and values(kept.rows_of(1)) == []


@pytest.mark.parametrize("fold_every", [1, 50])
def test_columns_grow_wider(spark, tmp_path, fold_every):
    first = spark.createDataFrame([(1, 10, 1.5)], "id int, value int, share float")
    kept = KeyedTable(spark, str(tmp_path / "table"), ("id",), first.schema, fold_every=fold_every)
    kept.upsert(first, 0)
    kept.upsert(spark.createDataFrame([(2, 1 << 40, 1e300)], "id int, value long, share double"), 1)
    kept.upsert(spark.createDataFrame([(3, 5, 0.25)], "id int, value int, share float"), 2)
    assert values(kept.read()) == [(1, 10, 1.5), (2, 1 << 40, 1e300), (3, 5, 0.25)]
    assert [f.dataType.simpleString() for f in kept.read().schema] == ["int", "bigint", "double"]
    kept.upsert(spark.createDataFrame([(4, "x")], "id int, value string"), 3)
    with pytest.raises(ValueError, match="column value"):
        kept.read()


def test_another_run_is_refused(spark, tmp_path):
    kept = table(spark, tmp_path)
    kept.upsert(numbers(spark, (1, 1)), 0, "a")
    for batch in (0, 1, 60):
        with pytest.raises(ValueError, match="run a"):
            kept.upsert(numbers(spark, (1, 99), (2, 5)), batch, "b")
    kept.upsert(numbers(spark, (1, 2)), 60, "a")
    with pytest.raises(ValueError, match="run a"):
        kept.upsert(numbers(spark, (1, 99)), 0, "b")
    assert values(kept.read()) == [(1, 2)]


def test_batches_count_without_success_marks(spark, tmp_path):
    kept = table(spark, tmp_path)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        kept.upsert(numbers(spark, (1, 10)), 0)
        kept.upsert(numbers(spark, (2, 20)), 1)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert values(kept.read()) == [(1, 10), (2, 20)]


def test_new_columns_are_added(spark, tmp_path):
    kept = table(spark, tmp_path, fold_every=2)
    kept.upsert(numbers(spark, (1, 10)), 0)
    kept.upsert(numbers(spark, (2, 20)).withColumn("name", F.lit("x")), 1)
    assert values(kept.read()) == [(1, 10, None), (2, 20, "x")]
    kept.upsert(numbers(spark, (3, 30)).withColumn("late", F.lit(True)), 2)
    assert kept.read().columns == ["id", "value", "name", "late"]
    assert values(kept.read().select("id", "late")) == [(1, None), (2, None), (3, True)]


def test_statements():
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("pct", T.FloatType()),
         T.StructField("name", T.StringType())]
    )
    assert database.create_statement("req", schema, ["id"]) == (
        'CREATE TABLE IF NOT EXISTS "req" '
        '("id" bigint, "pct" real, "name" text, PRIMARY KEY ("id"))'
    )
    assert database.widen_statements("req", schema)[1] == (
        'ALTER TABLE "req" ADD COLUMN IF NOT EXISTS "pct" real'
    )
    assert database.upsert_statement("req", ["id", "pct"], ["id"], "?") == (
        'INSERT INTO "req" ("id", "pct") VALUES (?, ?) '
        'ON CONFLICT ("id") DO UPDATE SET "pct" = excluded."pct"'
    )
    assert database.upsert_statement("ops", ["operator"], ["operator"]).endswith(
        'ON CONFLICT ("operator") DO NOTHING'
    )


def test_rows_reach_the_database_in_chunks(spark, tmp_path):
    class Recorder:
        """Stands in for a connection; writes what it is sent to a file of its own."""

        def __init__(self, folder):
            import uuid

            self.file = f"{folder}/{uuid.uuid4().hex}"
            self.sent = []

        def cursor(self):
            return self

        def execute(self, statement):
            self.sent.append([statement, None])

        def executemany(self, statement, rows):
            self.sent.append([statement, rows])

        def commit(self):
            with open(self.file, "w") as out:
                json.dump(self.sent, out)

        def close(self):
            pass

    folder = str(tmp_path)
    rows = spark.range(10).select("id", (F.col("id") * 2).alias("value")).repartition(3)
    database.upsert(rows, lambda: Recorder(folder), "req", ["id"], chunk=2, connections=2)
    calls = [call for file in tmp_path.iterdir() for call in json.loads(file.read_text())]
    sent = [tuple(row) for statement, batch in calls for row in batch or []]
    assert sorted(sent) == [(i, 2 * i) for i in range(10)]
    assert max(len(batch) for _, batch in calls if batch) == 2
    assert any(statement.startswith("CREATE TABLE") for statement, _ in calls)
    senders = [f for f in tmp_path.iterdir() if any(batch for _, batch in json.loads(f.read_text()))]
    assert len(senders) <= 2


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert session.work_folder(spark, "x").startswith(f"{base}/x-")
    assert session.work_folder(spark, "x") != session.work_folder(spark, "x")


def test_seed_operators(spark):
    assert values(messages.seed_operators(spark)) == [("Bolt",), ("SMTUC",)]
