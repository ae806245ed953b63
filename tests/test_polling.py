"""Bulk sources that are read whole, poll after poll, and messages that are parsed once."""

import pytest
from conftest import values
from pyspark.sql import functions as F

import __spark_entry__ as registry
from ridegauge.functions.envelope import encode
from ridegauge.schemas import OPERATOR, TRIP
from ridegauge.sinks.keyed_table import KeyedTable
from ridegauge.sources import messages
from ridegauge.streaming import live, polling

SF = "/root/testdata/sf0.001"


def test_each_poll_reads_the_whole_table(spark, tmp_path):
    source, seen = str(tmp_path / "operators"), []
    table = KeyedTable(spark, str(tmp_path / "table"), ("operator",), OPERATOR)

    def read():
        return spark.read.schema(OPERATOR).parquet(source)

    def note(rows, number):
        seen.append((number, rows.count()))

    for names in (["A", "B"], ["C"], []):
        spark.createDataFrame([(n,) for n in names], OPERATOR).write.mode("append").parquet(source)
        polling.poll(spark, read, note, str(tmp_path / "counted")).awaitTermination()
        polling.poll_into(table, read, str(tmp_path / "checkpoint")).awaitTermination()
    assert seen == [(0, 2), (1, 3), (2, 3)]
    assert values(table.read()) == [("A",), ("B",), ("C",)]


def test_a_failed_poll_is_repeated(spark, tmp_path):
    seen = []

    def fail_once(rows, number):
        seen.append(number)
        if len(seen) == 2:
            raise RuntimeError("lost")

    checkpoint = str(tmp_path / "checkpoint")
    for lost in (False, True, False):
        query = polling.poll(spark, lambda: spark.range(1), fail_once, checkpoint)
        if lost:
            with pytest.raises(Exception, match="lost"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert seen == [0, 1, 1]


def test_polls_go_on(spark, tmp_path):
    seen = []
    query = polling.poll(spark, lambda: spark.range(2), lambda rows, n: seen.append(n), str(tmp_path / "c"), "100 milliseconds")
    try:
        for _ in range(100):
            if len(seen) > 2:
                break
            query.awaitTermination(0.2)
    finally:
        query.stop()
    assert seen[:3] == [0, 1, 2]


def test_messages_are_parsed_once(spark):
    found = registry.queries()["trips_from_messages"](spark, SF)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("from_json") >= 1
    sent = registry._trip_messages(spark, SF).count()
    read, lost = found.where("unreadable IS NULL").count(), found.where("unreadable IS NOT NULL").count()
    assert read + lost == sent and read and lost


def test_a_stream_of_messages_is_split(spark, tmp_path):
    rows = [(i, i % 3, None, None, 7, "Bus") for i in range(10)]
    good = encode(spark.createDataFrame(rows, TRIP), "Trip").select("value")
    bad = spark.createDataFrame([("{",), ("[]",), ('{"payload":{"other":1}}',)], "value string")
    sent, folder = str(tmp_path / "sent"), str(tmp_path / "split")
    for part in (good, bad, good.limit(1)):
        part.coalesce(1).write.mode("append").text(sent)
        live.split_messages(messages.message_files(spark, sent, stream=True), TRIP, folder).awaitTermination()
    assert live.split_records(spark, folder).count() == 11
    assert values(live.split_unreadable(spark, folder)) == sorted(values(bad), key=repr)
    assert values(messages.records(spark.read.text(sent), TRIP)) == values(live.split_records(spark, folder))
    assert values(messages.unreadable(spark.read.text(sent), TRIP)) == sorted(values(bad), key=repr)


def test_a_field_named_like_the_message(spark):
    sent = encode(spark.createDataFrame([(1, 5)], "id long, value long"), "Number").select("value", F.lit(3).alias("seq"))
    schema = spark.createDataFrame([], "id long, value long").schema
    assert values(messages.split(sent, schema)) == [(3, 1, 5, None)]
