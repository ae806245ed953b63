"""One order over several partitions."""

import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from ridegauge.operators.ordering import positions
from ridegauge.plans import state
from ridegauge.sources import messages
from ridegauge.functions.envelope import encode
from ridegauge.schemas import ROUTE


def log(spark, n, partitions=3):
    return spark.range(n).selectExpr(
        f"id AS value", f"timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, (id * 37) % 11) AS ts",
        f"CAST(id % {partitions} AS INT) AS partition", f"id div {partitions} AS offset",
    )


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
@pytest.mark.parametrize("tasks", [1, 7])
def test_positions_are_dense_and_in_order(spark, n, tasks):
    rows = log(spark, n).repartition(tasks)
    found = positions(rows)
    assert found.columns == [*rows.columns, "seq"]
    got = [(r.ts, r.partition, r.offset) for r in found.orderBy("seq").collect()]
    assert got == sorted(got) and len(got) == n
    assert sorted(r.seq for r in found.collect()) == list(range(n))


def test_equal_rows_and_nulls(spark):
    rows = spark.createDataFrame([(None,), (1,), (1,), (0,), (None,)], "at int")
    found = positions(rows, "at", name="place")
    assert [(r.place, r["at"]) for r in found.orderBy("place").collect()] == [(0, None), (1, None), (2, 0), (3, 1), (4, 1)]


def test_no_task_holds_all_rows(spark):
    found = positions(log(spark, 5000))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "RepartitionByExpression" not in plan  # the window is over counts


def test_records_of_a_topic_keep_their_partition(spark):
    at = datetime.datetime(2024, 1, 1)
    versions = [(1, 0, 5, at, 10), (1, 2, 4, at, 20), (1, 1, 9, at, 30), (2, 0, 6, at, 1)]
    rows = spark.createDataFrame(
        [(i, capacity, "a", "b", f"T{capacity}", "o") for i, _, _, _, capacity in versions], ROUTE
    )
    sent = encode(rows, "Route").withColumn("n", F.get_json_object("value", "$.payload.passengerCapacity").cast("int"))
    where = spark.createDataFrame([(c, p, o, t) for _, p, o, t, c in versions], "n int, partition int, offset long, ts timestamp")
    found = messages.records(sent.join(where, "n").drop("n", "key"), ROUTE)
    assert {"partition", "offset", "ts"} <= set(found.columns)
    latest = state.latest_routes(found, "transportType")
    assert values(latest.select("id", "transportType")) == [(1, "T20"), (2, "T1")]
    numbered = state.latest_routes(positions(found), "transportType")
    assert values(numbered.select("id", "transportType")) == [(1, "T20"), (2, "T1")]
