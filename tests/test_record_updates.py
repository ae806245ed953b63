"""Streams that give a row for each record, over several micro-batches."""

import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from ridegauge.streaming import live, updates

LOG = "turn int, seq long, id long, routeId long, passengerCapacity long"


def occupancy(spark, rows, turns):
    log = spark.createDataFrame(rows, LOG)

    def start(stream, folder):
        return updates.follow_occupancy(
            stream.where("id IS NOT NULL OR (routeId IS NULL AND passengerCapacity IS NOT NULL)").select("id", "passengerCapacity", "seq"),
            stream.where("id IS NULL AND passengerCapacity IS NULL").select("routeId", "seq"), folder,
        )

    found = updates.occupancy_updates(spark, live.in_turns(log, F.col("turn"), turns, start))
    return [(r.seq, r.routeId, r.passengers, r.capacity) for r in found.orderBy("seq").collect()]


def test_one_update_per_record(spark):
    rows = [
        (0, 1, 7, None, 2), (0, 3, None, 7, None), (0, 2, None, 7, None), (0, 4, None, 8, None),
        (1, 6, None, 7, None), (1, 5, 8, None, 5), (1, 7, None, None, None), (1, 8, None, None, 4),
        (2, 9, None, 8, None), (2, 10, 7, None, 10), (2, 11, 9, None, 3), (2, 12, 8, None, None),
    ]
    assert occupancy(spark, rows, 3) == [
        (2, 7, 1, 2), (3, 7, 2, 2), (5, 8, 1, 5), (6, 7, 3, 2), (9, 8, 2, 5), (10, 7, 3, 12)
    ]


def test_a_later_batch_counts_as_later(spark):
    rows = [(1, 1, None, 7, None), (0, 2, 7, None, 4), (0, 3, None, 7, None)]
    assert sorted(occupancy(spark, rows, 2), key=lambda r: r[2]) == [(3, 7, 1, 4), (1, 7, 2, 4)]


def test_a_batch_that_failed_half_way_is_repeated(spark, monkeypatch):
    """The updates of the second batch are there, its state is not; the run that takes over adds each once."""
    rows = [(0, 1, 7, None, 4), (0, 2, None, 7, None), (1, 3, None, 7, None), (2, 4, None, 7, None)]
    upsert, failed = updates.KeyedTable.upsert, []

    def lose(self, rows, batch, run="only"):
        if batch == 1 and not failed:
            failed.append(batch)
            raise RuntimeError("lost")
        upsert(self, rows, batch, run)

    monkeypatch.setattr(updates.KeyedTable, "upsert", lose)
    start = updates.follow_occupancy

    def twice(*given):
        query = start(*given)
        try:
            query.awaitTermination()
            return query
        except Exception:
            return start(*given)

    monkeypatch.setattr(updates, "follow_occupancy", twice)
    assert occupancy(spark, rows, 3) == [(2, 7, 1, 4), (3, 7, 2, 4), (4, 7, 3, 4)] and failed


@pytest.mark.parametrize("turns", [1, 4])
def test_time_moves_with_each_record(spark, turns):
    minutes = {"Bus": [10, 65, 50, 80, 20, 125, 119, 121], "Taxi": [130, 10, 140, 119]}
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (i % turns if turns == 1 else i // 2, i, kind, start + datetime.timedelta(minutes=m))
        for kind, times in minutes.items() for i, m in enumerate(times)
    ]
    rows += [(0, 99, None, start), (0, 100, "Bus", None)]
    log = spark.createDataFrame(rows, "turn int, seq long, transportType string, ts timestamp")
    found = live.append_in_turns(log, F.col("turn"), turns, updates.in_open_hour)
    expected = []
    for kind, times in minutes.items():
        now = 0
        for i, m in enumerate(times):
            now = max(now, m)
            if m - m % 60 + 60 > now:
                expected.append((kind, i, start + datetime.timedelta(minutes=m - m % 60)))
    assert values(found.select("transportType", "seq", "hour")) == sorted(expected, key=repr)


def test_order_by_time_partition_and_offset(spark):
    at = datetime.datetime(2024, 1, 1)
    rows = [(1, 2, 0, at, 1), (1, 0, 9, at, 2), (1, 1, 3, at, 4), (1, 0, 8, at, 8)]
    log = spark.createDataFrame(rows, "routeId long, partition int, offset long, ts timestamp, n long")
    log = log.withColumn("id", F.when(F.col("n") == 8, 1)).withColumn("passengerCapacity", F.lit(5).cast("long"))

    def start(stream, folder):
        routes = stream.where("id IS NOT NULL").select("id", "passengerCapacity", "ts", "partition", "offset")
        trips = stream.where("id IS NULL").select("routeId", "ts", "partition", "offset")
        return updates.follow_occupancy(routes, trips, folder)

    found = updates.occupancy_updates(spark, live.in_turns(log, F.lit(0), 1, start))
    assert values(found.select("passengers", "partition", "offset")) == [(1, 0, 9), (2, 1, 3), (3, 2, 0)]
