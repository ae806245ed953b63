"""The analytic test tables, read as routes and trips.

``part`` and ``lineitem`` give routes and trips: a part is a route with ``p_size`` places, a line
is a trip on it, the order of the line is the passenger.  ``events`` is a message log: a signup
publishes the route of that user and day, every other event is a trip on it.  Users publish a
route several times, travel on days without a publication, and the other way round.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared up front, which saves a job per read that would look into the files.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _named(prefix: str, number: str) -> F.Column:
    return F.concat(F.lit(prefix), F.expr(number).cast("string"))


def part_routes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").cast("bigint").alias("passengerCapacity"),
        F.col("p_name").alias("origin"),
        F.col("p_brand").alias("destination"),
        _named("T", "p_partkey % 25").alias("transportType"),
        F.col("p_type").alias("operator"),
        F.col("p_partkey").alias("seq"),
    )


def line_trips(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("id"),
        F.col("l_partkey").alias("routeId"),
        F.col("l_orderkey").alias("passengerId"),
        _named("T", "l_partkey % 25").alias("transportType"),
    )


def _event_route() -> F.Column:
    return F.expr("user_id * 100 + day(ts)")


def routes_of_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "signup").select(
        _event_route().alias("id"),
        F.expr("1 + event_id % 4").alias("passengerCapacity"),
        _named("T", "event_id % 5").alias("transportType"),
        _named("O", "event_id % 4").alias("operator"),
        F.col("event_id").alias("seq"),
        "ts",
    )


def trips_of_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") != "signup").select(
        F.col("event_id").alias("id"),
        _event_route().alias("routeId"),
        F.expr("event_id % 997").alias("passengerId"),
        _named("T", "user_id % 5").alias("transportType"),
        F.col("event_id").alias("seq"),
        "ts",
    )


def event_routes(spark: SparkSession, folder: str) -> DataFrame:
    return routes_of_events(table(spark, folder, "events"))


def event_trips(spark: SparkSession, folder: str) -> DataFrame:
    return trips_of_events(table(spark, folder, "events"))


def turns_of(rows: DataFrame, order: str, turns: int) -> Column:
    """Which of ``turns`` equal ranges of ``order`` holds the row, from 0."""
    lowest, highest = rows.agg(F.min(order), F.max(order)).first()
    step = ((highest or 0) - (lowest or 0)) // turns + 1
    return F.floor((F.col(order) - F.lit(lowest or 0)) / F.lit(step))


def over_partitions(records: DataFrame, partitions: int = 3) -> DataFrame:
    """``records`` as a topic of several partitions holds them: offsets repeat, and record times, which
    are whole hours here, do so in each partition.  What is left of ``seq`` is partition and offset.
    """
    return records.select(
        *[c for c in records.columns if c not in ("seq", "ts")],
        F.date_trunc("hour", "ts").alias("ts"),
        F.expr(f"CAST(seq % {partitions} AS INT)").alias("partition"),
        F.expr(f"seq div {partitions}").alias("offset"),
    )


def publications_of_events(events: DataFrame) -> DataFrame:
    """Each event as a publication in its hour, for the hourly reports."""
    return events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("transportType"),
        F.col("event_id").alias("seq"), "ts",
    )


def event_publications(spark: SparkSession, folder: str) -> DataFrame:
    return publications_of_events(table(spark, folder, "events"))


def order_publications(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as publications whose times are out of order, so that many arrive late."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("transportType"),
        F.col("o_orderkey").alias("seq"), F.col("o_orderdate").alias("ts"),
    )


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as a stream of its files, whether the table is one file or a folder of them.

    The braces make the path a pattern; a stream refuses the plain path of a single file.
    """
    log = spark.readStream.schema(SCHEMAS["events"]).parquet(f"{folder}/{{events}}.parquet")
    return log.withColumn("ts", F.col("ts").cast("timestamp"))
