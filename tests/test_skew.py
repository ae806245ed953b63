"""Keys cut into ranges: same results as plain windows, and plans without dangerous steps."""

import pytest
from conftest import values
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as registry
from ridegauge.operators.running import _ranges, records, running

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on key 0, many copies of one row among them."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40)
    return spark.range(600).select(
        key.cast("bigint").alias("key"), F.col("id").alias("seq"),
        (F.col("id") * 7919 % 101).alias("v"),
    ).repartition(5).cache()


def test_no_range_holds_more_than_its_rows(spark):
    """Positions in two distant bands, as a partition number in the high bits makes them."""
    band = F.when(F.col("id") < 5000, 0).otherwise(F.lit(1 << 40))
    rows = spark.range(10_000).select((band + F.col("id")).alias("seq"), F.col("id").alias("v"))
    largest = _ranges(rows, "seq", 100).groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert largest <= 100
    last = running(rows, [], "seq", {"n": ("count", "v")}, slice_rows=100).agg(F.max("n")).first()[0]
    assert last == 10_000


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("slice_rows", [4, 64, 1 << 20])
def test_running_equals_a_window(facts, keys, slice_rows):
    plain = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    expected = facts.select(
        "key", "seq", "v", F.count("v").over(plain).alias("n"), F.sum("v").over(plain).alias("s"),
        F.max("v").over(plain).alias("hi"), F.min("v").over(plain).alias("lo"),
    )
    aggs = {"n": ("count", "v"), "s": ("sum", "v"), "hi": ("max", "v"), "lo": ("min", "v")}
    assert values(running(facts, keys, "seq", aggs, slice_rows=slice_rows)) == values(expected)


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("lowest", [False, True])
def test_records(facts, keys, lowest):
    before = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    best = (F.min if lowest else F.max)("v").over(before)
    beats = F.col("v") < F.col("b") if lowest else F.col("v") > F.col("b")
    expected = facts.withColumn("b", best).where(F.col("b").isNull() | beats).drop("b")
    for slice_rows in (5, 1 << 20):
        got = records(facts, keys, "seq", "v", lowest, slice_rows=slice_rows)
        assert values(got) == values(expected)


def test_attach_drops_unknown_keys(spark, facts):
    dim = spark.range(0, 3).select(F.col("id").alias("key"), (F.col("id") * 10).alias("w"))
    for slice_rows in (6, 1 << 20):
        got = running(facts, ["key"], "seq", {"n": ("count", "v")}, attach=dim, slice_rows=slice_rows)
        assert {row["key"] for row in got.collect()} == {0, 1, 2}
        assert got.where(F.col("w") != F.col("key") * 10).count() == 0
        assert got.agg(F.max("n")).first()[0] == facts.where("key = 0").count()


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(registry.STATE_QUERIES) + sorted(registry.CHANGELOG_QUERIES))
def test_plans(spark, name):
    """No cross join, no Python, no window over everything, in any batch query."""
    plan = plan_of(registry.queries()[name](spark, SF))
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert step not in plan
    assert "CollectLimit" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(registry.queries()["passengers_per_route"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint>" in plan
    plan = plan_of(registry.queries()["busiest_transport_type_changelog"](spark, SF))
    assert "Not(EqualTo(event_type,signup))" in plan


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("passengers_per_route", 1),
        ("occupancy_per_route", 1),  # routes and trips in one grouping
        ("avg_passengers_per_type", 1),
        ("max_occupancy_per_operator", 3),  # trips and routes by route, then by operator
        ("total_passengers", 0),
        ("busiest_transport_type_changelog", 0),
    ],
)
def test_shuffles(spark, name, shuffles):
    """Hash exchanges of the plan when nothing is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.queries()[name](spark, SF)
        physical = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert physical.count("Exchange hashpartitioning") == shuffles


def test_one_shuffle_moves_the_numbered_trips(spark):
    """Joining the routes on, carrying ranges in and numbering share one exchange of the trips."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.queries()["occupancy_updates"](spark, SF)
        physical = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    window = physical.index("Window ")
    join = physical.index("SortMergeJoin", window)
    assert "Exchange" not in physical[window:join]


def test_enriching_writes_no_table_while_planning(spark, monkeypatch):
    from ridegauge import session

    def fail(*_):
        raise AssertionError("a table was written")

    monkeypatch.setattr(session, "work_folder", fail)
    assert "_slice" not in plan_of(registry.queries()["trips_enriched"](spark, SF))
