"""Reports over streams.

A stream keeps one keyed state up to date and writes what changed to a keyed table; the reports
of ``plans.reports`` run on these tables as they do on any other.  The state functions of
``plans.state`` are used as they are: on a stream they are update-mode aggregates.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ridegauge.operators.keyed import known
from ridegauge.operators.ordering import MESSAGE_ORDER
from ridegauge.operators.windows import HOUR, windowed_counts
from ridegauge.plans.reports import most_used_type_per_hour
from ridegauge.plans.suite import STATES
from ridegauge.session import stream_settings, work_folder
from ridegauge.sinks.batches import BatchFolders
from ridegauge.sinks.keyed_table import KeyedTable
from ridegauge.sources.messages import split


def hourly_updates(routes: DataFrame, ts: str = "ts") -> DataFrame:
    """Hourly counts per type on a stream, without grace for late records."""
    return windowed_counts(routes.withWatermark(ts, "0 seconds"), "transportType", ts)


def hourly_leaders(routes: DataFrame, ts: str = "ts") -> DataFrame:
    """The most used type of each closed hour, as an append-mode stream.

    ``current_hourly_leaders`` gives the open hour too.
    """
    counted = (
        routes.withWatermark(ts, "0 seconds")
        .groupBy(F.window(ts, HOUR).alias("w"), "transportType")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    leader = F.min_by(F.struct("transportType", "n"), F.struct(-F.col("n"), F.col("transportType")))
    per_hour = counted.groupBy(F.window(F.window_time("w"), HOUR).alias("hour")).agg(leader.alias("top"))
    return per_hour.select(
        F.col("hour.start").alias("window_start"),
        F.col("top.transportType").alias("id"),
        F.col("top.n").alias("value"),
    )


def keyed_table(spark: SparkSession, updates: DataFrame, path: str, *keys: str) -> KeyedTable:
    """The table that will hold the state of ``updates``."""
    return KeyedTable(spark, path, keys, updates.schema)


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the stream that a checkpoint belongs to; a new checkpoint has a new one."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def enrich(
    trips: DataFrame, latest: Callable[[], DataFrame], folder: str, *attributes: str, every: str | None = None
) -> StreamingQuery:
    """Write a stream of trips with attributes of their route; ``enriched`` reads them.

    ``latest()`` is the route table.  It is asked anew for each batch, so a trip meets the route as
    the table holds it when the trip comes in.  A trip on a route that is not there yet is held back:
    each batch asks for the routes of all trips held so far, and a trip comes out once, in the batch
    that finds its route (``held_back`` reads the others).  A batch counts once its mark is
    written: one that fails half-way is not seen, and one that is repeated does nothing.  A stream on a new
    checkpoint would send all trips again, so it needs a folder of its own and gets an error.
    """
    spark = trips.sparkSession
    bare = known(trips.drop(*attributes), "routeId")
    checkpoint = f"{folder}/checkpoint"

    def apply(rows: DataFrame, batch: int) -> None:
        run = run_of(spark, checkpoint)
        done = kept.finished(run)
        if batch in done:
            return
        if done:
            rows = rows.unionByName(kept.read(done[-1:], "known=false").select(*rows.columns))
        route = latest().select(F.col("id").alias("routeId"), *attributes, F.lit(True).alias("known"))
        met = rows.join(route, "routeId", "left").fillna(False, ["known"])
        kept.write(met, batch, run, part="known")

    kept = BatchFolders(spark, f"{folder}/rows")
    writer = bare.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return writer.trigger(**trigger_of(every)).start()


def split_messages(
    messages: DataFrame, schema: T.StructType, folder: str, every: str | None = None
) -> StreamingQuery:
    """Write a stream of messages as records and, beside them, those that cannot be read, parsing each once.

    ``split_records`` and ``split_unreadable`` read them; a batch counts once both are written.
    """
    spark, checkpoint, kept = messages.sparkSession, f"{folder}/checkpoint", BatchFolders(messages.sparkSession, f"{folder}/rows")

    def apply(rows: DataFrame, batch: int) -> None:
        run = run_of(spark, checkpoint)
        if batch not in kept.finished(run):
            kept.write(rows.withColumn("readable", F.col("unreadable").isNull()), batch, run, part="readable")

    writer = split(messages, schema).writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return writer.trigger(**trigger_of(every)).start()


def split_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records that ``split_messages`` has written."""
    kept = BatchFolders(spark, f"{folder}/rows")
    return kept.read(kept.finished(), "readable=true").drop("unreadable")


def split_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """The messages that ``split_messages`` could not read, as text in ``unreadable``."""
    kept = BatchFolders(spark, f"{folder}/rows")
    read = kept.read(kept.finished(), "readable=false")
    return read.select(*[c for c in ("seq", *MESSAGE_ORDER) if c in read.columns], "unreadable")


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    """The trips that ``enrich`` has written so far, each with the attributes of its route."""
    kept = BatchFolders(spark, f"{folder}/rows")
    return kept.read(kept.finished(), "known=true")


def held_back(spark: SparkSession, folder: str) -> DataFrame:
    """The trips that ``enrich`` holds until their route comes."""
    kept = BatchFolders(spark, f"{folder}/rows")
    return kept.read(kept.finished()[-1:], "known=false")


def trigger_of(every: str | None) -> dict[str, str | bool]:
    return {"processingTime": every} if every else {"availableNow": True}


def maintain(
    updates: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    every: str | None = None,
    then: Callable[[KeyedTable, int], None] | None = None,
) -> StreamingQuery:
    """Keep ``table`` equal to the state of ``updates``.

    Runs each ``every`` (say ``1 minute``), or without it once over all that is there now.
    ``then(table, batch)`` follows each batch, to write reports on the table elsewhere; a batch
    that is repeated after a failure repeats it too.  A stream on a new checkpoint needs a new table.
    """

    def apply(rows: DataFrame, batch: int) -> None:
        table.upsert(rows, batch, run_of(rows.sparkSession, checkpoint))
        if then:
            then(table, batch)

    writer = (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
    )
    with stream_settings(updates.sparkSession):
        return writer.trigger(**trigger_of(every)).start()


def grouped_table(spark: SparkSession, updates: DataFrame, path: str, group: str, *keys: str, **options) -> KeyedTable:
    """The table that will hold the state of ``updates``, in buckets by ``group``, one of its keys."""
    return KeyedTable(spark, path, (group, *keys), updates.schema, cluster=(group,), **options)


def maintain_groups(
    updates: DataFrame,
    table: KeyedTable,
    derived: KeyedTable,
    report: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Keep ``table`` equal to the state of ``updates`` and ``derived`` to ``report`` on its groups.

    ``report`` gives one row per group, such as its leader, and ``derived`` has the group as its key.
    After each batch it runs on the groups that the batch touched, and reads their buckets only, so the
    report of a group that is still growing follows every batch, at a cost that goes with the batch.
    """
    group = derived.keys

    def follow(kept: KeyedTable, batch: int) -> None:
        changed = kept.rows_of(batch).select(*group).distinct()
        current = kept.read_like(changed).join(changed, list(group), "left_semi")
        derived.upsert(report(current), batch, run_of(kept.spark, checkpoint))

    return maintain(updates, table, checkpoint, every, follow)


def in_parts(updates: DataFrame, key: str, parts: int = 64) -> DataFrame:
    """``updates`` with ``part``, a group of keys, for a leader over all keys: see ``partial_leaders``."""
    return updates.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))


def partial_leaders(updates: DataFrame, key: str, report: Callable[[DataFrame], DataFrame]) -> tuple[KeyedTable, KeyedTable]:
    """Run ``updates`` over all that is there now; the state, and ``report`` on each part of its keys.

    A leader over all keys is the leader of at most as many rows as there are parts, and after a batch
    only the parts it touched are looked at again.
    """
    spark = updates.sparkSession
    parted, folder = in_parts(updates, key), work_folder(updates.sparkSession, "leaders")
    kept = grouped_table(spark, parted, f"{folder}/state", "part", key)
    led = T.StructType([T.StructField("part", T.IntegerType())])
    leaders = KeyedTable(spark, f"{folder}/leaders", ("part",), led)
    maintain_groups(parted, kept, leaders, report, f"{folder}/checkpoint").awaitTermination()
    return kept, leaders


def current_hourly_leaders(updates: DataFrame) -> KeyedTable:
    """The most used type of every hour, the open one included, from ``hourly_updates``."""
    spark, folder = updates.sparkSession, work_folder(updates.sparkSession, "hourly")
    counts = grouped_table(spark, updates, f"{folder}/counts", "window_start", "transportType")
    schema = most_used_type_per_hour(spark.createDataFrame([], updates.schema)).schema
    leaders = KeyedTable(spark, f"{folder}/leaders", ("window_start",), schema)
    maintain_groups(updates, counts, leaders, most_used_type_per_hour, f"{folder}/checkpoint").awaitTermination()
    return leaders


def catch_up(updates: DataFrame, *keys: str) -> KeyedTable:
    """Run ``updates`` over all that is there now, into a fresh table in the work folder."""
    spark = updates.sparkSession
    folder = work_folder(spark, "stream")
    table = keyed_table(spark, updates, f"{folder}/table", *keys)
    maintain(updates, table, f"{folder}/checkpoint").awaitTermination()
    return table


def live_states(
    routes: DataFrame, trips: DataFrame, folder: str, every: str | None = None
) -> tuple[dict[str, KeyedTable], list[StreamingQuery]]:
    """Start one stream per state; ``folder`` holds the tables and checkpoints.

    Read the tables into ``plans.suite.States`` for the reports as of now.  ``routes`` needs the
    record time ``ts``, which bounds how long an hour stays open.
    """
    timed = routes.withWatermark("ts", "0 seconds")
    tables, running = {}, []
    for name, (build, keys) in STATES.items():
        updates = build(timed if name == "hourly" else routes, trips)
        tables[name] = keyed_table(updates.sparkSession, updates, f"{folder}/{name}/table", *keys)
        running.append(maintain(updates, tables[name], f"{folder}/{name}/checkpoint", every))
    return tables, running


def append_all(rows: DataFrame) -> DataFrame:
    """Run an append-mode stream over all that is there now, into files in the work folder."""
    folder = work_folder(rows.sparkSession, "stream")
    writer = rows.writeStream.outputMode("append").format("parquet")
    writer = writer.option("checkpointLocation", f"{folder}/checkpoint")
    with stream_settings(rows.sparkSession):
        query = writer.trigger(availableNow=True).start(f"{folder}/rows")
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/rows")


def in_turns(
    rows: DataFrame, turn: Column, turns: int, start: Callable[[DataFrame, str], StreamingQuery]
) -> str:
    """Run a stream that gets ``rows`` in several micro-batches, one a ``turn`` from 0; the folder it has.

    The rows of a turn are written where the stream reads, then ``start(stream, folder)`` goes on from the
    checkpoint that it keeps in the folder.
    """
    spark, folder = rows.sparkSession, work_folder(rows.sparkSession, "turns")
    rows.limit(0).write.parquet(f"{folder}/log")  # a stream needs its folder
    for number in range(turns):
        rows.where(turn == number).write.mode("append").parquet(f"{folder}/log")
        start(spark.readStream.schema(rows.schema).parquet(f"{folder}/log"), folder).awaitTermination()
    return folder


def append_in_turns(
    rows: DataFrame, turn: Column, turns: int, build: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What ``build`` makes of a stream that gets ``rows`` in turns, as files."""
    spark = rows.sparkSession

    def start(stream: DataFrame, folder: str) -> StreamingQuery:
        writer = build(stream).writeStream.outputMode("append").format("parquet")
        writer = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
        with stream_settings(spark):
            return writer.start(f"{folder}/rows")

    return spark.read.parquet(f"{in_turns(rows, turn, turns, start)}/rows")
