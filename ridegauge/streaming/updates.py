"""Updates of a stream, one for each input record.

An update-mode aggregate says what a key's state is after a micro-batch; what it was after each record
in between is lost.  Here each record gives its own row, in the order of ``seq`` (or of time, partition
and offset) within each micro-batch.  What comes in a later micro-batch counts as later, as it does for a
consumer of the topic.

Sums are carried as ``operators.running`` carries them: a micro-batch is numbered in parallel inside each
key, and the state before it, a keyed table, is added.  So a key with most of a batch is many tasks'
work, and nothing runs per key.  What is no sum, such as a stream time, is carried by
``applyInPandasWithState``; there a task holds the numbers of one key's records of a micro-batch while it
sorts them, which a source's trigger limit bounds.
"""

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ridegauge.functions.occupancy import available_seats, occupancy_pct
from ridegauge.operators.keyed import known
from ridegauge.operators.ordering import order_of, positions
from ridegauge.operators.running import running
from ridegauge.session import written
from ridegauge.sinks.batches import BatchFolders
from ridegauge.sinks.keyed_table import KeyedTable
from ridegauge.streaming.live import run_of, trigger_of

_HOUR = 3_600_000_000  # microseconds
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _stateful(
    rows: DataFrame,
    key: str,
    order: tuple[str, ...],
    step: Callable[[Any, pd.DataFrame], tuple[tuple, pd.DataFrame]],
    output: str,
    state: str,
) -> DataFrame:
    """``step(state, records)`` on the sorted records of each key and micro-batch.

    ``step`` gets the key's state, or None, and returns the next state and the rows to give out.
    """

    def run(_: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        records = pd.concat(parts).sort_values(list(order), kind="stable")
        after, given = step(held.get if held.exists else None, records)
        held.update(after)
        if len(given):
            yield given

    return rows.groupBy(key).applyInPandasWithState(run, output, state, "append", GroupStateTimeout.NoTimeout)


def follow_occupancy(
    routes: DataFrame, trips: DataFrame, folder: str, every: str | None = None
) -> StreamingQuery:
    """Write every occupancy that streams of publications and trips report; ``occupancy_updates`` reads them.

    A trip adds a passenger, a publication adds its capacity; each reports the route's occupancy after it,
    as soon as the route is both published and travelled.  Trips ahead of the first publication count and
    show in its report.  Publications come before trips of the same position.  Records without a route are
    left out, and so are publications without a capacity.  Both streams need the same order columns.

    A batch first writes its updates and then the state; either is recognised when it is repeated, and
    as the state comes last, updates are always computed from the state before their batch.
    """
    spark, checkpoint, order = routes.sparkSession, f"{folder}/checkpoint", order_of(routes)
    none = F.lit(None).cast("bigint")
    published = known(routes, "id", "passengerCapacity").select(
        F.col("id").alias("routeId"), *order, F.col("passengerCapacity").alias("places"), none.alias("trip")
    )
    travelled = known(trips, "routeId").select("routeId", *order, none.alias("places"), F.lit(1).cast("bigint").alias("trip"))
    kept, state = BatchFolders(spark, f"{folder}/updates"), occupancy_state(spark, folder)

    def apply(rows: DataFrame, batch: int) -> None:
        run = run_of(spark, checkpoint)
        rows = written(rows, "records")
        totals = rows.groupBy("routeId").agg(
            F.sum("places").alias("more_capacity"), F.count("places").alias("more_publications"),
            F.count("trip").alias("more_passengers"),
        )
        names = ("capacity", "publications", "passengers")
        before = totals.join(state.read_like(rows), "routeId", "left").select(
            "routeId", *(F.coalesce(name, F.lit(0)).alias(name) for name in names),
            *(F.coalesce(f"more_{name}", F.lit(0)).alias(f"more_{name}") for name in names),
        )
        before = written(before, "before")
        if batch not in kept.finished(run):
            numbered = _numbered(rows, order)
            sums = {"new_capacity": ("sum", "places"), "new_publications": ("count", "places"), "new_passengers": ("count", "trip")}
            grown = running(numbered, ["routeId"], "place", sums, attach=before.select("routeId", *names))
            after = {name: F.col(name) + F.coalesce(f"new_{name}", F.lit(0)) for name in names}
            given = grown.select("routeId", *order, *(column.alias(name) for name, column in after.items()))
            given = given.where("publications > 0 AND passengers > 0").drop("publications")
            seats = available_seats(F.col("capacity"), F.col("passengers"))
            pct = occupancy_pct(F.col("passengers"), seats)
            kept.write(given.withColumn("occupancyPercentage", pct), batch, run)
        added = before.select("routeId", *((F.col(name) + F.col(f"more_{name}")).alias(name) for name in names))
        state.upsert(added, batch, run)

    writer = published.unionByName(travelled).writeStream.option("checkpointLocation", checkpoint)
    return writer.foreachBatch(apply).trigger(**trigger_of(every)).start()


def _numbered(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``rows`` with ``place``, their number in ``order``, publications before trips."""
    if order == ("seq",):
        return rows.withColumn("place", F.col("seq") * 2 + F.coalesce("trip", F.lit(0)))
    return positions(rows.withColumn("kind", F.coalesce("trip", F.lit(0))), *order, "kind", name="place").drop("kind")


def occupancy_state(spark: SparkSession, folder: str) -> KeyedTable:
    """``routeId, capacity, publications, passengers`` as ``follow_occupancy`` keeps them."""
    return KeyedTable(
        spark, f"{folder}/state", ("routeId",),
        T.StructType([T.StructField(name, T.LongType()) for name in ("routeId", "capacity", "publications", "passengers")]),
    )


def occupancy_updates(spark: SparkSession, folder: str) -> DataFrame:
    """``routeId, <order>, capacity, passengers, occupancyPercentage``, a row per record."""
    kept = BatchFolders(spark, f"{folder}/updates")
    return kept.read(kept.finished())


def in_open_hour(routes: DataFrame, key: str = "transportType", ts: str = "ts") -> DataFrame:
    """Records that came while their hour was open, without grace: ``<key>, <order>, hour``.

    Stream time is the largest ``ts`` of the key so far, the record's own included, and an hour is closed
    once stream time reaches its end.  Unlike a watermark, it moves with each record of the key and not
    between micro-batches, and one key's time closes no hour of another.  Records without key or time
    are left out.
    """
    order = order_of(routes)
    kinds = {c: routes.schema[c].dataType.simpleString() for c in order}
    plain = isinstance(routes.schema[ts].dataType, T.TimestampNTZType)
    at = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), F.col(ts)) if plain else F.unix_micros(ts)
    rows = known(routes, key, ts).select(key, *order, at.alias("at"))

    def step(before: tuple | None, records: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        times = records["at"].to_numpy(np.int64)
        now = np.maximum.accumulate(times)
        if before is not None:
            now = np.maximum(now, before[0])
        hours = times - times % _HOUR
        kept = hours + _HOUR > now
        return (int(now[-1]),), records[[key, *order]].assign(hour=hours)[kept]

    kind = routes.schema[key].dataType.simpleString()
    output = f"`{key}` {kind}, " + ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", hour long"
    given = _stateful(rows, key, order, step, output, "time long")
    hour = F.expr(f"{_EPOCH} + make_dt_interval(0, 0, 0, hour / 1000000)") if plain else F.timestamp_micros("hour")
    return given.withColumn("hour", hour)
