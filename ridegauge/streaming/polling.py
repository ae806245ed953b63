"""Tables that are read whole again and again, as a bulk connector does.

A stream that only counts serves as the clock: each of its micro-batches is one poll, which reads the
table through any batch reader (a database with its partitioned read, files) and hands on all rows.  The
reader runs on the executors as it always does.  A poll that fails is repeated with the same number,
so a consumer that knows batch numbers, such as a keyed table, takes each poll once; rows that
come unchanged in every poll are what its keys are for.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ridegauge.sinks.keyed_table import KeyedTable
from ridegauge.streaming.live import run_of


def poll(
    spark: SparkSession,
    read: Callable[[], DataFrame],
    then: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Call ``then(read(), number)`` each ``every`` (say ``60 seconds``), or without it once.

    Numbers go on from the checkpoint, from 0.
    """
    clock = spark.readStream.format("rate-micro-batch").options(rowsPerBatch=1, numPartitions=1).load()
    writer = clock.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda _, number: then(read(), number))
    return writer.trigger(**({"processingTime": every} if every else {"once": True})).start()


def poll_into(
    table: KeyedTable, read: Callable[[], DataFrame], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep ``table`` at the last row that any poll has read for each key."""

    def upsert(rows: DataFrame, number: int) -> None:
        table.upsert(rows, number, run_of(table.spark, checkpoint))

    return poll(table.spark, read, upsert, checkpoint, every)
