"""One order over messages of several partitions.

An offset is a position in its partition only.  All messages are put in order by record time, then by
partition and offset, which tells any two apart; ``positions`` numbers that order without a gap, as
``operators.running`` and the reports on updates need it.  The rows are exchanged by ranges of the
order and sorted inside each range; one count a range then says where its numbers start.  No task
sees more than its range, and what is broadcast is one row a range, however many rows there are.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridegauge.session import written

MESSAGE_ORDER = ("ts", "partition", "offset")

_BITS = 33  # where monotonically_increasing_id keeps the row's place, below its partition


def order_of(rows: DataFrame) -> tuple[str, ...]:
    """The columns that order messages: their position if they have one, else time, partition, offset."""
    return ("seq",) if "seq" in rows.columns else MESSAGE_ORDER


def order_key(rows: DataFrame) -> Column:
    """The same as one comparable value, for aggregates that pick the last message; works on streams."""
    order = order_of(rows)
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def positions(rows: DataFrame, *order: str, name: str = "seq") -> DataFrame:
    """``rows`` with ``name``, from 0: the place of the row in ``order`` (by default that of messages).

    Rows that are equal in ``order`` get different places, in any order; nulls come first.  The numbered
    rows are written once, so every later read sees the same places.
    """
    order = order or MESSAGE_ORDER
    place = f"{name}_place"
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = written(ranged.withColumn(place, F.monotonically_increasing_id()), "positions")
    part, inside = F.shiftright(place, _BITS), F.col(place).bitwiseAND(F.lit((1 << _BITS) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    met = kept.join(F.broadcast(starts), part == F.col("part"))
    return met.select(*rows.columns, (F.col("start") + inside).alias(name))
