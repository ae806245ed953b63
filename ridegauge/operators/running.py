"""Running aggregates in message order, computed in parallel inside a key.

A window over a whole key puts that key into one task.  Here the order column is cut into ranges
of ``slice_rows`` positions; each key is aggregated inside each range, the results of the ranges
before it are carried in, and the window only runs inside a range.  Positions are unique, so no
window holds more than ``slice_rows`` rows, however large the key and wherever its rows lie.  The
input is read twice.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 1 << 20

_INSIDE = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
_ACROSS = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, carried: Column, inside: Column) -> Column:
    if kind == "max":
        return F.greatest(carried, inside)
    if kind == "min":
        return F.least(carried, inside)
    return F.coalesce(carried + inside, carried, inside)


def _ranges(rows: DataFrame, order: str, slice_rows: int) -> DataFrame:
    """``rows`` with ``_slice``, the range of ``slice_rows`` positions that holds the row."""
    return rows.withColumn("_slice", F.floor(F.col(order) / slice_rows))


def _carried(
    rows: DataFrame, keys: list[str], aggs: dict[str, tuple[str, str]]
) -> DataFrame:
    """One row per key and range: the aggregates of all ranges before it (null in the first)."""
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = rows.groupBy(*keys, "_slice").agg(
        *[_INSIDE[kind](column).alias(f"_part_{name}") for name, (kind, column) in aggs.items()]
    )
    return parts.select(
        *keys,
        "_slice",
        *[
            _ACROSS[kind](f"_part_{name}").over(before).alias(f"_carry_{name}")
            for name, (kind, _) in aggs.items()
        ],
    )


def running(
    rows: DataFrame,
    keys: list[str],
    order: str,
    aggs: dict[str, tuple[str, str]],
    attach: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add running aggregates to ``rows``, per ``keys`` (or over all rows) in ``order``.

    ``aggs`` maps a new column to ``(kind, column)`` with kind count, sum, max or min.  ``order``
    is a unique number such as a message position.  ``attach`` holds one row per key; its columns
    are joined on in the same shuffle, and rows of other keys are dropped.
    """
    columns = rows.columns
    sliced = _ranges(rows, order, slice_rows)
    side = _carried(sliced, keys, aggs)
    carries = [f"_carry_{name}" for name in aggs]
    on = [*keys, "_slice"]
    extra = []
    if attach is not None:
        extra = [c for c in attach.columns if c not in keys]
        side = attach.join(side, keys)
    joined = sliced.join(side, on, "left" if attach is None else "inner")
    inside = Window.partitionBy(*on).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *columns,
        *extra,
        *[
            _combine(kind, F.col(carry), _INSIDE[kind](column).over(inside)).alias(name)
            for (name, (kind, column)), carry in zip(aggs.items(), carries, strict=True)
        ],
    )


def records(
    rows: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    lowest: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Rows whose ``value`` beats every earlier one of the key.

    Rows that do not beat the ranges before theirs are dropped first; of the whole input few rows
    are left to be put in order.
    """
    kind = "min" if lowest else "max"
    sliced = _ranges(rows, order, slice_rows)
    side = _carried(sliced, keys, {"best": (kind, value)})

    def beats(best: str) -> Column:
        better = F.col(value) < F.col(best) if lowest else F.col(value) > F.col(best)
        return F.col(best).isNull() | better

    on = [*keys, "_slice"]
    hopeful = sliced.join(side, on, "left").where(beats("_carry_best"))
    before = Window.partitionBy(*on).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    best_before = _INSIDE[kind](value).over(before)
    led = hopeful.withColumn("_best", best_before).where(beats("_best"))
    return led.select(*rows.columns)
