"""Sums of 32-bit floats that do not depend on the order of the rows.

Adding doubles rounds at every step, so partitioning shows in the last bits and decides near ties.  Here
each value becomes a whole number of 2^-40 first, which is a function of the value alone (and exact for
percentages of 2^-17 and more); whole numbers add up to the same in any order.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(1 << 40)
_LARGEST = 1e15


def scaled(column: Column) -> Column:
    """Finite values as whole numbers, to be summed; null for infinite ones."""
    wide = column.cast("double")
    return F.when(F.abs(wide) < _LARGEST, (wide * _SCALE).cast("decimal(28,0)"))


def beyond(column: Column) -> Column:
    """What ``scaled`` leaves out; its largest stands for the whole sum."""
    wide = column.cast("double")
    return F.when(F.abs(wide) >= _LARGEST, wide)


def mean_of(total: Column, largest_beyond: Column, rows: Column) -> Column:
    """The mean as a 32-bit float from the sum of ``scaled`` values, the largest ``beyond`` and a count."""
    finite = total.cast("double") / _SCALE / rows.cast("double")
    return F.coalesce(largest_beyond, finite).cast("float")


def mean(column: Column) -> Column:
    """An aggregate: the mean of 32-bit floats; null without a value."""
    rows = F.count(column)
    return F.when(rows > 0, mean_of(F.sum(scaled(column)), F.max(beyond(column)), rows))
