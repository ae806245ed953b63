"""Column functions shared by the reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def available_seats(capacity: Column, passengers: Column) -> Column:
    """Seats left; negative when overbooked, the whole capacity when nobody travels."""
    return capacity - F.coalesce(passengers, F.lit(0))


def occupancy_pct(passengers: Column, seats: Column, full_as_zero: bool = True) -> Column:
    """Share of taken places in percent, rounded to 32-bit float after each step.

    A route without a free seat reports 0 unless ``full_as_zero`` is off; unknown seats always
    do.  Passengers on a capacity of zero report infinity; the guard is needed because ANSI mode
    raises on a zero denominator.
    """
    places = passengers + seats
    share = (passengers.cast("float") / places.cast("float")).cast("float")
    empty = seats == 0 if full_as_zero else (seats == 0) & (passengers == 0)
    return (
        F.when(seats.isNull() | empty, F.lit(0.0).cast("float"))
        .when(places == 0, F.lit(float("inf")).cast("float"))
        .otherwise((share * F.lit(100)).cast("float"))
    )


def whole_average(total: Column, parts: Column) -> Column:
    """``total / parts`` cut to a whole number."""
    return (total.cast("double") / parts.cast("double")).cast("bigint")
