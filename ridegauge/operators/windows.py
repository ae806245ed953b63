"""Hourly windows over record time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridegauge.operators.keyed import known
from ridegauge.operators.running import SLICE_ROWS, running

HOUR = "1 hour"


def windowed_counts(df: DataFrame, key: str, ts: str = "ts", size: str = HOUR) -> DataFrame:
    """Rows per tumbling window and key: ``window_start, <key>, n``.

    Works on a table and on a stream; on a stream set the watermark first.
    """
    counted = known(df, key, ts).groupBy(F.window(ts, size).alias("w"), key)
    return counted.agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), key, "n"
    )


def without_late(
    df: DataFrame,
    key: str,
    ts: str = "ts",
    order: str = "seq",
    size: str = HOUR,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Rows whose window was still open when they arrived, without grace.

    Stream time is the largest ``ts`` of the key seen so far in ``order``; a window is closed
    once stream time reaches its end.
    """
    timed = running(
        known(df, key, ts), [key], order, {"_stream_time": ("max", ts)}, slice_rows=slice_rows
    )
    return timed.where(F.window(ts, size)["end"] > F.col("_stream_time")).drop("_stream_time")


def last_window(df: DataFrame, ts: str = "ts", unit: str = "hour") -> DataFrame:
    """Rows of the latest hour that holds a record.

    The bound is a scalar subquery on one column, so the scan of the other columns can skip
    everything older.
    """
    kind = df.schema[ts].dataType
    newest = df.agg(F.date_trunc(unit, F.max(ts)).cast(kind).alias("newest")).scalar()
    return df.where(F.col(ts) >= newest)
