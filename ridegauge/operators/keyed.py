"""Per-key picks: latest version, leader by a measure.

All of them are aggregates with map-side combine; none sorts or windows a whole key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose grouping keys are all set; a grouped stream skips the others."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def latest_by(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key by ``order``.  Select the columns you need first."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order) if len(order) > 1 else F.col(order[0]))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def first_by(df: DataFrame, keys: list[str], columns: list[Column], rank: list[Column]) -> DataFrame:
    """``columns`` of the row with the smallest ``rank`` in each key (in all rows without keys).

    To lead by the largest value, rank by its negation.  No input rows, no output rows.
    """
    best = F.min_by(F.struct(*columns), F.struct(*rank)).alias("_row")
    grouped = df.groupBy(*keys).agg(best)
    return grouped.where(F.col("_row").isNotNull()).select(*keys, "_row.*")
