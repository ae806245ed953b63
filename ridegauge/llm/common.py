"""Small helpers that several text operators share."""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space as all contracts here mean it: space and the five ASCII control characters that
# ``bytes.split()`` without an argument also splits on.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str) -> Column:
    """A text column without nulls."""
    return F.coalesce(F.col(text), F.lit(""))


def in_batches(
    rows: DataFrame, function: Callable[..., pa.RecordBatch], schema: str, *columns: Column
) -> DataFrame:
    """``function`` on the named columns of each Arrow batch, as a table of ``schema``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(*batch.columns)

    return rows.select(*columns).mapInArrow(run, schema)


def unused(name: str, rows: DataFrame) -> str:
    """``name``, with underscores at its end until no column of ``rows`` has it."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_text(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The ``chosen`` labels (``of`` and others) with the text of their document.

    An id that comes several times gives one row, its smallest text, so a bound on labels bounds the rows.
    ``chosen`` has to be bounded (see ``sampled_labels``): it is broadcast, so that the other texts stay where they are.
    """
    ids = F.broadcast(chosen.select("of").distinct())
    own = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("of"), "left_semi")
    texts = own.groupBy("doc_id").agg(F.min("text").alias("text"))
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))


def sampled_labels(labels: DataFrame, at_most: int, *needed: str) -> DataFrame:
    """Up to ``at_most`` labelled ids in an order that has nothing to do with the labels.

    ``at_most`` bounds what a classifier is fitted on and what its driver holds.  Rows without an
    id or without one of the ``needed`` labels teach nothing.
    """
    known = labels.select("doc_id", *needed).dropna().dropDuplicates()
    return known.orderBy(F.xxhash64("doc_id"), *known.columns).limit(at_most)
