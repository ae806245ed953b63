"""Rows of a stream in a folder per batch, each there once or not at all.

A batch counts once its mark is written, after its rows: one that fails half-way is not seen, and one
that is repeated is recognised.  The mark names the stream's run; a stream on a new checkpoint counts its
batches anew and would write everything again, so it gets an error and needs a folder of its own.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ridegauge.session import folders, mark, marked, note_of


@dataclass(frozen=True)
class BatchFolders:
    spark: SparkSession
    path: str

    def finished(self, run: str | None = None) -> list[int]:
        """The numbers of the batches that count; an error if ``run`` is given and not theirs."""
        found = {int(name): of for name, of in marked(self.spark, self.path).items()}
        others = set(found.values()) - {run}
        if run is not None and others:
            raise ValueError(f"{self.path} holds batches of run {others.pop()}, not of {run}")
        return sorted(found)

    def write(self, rows: DataFrame, batch: int, run: str, part: str | None = None) -> None:
        """Write a batch, in one folder per value of the boolean column ``part`` if that is named."""
        target, plain = f"{self.path}/{batch}", rows.drop(*filter(None, [part]))
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(part) if part else writer).parquet(target)
        if part:
            for empty in {f"{part}=false", f"{part}=true"} - set(folders(self.spark, target)):
                plain.limit(0).write.parquet(f"{target}/{empty}")
        mark(self.spark, target, run, plain.schema.jsonValue())

    def read(self, batches: list[int], part: str = "") -> DataFrame:
        """The rows of ``batches``; ``part`` names one folder of each, such as ``known=true``."""
        if not batches:
            raise ValueError(f"no batch has been written to {self.path} yet")
        schema = T.StructType.fromJson(note_of(self.spark, f"{self.path}/{batches[-1]}"))
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{batch}/{part}" for batch in batches))
