"""A log of rows in files that takes each batch once, written by tasks and committed by the driver.

Tasks write their rows to files that nobody reads yet.  Once all have, the driver commits: one entry that
names the batch, the stream's run and the files.  A failed batch leaves no entry and its files go; a
batch that is repeated after its commit finds the entry and drops the new files.  So a reader, who
takes the files that entries name, sees every batch whole and once.  A stream of another run, whose
batch numbers mean other batches, gets an error.

``path`` is a folder that all machines share, as a plain path or as a URI that Arrow's file systems know.
"""

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

FORMAT = "message_log"

# Workers get the classes themselves, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str, run: str):
        self.path, self.run = path, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        """One file per task, if it has rows; on the executors."""
        files, base = _place(self.path)
        name, writer = f"data/{uuid.uuid4().hex}.parquet", None
        for batch in iterator:
            if batch.num_rows:
                if writer is None:
                    files.create_dir(f"{base}/data", recursive=True)
                    writer = pq.ParquetWriter(files.open_output_stream(f"{base}/{name}"), batch.schema)
                writer.write_batch(batch)
        if writer is None:
            return _Written([])
        writer.close()
        return _Written([name])

    def commit(self, messages: list[_Written | None], batchId: int) -> None:
        """On the driver, once all tasks have written."""
        files, base = _place(self.path)
        entry = f"{base}/commits/{batchId}.json"
        if files.get_file_info(entry).type != fs.FileType.NotFound:
            with files.open_input_stream(entry) as known:
                run = json.loads(known.read())["run"]
            if run != self.run:
                raise ValueError(f"{self.path} holds batches of run {run}, not of {self.run}")
            self.abort(messages, batchId)
            return
        files.create_dir(f"{base}/commits", recursive=True)
        names = [name for message in messages if message for name in message.files]
        staged = f"{base}/commits/_{batchId}-{uuid.uuid4().hex}"
        with files.open_output_stream(staged) as out:
            out.write(json.dumps({"batch": batchId, "run": self.run, "files": names}).encode())
        files.move(staged, entry)

    def abort(self, messages: list[_Written | None], batchId: int) -> None:
        files, base = _place(self.path)
        for message in messages:
            for name in message.files if message else ():
                files.delete_file(f"{base}/{name}")


class MessageLog(DataSource):
    """``writeStream.format("message_log")`` with the options ``path`` and ``run``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], self.options.get("run", "only"))


def write_log(
    rows: DataFrame, path: str, checkpoint: str, run: str = "only", mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Write a stream to the log.  ``run`` names the stream; keep it while the checkpoint is kept."""
    rows.sparkSession.dataSource.register(MessageLog)
    writer = rows.writeStream.format(FORMAT).options(path=path, run=run, checkpointLocation=checkpoint).outputMode(mode)
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches.  The driver sees the names of their files only."""
    entry = "batch long, run string, files array<string>"
    entries = spark.read.schema(entry).option("pathGlobFilter", "*.json").json(f"{path}/commits")
    names = [row["name"] for row in entries.select(F.explode("files").alias("name")).toLocalIterator()]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{name}" for name in names))
