"""Session settings and the shared work folder."""

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Stream state on local disk with its changes in the checkpoint: keys never expire, so the state
# must not have to fit in memory.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    **STREAM_SETTINGS,
}


# Many small shuffle partitions that adaptive execution merges to an even size.  The number also
# fixes the state partitions of a stream at its first start.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build(app: str = "ridegauge", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``settings`` override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = (master or "").startswith("local")
    defaults = {**SETTINGS, "spark.ui.enabled": "false", **({} if local else CLUSTER_SETTINGS)}
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def _set_for_now(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stream_settings(spark: SparkSession):
    """The stream settings while a query starts; it keeps them, the session gets its own back."""
    return _set_for_now(spark, STREAM_SETTINGS)


def shuffles_dropped(spark: SparkSession):
    """While this is entered, a job's shuffle files go with its end, not when the driver collects its garbage.

    For steps whose results are written or collected: a table that is run again shuffles again.
    """
    return _set_for_now(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path for tables and stream checkpoints, in the folder ``spark.checkpoint.dir`` names.

    Without that setting a local session gets a temporary folder; a cluster gets an error,
    because a folder of one machine is lost with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ridegauge-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the work folder, for steps that read an expensive input repeatedly.

    Later steps start from the files, so a lost executor costs none of the work before them.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MARK = "_written_by_"


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def mark(spark: SparkSession, folder: str, run: str, note: object = None) -> None:
    """Note in ``folder`` that ``run`` has finished writing it, and what ``note`` (JSON) says of it."""
    files, place = _files(spark, f"{folder}/{_MARK}{run}")
    stream = files.create(place, True)
    stream.write(bytearray(json.dumps(note).encode()))
    stream.close()


def note_of(spark: SparkSession, folder: str) -> object:
    """The note on the mark of ``folder``."""
    files, marks = _files(spark, f"{folder}/{_MARK}*")
    stream = files.open(files.globStatus(marks)[0].getPath())
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def folders(spark: SparkSession, parent: str) -> list[str]:
    """The names of the folders ``<name>=<value>`` in ``parent``."""
    files, parts = _files(spark, f"{parent}/*=*")
    return sorted(found.getPath().getName() for found in files.globStatus(parts) or [])


def marked(spark: SparkSession, parent: str) -> dict[str, str]:
    """Names of the marked folders in ``parent``, and the run that wrote each."""
    files, marks = _files(spark, f"{parent}/*/{_MARK}*")
    paths = [found.getPath() for found in files.globStatus(marks) or []]
    return {path.getParent().getName(): path.getName().removeprefix(_MARK) for path in paths}


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder of written rows, if it is there."""
    files, place = _files(spark, folder)
    files.delete(place, True)
