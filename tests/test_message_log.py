"""A log that takes each batch once."""

import json

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridegauge.sinks import message_log

SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())])


@pytest.fixture
def send(spark, tmp_path):
    """Adds rows to a stream's folder and runs the stream over what is new."""
    sent = str(tmp_path / "sent")

    def run(*rows, path="log", checkpoint="checkpoint", change=None, **options):
        if rows:
            spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(sent)
        stream = spark.readStream.schema(SCHEMA).parquet(sent)
        stream = change(stream) if change else stream
        message_log.write_log(stream, str(tmp_path / path), str(tmp_path / checkpoint), **options).awaitTermination()
        return values(message_log.read_log(spark, str(tmp_path / path), SCHEMA))

    return run


def test_batches_add_up(send):
    assert send(("a", 1), ("b", 2)) == [("a", 1), ("b", 2)]
    assert send(("c", None)) == [("a", 1), ("b", 2), ("c", None)]
    assert send() == [("a", 1), ("b", 2), ("c", None)]


def test_a_failed_batch_leaves_one_copy(send, tmp_path):
    def lose(rows):
        return rows.withColumn("value", F.when(F.col("key") == "e", F.raise_error(F.lit("lost"))).otherwise(F.col("value")))

    assert send(("a", 1)) == [("a", 1)]
    with pytest.raises(Exception, match="lost"):
        send(*((k, 1) for k in "bcdef"), change=lose)
    assert sorted(p.name for p in (tmp_path / "log/commits").iterdir()) == ["0.json"]
    assert send() == [(k, 1) for k in "abcdef"]


def test_a_repeated_batch_leaves_one_copy(send, tmp_path):
    """The stream dies after the log's commit and before it has noted the batch itself."""
    send(("a", 1))
    first = send(("b", 2), ("c", 3))
    files = len(list((tmp_path / "log/data").iterdir()))
    for note in (tmp_path / "checkpoint/commits").iterdir():
        if note.name.strip(".").startswith("1"):
            note.rename(tmp_path / f"noted-{note.name}")
    assert send() == first == [("a", 1), ("b", 2), ("c", 3)]
    assert len(list((tmp_path / "log/data").iterdir())) == files
    assert json.loads((tmp_path / "log/commits/1.json").read_text())["batch"] == 1


def test_another_run_is_refused(send):
    send(("a", 1), run="x")
    with pytest.raises(Exception, match="holds batches of run x"):
        send(checkpoint="other", run="y")
    assert send(run="x") == [("a", 1)]


def test_an_empty_log(spark, send):
    assert send(change=lambda rows: rows.where("key = 'none'"), *[("a", 1)]) == []
