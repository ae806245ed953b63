"""Messages to topics (needs the Kafka connector on the class path)."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def write_topic(messages: DataFrame, topic: str, servers: str) -> None:
    """Write a table of ``key, value`` messages to a topic."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    messages.write.format("kafka").options(**options).save()


def stream_topic(
    messages: DataFrame, topic: str, servers: str, checkpoint: str, mode: str = "update"
) -> DataStreamWriter:
    """A stream of ``key, value`` messages to a topic, ready to start."""
    options = {
        "kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint,
    }
    return messages.writeStream.format("kafka").options(**options).outputMode(mode)
