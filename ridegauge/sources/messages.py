"""Routes, trips and operators from topics, message files and databases."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridegauge.functions.envelope import decode
from ridegauge.operators.keyed import known
from ridegauge.operators.ordering import MESSAGE_ORDER, positions
from ridegauge.schemas import OPERATOR, ROUTE, TRIP

# Topic names.
ROUTES_TOPIC = "routes-topic"
TRIPS_TOPIC = "trips-topic"
OPERATORS_TOPIC = "operators-from-db"

# The seed rows of the operator table.
SEED_OPERATORS = ("SMTUC", "Bolt")


def topic(spark: SparkSession, name: str, servers: str, stream: bool = False, **options: str) -> DataFrame:
    """Messages of a topic from its start: ``value, partition, offset, ts`` (needs the Kafka connector).

    A table read covers what the topic holds now.  An offset is a position in its partition only; see
    ``operators.ordering`` for one order over all partitions.
    """
    reader = spark.readStream if stream else spark.read
    settings = {"kafka.bootstrap.servers": servers, "subscribe": name,
                "startingOffsets": "earliest", **options}
    raw = reader.format("kafka").options(**settings).load()
    return raw.selectExpr("value", "partition", "offset", "timestamp AS ts")


def split(messages: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Every message that is not null, parsed once: its record's fields, and ``unreadable``.

    That is the message as text if none of the fields could be read from it, else null.  Position and
    time are kept; with ``strict`` a malformed message raises.
    """
    keep = tuple(c for c in ("seq", *MESSAGE_ORDER) if c in messages.columns)
    sent = messages.withColumnRenamed("value", "_sent").where(F.col("_sent").isNotNull())
    parsed = decode(sent, schema, "_sent", keep=(*keep, "_sent"), strict=strict)
    empty = F.coalesce(*(F.col(name).cast("string") for name in schema.fieldNames())).isNull()
    unread = F.when(empty, F.col("_sent").cast("string")).alias("unreadable")
    return parsed.select(*keep, *schema.fieldNames(), unread)


def records(
    messages: DataFrame, schema: T.StructType, key: str | None = None, strict: bool = False
) -> DataFrame:
    """Decoded messages with their position and time.

    Null messages, and those without any field of ``schema``, are left out (see ``unreadable``);
    with ``strict`` a malformed one raises.  Rows that lack a field are kept, as each report leaves
    out only what its own grouping needs; name a ``key`` to leave out rows without that field.
    """
    read = split(messages, schema, strict).where("unreadable IS NULL").drop("unreadable")
    return known(read, key) if key is not None else read


def unreadable(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The messages, as text, that are not null and that ``records`` leaves out, with position and time."""
    lost = split(messages, schema).where("unreadable IS NOT NULL").withColumnRenamed("unreadable", "value")
    return lost.select(*[c for c in messages.columns if c in ("value", "seq", *MESSAGE_ORDER)])


def _in_order(found: DataFrame) -> DataFrame:
    """Records of a table read with their position over all partitions; a stream keeps the parts of it."""
    return found if found.isStreaming else positions(found)


def routes(
    spark: SparkSession, servers: str, stream: bool = False, strict: bool = False, **options: str
) -> DataFrame:
    """Published routes; a table read returns what the topic holds now, numbered by ``seq``."""
    return _in_order(records(topic(spark, ROUTES_TOPIC, servers, stream, **options), ROUTE, strict=strict))


def trips(
    spark: SparkSession, servers: str, stream: bool = False, strict: bool = False, **options: str
) -> DataFrame:
    return _in_order(records(topic(spark, TRIPS_TOPIC, servers, stream, **options), TRIP, strict=strict))


def operators(
    spark: SparkSession, servers: str, stream: bool = False, strict: bool = False, **options: str
) -> DataFrame:
    return records(topic(spark, OPERATORS_TOPIC, servers, stream, **options), OPERATOR, strict=strict)


def message_files(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """One message per line in text files: ``value``."""
    return (spark.readStream if stream else spark.read).text(folder)


def operators_in_database(
    spark: SparkSession, url: str, query: str = "SELECT * FROM operators", **properties: str
) -> DataFrame:
    """The operator table as it is now; ``streaming.polling`` reads it again and again."""
    return spark.read.format("jdbc").options(url=url, query=query, **properties).load()


def seed_operators(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name,) for name in SEED_OPERATORS], "operator string")
