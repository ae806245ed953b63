"""Record types of the input topics and of the reports."""

from pyspark.sql import types as T


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _TEXT, _FLOAT = T.LongType(), T.StringType(), T.FloatType()

# Field names and types of the messages.
ROUTE = _record(id=_LONG, passengerCapacity=_LONG, origin=_TEXT, destination=_TEXT,
                transportType=_TEXT, operator=_TEXT)
TRIP = _record(id=_LONG, routeId=_LONG, origin=_TEXT, destination=_TEXT,
               passengerId=_LONG, transportType=_TEXT)
OPERATOR = _record(operator=_TEXT)
NUMBER = _record(id=_LONG, value=_LONG)
NAME_NUMBER = _record(id=_TEXT, value=_LONG)
NAME_VALUE = _record(id=_TEXT, value=_TEXT)
ROUTE_OCCUPANCY = _record(routeId=_LONG, occupancyPercentage=_FLOAT)
ROUTE_OCCUPANCY_NAMED = _record(routeId=_LONG, name=_TEXT, occupancyPercentage=_FLOAT)

# What a topic holds of a record.
MESSAGE = _record(key=_TEXT, value=_TEXT)

# Position and record time of a message, which travel beside its fields.
SEQ = T.StructField("seq", T.LongType())
TS = T.StructField("ts", T.TimestampType())

# Names that the message schema gives to field types.
WIRE_TYPES = {
    T.StringType(): "string",
    T.IntegerType(): "int32",
    T.LongType(): "int64",
    T.FloatType(): "float",
    T.DoubleType(): "double",
    T.BooleanType(): "boolean",
}


def wire_type(kind: T.DataType) -> str:
    """Name of a field type in a message schema; types without a name of their own are strings."""
    return WIRE_TYPES.get(kind, "string")
