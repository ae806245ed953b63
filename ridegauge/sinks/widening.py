"""One schema for rows that were written at different times, with columns that came later or grew wider."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# From narrow to wide; a type gives way to any that follows it in its line.
_LINES = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DecimalType(38, 0)),
    (T.FloatType(), T.DoubleType()),
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType()),
)


def wider(a: T.DataType, b: T.DataType, name: str) -> T.DataType:
    """The type that holds all values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for line in _LINES:
        if a in line and b in line:
            return max(a, b, key=line.index)
    raise ValueError(f"column {name}: {a.simpleString()} and {b.simpleString()} have no common type")


def merged(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of ``schemas``, in order of their first appearance, each as wide as it ever was."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            kind = found.get(field.name, field.dataType)
            found[field.name] = wider(kind, field.dataType, field.name)
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


def as_schema(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with the columns of ``schema``; null where they lack one."""
    own = set(rows.columns)
    return rows.select(
        *((F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema)
    )
