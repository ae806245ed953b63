"""JSON messages that carry their own schema: ``{"schema": {...}, "payload": {...}}``."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridegauge.schemas import wire_type


def schema_literal(schema: T.StructType, name: str) -> Column:
    """The schema part of a message, a constant of the plan."""
    fields = [
        F.struct(
            F.lit(wire_type(field.dataType)).alias("type"),
            F.lit(False).alias("optional"),
            F.lit(field.name).alias("field"),
        )
        for field in schema.fields
    ]
    return F.struct(
        F.lit("struct").alias("type"),
        F.array(*fields).alias("fields"),
        F.lit(False).alias("optional"),
        F.lit(f"{name}_record").alias("name"),
    )


def encode(df: DataFrame, name: str, key: Column | None = None, envelope: bool = True) -> DataFrame:
    """Rows to ``key, value`` messages.  Null fields are left out of the payload.

    A row of nulls alone is what ``decode`` makes of a null message, and becomes one again.
    """
    payload = F.struct(*[F.col(c) for c in df.columns])
    body = payload
    if envelope:
        body = F.struct(schema_literal(df.schema, name).alias("schema"), payload.alias("payload"))
    key = F.lit(None).cast("string") if key is None else key.cast("string")
    some = reduce(Column.__or__, [F.col(c).isNotNull() for c in df.columns])
    return df.select(key.alias("key"), F.when(some, F.to_json(body)).alias("value"))


def decode(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    keep: tuple[str, ...] = (),
    envelope: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Messages to rows.  ``keep`` names columns of ``df`` to carry along.

    A null or malformed message becomes a row of nulls; with ``strict`` a malformed one raises.
    Fields that are missing from the payload are null.
    """
    wanted = T.StructType([T.StructField("payload", schema)]) if envelope else schema
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    parsed = df.select(*keep, F.from_json(F.col(value).cast("string"), wanted, mode).alias("_m"))
    return parsed.select(*keep, "_m.payload.*" if envelope else "_m.*")
