"""Client messages: parsing and routing, batch or stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeframe.schemas import MESSAGE

# Message types of the client protocol.
INIT, FRAME, CLOSE = "init", "frame", "close"


def parse_messages(raw: DataFrame, column: str = "value", schema: T.StructType = MESSAGE) -> DataFrame:
    """JSON text to columns plus ``route``: init, frame, close, unknown, invalid.

    Only text that is no JSON object is invalid. A number written as text counts as
    that number; a value that can't be read as its column's type is null.
    """
    # simple values are read as text first, whatever JSON type they have
    simple = (T.NumericType, T.BooleanType)
    loose = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, simple) else f.dataType) for f in schema])
    parsed = raw.withColumn(
        "__m",
        F.from_json(column, loose, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}),
    )
    broken = F.col("__m").isNull() | F.col("__m._corrupt_record").isNotNull()
    kind = F.col("__m.type")
    route = (
        F.when(broken, "invalid")
        .when(kind.isin(INIT, FRAME, CLOSE), kind)
        .otherwise("unknown")
    )
    keep = [
        (F.col(f"__m.{f.name}").try_cast(f.dataType) if isinstance(f.dataType, simple) else F.col(f"__m.{f.name}")).alias(f.name)
        for f in schema
        if f.name != "_corrupt_record"
    ]
    rest = [c for c in raw.columns if c != column and c not in schema.fieldNames()]
    return parsed.select(*rest, route.alias("route"), *keep, F.col(column).alias("raw"))


def errors(routed: DataFrame) -> DataFrame:
    """One error row per message that cannot be handled; the stream goes on."""
    # What a client hears.
    text = F.when(F.col("route") == "invalid", "Invalid JSON message").otherwise(
        F.concat(F.lit("Unknown message type: "), F.coalesce("type", F.lit("null")))
    )
    return routed.filter(F.col("route").isin("invalid", "unknown")).select(
        *[c for c in routed.columns if c not in ("route", "raw")], "raw", text.alias("message")
    )


def sinks() -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Where a stream's messages go: frames, session messages (init, close), and errors with their line."""
    kept = ["route", "session_id", "frame_id", "window_size", "ts"]

    def of(*routes: str) -> Callable[[DataFrame], DataFrame]:
        return lambda routed: routed.filter(F.col("route").isin(*routes)).select(*kept, "payload")

    def bad(routed: DataFrame) -> DataFrame:
        told = errors(routed.withColumn("__route", F.col("route")))
        return told.select(F.col("__route").alias("route"), *kept[1:], "message", F.col("raw").alias("line"))

    return {"frames": of(FRAME), "sessions": of(INIT, CLOSE), "errors": bad}
