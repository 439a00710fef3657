"""Payload encoding: JSON with Spark's built-in functions, Avro with Spark's own module."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offsetledger.schemas import PAYLOAD, PAYLOAD_AVRO


def decode_payload(value: Column, fmt: str = "json") -> Column:
    """Bytes to a `(uuid, timestamp)` struct, timestamp in epoch milliseconds.

    Undecodable bytes give a null struct or null fields, never an error.
    `fmt="avro"` needs the spark-avro package on the session.
    """
    if fmt == "json":
        return F.from_json(value.cast("string"), PAYLOAD)
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(value, PAYLOAD_AVRO, {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown payload format {fmt!r}")


def encode_payload(uuid: Column, millis: Column, fmt: str = "json") -> Column:
    """`(uuid, timestamp)` to bytes."""
    fields = F.struct(uuid.alias("uuid"), millis.alias("timestamp"))
    if fmt == "json":
        return F.to_json(fields).cast("binary")
    if fmt == "avro":
        from pyspark.sql.avro.functions import to_avro

        return F.when(uuid.isNotNull() & millis.isNotNull(), to_avro(fields, PAYLOAD_AVRO))
    raise ValueError(f"unknown payload format {fmt!r}")


def malformed_reason(value: Column, uuid: Column, timestamp: Column) -> Column:
    """Why a message cannot be used; null when it can."""
    return (
        F.when(value.isNull(), "null value")
        .when(uuid.isNull() & timestamp.isNull(), "undecodable")
        .when(uuid.isNull(), "no uuid")
        .when(timestamp.isNull(), "no timestamp")
    )
