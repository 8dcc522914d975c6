"""Markers, batch ids, destinations, headers and encodings of a batch or a record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

START = "0"
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def start_marker(marker: Column) -> Column:
    """The marker to ask for: an empty one means the start of the file."""
    return F.coalesce(F.nullif(marker, F.lit("")), F.lit(START))


def batch_id(instance: Column, log_file: Column, prev_marker: Column, next_marker: Column) -> Column:
    """16 hexadecimal digits that depend on nothing but where the chunk lies. Empty and null markers are alike."""
    parts = [F.coalesce(c, F.lit("")) for c in (instance, log_file, prev_marker, next_marker)]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def payload_bytes(data: Column) -> Column:
    return F.coalesce(F.octet_length(data), F.lit(0)).cast("long")


def record_json(timestamp: str = "timestamp") -> Column:
    """The record as JSON. Empty markers and batch ids are left out."""
    return F.to_json(record_struct(timestamp))


def record_struct(timestamp: str = "timestamp") -> Column:
    return record_of(F.col("message"), timestamp)


def record_of(message: Column, timestamp: str = "timestamp") -> Column:
    """A record with the given message."""
    return F.struct(
        "instance_id",
        "engine",
        "log_file",
        F.date_format(timestamp, JSON_TIME).alias("timestamp"),
        message.alias("message"),
        F.nullif(F.col("marker"), F.lit("")).alias("marker"),
        F.nullif(F.col("batch_id"), F.lit("")).alias("batch_id"),
    )


def object_key(prefix: str, instance: Column, engine: Column, base: Column, timestamp: Column, batch: Column) -> Column:
    """``prefix/instance/engine/base/yyyy/MM/dd/millis-batch.ndjson.gz``; names that are empty get stand-ins."""
    return F.concat_ws(
        "/",
        *([F.lit(prefix.removesuffix("/"))] if prefix.removesuffix("/") else []),
        F.replace(instance, F.lit("/"), F.lit("_")),
        F.coalesce(F.nullif(engine, F.lit("")), F.lit("unknown")),
        F.coalesce(F.nullif(base, F.lit("")), F.lit("log")),
        F.date_format(timestamp, "yyyy/MM/dd"),
        F.concat(F.unix_millis(timestamp).cast("string"), F.lit("-"), batch, F.lit(".ndjson.gz")),
    )


def kafka_key(instance: Column, log_file: Column) -> Column:
    return F.concat_ws("|", instance, log_file)


def kafka_topic(topic: str, template: str, engine: Column, instance: Column) -> Column:
    """A fixed topic wins; else ``{engine}`` and ``{instance}`` in the template are filled in."""
    if topic:
        return F.lit(topic)
    return F.replace(F.replace(F.lit(template), F.lit("{engine}"), engine), F.lit("{instance}"), instance)


def kafka_headers() -> Column:
    """array<struct<key, value>> of who and which batch a record is from."""
    pairs = (("batch-id", "batch_id"), ("instance-id", "instance_id"), ("log-file", "log_file"), ("engine", "engine"))
    return F.array(*(F.struct(F.lit(k).alias("key"), F.encode(F.coalesce(F.col(c), F.lit("")), "UTF-8").alias("value")) for k, c in pairs))


def identity_headers(own: dict[str, str] | None = None, gzip: bool = False) -> Column:
    """HTTP headers of a batch. The user's own headers override the built-in ones, whatever their case."""
    built_in = {"Content-Type": F.lit("application/json"), "X-Batch-Id": F.col("batch_id"), "X-Instance-Id": F.col("instance_id"), "X-Log-File": F.col("log_file")}
    if gzip:
        built_in["Content-Encoding"] = F.lit("gzip")
    taken = {k.lower() for k in own or {}}
    headers = {k: v for k, v in built_in.items() if k.lower() not in taken} | {k: F.lit(v) for k, v in (own or {}).items()}
    return F.map_from_arrays(F.array(*(F.lit(k) for k in headers)), F.array(*(F.coalesce(v, F.lit("")) for v in headers.values())))


def classify_status(status: Column) -> Column:
    """ok, permanent or transient: only 4xx is permanent, and all but 2xx and 4xx may be tried again."""
    return F.when(status.between(200, 299), "ok").when(status.between(400, 499), "permanent").otherwise("transient")
