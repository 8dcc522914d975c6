"""Records to batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailframe.functions.batches import payload_bytes, record_of, record_struct
from tailframe.operators.checkpoints import running_sum
from tailframe.operators.lines import stamp

BATCH = ["instance_id", "engine", "log_file", "batch_id"]


def batch_sizes(records: DataFrame) -> DataFrame:
    """Records and message bytes of each batch. Combined before the shuffle; no text is moved."""
    return records.groupBy(*BATCH).agg(F.count("*").alias("n_records"), F.sum(payload_bytes(F.col("message"))).alias("batch_bytes"))


def assemble_batches(records: DataFrame) -> DataFrame:
    """One row a batch: its size, and its records in payload order as a JSON array.

    A batch is one chunk, about a megabyte, so collecting its records is bounded by how chunks are made.
    """
    rows = F.sort_array(F.collect_list(F.struct("line_no", record_struct().alias("record"))))
    grouped = records.groupBy(*BATCH).agg(F.count("*").alias("n_records"), F.sum(payload_bytes(F.col("message"))).alias("batch_bytes"), rows.alias("_rows"), F.min("timestamp").alias("timestamp"))
    return grouped.withColumn("payload", F.to_json(F.transform("_rows", lambda r: r["record"]))).drop("_rows")


def chunk_batches(chunks: DataFrame, *also: str) -> DataFrame:
    """The rows of ``assemble_batches`` straight from chunks, as a chunk is a batch: a narrow operation, without a shuffle, that streams can run.

    A chunk that is there twice makes two batches. ``also`` names further columns to keep. ``records`` holds each record's JSON, for sinks that write them line by line. Chunks without lines make no batch.
    """
    messages = F.filter(F.split("data", "\n", -1), lambda x: x != "")
    stamped = stamp(chunks).withColumn("_messages", messages)
    size = F.aggregate("_messages", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x))
    records = F.transform("_messages", lambda x: F.to_json(record_of(x)))
    made = stamped.where(F.size("_messages") > 0).withColumns({"n_records": F.size("_messages").cast("long"), "batch_bytes": size, "records": records})
    return made.select(*BATCH, *also, "n_records", "batch_bytes", "timestamp", F.concat(F.lit("["), F.array_join("records", ","), F.lit("]")).alias("payload"), "records")


def coalesce_batches(sizes: DataFrame, max_bytes: int, order: str = "chunk_no") -> DataFrame:
    """Adds ``bucket``: consecutive batches of a file up to about ``max_bytes`` share one. Optional, off by default."""
    rows = running_sum(sizes, ["instance_id", "log_file"], order, F.col("batch_bytes"))
    return rows.withColumn("bucket", F.floor((F.col("running") - F.col("batch_bytes")) / max_bytes).cast("long")).drop("running")
