"""Versioned positions: an append-only log in which the newest version of a key counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailframe.functions.batches import payload_bytes
from tailframe.storage import exists

KEY = ["instance_id", "log_file"]


def current_checkpoints(log: DataFrame) -> DataFrame:
    """The newest version of each key, without deleted keys. Partial maxima are taken before the shuffle."""
    row = F.struct(*(c for c in log.columns if c not in KEY))
    newest = log.groupBy(*KEY).agg(F.max_by(row, F.struct("updated_at", "seq")).alias("_v"))
    return newest.where("not coalesce(_v.deleted, false)").select(*KEY, "_v.*").drop("deleted")


def get_checkpoint(log: DataFrame, instance_id: str, log_file: str) -> DataFrame:
    """The position of one file, or no row. The key is filtered first, so that the scan can skip row groups."""
    return current_checkpoints(log.where((F.col("instance_id") == instance_id) & (F.col("log_file") == log_file)))


def list_checkpoints(log: DataFrame, instance_id: str) -> DataFrame:
    return current_checkpoints(log.where(F.col("instance_id") == instance_id))


def append_checkpoints(rows: DataFrame, path: str) -> None:
    """Sets positions: appends versions. Setting the same version again changes nothing."""
    rows.write.mode("append").parquet(path)


def tombstones(keys: DataFrame, updated_at, seq) -> DataFrame:
    """Versions that delete the given keys. Deleting a missing or deleted key changes nothing."""
    return keys.select(*KEY).distinct().withColumns({"updated_at": updated_at, "seq": seq, "deleted": F.lit(True)})


def compact(log: DataFrame, path: str) -> DataFrame:
    """One version a key, written to a new folder, for the caller to point readers at."""
    current_checkpoints(log).withColumn("deleted", F.lit(False)).write.parquet(path)
    return log.sparkSession.read.parquet(path)


def publish(log: DataFrame, root: str) -> DataFrame:
    """Compacts the log below ``root`` and makes that the version which ``published`` reads.

    The pointer is a table of folders, appended to after the folder is complete; a reader sees the old version or the new one, never half of either.
    """
    spark = log.sparkSession
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    compacted = compact(log, path)
    pointer = f"{root.rstrip('/')}/pointer"
    number = (spark.read.parquet(pointer).agg(F.max("number")).head()[0] or 0) + 1 if exists(spark, pointer) else 1
    spark.createDataFrame([(path, number)], "path string, number long").coalesce(1).write.mode("append").parquet(pointer)
    return compacted


def published(spark: SparkSession, root: str) -> DataFrame:
    """The latest published version."""
    path = spark.read.parquet(f"{root.rstrip('/')}/pointer").agg(F.max_by("path", "number")).head()[0]
    return spark.read.parquet(path)


def running_sum(rows: DataFrame, keys: list[str], order: str, value: Column, span: int = 4_096) -> DataFrame:
    """Adds ``running``: the sum of ``value`` up to each row, by the whole number ``order``.

    Sums of spans of ``order`` are added up first, then each span by itself, so a key with a large part of all rows is
    spread over many tasks.
    """
    spans = F.floor(F.col(order) / span).cast("long")
    rows = rows.withColumns({"_span": spans, "_value": value})
    upto = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy(*keys, "_span").agg(F.sum("_value").alias("_sum"))
    before = sums.select(*keys, "_span", (F.sum("_sum").over(upto) - F.col("_sum")).alias("_before"))
    within = F.sum("_value").over(Window.partitionBy(*keys, "_span").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(before, [*keys, "_span"]).withColumn("running", F.col("_before") + within).drop("_span", "_value", "_before")


def checkpoint_trail(drained: DataFrame, start_bytes: DataFrame | None = None) -> DataFrame:
    """A position after each drained chunk. ``bytes_written`` goes on counting from that of the resumed position."""
    light = drained.select(*KEY, "hop", "next_marker", payload_bytes(F.col("data")).alias("n_bytes"))
    rows, before = running_sum(light, KEY, "hop", F.col("n_bytes")), F.lit(0).cast("long")
    if start_bytes is not None:
        rows, before = rows.join(start_bytes.select(*KEY, F.col("bytes_written").alias("_start")), KEY, "left"), F.coalesce("_start", F.lit(0).cast("long"))
    return rows.select(*KEY, "hop", F.col("next_marker").alias("marker"), (before + F.col("running")).alias("bytes_written"))
