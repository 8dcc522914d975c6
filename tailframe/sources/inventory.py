"""Inventories of log files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailframe.functions.names import accepts, last_written, listing_hint


def discover_files(*pages: DataFrame) -> DataFrame:
    """The eligible files of all listing pages, with ``last_written``."""
    listed = reduce(DataFrame.unionByName, pages)
    return listed.where(accepts(F.col("engine"), F.col("log_file"))).withColumn("last_written", last_written(F.col("last_written_ms")))


def hinted(listing: DataFrame, engine: str) -> DataFrame:
    """Narrows a listing of one engine by its hint, which Spark pushes down to the files' scan."""
    hint = listing_hint(engine)
    return listing.where(F.contains("log_file", F.lit(hint))) if hint else listing


def list_directory(spark: SparkSession, path: str, instance_id: str, engine: str) -> DataFrame:
    """An inventory of the files below ``path``. Their contents are not read: that column is pruned from the scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = path.removeprefix("file://").rstrip("/") + "/"
    return files.select(
        F.lit(instance_id).alias("instance_id"),
        F.lit(engine).alias("engine"),
        F.regexp_replace(F.substring_index("path", root, -1), "^/+", "").alias("log_file"),
        F.col("length").alias("size"),
        F.unix_millis("modificationTime").alias("last_written_ms"),
    )


def skip_unchanged(inventory: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Leaves out files whose size and time are as checkpointed: nothing to fetch. An option; off, all are polled."""
    key = ["instance_id", "log_file"]
    seen = checkpoints.select(*key, F.col("file_size").alias("_size"), F.col("last_written").alias("_time"))
    same = F.col("size").eqNullSafe(F.col("_size")) & last_written(F.col("last_written_ms")).eqNullSafe(F.col("_time"))
    return inventory.join(seen, key, "left").where(~same).drop("_size", "_time")
