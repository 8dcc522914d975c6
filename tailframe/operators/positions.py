"""Where to resume each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tailframe.functions.batches import START, start_marker

KEY = ["instance_id", "log_file"]


def resolve_positions(inventory: DataFrame, checkpoints: DataFrame, start_from: str = "end") -> DataFrame:
    """Adds ``action`` (skip_to_end, beginning, reset, resume) and ``from_marker`` (null when skipping).

    A known file that is now smaller than checkpointed was truncated and starts over.
    """
    if start_from not in ("end", "beginning"):
        raise ValueError(start_from)
    known = checkpoints.select(*KEY, F.col("marker").alias("_marker"), F.col("file_size").alias("_size"), F.lit(True).alias("_known"))
    new = "skip_to_end" if start_from == "end" else "beginning"
    action = F.when(F.col("_known").isNull(), new).when(F.col("size") < F.col("_size"), "reset").otherwise("resume")
    marker = F.when(F.col("action") == "resume", start_marker(F.col("_marker"))).when(F.col("action") != "skip_to_end", START)
    return inventory.join(known, KEY, "left").withColumn("action", action).withColumn("from_marker", marker).drop("_marker", "_size", "_known")


def rotated_out(checkpoints: DataFrame, inventory: DataFrame) -> DataFrame:
    """Checkpoints of files that are no longer listed. They are kept."""
    return checkpoints.join(inventory.select(*KEY), KEY, "left_anti")


def truncations(polls: DataFrame, span: int = 4_096) -> DataFrame:
    """Adds ``prev_size``, ``truncated`` and ``generation``, the number of truncations of the file so far.

    Polls are compared within spans of ``poll_id`` first; of each span only its last size and its number of truncations go on to the
    next, so a file with a large part of all polls is spread over many tasks.
    """
    rows = polls.withColumn("_span", F.floor(F.col("poll_id") / span).cast("long"))
    inner = Window.partitionBy(*KEY, "_span").orderBy("poll_id")
    cut = lambda size, before: F.coalesce(size < before, F.lit(False)).cast("long")
    rows = rows.withColumns({"_prev": F.lag("size").over(inner), "_first": F.row_number().over(inner) == 1})
    rows = rows.withColumn("_inside", F.sum(cut(F.col("size"), F.col("_prev"))).over(inner))
    ends = rows.groupBy(*KEY, "_span").agg(F.min_by("size", "poll_id").alias("_head"), F.max_by("size", "poll_id").alias("_last"), F.max("_inside").alias("_cuts"))
    over = Window.partitionBy(*KEY).orderBy("_span")
    ends = ends.withColumn("_carried", F.lag("_last").over(over))
    ends = ends.withColumn("_edge", cut(F.col("_head"), F.col("_carried")))
    ends = ends.withColumn("_base", F.sum(F.col("_edge") + F.col("_cuts")).over(over) - F.col("_cuts"))
    both = rows.join(ends.select(*KEY, "_span", "_carried", "_base"), [*KEY, "_span"])
    prev = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_prev"))
    added = {"prev_size": prev, "truncated": cut(F.col("size"), prev).cast("boolean"), "generation": (F.col("_base") + F.col("_inside")).cast("int")}
    return both.withColumns(added).select(*polls.columns, *added)
