"""Payloads to lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailframe.functions.batches import batch_id
from tailframe.operators.checkpoints import running_sum


def split_lines(chunks: DataFrame) -> DataFrame:
    """One row per line: split at line feeds only, empty lines dropped, everything else kept as it is.

    A line that a chunk's end cuts is two lines. ``line_no`` is the line's place in its payload. A narrow
    operation: no shuffle, and only the columns used reach the scan.
    """
    others = [c for c in chunks.columns if c != "data"]
    lines = chunks.select(*others, F.posexplode(F.split("data", "\n", -1)).alias("line_no", "message"))
    return lines.where("message <> ''")


def numbered_lines(chunks: DataFrame, order: str = "chunk_no") -> DataFrame:
    """The lines of ``split_lines`` with ``place``, the line's number in its whole file.

    Lines are counted by chunk, counts are summed up along the file's chunks by spans, and each line adds its place in its chunk. The text
    is not shuffled for it by file, and no task holds a whole file.
    """
    key = ["instance_id", "log_file"]
    kept = F.filter(F.transform(F.split("data", "\n", -1), lambda x, k: F.struct(k.alias("line_no"), x.alias("message"))), lambda x: x["message"] != "")
    counts = running_sum(chunks.select(*key, order, F.size(kept).cast("long").alias("_n")), key, order, F.col("_n"))
    before = counts.select(*key, order, (F.col("running") - F.col("_n")).alias("_before"))
    others = [c for c in chunks.columns if c != "data"]
    lines = chunks.join(before, [*key, order]).select(*others, "_before", F.posexplode(kept).alias("_k", "_line"))
    return lines.select(*others, F.col("_line.line_no"), F.col("_line.message"), (F.col("_before") + F.col("_k") + 1).alias("place"))


def stamp(chunks: DataFrame) -> DataFrame:
    """Adds what every line of a chunk carries: the next marker, the batch id and the time of fetching."""
    stamped = {"marker": F.col("next_marker"), "batch_id": batch_id(F.col("instance_id"), F.col("log_file"), F.col("prev_marker"), F.col("next_marker"))}
    if "fetched_at" in chunks.columns:
        stamped["timestamp"] = F.col("fetched_at")
    return chunks.withColumns(stamped)


def records(chunks: DataFrame) -> DataFrame:
    """Chunks to stamped records."""
    return split_lines(stamp(chunks))
