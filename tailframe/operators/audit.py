"""Proof of delivery: what is missing, what came twice."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: What identifies a line. A truncated file may repeat batch ids for new lines, hence the generation.
LINE = ["instance_id", "log_file", "batch_id", "line_no"]


def _key(df: DataFrame) -> list[str]:
    return [*LINE, "generation"] if "generation" in df.columns else LINE


def missing_lines(source: DataFrame, delivered: DataFrame) -> DataFrame:
    """Source lines that were never delivered. Empty means at least once."""
    return source.join(delivered.select(*_key(source)), _key(source), "left_anti")


def dedupe_lines(delivered: DataFrame) -> DataFrame:
    """Each line once. Equal messages of one batch are different lines, so the message is no part of the key."""
    return delivered.dropDuplicates(_key(delivered))
