"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailframe.storage import new_dir as _new_dir
from tailframe.storage import scratch, shared_dir, staged, write

__all__ = ["bounded_sample", "let", "ranked", "scratch", "shared_dir", "staged", "staged_for_good", "table", "words", "write"]

#: Java character class of the white space that separates words.
SPACE = r"[\x20\x09-\x0D]"


def staged_for_good(df: DataFrame, name: str) -> DataFrame:
    """As ``staged``, but not removed at the end of a ``scratch`` block: what the block's result reads."""
    path = _new_dir(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once for each row, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Array of the maximal runs of non-space characters; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, chosen by a hash of ``key``: the same rows on every run.

    A table that is larger gives one row of each key chosen, the least by its other columns, so a key that repeats takes one place.
    """
    total = df.count()
    if total <= limit:
        return df
    share = int(0.95 * limit / total * (1 << 30))
    chosen = df.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < share)
    others = [c for c in df.columns if c != key]
    one = chosen.groupBy(key).agg(F.min(F.struct(*others)).alias("_one")).select(key, "_one.*") if others else chosen.distinct()
    return one.select(*df.columns).limit(limit)  # for the rare case that the hashes fall unevenly


def ranked(df: DataFrame, order: list[str | Column], group: list[str] = ()) -> DataFrame:  # type: ignore[assignment]
    """Adds ``rank``, the number of rows before each one in its ``group`` (columns without nulls), and ``of``, the rows of that group.

    Rows are dealt by ranges of (group, order) and sorted there, so no task holds a whole group; a range's first row in each group then starts at the
    number of the group's rows in the ranges before. The sort is written once, and so is fixed. ``order`` should tell rows apart: those that it doesn't stay in one task, in any order.
    """
    group = list(group)
    placed = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn("_at", F.monotonically_increasing_id())
    placed = staged(placed.withColumn("_part", F.shiftright("_at", 33)), "ranked")
    counts = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(*group)
    so_far = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    starts = staged(counts.select(*group, "_part", "_first", (F.sum("_n").over(so_far) - F.col("_n")).alias("_before"), F.sum("_n").over(whole).alias("of")), "rank-starts")
    return placed.join(starts, [*group, "_part"]).withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_first", "_before")
