"""Following a file's chunks from marker to marker while more is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tailframe.storage import staged

KEY = ["instance_id", "log_file"]


def last_landed(chunks: DataFrame, order: str = "fetched_at") -> DataFrame:
    """Of pages that start at one marker, the one landed last: a walk must not fork, and keep-first could strand lines."""
    newest = Window.partitionBy(*KEY, "prev_marker").orderBy(F.desc(order), F.desc("next_marker"))
    return chunks.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def drain_by_ordinal(chunks: DataFrame, positions: DataFrame, ordinal: str = "chunk_no") -> DataFrame:
    """The chunks from each ``from_marker`` up to the first without pending data, with ``hop`` from 1.

    For tables that number a file's chunks consecutively. Two narrow scans find the first and the last number of each
    file; the third joins them to the chunks. There is no window, so a file with very many chunks burdens no single task:
    minima are combined before the shuffle, and the joins' large partitions can be split.
    """
    start = positions.select(*KEY, F.col("from_marker").alias("prev_marker"))
    first = chunks.select(*KEY, "prev_marker", ordinal).join(start, [*KEY, "prev_marker"]).groupBy(*KEY).agg(F.min(ordinal).alias("_first"))
    ends = chunks.where(~F.col("additional_pending")).select(*KEY, F.col(ordinal).alias("_end"))
    last = first.join(ends, KEY, "left").groupBy(*KEY, "_first").agg(F.min(F.when(F.col("_end") >= F.col("_first"), F.col("_end"))).alias("_last"))
    reached = chunks.join(last, KEY).where((F.col(ordinal) >= F.col("_first")) & (F.col("_last").isNull() | (F.col(ordinal) <= F.col("_last"))))
    return reached.withColumn("hop", (F.col(ordinal) - F.col("_first") + 1).cast("int")).drop("_first", "_last")


def drain_by_marker(chunks: DataFrame, positions: DataFrame, max_hops: int | None = None) -> DataFrame:
    """The same for opaque markers, by doubling: round r joins what is reached with pointers 2**r hops long.

    Of pages that start at one marker the one landed last counts, and only files with a position are looked at.
    As many rounds as the longest walk has binary digits, each a join on the marker; ``max_hops`` bounds walks
    that would otherwise run in circles; without it the number of chunks of the largest file does. Rounds are written to the shared folder.
    """
    files = positions.select(*KEY).distinct()
    if "fetched_at" in chunks.columns:
        # Only the page's key and markers are needed to find it; the join at the end brings its data.
        newest = F.max(F.struct("fetched_at", "next_marker")).alias("_newest")
        chosen = staged(chunks.join(files, KEY, "left_semi").groupBy(*KEY, "prev_marker").agg(newest), "walk-chosen")
        chunks = chunks.join(chosen, [*KEY, "prev_marker"]).where(F.struct("fetched_at", "next_marker").eqNullSafe(F.col("_newest"))).drop("_newest")
    else:
        chunks = chunks.join(files, KEY, "left_semi")
    nodes = chunks.select(*KEY, F.col("prev_marker").alias("at"), F.when(F.col("additional_pending"), F.col("next_marker")).alias("to"))
    nodes = staged(nodes.distinct(), "walk-nodes")
    if max_hops is None:
        max_hops = nodes.groupBy(*KEY).count().agg(F.max("count")).head()[0] or 0
    starts = positions.select(*KEY, F.col("from_marker").alias("at")).join(nodes.select(*KEY, "at"), [*KEY, "at"], "left_semi")
    reached = staged(starts.withColumn("hop", F.lit(1).cast("long")), "walk-reached")
    jumps, length = staged(nodes.where("`to` is not null").join(nodes.select(*KEY, F.col("at").alias("to")), [*KEY, "to"], "left_semi"), "walk-jumps"), 1
    while length <= max_hops:
        further = reached.join(jumps, [*KEY, "at"]).select(*KEY, F.col("to").alias("at"), (F.col("hop") + length).alias("hop")).where(F.col("hop") <= max_hops)
        further = staged(further, "walk-further")
        if further.isEmpty():
            break
        reached = reached.unionByName(further)
        onward = jumps.select(*KEY, F.col("at").alias("to"), F.col("to").alias("beyond"))
        jumps, length = staged(jumps.join(onward, [*KEY, "to"]).select(*KEY, "at", F.col("beyond").alias("to")), "walk-jumps"), 2 * length
    return chunks.join(reached.withColumnRenamed("at", "prev_marker"), [*KEY, "prev_marker"]).withColumn("hop", F.col("hop").cast("int"))


RECURSIVE = """
with recursive walk(instance_id, log_file, prev_marker, next_marker, additional_pending, hop) as (
  select c.instance_id, c.log_file, c.prev_marker, c.next_marker, c.additional_pending, 1
  from {chunks} c join {positions} p on c.instance_id = p.instance_id and c.log_file = p.log_file and c.prev_marker = p.from_marker
  union all
  select c.instance_id, c.log_file, c.prev_marker, c.next_marker, c.additional_pending, w.hop + 1
  from walk w join {chunks} c on c.instance_id = w.instance_id and c.log_file = w.log_file and c.prev_marker = w.next_marker
  where w.additional_pending and w.hop < {max_hops})
select * from walk
"""


def drain_recursive(chunks: DataFrame, positions: DataFrame, max_hops: int = 90) -> DataFrame:
    """The same as one recursive query, a join a hop, within Spark's limits on recursion.

    Walks that are not at their end after ``max_hops`` go on by doubling, unless they run in circles.
    """
    walked = staged(chunks.sparkSession.sql(RECURSIVE, chunks=chunks, positions=positions, max_hops=max_hops), "walk-recursive")
    longer = chunks.groupBy(*KEY).count().where(F.col("count") > max_hops).select(*KEY)
    cut = walked.where((F.col("hop") == max_hops) & F.col("additional_pending")).select(*KEY, F.col("next_marker").alias("from_marker"))
    cut = staged(cut.join(longer, KEY, "left_semi"), "walk-cut")
    if cut.isEmpty():
        return walked
    return walked.unionByName(drain_by_marker(chunks, cut).withColumn("hop", F.col("hop") + max_hops).select(*walked.columns))


def tail_markers(drained: DataFrame) -> DataFrame:
    """The last reachable marker of each file, where skipping to the end resumes, and the hops to it."""
    return drained.groupBy(*KEY).agg(F.max_by("next_marker", "hop").alias("tail_marker"), F.max("hop").alias("hops"))
