"""One poll from end to end: inventory, positions, pages, lines, delivery, dead letters, positions again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailframe.functions.batches import START
from tailframe.functions.names import last_written
from tailframe.operators.batches import assemble_batches
from tailframe.operators.checkpoints import checkpoint_trail, current_checkpoints
from tailframe.operators.delivery import advance, retry_outcome, route_dlq, settle, with_parked, with_payload
from tailframe.operators.lines import records
from tailframe.operators.positions import KEY, resolve_positions
from tailframe.operators.walk import drain_by_marker, tail_markers
from tailframe.schemas import CHECKPOINT
from tailframe.sources.inventory import discover_files
from tailframe.sources.sinks import Sink, deliver
from tailframe.storage import staged


@dataclass(frozen=True)
class Poll:
    """What a poll did: the attempts made, dead letters with their payloads (to be appended by ``dlq_put``), and versions of positions."""

    attempts: DataFrame
    dead: DataFrame
    positions: DataFrame


def poll_once(inventory: DataFrame, log: DataFrame, chunks: DataFrame, sinks: dict[str, tuple[str, Sink]], now: Column, start_from: str = "end", park: bool = True, drain: Callable[[DataFrame, DataFrame], DataFrame] = drain_by_marker, max_attempts: int = 10) -> Poll:
    """Delivers what is new in each listed file and says where to go on.

    A file's position moves chunk by chunk up to the first that some sink has neither taken nor, with ``park``, parked. Of new files that are read from
    their end on, the end is stored, so that the next poll delivers what was added. Append ``dead`` first, then ``positions``: a crash between repeats
    deliveries and loses none.
    """
    files = staged(discover_files(inventory), "poll-files")
    known = staged(current_checkpoints(log), "poll-known")
    wanted = staged(resolve_positions(files, known, start_from), "poll-wanted")
    tails = tail_markers(drain(chunks, wanted.where("action = 'skip_to_end'").withColumn("from_marker", F.lit(START))))
    drained = staged(drain(chunks, wanted.where("from_marker is not null").select(*KEY, "from_marker")), "poll-drained")
    batches = staged(assemble_batches(records(drained)), "poll-batches")
    attempts = deliver(batches, sinks)
    outcomes = staged(retry_outcome(attempts, max_attempts), "poll-outcomes")
    dead = with_payload(route_dlq(outcomes), batches) if park else with_payload(route_dlq(outcomes).limit(0), batches)
    dead = staged(dead, "poll-dead")
    done = advance(settle(drained, with_parked(outcomes, dead), list(sinks)), "hop")
    # A truncated file starts over, its count of bytes goes on.
    resumed = wanted.where("action in ('resume', 'reset')").join(known.select(*KEY, "bytes_written"), KEY).select(*KEY, "bytes_written")
    moved = checkpoint_trail(done, resumed).select(*KEY, "marker", "bytes_written", F.col("hop").cast("long").alias("seq"))
    ended = tails.select(*KEY, F.col("tail_marker").alias("marker"), F.lit(0).cast("long").alias("bytes_written"), F.lit(0).cast("long").alias("seq"))
    listed = files.select(*KEY, F.col("size").alias("file_size"), last_written(F.col("last_written_ms")).alias("last_written"))
    rows = moved.unionByName(ended).join(listed, KEY).withColumns({"updated_at": now, "deleted": F.lit(False)})
    return Poll(attempts, dead, staged(rows.select(*CHECKPOINT.names), "poll-positions"))
