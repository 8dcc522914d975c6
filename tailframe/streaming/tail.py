"""Streams over landed chunks. Landed files replay exactly, so every stream here is at least once, and the deduplicated
ones exactly once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tailframe.functions.batches import payload_bytes
from tailframe.operators.audit import LINE
from tailframe.operators.lines import records
from tailframe.operators.metrics import lag_seconds
from tailframe.storage import shared_dir
from tailframe.streaming.outbox import fan_out_batch, with_ticks

__all__ = ["FilePosition", "dedupe_stream", "fan_out_batch", "file_positions", "lag_batch", "poll", "run_to_end", "tail_chunks", "tail_records", "with_ticks"]


def tail_chunks(spark: SparkSession, folder: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """New chunks as they land. ``files_per_trigger`` admits so many files to a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def tail_records(spark: SparkSession, folder: str, schema, files_per_trigger: int = 100) -> DataFrame:
    return records(tail_chunks(spark, folder, schema, files_per_trigger))


def _use_rocksdb(spark: SparkSession) -> None:
    """State on disk, for streams of this session started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def dedupe_stream(lines: DataFrame) -> DataFrame:
    """Each line once, whenever it is delivered again, for lines whose chunks have no numbers.

    There is no watermark: it would also drop first deliveries that come late, as those of a backlog do. So the state
    holds the key of every line seen, on disk. Where chunks are numbered, ``dedupe_chunks`` before they are split needs a state by file.
    """
    _use_rocksdb(lines.sparkSession)
    key = [*LINE, "generation"] if "generation" in lines.columns else LINE
    return lines.dropDuplicates(key)


def add_span(spans: list[list[int]], first: int, last: int) -> list[list[int]]:
    """Ascending spans [first, last) that neither meet nor overlap, with one more."""
    before = [s for s in spans if s[1] < first]
    after = [s for s in spans if s[0] > last]
    within = spans[len(before) : len(spans) - len(after)]
    return [*before, [min([first, *(s[0] for s in within)]), max([last, *(s[1] for s in within)])], *after]


class SeenSpans(StatefulProcessor):
    """Per file: which of its chunks have been seen, as spans of their numbers; those of its last two generations are kept."""

    def __init__(self, first: str, last: str | None):
        self.first, self.last = first, last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("spans", "spans array<struct<generation: int, first: bigint, last: bigint>>")

    def handleInputRows(self, key, rows, timerValues):
        old = self.state.get()
        spans: dict[int, list[list[int]]] = {}
        for generation, first, last in old[0] if old is not None else []:
            spans.setdefault(generation, []).append([first, last])
        for frame in rows:
            generations = frame["generation"].fillna(0).astype(int) if "generation" in frame else pd.Series(0, frame.index)
            firsts = frame[self.first].astype(int)
            lasts = frame[self.last].astype(int) if self.last else firsts + 1
            new = []
            for g, a, b in zip(generations, firsts, lasts):
                mine = spans.setdefault(int(g), [])
                new.append(not any(s[0] <= a and b <= s[1] for s in mine))
                spans[int(g)] = add_span(mine, int(a), int(b))
            yield frame[new]
        # An older generation's chunks are not fetched any more once the file has started over twice.
        kept = [(g, a, b) for g in sorted(spans)[-2:] for a, b in spans[g]]
        self.state.update((kept,))

    def close(self) -> None:
        pass


def dedupe_chunks(chunks: DataFrame, first: str = "chunk_no", last: str | None = None) -> DataFrame:
    """Each chunk once, whenever it is delivered again: exactly once for whatever is made of it by then.

    ``first`` numbers a file's chunks without gaps, or is the first byte of each, and ``last`` the byte after it. Chunks of a file come nearly in order, so what has been
    seen of it are few spans, however many chunks: the state, on disk, is one row a file. A chunk that goes beyond what was seen is kept whole.
    """
    _use_rocksdb(chunks.sparkSession)
    return chunks.groupBy("instance_id", "log_file").transformWithStateInPandas(SeenSpans(first, last), chunks.schema, "Append", "None")


class FilePosition(StatefulProcessor):
    """Per file: marker, bytes written, chunks, and truncations seen (a chunk that starts over at the start marker)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("position", "marker string, bytes_written bigint, chunks bigint, generation int")

    def handleInputRows(self, key, rows, timerValues):
        old = self.state.get()
        marker, size, chunks, generation = old if old is not None else (None, 0, 0, 0)
        started = chunks > 0
        # Rows of a group come in any order and any number: each frame is folded in as it comes.
        newest = first = None
        for frame in rows:
            began = frame[frame["prev_marker"] == "0"]
            generation += len(began)
            size, chunks = size + int(frame["n_bytes"].sum()), chunks + len(frame)
            at = (frame["fetched_at"].to_numpy(), frame["chunk_no"].to_numpy())
            order = np.lexsort(at[::-1])
            low, high = (tuple(frame.iloc[order[k]][["fetched_at", "chunk_no", "prev_marker", "next_marker"]]) for k in (0, -1))
            first = low if first is None or low[:2] < first[:2] else first
            newest = high if newest is None or high[:2] > newest[:2] else newest
        # A file's very first chunk starts at the start without starting over.
        if not started and first is not None and first[2] == "0":
            generation -= 1
        marker = newest[3] if newest is not None else marker
        self.state.update((marker, int(size), int(chunks), int(generation)))
        yield pd.DataFrame({"instance_id": [key[0]], "log_file": [key[1]], "marker": [marker], "bytes_written": [size], "chunks": [chunks], "generation": [generation]})

    def close(self) -> None:
        pass


def file_positions(chunks: DataFrame) -> DataFrame:
    """A stream of positions: one row per file and micro-batch. The state is on disk."""
    _use_rocksdb(chunks.sparkSession)
    light = chunks.select("instance_id", "log_file", "chunk_no", "prev_marker", "next_marker", payload_bytes(F.col("data")).alias("n_bytes"), "fetched_at")
    out = "instance_id string, log_file string, marker string, bytes_written bigint, chunks bigint, generation int"
    return light.groupBy("instance_id", "log_file").transformWithStateInPandas(FilePosition(), out, "Update", "None")


def run_to_end(stream: DataFrame, name: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None, checkpoint: str | None = None) -> str:
    """Runs a stream over all that has landed and returns the folder of its output."""
    out = shared_dir(stream.sparkSession, name)
    checkpoint = checkpoint or f"{out}-checkpoint"
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True)
    writer = writer.foreachBatch(each) if each else writer.format("parquet").option("path", out)
    query: StreamingQuery = writer.start()
    query.awaitTermination()
    return out


def poll(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, seconds: int = 10) -> StreamingQuery:
    """Runs ``each`` on what has landed, at once and then every so many seconds, until the query is stopped."""
    if seconds < 1:
        raise ValueError("poll at most once a second")
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").foreachBatch(each).start()


def lag_batch(now, out: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over an inventory stream: the lag of each file seen."""

    def run(inventory: DataFrame, epoch: int) -> None:
        lag_seconds(inventory, now).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return run
