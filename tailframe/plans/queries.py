"""The registered queries of the core library and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailframe.functions import batches as fb
from tailframe.functions import names as fn
from tailframe.operators import audit, batches, checkpoints, deadletters, delivery, lines, metrics, positions, walk
from tailframe.plans.fixtures import SINKS, view
from tailframe.sources import inventory, objects, sinks
from tailframe.sources import tail as live
from tailframe.storage import shared_dir, staged
from tailframe.streaming import counters, outbox, poll, tail

#: A fixed "now" for lags, so that results repeat.
NOW = "2024-01-02 00:00:00"
KEY = ["instance_id", "log_file"]


def _chunks(spark, d):
    return view(spark, d, "chunks")


def _records(spark, d):
    return lines.records(_chunks(spark, d))


def _starts(spark, d):
    """Positions of files that were last read up to their second chunk."""
    return _chunks(spark, d).where("chunk_no = 1").select(*KEY, F.col("next_marker").alias("from_marker"))


def _line_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("instance_id", "engine", "log_file").agg(F.count("*").alias("n_lines"), F.sum(fb.payload_bytes(F.col("message"))).alias("n_bytes"))


# -- sources, lines, names --------------------------------------------------------------------------------------


def lines_by_file(spark: SparkSession, d: str) -> DataFrame:
    return _line_counts(lines.split_lines(_chunks(spark, d)))


def batch_ids(spark, d):
    c = lines.stamp(_chunks(spark, d))
    return c.select("instance_id", "log_file", "chunk_no", fb.start_marker(F.col("prev_marker")).alias("from_marker"), "marker", "batch_id", fb.payload_bytes(F.col("data")).alias("n_bytes"))


def eligible_files(spark, d):
    polls = view(spark, d, "polls")
    pages = [polls.where(F.col("poll_id") % 2 == k).select(*KEY, "engine", "size", "last_written_ms") for k in (0, 1)]
    return inventory.discover_files(*pages).groupBy("instance_id", "engine", "log_file").agg(F.count("*").alias("n_polls"), F.max("size").alias("size"), F.max(F.unix_millis("last_written")).alias("last_ms"))


def hinted_files(spark, d):
    polls = view(spark, d, "polls").where("engine = 'postgres'")
    return inventory.discover_files(inventory.hinted(polls, "postgres")).groupBy(*KEY).agg(F.count("*").alias("n_polls"))


def file_labels(spark, d):
    polls = view(spark, d, "polls")
    return polls.select("poll_id", fn.basename(F.col("log_file")).alias("base"), fn.file_label(F.col("log_file")).alias("file_label"), fn.accepts(F.col("engine"), F.col("log_file")).alias("accepted"), F.unix_millis(fn.last_written(F.col("last_written_ms"))).alias("written_ms"))


def lag_by_file(spark, d):
    return metrics.lag_seconds(view(spark, d, "inventory"), F.lit(NOW).cast("timestamp"))


# -- positions and walks ----------------------------------------------------------------------------------------


def start_positions(spark, d):
    return positions.resolve_positions(view(spark, d, "inventory"), view(spark, d, "checkpoints")).select(*KEY, "engine", "size", "action", "from_marker")


def rotated_out(spark, d):
    return positions.rotated_out(view(spark, d, "checkpoints"), view(spark, d, "inventory")).select(*KEY, "marker", "file_size")


def unchanged_skipped(spark, d):
    seen = view(spark, d, "polls").where(F.col("poll_id") % 3 == 0).groupBy(*KEY).agg(F.max_by("size", "poll_id").alias("file_size"), fn.last_written(F.max_by("last_written_ms", "poll_id")).alias("last_written"))
    return inventory.skip_unchanged(view(spark, d, "inventory"), seen).select(*KEY, "size", "last_written_ms")


def truncations(spark, d):
    return positions.truncations(view(spark, d, "polls")).select(*KEY, "poll_id", "size", "prev_size", "truncated", F.col("generation").cast("long").alias("generation"))


def _walked(df):
    return df.select(*KEY, "prev_marker", "next_marker", F.col("hop").cast("long").alias("hop"), fb.payload_bytes(F.col("data")).alias("n_bytes"))


def drained_chunks(spark, d):
    return _walked(walk.drain_by_ordinal(_chunks(spark, d), _starts(spark, d)))


def drained_by_marker(spark, d):
    return _walked(walk.drain_by_marker(staged(_chunks(spark, d), "chunks"), _starts(spark, d)))


def drained_recursive(spark, d):
    chunks = staged(_chunks(spark, d), "chunks")
    walked = walk.drain_recursive(chunks, _starts(spark, d))
    return walked.select(*KEY, "prev_marker", "next_marker", F.col("hop").cast("long").alias("hop"))


def tail_markers(spark, d):
    return walk.tail_markers(walk.drain_by_ordinal(_chunks(spark, d), _starts(spark, d))).select(*KEY, "tail_marker", F.col("hops").cast("long").alias("hops"))


def checkpoint_trail(spark, d):
    first = _chunks(spark, d).where("chunk_no = 1").select(*KEY, fb.payload_bytes(F.col("data")).alias("bytes_written"))
    return checkpoints.checkpoint_trail(walk.drain_by_ordinal(_chunks(spark, d), _starts(spark, d)), first).withColumn("hop", F.col("hop").cast("long"))


# -- checkpoints ------------------------------------------------------------------------------------------------


def _checkpoint(df):
    return df.select(*KEY, "marker", "bytes_written", "updated_at", "seq")


def current_checkpoints(spark, d):
    return _checkpoint(checkpoints.current_checkpoints(view(spark, d, "checkpoint_log")))


def get_checkpoint(spark, d):
    return _checkpoint(checkpoints.get_checkpoint(view(spark, d, "checkpoint_log"), "db-7", "click.log"))


def list_checkpoints(spark, d):
    return _checkpoint(checkpoints.list_checkpoints(view(spark, d, "checkpoint_log"), "db-7"))


def deleted_checkpoints(spark, d):
    """What is left after all files of one kind are deleted, those that are gone already included."""
    log = view(spark, d, "checkpoint_log")
    gone = checkpoints.tombstones(log.where("log_file = 'view.log'"), F.lit("2100-01-01 00:00:00").cast("timestamp_ntz"), F.lit(1 << 60).cast("long"))
    return _checkpoint(checkpoints.current_checkpoints(log.unionByName(gone, allowMissingColumns=True)))


def compacted(spark, d):
    log = view(spark, d, "checkpoint_log")
    path = shared_dir(spark, "compacted")
    return _checkpoint(checkpoints.current_checkpoints(checkpoints.compact(log, path)))


def set_checkpoints(spark, d):
    """The log appended in three parts to one table, one of them twice."""
    log, path = view(spark, d, "checkpoint_log"), shared_dir(spark, "checkpoints")
    for k in (0, 1, 2, 1):
        checkpoints.append_checkpoints(log.where(F.col("seq") % 3 == k), path)
    return _checkpoint(checkpoints.current_checkpoints(spark.read.schema(log.schema).parquet(path)))


# -- batches and frames -----------------------------------------------------------------------------------------


def batch_sizes(spark, d):
    return batches.batch_sizes(_records(spark, d))


def coalesced_batches(spark, d):
    sizes = _chunks(spark, d).select(*KEY, "chunk_no", fb.payload_bytes(F.col("data")).alias("batch_bytes"))
    merged = batches.coalesce_batches(sizes, 1_000)
    return merged.groupBy(*KEY, "bucket").agg(F.count("*").alias("n_chunks"), F.sum("batch_bytes").alias("batch_bytes"))


def webhook_payloads(spark, d):
    frame = sinks.webhook_frame(_records(spark, d), {"x-log-file": "all"})
    return frame.select("instance_id", "log_file", "batch_id", "n_records", "payload", F.map_keys("headers").getItem(0).alias("first_header"), F.col("headers")["x-log-file"].alias("own_header"), F.size("headers").cast("long").alias("n_headers"))


def object_keys(spark, d):
    sizes = _records(spark, d).groupBy(*batches.BATCH).agg(F.min("timestamp").alias("timestamp"))
    return sinks.object_manifest(sizes, "logs/")


def kafka_frame(spark, d):
    frame = sinks.kafka_frame(_records(spark, d))
    shown = F.array_join(F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), F.decode(h["value"], "UTF-8"))), ";")
    return frame.select("key", "value", "topic", shown.alias("headers"))


def ndjson_roundtrip(spark, d):
    path = shared_dir(spark, "ndjson")
    for _ in range(2):  # the second time is a retry
        sinks.write_ndjson(_records(spark, d), path)
    return _line_counts(sinks.read_ndjson(spark, path))


# -- delivery ---------------------------------------------------------------------------------------------------


def _attempts(spark, d):
    return view(spark, d, "attempts")


def _made(spark, d):
    return delivery.made_attempts(_attempts(spark, d), 3)


def status_classes(spark, d):
    codes = _attempts(spark, d).select("instance_id", "batch_id", "sink_name", "attempt", (F.col("status") + F.col("attempt") * 50).alias("status"))
    return codes.withColumn("class", fb.classify_status(F.col("status"))).groupBy("status", "class").agg(F.count("*").alias("n"))


def retry_outcome(spark, d):
    return delivery.retry_outcome(_attempts(spark, d), 3).select("instance_id", "sink_name", "batch_id", "attempts", "status", "outcome")


def retry_waits(spark, d):
    waits = _made(spark, d).where("outcome = 'transient'").withColumn("wait_ms", delivery.backoff_ms(F.col("attempt"), 500, 2.0, 60_000))
    return waits.groupBy("sink_name").agg(F.sum("wait_ms").alias("wait_ms"), F.max("wait_ms").alias("longest_ms"))


def fanout_acks(spark, d):
    return delivery.acknowledged(delivery.retry_outcome(_attempts(spark, d), 3), list(SINKS))


def fanout_missing(spark, d):
    """Batches and sinks of the full matrix that have no success."""
    outcomes = delivery.retry_outcome(_attempts(spark, d), 3)
    names = spark.createDataFrame([(s,) for s in SINKS], "sink_name string")
    matrix = sinks.required(outcomes.select("instance_id", "batch_id").distinct(), names)
    return matrix.join(outcomes.where("outcome = 'ok'").select(*delivery.AT_SINK), delivery.AT_SINK, "left_anti").groupBy("sink_name").agg(F.count("*").alias("n_missing"))


def _dlq(spark, d):
    return delivery.dlq_ids(delivery.route_dlq(delivery.retry_outcome(_attempts(spark, d), 3)))


def dead_letters(spark, d):
    return _dlq(spark, d).select("dlq_id", "instance_id", "sink_name", "batch_id", "reason", "n_records", "attempted_at")


def dlq_oldest(spark, d):
    return delivery.dlq_list(dead_letters(spark, d), 0)


def dlq_after_delete(spark, d):
    dlq = staged(dead_letters(spark, d), "dlq")
    return delivery.dlq_delete(dlq, dlq.where(F.col("dlq_id") % 3 == 0))


def dlq_replay(spark, d):
    """Lines inside the dead letters of all batches, as after an outage, read back from their payloads."""
    batch = batches.assemble_batches(_records(spark, d))
    dead = batch.select(F.xxhash64("batch_id").alias("dlq_id"), F.lit("siem").alias("sink_name"), "payload")
    return _line_counts(delivery.dlq_records(dead))


def dlq_roundtrip(spark, d):
    """Dead letters put in two runs, the ten oldest deleted, the rest sent again and deleted as they arrive: what is left, with the ids given."""
    number = F.substring("batch_id", 2, 20).cast("long")
    dead = delivery.route_dlq(delivery.retry_outcome(_attempts(spark, d), 3)).withColumns({"payload": F.lit("[]"), "created_at": F.col("attempted_at")})
    store = deadletters.DeadLetters(spark, shared_dir(spark, "dead-letters"))
    for k in (0, 1):
        store.put(dead.where(number % 2 == k))
    store.delete(store.list(10))
    answer = F.when(number % 5 == 0, 503).otherwise(200)
    sink = lambda b: b.select("instance_id", "batch_id", F.lit(1).alias("attempt"), answer.alias("status"))
    store.replay({s: ("any", sink) for s in SINKS})
    return store.current().select("dlq_id", "instance_id", "sink_name", "batch_id", "reason")


# -- metrics ----------------------------------------------------------------------------------------------------


def _labelled(spark, d):
    return _made(spark, d).withColumns({"engine": F.lit("postgres"), "log_file": F.concat(F.lit("error/"), "batch_id", F.lit(".log"))})


def processed_total(spark, d):
    return metrics.processed_total(_labelled(spark, d))


def failed_total(spark, d):
    return metrics.failed_total(_made(spark, d))


def failed_by_hour(spark, d):
    made = _made(spark, d).withColumn("hour", F.date_trunc("hour", "attempted_at"))
    return metrics.failed_total(made, "hour")


def batch_bytes_hist(spark, d):
    return metrics.histogram(_made(spark, d), F.col("batch_bytes"), metrics.BYTES_BOUNDS, "sink_type")


def write_seconds_hist(spark, d):
    made = _made(spark, d)
    found = metrics.histogram(made, F.col("duration_ms").cast("long"), [b * 1000 for b in metrics.SECONDS_BOUNDS], "sink_type")
    return found.withColumnRenamed("total", "total_ms").withColumnRenamed("le", "le_ms")


def api_calls(spark, d):
    return metrics.api_calls(_made(spark, d), F.when(F.col("attempt") == 1, "DescribeDBLogFiles").otherwise("DownloadDBLogFilePortion"))


def store_ops(spark, d):
    return metrics.store_ops(_made(spark, d), F.when(F.col("attempt") % 2 == 1, "get").otherwise("set"))


def delivery_totals(spark, d):
    return metrics.delivery_totals(_attempts(spark, d).withColumn("outcome", fb.classify_status(F.col("status"))))


# -- audit ------------------------------------------------------------------------------------------------------


def _source_lines(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.col("source").alias("instance_id"), F.col("lang").alias("log_file"), F.col("text").alias("data"))
    marked = docs.withColumns({"prev_marker": F.col("doc_id").cast("string"), "next_marker": (F.col("doc_id") + 1).cast("string")})
    return lines.split_lines(lines.stamp(marked)).select("doc_id", *KEY, "batch_id", "line_no", "message")


def _delivered(source):
    return source.where(F.col("doc_id") % 7 != 0).unionByName(source.where(F.col("doc_id") % 5 == 0))


def missing_lines(spark, d):
    source = _source_lines(spark, d)
    return audit.missing_lines(source, _delivered(source)).select("doc_id", "line_no", "message")


def dedupe_lines(spark, d):
    return audit.dedupe_lines(_delivered(_source_lines(spark, d))).groupBy(*KEY).agg(F.count("*").alias("n_lines"), F.sum(fb.payload_bytes(F.col("message"))).alias("n_bytes"))


def line_generations(spark, d):
    """Lines kept when files that start over repeat their batch ids: those of each generation count."""
    source = _source_lines(spark, d)
    again = source.withColumn("generation", F.lit(0)).unionByName(source.withColumn("generation", F.lit(1))).unionByName(source.withColumn("generation", F.lit(1)))
    return audit.dedupe_lines(again).groupBy("generation").agg(F.count("*").alias("n_lines"))


# -- streams ----------------------------------------------------------------------------------------------------


def _landed(spark, d):
    """The chunk table as files in a folder, as a live source would have left them."""
    folder, schema, _ = _landed_wide(spark, d)
    return folder, schema


def _landed_wide(spark, d, files: int = 4):
    """The same in so many files, and half their number: a micro-batch of that many files keeps as many tasks busy."""
    chunks = _chunks(spark, d)
    folder = shared_dir(spark, "landed")
    chunks.repartition(files, "instance_id", "log_file").write.parquet(folder)
    return folder, chunks.schema, files // 2


def _width(spark) -> int:
    return max(4, 2 * spark.sparkContext.defaultParallelism)


def stream_tail(spark, d):
    folder, schema = _landed(spark, d)
    out = tail.run_to_end(tail.tail_records(spark, folder, schema, 2), "tailed")
    return _line_counts(spark.read.parquet(out))


def stream_dedupe(spark, d):
    """Every chunk lands twice; each line comes out once. The state is a row a file."""
    folder, schema, half = _landed_wide(spark, d, _width(spark))
    spark.read.schema(schema).parquet(folder).coalesce(half).write.mode("append").parquet(folder)
    out = tail.run_to_end(tail.dedupe_chunks(tail.tail_chunks(spark, folder, schema, half)), "deduped")
    return _line_counts(lines.records(spark.read.parquet(out)))


def stream_state(spark, d):
    folder, schema = _landed(spark, d)

    def keep(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    out = shared_dir(spark, "positions")
    tail.run_to_end(tail.file_positions(tail.tail_chunks(spark, folder, schema, 2)), "positions", "update", keep)
    rows = spark.read.parquet(out)
    return rows.groupBy(*KEY).agg(F.max_by("marker", "chunks").alias("marker"), F.max("bytes_written").alias("bytes_written"), F.max("chunks").alias("n_chunks"))


def _simulated(sink_type: str, status: int = 400):
    """A sink that answers by the batch id: the webhook refuses a sixteenth of all batches."""

    def sink(batch: DataFrame) -> DataFrame:
        refused = F.substring("batch_id", 1, 1) == "7" if sink_type == "http" else F.lit(False)
        answer = F.when(refused, status).otherwise(200).alias("status")
        return batch.select("instance_id", "engine", "log_file", "batch_id", F.lit(1).alias("attempt"), answer, "n_records", "batch_bytes", F.col("timestamp").alias("attempted_at"))

    return sink


def _fanned_out(spark, d, park: bool) -> str:
    folder, schema = _landed(spark, d)
    out = shared_dir(spark, "fanout")
    each = tail.fan_out_batch({"siem": ("http", _simulated("http", 503)), "cold": ("s3", _simulated("s3"))}, out, park, "chunk_no")
    tail.run_to_end(tail.tail_chunks(spark, folder, schema, 2), "fanout", "append", each)
    return out


def stream_positions(spark, d):
    """Positions after a stream one of whose sinks keeps refusing some batches: each file stops before its first such chunk."""
    log = spark.read.parquet(f"{_fanned_out(spark, d, False)}/positions")
    return checkpoints.current_checkpoints(log).select(*KEY, "marker", "bytes_written")


def stream_parked(spark, d):
    """The same with dead letters: their lines, read back from the payloads; every file's position is at its end."""
    out = _fanned_out(spark, d, True)
    ends = checkpoints.current_checkpoints(spark.read.parquet(f"{out}/positions")).select(*KEY, "marker")
    dead = delivery.dlq_ids(spark.read.parquet(f"{out}/dead"), at="created_at")
    return _line_counts(delivery.dlq_records(dead)).join(ends, KEY)


def _outage(row) -> tuple[int, str | None]:
    """A sink that refuses a sixteenth of all batches twice each, and then takes them."""
    return (503, "down") if row.batch_id[0] == "7" and row.tries < 2 else (200, None)


def stream_outbox(spark, d):
    """Two sinks, one of them with an outage, on a stream that falls quiet: what each was sent, whether in order, and where all files' positions end.

    Nothing lands after the first micro-batches; ticks have what was refused sent again.
    """
    folder, schema = _landed(spark, d)
    out = shared_dir(spark, "outbox")
    once = sinks.Retry(max_attempts=1)
    both = {"siem": ("http", sinks.in_order(lambda: _outage, once)), "cold": ("s3", sinks.in_order(lambda: lambda row: (200, None), once))}
    pages = outbox.with_ticks(tail.tail_chunks(spark, folder, schema, 4))
    query = tail.poll(pages, outbox.fan_out_batch(both, out), f"{out}-mark", 1)
    try:
        outbox.wait_until_empty(spark, out, schema, query)
    finally:
        query.stop()
    attempts = spark.read.parquet(f"{out}/attempts").withColumn("ok", (F.col("status") == 200).cast("long"))
    ids = lines.stamp(_chunks(spark, d)).select("instance_id", "batch_id", "chunk_no")
    arrived = attempts.join(ids, ["instance_id", "batch_id"])
    along = Window.partitionBy("sink_name", *KEY).orderBy("attempted_at", "chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    arrived = arrived.withColumn("late", (F.col("chunk_no") < F.max("chunk_no").over(along)).cast("long"))
    sent = arrived.groupBy("sink_name").agg(F.sum("ok").alias("n_ok"), F.countDistinct("instance_id", "batch_id").alias("n_batches"), F.sum(1 - F.col("ok")).alias("n_refused"), F.sum(F.coalesce("late", F.lit(0))).alias("n_out_of_order"))
    ends = checkpoints.current_checkpoints(spark.read.parquet(f"{out}/positions")).agg(F.count("*").alias("n_files"), F.sum((F.col("marker") == "tail").cast("long")).alias("n_at_end"), F.sum("bytes_written").alias("bytes_written"))
    return sent.crossJoin(F.broadcast(ends))


def poll_positions(spark, d):
    """One poll: every other file is known up to its first chunk, some of them are smaller than they were, the rest are new and read from their end on."""
    chunks = staged(_chunks(spark, d), "chunks")
    number = F.regexp_extract("log_file", "([0-9]+)$", 1).cast("long")
    size = F.sum(fb.payload_bytes(F.col("data"))).cast("long")
    listed = chunks.groupBy("instance_id", "engine", "log_file").agg(size.alias("size"), F.unix_millis(F.max(F.col("fetched_at").cast("timestamp"))).alias("last_written_ms"))
    first = chunks.where("chunk_no = 1").where(number % 2 == 0)
    was = F.when(number % 6 == 0, F.lit(1 << 50)).otherwise(0).cast("long")
    log = first.select(*KEY, F.col("next_marker").alias("marker"), fb.payload_bytes(F.col("data")).alias("bytes_written"), was.alias("file_size"), F.col("fetched_at").cast("timestamp").alias("updated_at"), F.lit(0).cast("long").alias("seq"), F.lit(False).alias("deleted"))
    found = poll.poll_once(listed, log, chunks, {"siem": ("http", _simulated("http", 503)), "cold": ("s3", _simulated("s3"))}, F.lit(NOW).cast("timestamp"), park=False, drain=walk.drain_by_ordinal)
    return found.positions.select(*KEY, "marker", "bytes_written", "file_size", "seq")


def objects_roundtrip(spark, d):
    """Batches written as objects under their keys, each twice, and read back."""
    root = shared_dir(spark, "objects").replace("file:///", "/", 1)
    batch = staged(batches.assemble_batches(_records(spark, d)), "batches")
    for _ in range(2):
        sinks.deliver(batch, {"cold": ("s3", lambda b: sinks.write_objects(b, root, "logs/"))})
    return _line_counts(sinks.read_ndjson(spark, root, recursive=True))


def log_tail_lines(spark, d):
    """The lines as log files in folders, read page by page through the live source."""
    folder, ordered = _log_folder(spark, d, "logs")
    _write_logs(ordered, folder, "file={}/part.txt")
    pages = live.read_pages(spark, folder, page_bytes="65536", task_bytes="200000")
    found = lines.split_lines(pages.where("error is null")).withColumn("file_no", F.regexp_extract("log_file", "file=([0-9]+)", 1).cast("long"))
    return found.groupBy("file_no").agg(F.count("*").alias("n_lines"), F.sum(fb.payload_bytes(F.col("message"))).alias("n_bytes"))


def _log_folder(spark, d, name: str):
    """A folder for log files, and the lines of each as ``file_no`` and ``message``, in order."""
    folder = shared_dir(spark, name).replace("file:///", "/", 1)
    ordered = _records(spark, d).withColumn("file_no", F.regexp_extract("log_file", "([0-9]+)$", 1).cast("long"))
    return folder, ordered.select("file_no", "chunk_no", "line_no", "message")


def _write_logs(ordered: DataFrame, folder: str, named: str = "{}.log") -> None:
    """Each file's lines into a file of its own, from the executors, in the place of what it held."""

    def run(parts):
        import os

        os.makedirs(folder, exist_ok=True)
        name, out = None, None
        for part in parts:
            for file_no, message in zip(part["file_no"], part["message"]):
                if file_no != name:
                    if out:
                        out.close()
                    path = f"{folder}/{named.format(file_no)}"
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    name, out = file_no, open(path, "w", encoding="utf-8", newline="\n")
                out.write(message + "\n")
        if out:
            out.close()
        yield from ()

    rows = ordered.repartition("file_no").sortWithinPartitions("file_no", "chunk_no", "line_no").select("file_no", "message")
    rows.mapInPandas(run, "file_no long").count()


def _landed_lines(spark, out: str, *also: str) -> DataFrame:
    pages = live.read_chunks(spark, out).where("error is null").dropDuplicates(["log_file", "generation", "start_byte"])
    found = lines.split_lines(pages).withColumn("file_no", F.regexp_extract("log_file", "([0-9]+)", 1).cast("long"))
    return found.groupBy("file_no", *also).agg(F.count("*").alias("n_lines"), F.sum(fb.payload_bytes(F.col("message"))).alias("n_bytes"))


class _FailingOnce(live.LogTail):
    """A live source each of whose files can't be opened the first time it is read."""

    @classmethod
    def name(cls) -> str:
        return "failing_once"

    def streamReader(self, schema):
        class Files(live._Files):
            def opened(self, part):
                import os

                mark = f"{self.state}/failed-{part.name}"
                if not os.path.exists(mark):
                    os.makedirs(self.state, exist_ok=True)
                    open(mark, "w").close()
                    raise OSError("not now")
                return super().opened(part)

        return live._TailReader(Files(self.options))


def stream_holes(spark, d):
    """Lines landed by a live source whose first read of each file fails: all of them, after as many errors as there are files."""
    folder, ordered = _log_folder(spark, d, "logs")
    out, mark = shared_dir(spark, "pages"), shared_dir(spark, "mark")
    _write_logs(ordered, folder)
    for _ in range(2):
        live.land(spark, folder, out, mark, _FailingOnce, page_bytes="65536").trigger(availableNow=True).start().awaitTermination()
    failed = live.read_chunks(spark, out).where("error is not null").groupBy(F.regexp_extract("log_file", "([0-9]+)", 1).cast("long").alias("file_no")).agg(F.count("*").alias("n_errors"))
    return _landed_lines(spark, out).join(failed, "file_no")


def stream_generations(spark, d):
    """Lines by generation, landed by a live source from files that are then cut to their first chunk: markers repeat, generations tell them apart."""
    folder, ordered = _log_folder(spark, d, "logs")
    out, mark = shared_dir(spark, "pages"), shared_dir(spark, "mark")
    for part in (ordered, ordered.where("chunk_no = 1")):
        _write_logs(part, folder)
        live.land(spark, folder, out, mark, page_bytes="65536").trigger(availableNow=True).start().awaitTermination()
    return _landed_lines(spark, out, "generation")


def stream_calls(spark, d):
    """Reads of pages that a live source made, counted while it ran: each file's first read fails."""
    folder, ordered = _log_folder(spark, d, "logs")
    out, mark = shared_dir(spark, "pages"), shared_dir(spark, "mark")
    _write_logs(ordered, folder)
    whole = str(1 << 30)
    with counters.Counters(spark) as found:
        for _ in range(2):
            live.land(spark, folder, out, mark, _FailingOnce, page_bytes=whole, task_bytes=whole).trigger(availableNow=True).start().awaitTermination()
    return found.api_calls()


def stream_store_ops(spark, d):
    """Positions that a stream looked up and set, as it recorded them: all files in one micro-batch."""
    folder, schema = _landed(spark, d)
    out = shared_dir(spark, "fanout")
    each = tail.fan_out_batch({"cold": ("s3", _simulated("s3"))}, out)
    tail.run_to_end(tail.tail_chunks(spark, folder, schema), "fanout", "append", each)
    return spark.read.parquet(f"{out}/calls").groupBy("op", "outcome").agg(F.sum("n").alias("n"))


def stream_objects(spark, d):
    """Lines of the objects in the manifest that a stream writer committed."""
    folder, schema, half = _landed_wide(spark, d, _width(spark))
    root = shared_dir(spark, "objects").replace("file:///", "/", 1)
    made = batches.chunk_batches(tail.tail_chunks(spark, folder, schema, half))
    objects.write_stream(made, root, shared_dir(spark, "mark"), "logs/").trigger(availableNow=True).start().awaitTermination()
    listed = objects.read_manifest(spark, root).groupBy(*KEY).agg(F.count("*").alias("n_objects"), F.sum("n_records").alias("n_listed"))
    return _line_counts(sinks.read_ndjson(spark, f"{root}/logs", recursive=True)).join(listed, KEY)


def log_tail_chosen(spark, d):
    """Lines of the log files whose names begin with a 1, read through the live source, which opens no others."""
    folder, ordered = _log_folder(spark, d, "logs")
    _write_logs(ordered, folder)
    key = "spark.sql.python.filterPushdown.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        chosen = staged(live.read_pages(spark, folder).where(F.startswith("log_file", F.lit("1"))), "chosen")
    finally:
        spark.conf.set(key, old)
    found = lines.split_lines(chosen).withColumn("file_no", F.regexp_extract("log_file", "([0-9]+)", 1).cast("long"))
    return found.groupBy("file_no").agg(F.count("*").alias("n_lines"), F.sum(fb.payload_bytes(F.col("message"))).alias("n_bytes"))


def stream_fanout(spark, d):
    folder, schema = _landed(spark, d)
    out = shared_dir(spark, "fanout")
    each = tail.fan_out_batch({"siem": ("http", _simulated("http")), "cold": ("s3", _simulated("s3"))}, out, park=True)
    tail.run_to_end(tail.tail_chunks(spark, folder, schema, 2), "fanout", "append", each)
    return spark.read.parquet(f"{out}/attempts").groupBy("sink_name", "status").agg(F.count("*").alias("n_batches"), F.sum("batch_bytes").alias("n_bytes"))


def stream_lag(spark, d):
    folder = shared_dir(spark, "inventory")
    view(spark, d, "inventory").repartition(4, *KEY).write.parquet(folder)
    schema = spark.read.parquet(folder).schema
    out = shared_dir(spark, "lag")
    tail.run_to_end(tail.tail_chunks(spark, folder, schema, 2), "lag", "append", tail.lag_batch(F.lit(NOW).cast("timestamp"), out))
    return spark.read.parquet(out).groupBy(*KEY).agg(F.min("lag_s").alias("lag_s"))


def ordered_lines(spark, d):
    """Each line's place in its file."""
    return lines.numbered_lines(_chunks(spark, d)).select(*KEY, "chunk_no", F.col("line_no").cast("long").alias("line_no"), "place")


QUERIES = (
    lines_by_file, batch_ids, eligible_files, hinted_files, file_labels, lag_by_file, start_positions, rotated_out, unchanged_skipped, truncations,
    drained_chunks, drained_by_marker, drained_recursive, tail_markers, checkpoint_trail,
    current_checkpoints, get_checkpoint, list_checkpoints, deleted_checkpoints, compacted, set_checkpoints,
    batch_sizes, coalesced_batches, webhook_payloads, object_keys, kafka_frame, ndjson_roundtrip,
    status_classes, retry_outcome, retry_waits, fanout_acks, fanout_missing, dead_letters, dlq_oldest, dlq_after_delete, dlq_replay, dlq_roundtrip,
    processed_total, failed_total, failed_by_hour, batch_bytes_hist, write_seconds_hist, api_calls, store_ops, delivery_totals,
    missing_lines, dedupe_lines, line_generations, ordered_lines,
    stream_tail, stream_dedupe, stream_state, stream_fanout, stream_positions, stream_outbox, stream_holes, stream_generations, stream_calls, stream_store_ops, stream_objects, stream_parked, stream_lag, poll_positions, objects_roundtrip, log_tail_lines, log_tail_chosen,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}
