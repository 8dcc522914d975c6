"""Delivery of a stream of pages to several sinks, with a ledger of what each of them still lacks.

Pages become batches, which are written once. Each sink is sent what it lacks: of a file that it has refused before, the first batch alone,
and the others behind it only once that one has arrived. So a healthy sink gets each batch once during another's outage, no batch of a file is sent before an earlier one, and an
outage costs one batch a file and attempt, whatever has piled up. The ledger, the pages not yet passed and the positions are
``EpochLog`` tables: small rows without payloads, of which a micro-batch reads a snapshot and what has changed since. Payloads go once no sink lacks any batch of their micro-batch, and with each new
snapshot what is older than the one before it, so a stream's folder grows with what waits, and otherwise by a row an attempt, position and dead letter.

A position moves along the chain of markers: a page follows if it starts where the one before ended, and every sink has it or has it parked. So neither a page that is refused nor one
that is missing is passed. Pages are put in order by ``order``, which must number a file's pages; the time of fetching does not. A page that starts at the start marker after others is a
truncated file's first: what is missing before it can't be read any more and does not hold it up, what a sink refuses before it does.

Order of writing: payloads, attempts, dead letters, ledger, positions. Every folder belongs to an epoch, and a repetition overwrites it; a crash repeats deliveries and loses none.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tailframe.functions.batches import START, batch_id, payload_bytes, start_marker
from tailframe.operators.batches import chunk_batches
from tailframe.operators.checkpoints import KEY
from tailframe.operators.delivery import AT_SINK, retry_outcome, route_dlq, with_payload
from tailframe.schemas import ATTEMPT, CHECKPOINT
from tailframe.sources.sinks import Retry, Sink
from tailframe.storage import EpochLog, children, remove, scratch, staged

#: Folders of payloads that are read by name; beyond, all are read and joined.
_NAMED = 1_000


def with_ticks(pages: DataFrame, seconds: int = 1) -> DataFrame:
    """The stream of pages with an empty row every so many seconds, so that what waits is tried again when no page comes."""
    ticks = pages.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().where(F.col("value") % seconds == 0)
    return pages.unionByName(ticks.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in pages.schema)))


class Outbox:
    """The tables below ``out``. ``order`` is the column, or the columns in turn, that number a file's pages."""

    def __init__(self, spark: SparkSession, out: str, pages: T.StructType, order: str | list[str], every: int = 16):
        self.order = [order] if isinstance(order, str) else list(order)
        if set(self.order) & {"fetched_at"}:
            raise ValueError("the time of fetching does not number a file's pages: two may have one, and a later page may be fetched before an earlier one")
        self.out = out.rstrip("/")
        place = T.StructField("place", T.StructType([T.StructField(c, pages[c].dataType) for c in self.order]))
        text = lambda *names: [T.StructField(n, T.StringType()) for n in names]
        page = [*text(*KEY), place]
        self.lacks = EpochLog(spark, f"{self.out}/lacks", T.StructType([*text("sink_name"), *page, *text("batch_id"), T.StructField("epoch", T.LongType()), T.StructField("tries", T.IntegerType()), T.StructField("due_at", T.TimestampType())]), ["sink_name", *KEY, "place"], every)
        self.ahead = EpochLog(spark, f"{self.out}/ahead", T.StructType([*page, *text("prev_marker", "next_marker"), T.StructField("n_bytes", T.LongType()), T.StructField("fetched_at", T.TimestampType())]), [*KEY, "place"], every)
        self.files = EpochLog(spark, f"{self.out}/files", T.StructType([*page, *text("marker"), T.StructField("bytes_written", T.LongType())]), KEY, every)

    def place(self):
        return F.struct(*self.order).alias("place")

    def waiting(self, epoch: int) -> DataFrame:
        """What each sink still lacked before ``epoch``."""
        return self.lacks.read(epoch)

    def expire(self, old: DataFrame, epoch: int) -> None:
        """Removes what no micro-batch needs any more, a repetition of ``epoch`` included. ``old`` is what was waiting before it."""
        spark, kept = self.lacks.spark, f"{self.out}/payloads"
        before = [(k,) for n in children(spark, kept) if n.startswith("epoch=") and (k := int(n[len("epoch=") :])) < epoch]
        done = spark.createDataFrame(before, "epoch long").join(old.select("epoch").distinct(), "epoch", "left_anti").collect() if before else []
        for row in done:
            remove(spark, f"{kept}/epoch={row.epoch}")
        if (epoch + 1) % self.lacks.every == 0:
            for log in (self.lacks, self.ahead, self.files):
                log.expire(epoch + 1)


def _passed(chain: DataFrame, starts: DataFrame) -> DataFrame:
    """Adds ``passed`` to (file, place, prev_marker, next_marker, held, again): whether the file's position may move beyond the page."""
    along = Window.partitionBy(*KEY).orderBy("place")
    restart = F.col("_from") == START
    rows = chain.join(starts.select(*KEY, F.col("marker").alias("_start")), KEY, "left").withColumn("_from", start_marker(F.col("prev_marker")))
    before = F.coalesce(F.lag("next_marker").over(along), start_marker(F.col("_start")))
    later = F.max(restart).over(along.rowsBetween(1, Window.unboundedFollowing))
    fits = (F.col("_from") == before) | F.col("again") | restart | F.coalesce(later, F.lit(False))
    rows = rows.withColumn("_ok", fits & ~F.col("held"))
    return rows.withColumn("passed", F.min("_ok").over(along.rowsBetween(Window.unboundedPreceding, 0))).drop("_from", "_start", "_ok")


def fan_out_batch(sinks: dict[str, tuple[str, Sink]], out: str, park: bool = False, order: str | list[str] = "chunk_no", max_attempts: int = 10, starts: DataFrame | None = None, wait: Retry = Retry(initial_ms=0), every: int = 16) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: sends every sink what it lacks, appends attempts and dead letters, and moves positions as far as all sinks have the pages.

    With ``park`` a batch that a sink refuses becomes a dead letter and counts as taken. ``starts`` (instance_id, log_file, marker, bytes_written) says where files are known to go on; others
    begin with the first page of their first micro-batch, read or not. ``wait`` says how long a refused batch waits, by the times it was refused. Of the tables below ``out``,
    ``attempts``, ``dead`` and ``positions`` are for readers.
    """

    def run(pages: DataFrame, epoch: int) -> None:
        spark = pages.sparkSession
        box = Outbox(spark, out, pages.schema, order, every)
        with scratch(spark):
            own = pages.where(F.col("log_file").isNotNull())
            old = staged(box.waiting(epoch), "lacked")
            if own.isEmpty() and old.isEmpty() and (epoch + 1) % every:
                return  # a tick with nothing to do
            key = batch_id(F.col("instance_id"), F.col("log_file"), F.col("prev_marker"), F.col("next_marker"))
            fresh = staged(own.withColumns({"place": box.place(), "batch_id": key, "n_bytes": payload_bytes(F.col("data"))}).drop(*set(box.order) - {"place"}), "fresh")
            read = fresh.where(F.col("error").isNull()) if "error" in fresh.columns else fresh
            made = chunk_batches(read.drop("batch_id", "n_bytes"), "place").drop("records")
            # Of pages at one place, the one fetched last counts.
            row = F.struct(*(c for c in made.columns if c not in (*KEY, "place")))
            payloads = made.groupBy(*KEY, "place").agg(F.max_by(row, "timestamp").alias("_row")).select(*KEY, "place", "_row.*")
            payloads.write.mode("overwrite").parquet(f"{box.out}/payloads/epoch={epoch}")
            sent = spark.read.schema(payloads.schema).parquet(f"{box.out}/payloads/epoch={epoch}")

            # What each sink lacks, and which of it is sent first.
            names = F.explode(F.array(*map(F.lit, sinks))).alias("sink_name")
            new = sent.select(names, *KEY, "place", "batch_id", F.lit(epoch).cast("long").alias("epoch"), F.lit(0).alias("tries"), F.lit(None).cast("timestamp").alias("due_at"))
            heads = old.groupBy("sink_name", *KEY).agg(F.min("place").alias("head"), F.min_by("due_at", "place").alias("_due"))
            # A page that was fetched anew before all sinks had it takes the place of what it was.
            same = ["sink_name", *KEY, "place"]
            new = new.join(old.select(*same, F.lit(True).alias("_had")), same, "left")
            due = old.join(new.select(*same), same, "left_anti").unionByName(new, allowMissingColumns=True)
            due = staged(due.join(heads, ["sink_name", *KEY], "left"), "due")
            now = F.lit(dt.datetime.now(dt.timezone.utc))
            ready = F.col("head").isNull() | ((F.col("place") == F.col("head")) & F.coalesce(F.col("_due") <= now, F.lit(True)))

            def send(rows: DataFrame, part: str) -> DataFrame:
                """(sink_name, file, place, arrived) of the rows that were tried; those that were parked have arrived."""
                rows = rows.select("sink_name", *KEY, "place", "batch_id", "epoch", "tries")
                epochs = [r[0] for r in rows.select("epoch").distinct().limit(_NAMED + 1).collect()]
                paths = [f"{box.out}/payloads/epoch={e}" for e in epochs] if 0 < len(epochs) <= _NAMED else [f"{box.out}/payloads"]
                held = spark.read.schema(T.StructType([*payloads.schema, T.StructField("epoch", T.LongType())])).option("basePath", f"{box.out}/payloads").parquet(*paths)
                made = spark.createDataFrame([], ATTEMPT)
                for name, (kind, sink) in sinks.items():
                    batches = held.join(rows.where(F.col("sink_name") == name).select(*KEY, "place", "epoch", "tries"), [*KEY, "place", "epoch"]).drop("epoch")
                    made = made.unionByName(sink(batches).withColumns({"sink_name": F.lit(name), "sink_type": F.lit(kind)}), allowMissingColumns=True)
                made.write.mode("overwrite").parquet(f"{box.out}/attempts/epoch={epoch}/part={part}")
                made = spark.read.schema(made.schema).parquet(f"{box.out}/attempts/epoch={epoch}/part={part}")
                outcomes = retry_outcome(made, max_attempts)
                dead = with_payload(route_dlq(outcomes if park else outcomes.limit(0)), held.join(rows.select(*KEY, "place", "epoch").distinct(), [*KEY, "place", "epoch"], "left_semi"))
                dead.write.mode("overwrite").parquet(f"{box.out}/dead/epoch={epoch}/part={part}")
                parked = spark.read.schema(dead.schema).parquet(f"{box.out}/dead/epoch={epoch}/part={part}").select(*AT_SINK, F.lit(True).alias("parked"))
                ended = outcomes.join(parked, AT_SINK, "left").select(*AT_SINK, ((F.col("outcome") == "ok") | F.coalesce("parked", F.lit(False))).alias("arrived"))
                return staged(rows.join(ended, AT_SINK).select("sink_name", *KEY, "place", "arrived"), "sent")

            first = send(due.where(ready), "first")
            open_ = first.where("arrived").select("sink_name", *KEY, F.col("place").alias("head"))
            rest = due.where(F.col("head").isNotNull() & (F.col("place") != F.col("head"))).join(open_, ["sink_name", *KEY, "head"], "left_semi")
            ended = first if old.isEmpty() else first.unionByName(send(rest, "rest"))

            # The ledger: what is new and has not arrived, what was refused once more, and what has arrived at last.
            told = due.join(ended, ["sink_name", *KEY, "place"], "left").withColumns({"gone": F.coalesce("arrived", F.lit(False)), "_new": F.col("epoch") == epoch})
            tries = F.col("tries") + (~F.coalesce("arrived", F.lit(True))).cast("int")
            pause = F.least(F.lit(float(wait.longest_ms)), wait.initial_ms * F.pow(F.lit(wait.multiplier), tries - 1)) / 1000
            due_at = F.when(F.col("arrived") == F.lit(False), F.timestamp_seconds(F.unix_micros(now) / 1e6 + pause)).otherwise(F.col("due_at"))
            told = staged(told.withColumns({"due_at": due_at, "_tries": tries}).drop("tries").withColumnRenamed("_tries", "tries"), "told")
            box.lacks.append(told.where((F.col("_new") & (~F.col("gone") | F.col("_had"))) | (~F.col("_new") & F.col("arrived").isNotNull())), epoch)

            # Positions.
            light = ["place", "prev_marker", "next_marker", "n_bytes", "fetched_at"]
            known = box.files.read(epoch)
            seen = fresh.groupBy(*KEY).agg(F.min_by("prev_marker", "place").alias("marker")).join(known, KEY, "left_anti")
            begun = F.lit(None).cast("long")
            if starts is not None:
                given = starts.select(*KEY, F.col("marker").alias("_given"), *(c for c in ("bytes_written",) if c in starts.columns))
                seen = seen.join(given, KEY, "left").withColumn("marker", F.coalesce("_given", "marker"))
                begun = F.col("bytes_written") if "bytes_written" in given.columns else begun
            seen = seen.select(*KEY, "marker", begun.alias("bytes_written"))
            at = staged(known.select(*KEY, "marker", "bytes_written", F.col("place").alias("_last"), F.lit(False).alias("_first")).unionByName(seen.withColumn("_first", F.lit(True)), allowMissingColumns=True), "files")
            held = told.where(~F.col("gone")).select(*KEY, "place", F.lit(True).alias("held")).distinct()
            chain = box.ahead.read(epoch).select(*KEY, *light, F.lit(False).alias("_new")).unionByName(read.select(*KEY, *light, F.lit(True).alias("_new")))
            # A page that came again counts once, one that was passed not at all, but for the last one if it now ends elsewhere.
            chain = chain.join(at.select(*KEY, "_last", F.col("marker").alias("_at")), KEY, "left").withColumn("again", F.coalesce((F.col("place") == F.col("_last")) & (F.col("next_marker") != F.col("_at")), F.lit(False)))
            chain = chain.where(F.col("_last").isNull() | (F.col("place") > F.col("_last")) | F.col("again"))
            chain = chain.groupBy(*KEY, "place", "again").agg(*(F.max_by(c, "fetched_at").alias(c) for c in light[1:]), F.min("_new").alias("_new"), (F.countDistinct("next_marker") > 1).alias("_other"))
            chain = staged(_passed(chain.join(held, [*KEY, "place"], "left").withColumn("held", F.coalesce("held", F.lit(False))), at), "chain")
            stays = F.col("_new") | F.col("_other")
            box.ahead.append(chain.where((stays & ~F.col("passed")) | (~F.col("_new") & F.col("passed"))).select(*KEY, *light, F.col("passed").alias("gone")), epoch)
            moved = chain.where("passed").groupBy(*KEY).agg(F.max("place").alias("place"), F.max_by("next_marker", "place").alias("marker"), F.sum("n_bytes").alias("_more"))
            moved = staged(moved.withColumn("updated_at", now).join(at.select(*KEY, "bytes_written"), KEY, "left").withColumn("bytes_written", F.coalesce("bytes_written", F.lit(0).cast("long")) + F.col("_more")), "moved")
            stay = at.where("_first").join(moved, KEY, "left_anti").select(*KEY, F.col("_last").alias("place"), "marker", "bytes_written")
            box.files.append(moved.select(*stay.columns).unionByName(stay).withColumn("gone", F.lit(False)), epoch)
            calls = lambda rows, op: rows.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), F.lit("ok").alias("outcome"), "n")
            calls(fresh.select(*KEY).distinct(), "get").unionByName(calls(moved, "set")).write.mode("overwrite").parquet(f"{box.out}/calls/epoch={epoch}")
            added = {"file_size": F.lit(None).cast("long"), "last_written": F.lit(None).cast("timestamp"), "seq": F.lit(epoch).cast("long"), "deleted": F.lit(False)}
            moved.withColumns(added).select(*CHECKPOINT.names).write.mode("overwrite").parquet(f"{box.out}/positions/epoch={epoch}")
            box.expire(old, epoch)

    return run


def wait_until_empty(spark: SparkSession, out: str, pages: T.StructType, query: StreamingQuery, order: str | list[str] = "chunk_no", every: int = 16, seconds: int = 3_600) -> None:
    """Returns once all that a stream with ticks has to read is read and no sink lacks anything any more; raises TimeoutError after so many seconds."""
    box, began, quiet = Outbox(spark, out, pages, order, every), time.monotonic(), None
    while time.monotonic() - began < seconds:
        if query.exception():
            raise query.exception()
        done = query.lastProgress
        # A micro-batch that read nothing but ticks, and that began when nothing was waiting, has nothing left to do.
        if done and done.batchId != quiet and all(s.numInputRows == 0 or "rate" in s.description.lower() for s in done.sources):
            quiet = done.batchId
            if box.waiting(quiet + 1).isEmpty():
                return
        time.sleep(0.2)
    raise TimeoutError(f"after {seconds} seconds some sink still lacks something")
