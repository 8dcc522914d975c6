"""Delivery outcomes: which attempt decides, who has acknowledged, what becomes a dead letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailframe.functions.batches import batch_id, classify_status

AT_SINK = ["instance_id", "sink_name", "batch_id"]


def made_attempts(attempts: DataFrame, max_attempts: int = 10) -> DataFrame:
    """The attempts that were made, with ``outcome``: none follows a success, a permanent failure or the last allowed."""
    earlier = Window.partitionBy(*AT_SINK).orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    ends = (F.col("outcome") != "transient").cast("int")
    judged = attempts.where(F.col("attempt") <= max_attempts).withColumn("outcome", classify_status(F.col("status")))
    return judged.withColumn("_ended", F.coalesce(F.max(ends).over(earlier), F.lit(0))).where("_ended = 0").drop("_ended")


def retry_outcome(attempts: DataFrame, max_attempts: int = 10) -> DataFrame:
    """One row per batch and sink: attempts made and how the last of them ended."""
    made = made_attempts(attempts, max_attempts)
    last = lambda c: F.max_by(c, "attempt").alias(c)
    kept = [c for c in made.columns if c not in (*AT_SINK, "attempt")]
    return made.groupBy(*AT_SINK).agg(F.max("attempt").alias("attempts"), *(last(c) for c in kept))


def backoff_ms(attempt: Column, initial: int, multiplier: float, longest: int) -> Column:
    """The wait after an attempt before jitter, which then takes away up to half of it."""
    return F.least(F.lit(float(longest)), initial * F.pow(F.lit(multiplier), attempt - 1)).cast("long")


def fan_out(batches: DataFrame, sinks: DataFrame, max_sinks: int = 1_000) -> DataFrame:
    """Every batch for every sink. Sinks are configuration: they are counted, and more than ``max_sinks`` are refused."""
    if (n := sinks.count()) > max_sinks:
        raise ValueError(f"{n} sinks; max_sinks is {max_sinks}")
    return batches.crossJoin(F.broadcast(sinks))


def acknowledged(outcomes: DataFrame, sinks: list[str], parked: bool = True) -> DataFrame:
    """Per batch: how many of the required sinks have it, and whether all do. Parked dead letters count if ``parked``."""
    has = (F.col("outcome") == "ok") | (F.lit(parked) & F.coalesce(F.col("parked"), F.lit(False)) if "parked" in outcomes.columns else F.lit(False))
    at = outcomes.where(F.col("sink_name").isin(sinks)).groupBy("instance_id", "batch_id", "sink_name").agg(F.bool_or(has).alias("has"))
    return at.groupBy("instance_id", "batch_id").agg(F.sum(F.col("has").cast("long")).alias("n_acked"), F.count("*").alias("n_seen")).withColumn("acked", F.col("n_acked") == len(set(sinks))).drop("n_seen")


def settle(chunks: DataFrame, outcomes: DataFrame, sinks: list[str]) -> DataFrame:
    """Adds ``acked`` to chunks: whether every required sink has their batch, or has it parked. Chunks without lines have nothing to deliver;
    those that could not be read (``error``) are not acknowledged. Chunks that were before stay so."""
    acks = acknowledged(outcomes, sinks).select("instance_id", "batch_id", F.col("acked").alias("_acked"))
    lines = F.length(F.replace(F.coalesce("data", F.lit("")), F.lit("\n"))) > 0
    was = F.col("acked") if "acked" in chunks.columns else F.lit(False)
    read = F.col("error").isNull() if "error" in chunks.columns else F.lit(True)
    key = batch_id(F.col("instance_id"), F.col("log_file"), F.col("prev_marker"), F.col("next_marker"))
    joined = chunks.withColumn("batch_id", key).join(acks, ["instance_id", "batch_id"], "left")
    return joined.withColumn("acked", was | (read & (F.coalesce("_acked", F.lit(False)) | ~lines))).drop("_acked", "batch_id")


def advance(settled: DataFrame, order: str) -> DataFrame:
    """The chunks up to which each file's position may move: all before its first chunk that is not acknowledged."""
    key = ["instance_id", "log_file"]
    stops = settled.where(~F.col("acked")).groupBy(*key).agg(F.min(order).alias("_stop"))
    return settled.join(stops, key, "left").where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")


def with_parked(outcomes: DataFrame, dead: DataFrame) -> DataFrame:
    """Outcomes with ``parked``, true for those among the dead letters."""
    return outcomes.join(dead.select(*AT_SINK, F.lit(True).alias("parked")), AT_SINK, "left")


def route_dlq(outcomes: DataFrame) -> DataFrame:
    """The failed batches to park, with ``reason``. Cancelled deliveries are not failures, and empty batches are not parked."""
    failed = outcomes.where("outcome <> 'ok' and n_records > 0")
    if "cancelled" in outcomes.columns:
        failed = failed.where(~F.coalesce("cancelled", F.lit(False)))
    return failed.withColumn("reason", F.when(F.col("outcome") == "permanent", "permanent").otherwise("error")).withColumn("parked", F.lit(True))


def with_payload(dead: DataFrame, batches: DataFrame) -> DataFrame:
    """Dead letters with the payload of their batch, and with ``created_at``, when they were given up."""
    return dead.join(batches.select("instance_id", "batch_id", "payload"), ["instance_id", "batch_id"]).withColumn("created_at", F.col("attempted_at"))


def dlq_ids(dead: DataFrame, after: int = 0, at: str = "attempted_at") -> DataFrame:
    """Adds ``dlq_id``, ascending in (time, instance, sink, batch) and starting after the largest id given so far. Unknown times come first.

    Rows are counted by second, seconds are summed up within their day and days in all, and rows are numbered within their second: so
    no task ranks the whole table, or all of a day on which a sink was down.
    """
    second = F.coalesce(F.unix_seconds(F.col(at).cast("timestamp")), F.lit(-(1 << 60)))
    keyed = dead.withColumns({"_second": second, "_day": F.floor(second / 86_400)})
    seconds = keyed.groupBy("_day", "_second").agg(F.count("*").alias("_n"))
    days = seconds.groupBy("_day").agg(F.sum("_n").alias("_of_day"))
    days = days.select("_day", (F.sum("_of_day").over(Window.orderBy("_day")) - F.col("_of_day")).alias("_days_before"))
    within = F.sum("_n").over(Window.partitionBy("_day").orderBy("_second")) - F.col("_n")
    before = seconds.withColumn("_before", within).join(days, "_day").select("_second", (F.col("_before") + F.col("_days_before")).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_second").orderBy(at, "instance_id", "sink_name", "batch_id"))
    return keyed.join(before, "_second").withColumn("dlq_id", F.lit(after).cast("long") + F.col("_before") + number).drop("_day", "_second", "_before")


def dlq_put(dead: DataFrame, path: str, after: int = 0) -> None:
    """Appends dead letters (as ``with_payload`` gives them) to the table at ``path``, numbered after the largest id in use."""
    dlq_ids(dead, after, "created_at").select(*(c for c in dead.columns if c != "dlq_id"), "dlq_id").write.mode("append").parquet(path)


def dlq_list(dlq: DataFrame, limit: int = 100) -> DataFrame:
    """The oldest entries; a limit below 1 means 100."""
    return dlq.orderBy("dlq_id").limit(limit if limit > 0 else 100)


def dlq_delete(dlq: DataFrame, ids: DataFrame) -> DataFrame:
    """What is left when the entries with these ids are taken out. Missing ids change nothing."""
    return dlq.join(ids.select("dlq_id"), "dlq_id", "left_anti")


def dlq_records(dlq: DataFrame) -> DataFrame:
    """The records inside dead letters, for sending them once more."""
    schema = "array<struct<instance_id:string,engine:string,log_file:string,timestamp:string,message:string,marker:string,batch_id:string>>"
    return dlq.select("dlq_id", "sink_name", F.posexplode(F.from_json("payload", schema)).alias("line_no", "r")).select("dlq_id", "sink_name", "line_no", "r.*")
