"""Delivery metrics as tables. Each takes further grouping columns, such as a time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailframe.functions.batches import classify_status
from tailframe.functions.names import file_label, last_written

# Upper bounds of histogram buckets.
BYTES_BOUNDS = [1024.0 * 2**i for i in range(14)]
SECONDS_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]


def processed_total(attempts: DataFrame, *also: Column | str) -> DataFrame:
    """Records delivered, by instance, engine, file label and sink type."""
    rows = attempts.where("outcome = 'ok'").withColumn("file_label", file_label(F.col("log_file")))
    return rows.groupBy("instance_id", "engine", "file_label", "sink_type", *also).agg(F.sum("n_records").alias("n"))


def failed_total(attempts: DataFrame, *also: Column | str) -> DataFrame:
    """Records of failed attempts, by instance, sink type and reason; an attempt counts each time."""
    reason = F.when(F.col("outcome") == "permanent", "permanent").otherwise("error")
    return attempts.where("outcome <> 'ok'").withColumn("reason", reason).groupBy("instance_id", "sink_type", "reason", *also).agg(F.sum("n_records").alias("n"))


def lag_seconds(inventory: DataFrame, now: Column, *also: Column | str) -> DataFrame:
    """Whole seconds since each file was last written, never negative; files without a time are left out."""
    written = last_written(F.col("last_written_ms"))
    lag = F.greatest(F.lit(0).cast("long"), F.unix_seconds(now) - F.unix_seconds(written))
    rows = inventory.withColumn("lag_s", lag).where(written.isNotNull())
    return rows.groupBy("instance_id", "log_file", *also).agg(F.min("lag_s").alias("lag_s"))


def api_calls(attempts: DataFrame, operation: Column, *also: Column | str) -> DataFrame:
    """Calls by operation and outcome (ok or error)."""
    return _operations(attempts, operation, "operation", *also)


def store_ops(attempts: DataFrame, op: Column, *also: Column | str) -> DataFrame:
    """State store operations by kind and outcome."""
    return _operations(attempts, op, "op", *also)


def _operations(rows: DataFrame, what: Column, name: str, *also: Column | str) -> DataFrame:
    outcome = F.when(classify_status(F.col("status")) == "ok", "ok").otherwise("error")
    return rows.groupBy(what.alias(name), outcome.alias("outcome"), *also).agg(F.count("*").alias("n"))


def histogram(rows: DataFrame, value: Column, bounds: list[float], *by: Column | str) -> DataFrame:
    """Cumulative bucket counts: a row for each bound and one for infinity (``le`` is null), with sum and count.

    Each row is put into its one bucket and counted there before the shuffle; the few bucket counts are then
    added up, instead of multiplying the rows by the bounds.
    """
    bucket = F.lit(len(bounds))
    for k in range(len(bounds) - 1, -1, -1):
        bucket = F.when(value <= bounds[k], k).otherwise(bucket)
    counts = rows.groupBy(*by, bucket.alias("_k")).agg(F.count("*").alias("_n"), F.sum(value).alias("_s"))
    names = [c for c in counts.columns if c not in ("_k", "_n", "_s")]
    upto = [F.sum(F.when(F.col("_k") <= k, F.col("_n")).otherwise(0)).alias(f"_{k}") for k in range(len(bounds) + 1)]
    wide = counts.groupBy(*names).agg(F.sum("_s").alias("total"), *upto)
    rows_of = F.array(*(F.struct((F.lit(b) if b is not None else F.lit(None).cast("double")).alias("le"), F.col(f"_{k}").alias("n")) for k, b in enumerate([*bounds, None])))
    return wide.select(*names, "total", F.col(f"_{len(bounds)}").alias("count"), F.inline(rows_of))


def delivery_totals(attempts: DataFrame) -> DataFrame:
    """Per sink: records and batches delivered, batches delivered again, failed attempts."""
    ok = F.col("outcome") == "ok"
    per = attempts.groupBy("sink_name", "instance_id", "batch_id").agg(F.sum(ok.cast("long")).alias("_ok"), F.sum(F.when(ok, F.col("n_records")).otherwise(0)).alias("_records"), F.sum((~ok).cast("long")).alias("_failed"))
    return per.groupBy("sink_name").agg(F.sum("_records").alias("n_records"), F.sum((F.col("_ok") > 0).cast("long")).alias("n_batches"), F.sum(F.greatest(F.col("_ok") - 1, F.lit(0))).alias("n_duplicates"), F.sum("_failed").alias("n_failures"))
