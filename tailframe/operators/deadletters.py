"""The store of dead letters: ids from a sequence table, tombstones, and a replay that deletes what arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailframe.operators.delivery import AT_SINK, dlq_ids, dlq_list, retry_outcome
from tailframe.schemas import DEAD_LETTER
from tailframe.sources.sinks import Sink, replay
from tailframe.storage import exists, staged

LETTER = T.StructType([*DEAD_LETTER, T.StructField("instance_id", T.StringType())])


class DeadLetters:
    """Tables below ``root``, which only ever grow by whole files: ``sequence`` (ids given), ``letters``, ``gone`` (ids deleted).

    One writer at a time. A block of ids is reserved before the letters of a put are written, so a crash between leaves a gap and no id is given twice.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, name: str, schema: str | T.StructType) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def last_id(self) -> int:
        """The largest id given so far, deleted or not."""
        return self._table("sequence", "upto long").agg(F.max("upto")).head()[0] or 0

    def _reserve(self, upto: int) -> None:
        self.spark.createDataFrame([(upto,)], "upto long").coalesce(1).write.mode("append").parquet(f"{self.root}/sequence")

    def put(self, dead: DataFrame) -> int:
        """Stores dead letters (as ``with_payload`` gives them), numbered in the order of time after all ids in use. Returns how many."""
        rows = staged(dead.select("instance_id", "sink_name", "batch_id", "payload", "reason", "created_at"), "dead")
        n, last = rows.count(), self.last_id()
        if n:
            self._reserve(last + n)
            dlq_ids(rows, last, "created_at").select(*LETTER.names).write.mode("append").parquet(f"{self.root}/letters")
        return n

    def current(self) -> DataFrame:
        """The letters that were not deleted."""
        return self._table("letters", LETTER).join(self._table("gone", "dlq_id long"), "dlq_id", "left_anti")

    def list(self, limit: int = 100) -> DataFrame:
        """The oldest; a limit below 1 means 100."""
        return dlq_list(self.current(), limit)

    def delete(self, ids: DataFrame) -> None:
        """Deletes the letters with these ids. Missing ids, and deleting twice, change nothing."""
        ids.select(F.col("dlq_id").cast("long")).distinct().write.mode("append").parquet(f"{self.root}/gone")

    def replay(self, sinks: dict[str, tuple[str, Sink]]) -> DataFrame:
        """Sends the letters meant for these sinks once more and deletes what arrived. Returns the attempts.

        Letters are deleted after they arrived, so a crash between sends them again.
        """
        due = staged(self.current().where(F.col("sink_name").isin(*sinks)), "replayed")
        attempts, _ = replay(due, sinks)
        arrived = retry_outcome(attempts).where("outcome = 'ok'").select(*AT_SINK)
        self.delete(due.join(arrived, AT_SINK, "left_semi"))
        return attempts

    def compact(self, root: str) -> DeadLetters:
        """The letters that are left, in a new store below ``root`` that gives ids from where this one stopped."""
        new = DeadLetters(self.spark, root)
        new._reserve(self.last_id())
        self.current().select(*LETTER.names).write.mode("append").parquet(f"{new.root}/letters")
        return new
