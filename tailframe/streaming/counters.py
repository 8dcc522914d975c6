"""Live counters: what streams observe while they run, added up by a listener."""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Name under which the pages' reads are observed.
READS = "page_reads"


def observe_reads(pages: DataFrame) -> DataFrame:
    """Counts the source's reads as they are made, by outcome, and the bytes read; the rows pass as they are."""
    failed = F.col("error").isNotNull()
    size = F.coalesce(F.octet_length("data"), F.lit(0)).cast("long")
    return pages.observe(READS, F.count(F.when(~failed, True)).alias("ok"), F.count(F.when(failed, True)).alias("error"), F.sum(size).alias("bytes"))


class Counters(StreamingQueryListener):
    """Adds up what the session's streams observe: one number for each name and metric, whatever the streams' length.

    ``with Counters(spark) as counters:`` counts from the block's beginning to its end.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self._lock, self.totals = spark, threading.Lock(), Counter()

    def __enter__(self) -> Counters:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            for name, row in event.progress.observedMetrics.items():
                self.totals.update({(name, k): v or 0 for k, v in row.asDict().items()})
            self.totals.update({("rows", "read"): event.progress.numInputRows, ("micro-batches", "run"): 1})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def api_calls(self) -> DataFrame:
        """operation, outcome, n: the reads of pages that the streams made."""
        rows = [("read_page", outcome, int(self.totals[READS, outcome])) for outcome in ("ok", "error")]
        return self.spark.createDataFrame([r for r in rows if r[2]], "operation string, outcome string, n long")
