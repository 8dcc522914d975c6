"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Shuffle files go when the query that made them ends; one that is run again makes them anew.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders made in the innermost open ``scratch`` block of this thread; none where no block is open.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)
#: Writers under way in each session, and what the setting was before the first of them.
_writers: Counter[str] = Counter()
_before: dict[str, str] = {}
_lock = threading.Lock()


def new_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, on a single machine only, under the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_staged"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder as ``new_dir`` gives it. In a ``scratch`` block it is removed at the end."""
    path = new_dir(spark, name)
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def _freeing(spark: SparkSession) -> Iterator[None]:
    """Sets ``_FREE_SHUFFLES`` as long as any thread's writer of the session is under way."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        _writers[session] += 1
        if _writers[session] == 1:
            _before[session] = spark.conf.get(_FREE_SHUFFLES, "false")
            spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            _writers[session] -= 1
            if not _writers[session]:
                del _writers[session]
                spark.conf.set(_FREE_SHUFFLES, _before.pop(session))


def write(df: DataFrame, path: str, mode: str = "error") -> None:
    """Writes ``df`` as Parquet and frees its shuffle files at once, not when the driver's garbage collection finds them unused."""
    with _freeing(df.sparkSession):
        df.write.mode(mode).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once and reads it back: side effects happen once, lineage ends here, lost executors don't matter."""
    path = shared_dir(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder by Spark's own file systems."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that this thread staged inside, at the end of the block. What leaves it must not read them any more."""
    made: list[str] = []
    before = _made.set(made)
    try:
        yield
    finally:
        _made.reset(before)
        for path in made:
            remove(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, by Spark's own file systems."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies directly in a folder; none if there is no such folder."""
    if not exists(spark, path):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(where)]


class EpochLog:
    """A table of versions by key, written once a micro-batch, of which a reader needs a snapshot and the epochs since, however long the history.

    ``append`` writes the versions of one epoch into a folder of its own, so that a repetition replaces them; of each key the version of the last epoch
    counts, and one with ``gone`` removes it. After every ``every`` epochs what counts is written as a snapshot. A snapshot is complete when its
    ``_SUCCESS`` is there, which is the pointer: a reader takes the last complete one before its epoch.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: list[str], every: int = 16):
        self.spark, self.root, self.schema, self.key, self.every = spark, root.rstrip("/"), schema, key, every
        self._stored = T.StructType([*schema.fields, T.StructField("gone", T.BooleanType()), T.StructField("at", T.LongType())])

    def _snapshot(self, epoch: int) -> int:
        """The last epoch up to which, itself not included, there is a snapshot."""
        at = epoch - epoch % self.every
        while at > 0 and not exists(self.spark, f"{self.root}/snapshot-{at}/_SUCCESS"):
            at -= self.every
        return max(at, 0)

    def _folders(self, epoch: int) -> list[str]:
        at = self._snapshot(epoch)
        found = [f"{self.root}/snapshot-{at}"] if at else []
        return found + [f for k in range(at, epoch) if exists(self.spark, f := f"{self.root}/epoch={k}")]

    def read(self, epoch: int) -> DataFrame:
        """What counts before ``epoch``."""
        folders = self._folders(epoch)
        rows = self.spark.read.schema(self._stored).parquet(*folders) if folders else self.spark.createDataFrame([], self._stored)
        others = [c for c in self._stored.names if c not in self.key]
        newest = rows.groupBy(*self.key).agg(F.max_by(F.struct(*others), "at").alias("_v"))
        return newest.where("not _v.gone").select(*(c if c in self.key else f"_v.{c}" for c in self.schema.names))

    def append(self, rows: DataFrame, epoch: int) -> None:
        """Writes the versions of an epoch, ``rows`` with a boolean ``gone``, at most one of each key; then a snapshot, if one is due."""
        rows.select(*self.schema.names, "gone", F.lit(epoch).cast("long").alias("at")).write.mode("overwrite").parquet(f"{self.root}/epoch={epoch}")
        if (epoch + 1) % self.every == 0:
            kept = self.read(epoch + 1).withColumns({"gone": F.lit(False), "at": F.lit(epoch).cast("long")})
            kept.write.mode("overwrite").parquet(f"{self.root}/snapshot-{epoch + 1}")

    def expire(self, epoch: int) -> None:
        """Removes what reading before ``epoch`` or one epoch earlier, as a repetition does, has no need of: all from before the snapshot that the earlier of them begins with."""
        start = self._snapshot(epoch - 1)
        for name in children(self.spark, self.root) if start else []:
            kind, _, number = name.replace("=", "-").partition("-")
            if kind in ("epoch", "snapshot") and number.isdigit() and int(number) < start:
                remove(self.spark, f"{self.root}/{name}")
