"""Batches of a stream as gzip NDJSON objects, with a manifest: a Python data source that Spark commits or aborts by micro-batch.

A task writes its batches' objects and a list of them, and reports the list's name. Only when all tasks of a micro-batch have ended are the lists entered in the manifest, under the
micro-batch's number, by one move. What a failed task or a stopped micro-batch has written is in no manifest; aborting removes it as far as it is known. A
micro-batch that is repeated writes the same keys and replaces its entry, so readers of the manifest see each batch once.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

from tailframe.functions.batches import object_key
from tailframe.functions.names import basename

#: What the writer takes: rows of ``chunk_batches`` with their key.
TAKEN = "instance_id string, engine string, log_file string, batch_id string, n_records long, batch_bytes long, object_key string, records array<string>"
LISTED = "instance_id string, engine string, log_file string, batch_id string, n_records long, batch_bytes long, object_key string"


def _opened(root: str) -> tuple[pafs.FileSystem, str]:
    fs, base = pafs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
    return fs, base.rstrip("/")


def _put(fs: pafs.FileSystem, path: str, body: bytes) -> None:
    """Under another name first, then moved."""
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft, compression=None) as f:
        f.write(body)
    fs.move(draft, path)


@dataclass
class Written(WriterCommitMessage):
    part: str
    n_objects: int


class _ObjectWriter(DataSourceStreamWriter):
    def __init__(self, options):
        self.root = options["path"]

    def write(self, iterator: Iterator[Row]) -> Written:
        fs, base = _opened(self.root)
        listed = []
        for row in iterator:
            _put(fs, f"{base}/{row.object_key}", gzip.compress("".join(f"{r}\n" for r in row.records).encode("utf-8", "surrogatepass"), mtime=0))
            listed.append(json.dumps({k: row[k] for k in row.asDict() if k != "records"}))
        part = f"_manifest/lists/{uuid.uuid4().hex}.json"
        _put(fs, f"{base}/{part}", "".join(f"{x}\n" for x in listed).encode("utf-8", "surrogatepass"))
        return Written(part, len(listed))

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        fs, base = _opened(self.root)
        _put(fs, f"{base}/_manifest/epochs/{batchId}.json", "".join(json.dumps({"epoch": batchId, "part": m.part}) + "\n" for m in messages if m).encode())

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        """The lists of tasks that did end; their objects keep keys that a repetition writes again."""
        fs, base = _opened(self.root)
        for m in messages:
            if m and fs.get_file_info(f"{base}/{m.part}").type == pafs.FileType.File:
                fs.delete_file(f"{base}/{m.part}")


class LogObjects(DataSource):
    """``spark.dataSource.register(LogObjects)``, then ``writeStream.format("log_objects").option("path", root)``."""

    @classmethod
    def name(cls) -> str:
        return "log_objects"

    def schema(self):
        return TAKEN

    def streamWriter(self, schema, overwrite):
        return _ObjectWriter(self.options)


def keyed(batches: DataFrame, prefix: str = "") -> DataFrame:
    """Rows of ``chunk_batches`` as the writer takes them."""
    key: Column = object_key(prefix, F.col("instance_id"), F.col("engine"), basename(F.col("log_file")), F.col("timestamp"), F.col("batch_id"))
    return batches.select("instance_id", "engine", "log_file", "batch_id", "n_records", "batch_bytes", key.alias("object_key"), "records")


def write_stream(batches: DataFrame, root: str, checkpoint: str, prefix: str = ""):
    """A stream writer that puts each batch of ``chunk_batches`` under its key below ``root``."""
    batches.sparkSession.dataSource.register(LogObjects)
    return keyed(batches, prefix).writeStream.format("log_objects").option("path", root).option("checkpointLocation", checkpoint)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The objects of all committed micro-batches, one row each, with their ``epoch``."""
    epochs = spark.read.schema("epoch long, part string").json(f"{root}/_manifest/epochs")
    lists = spark.read.schema(LISTED).json(f"{root}/_manifest/lists").withColumn("part", F.concat(F.lit("_manifest/lists/"), F.element_at(F.split(F.input_file_name(), "/"), -1)))
    return lists.join(epochs, "part").drop("part")
