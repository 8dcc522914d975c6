"""Sinks: gzip NDJSON objects, Kafka frames, webhooks, and delivery of batches to several of them."""

from __future__ import annotations

import datetime as dt
import errno
import gzip
import http.client
import io
import json
import random
import re
import string
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailframe.functions.batches import JSON_TIME, classify_status, identity_headers, kafka_headers, kafka_key, kafka_topic, object_key, record_json
from tailframe.functions.names import basename
from tailframe.operators.batches import assemble_batches
from tailframe.operators.delivery import fan_out, retry_outcome
from tailframe.storage import staged

#: What an attempt at a batch says.
MADE = "instance_id string, engine string, log_file string, batch_id string, attempt int, status int, n_records long, batch_bytes long, duration_ms long, attempted_at timestamp"
#: Characters that a header's value may hold as they are; a percent sign is left alone, so that plain names stay readable.
_PLAIN = "".join(c for c in string.printable if c not in "\t\n\r\x0b\x0c")
PARTS = ["instance", "engine_name", "log_base", "dt", "batch"]


def _names() -> dict[str, Column]:
    return {
        "instance": F.replace("instance_id", F.lit("/"), F.lit("_")),
        "engine_name": F.coalesce(F.nullif(F.col("engine"), F.lit("")), F.lit("unknown")),
        "log_base": F.coalesce(F.nullif(basename(F.col("log_file")), F.lit("")), F.lit("log")),
        "dt": F.date_format("timestamp", "yyyy-MM-dd"),
        "batch": F.col("batch_id"),
    }


def _file_system(root: str) -> tuple[pafs.FileSystem, str]:
    where = root.replace("file:///", "/", 1)
    fs, base = pafs.FileSystem.from_uri(where) if "://" in where else (pafs.LocalFileSystem(), where)
    return fs, base.rstrip("/")


def _folder_name(name: str, value: str | None) -> str:
    """``name=value``, escaped as Spark does it."""
    return f"{name}=" + (re.sub(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__")


def write_ndjson(records: DataFrame, path: str) -> None:
    """One gzip NDJSON object per batch, lines in payload order, in folders by instance, engine, file and day, written from the executors.

    The object's path depends on the batch and the day of fetching, and only the objects that are written are replaced, so a retry from landed chunks puts its
    object in the place of the first one. An object is written under another name first and then moved. ``write_objects`` takes assembled batches and uses the keys of ``object_manifest``.
    """
    shown = F.struct(*(F.nullif(F.col(c), F.lit("")).alias(c) if c in ("marker", "batch_id") else F.col(c) for c in records.columns if c != "line_no"))
    # An empty name and none are the same folder, so they must be one group as well.
    named = records.withColumns({k: F.nullif(v, F.lit("")) for k, v in _names().items()}).withColumn("_json", F.to_json(shown, {"timestampFormat": JSON_TIME}))
    ordered = named.repartition(*PARTS).sortWithinPartitions(*PARTS, "line_no").select(*PARTS, "_json")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _file_system(path)
        last = folder = draft = out = None
        n = 0

        def close() -> None:
            out.close()
            fs.move(draft, f"{folder}/{_folder_name(PARTS[-1], last[-1])}.json.gz")

        for part in parts:
            for *key, line in part.itertuples(index=False, name=None):
                if key != last:
                    if out:
                        close()
                    if last is None or key[:-1] != last[:-1]:
                        folder = "/".join([base, *map(_folder_name, PARTS[:-1], key)])
                        fs.create_dir(folder, recursive=True)
                    last, draft, n = key, f"{folder}/.{uuid.uuid4().hex}", n + 1
                    out = _Gzip(fs.open_output_stream(draft, compression=None))
                out.write(line.encode("utf-8", "surrogatepass") + b"\n")
        if out:
            close()
        yield pd.DataFrame({"n": [n]})

    ordered.mapInPandas(run, "n long").agg(F.sum("n")).collect()


class _Gzip(gzip.GzipFile):
    """The same bytes for the same lines, and the stream below is closed as well."""

    def __init__(self, stream):
        super().__init__(filename="", mode="wb", fileobj=stream, mtime=0)
        self._stream = stream

    def close(self) -> None:
        super().close()
        self._stream.close()


def list_objects(spark, path: str, recursive: bool = True) -> DataFrame:
    """``path`` of every file below a folder; without ``recursive`` only of folders named as partitions are. Names that begin with a dot or an underscore are left out, as Spark does.

    Each level of folders is listed by tasks and written to the shared folder, so the driver holds no names, however many.
    """

    def listed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = _file_system(path)
        for part in parts:
            for folder in part["path"]:
                found = [i for i in fs.get_file_info(pafs.FileSelector(folder)) if i.base_name[0] not in "._"]
                found = [(i.path, i.type == pafs.FileType.Directory) for i in found if recursive or i.type == pafs.FileType.File or "=" in i.base_name]
                for k in range(0, len(found), 10_000):
                    yield pd.DataFrame(found[k : k + 10_000], columns=["path", "folder"])

    fs, base = _file_system(path)
    kind = fs.get_file_info(base).type
    if kind == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    level = spark.createDataFrame([(base, kind == pafs.FileType.Directory)], "path string, folder boolean")
    found = level.where("not folder")
    while not (folders := level.where("folder").select("path")).isEmpty():
        level = staged(folders.repartition(4 * spark.sparkContext.defaultParallelism, "path").mapInPandas(listed, level.schema), "listed")
        found = found.unionByName(level.where("not folder"))
    return found.select("path")


def read_ndjson(spark, path: str, recursive: bool = False) -> DataFrame:
    """The records of all objects below ``path``, by ``list_objects``.

    There is an object a batch, so tasks list, open and read them, many each: Spark's own reader would hold the status of each in the driver.
    """
    schema = "instance_id string, engine string, log_file string, timestamp timestamp, message string, marker string, batch_id string"

    def lines(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = _file_system(path)
        held, size = [], 0
        for part in parts:
            for name in part["path"]:
                with fs.open_input_stream(name, compression=None) as f, gzip.open(f) if name.endswith(".gz") else io.BufferedReader(f) as body:
                    for line in body:
                        held.append(line.rstrip(b"\r\n"))
                        size += len(line)
                        if size > 1 << 22:
                            yield pd.DataFrame({"line": held})
                            held, size = [], 0
        yield pd.DataFrame({"line": held})

    found = list_objects(spark, path, recursive).repartition(4 * spark.sparkContext.defaultParallelism, "path")
    text = found.mapInPandas(lines, "line binary").where(F.octet_length("line") > 0)
    return text.select(F.from_json(F.col("line").cast("string"), schema).alias("_r")).select("_r.*")


def object_manifest(batches: DataFrame, prefix: str, kms_key: str = "") -> DataFrame:
    """Key and metadata of each batch's object. Encryption itself is a setting of the file system."""
    key = object_key(prefix, F.col("instance_id"), F.col("engine"), basename(F.col("log_file")), F.col("timestamp"), F.col("batch_id"))
    return batches.select("batch_id", "instance_id", "log_file", "engine", key.alias("object_key"), F.lit("aws:kms" if kms_key else "AES256").alias("sse"))


def kafka_frame(records: DataFrame, topic: str = "", template: str = "logs-{engine}") -> DataFrame:
    """Ready for ``write.format("kafka").option("includeHeaders", "true")``: one message a record, order kept by key."""
    return records.select(
        kafka_key(F.col("instance_id"), F.col("log_file")).alias("key"),
        record_json().alias("value"),
        kafka_topic(topic, template, F.col("engine"), F.col("instance_id")).alias("topic"),
        kafka_headers().alias("headers"),
    )


def webhook_frame(records: DataFrame, headers: dict[str, str] | None = None, gzipped: bool = False) -> DataFrame:
    """One request a batch: a JSON array of its records, and headers that say whose it is."""
    return assemble_batches(records).withColumn("headers", identity_headers(headers, gzipped))


#: A custom sink: batches in, attempts out (the columns of the ATTEMPT schema that it knows).
Sink = Callable[[DataFrame], DataFrame]
#: Sends one row (a batch) and says with what status and error it ended; 0 means no answer, which may be tried again.
Send = Callable[[tuple], tuple[int, str | None]]
#: Errors of a store that the next attempt meets again.
_LASTING = {errno.EACCES, errno.EPERM, errno.ENOENT, errno.ENOTDIR, errno.EISDIR, errno.EROFS}


@dataclass(frozen=True)
class Retry:
    """Attempts at most, and the waits between them: ``initial_ms`` times ``multiplier`` for each further one, up to ``longest_ms``, less up to half of it by chance."""

    max_attempts: int = 10
    initial_ms: int = 500
    longest_ms: int = 60_000
    multiplier: float = 2.0

    def wait_s(self, attempt: int) -> float:
        longest = min(self.initial_ms * self.multiplier ** (attempt - 1), self.longest_ms) / 1000
        return random.uniform(longest / 2, longest)


def _sent(frame: DataFrame, opened: Callable[[], Send], retry: Retry, also: str = "", until_failure: bool = False) -> DataFrame:
    """Sends each row of ``frame`` from the executors, with retries, and returns the attempts; ``also`` names further columns of theirs.

    ``until_failure``: rows come file by file, in order, and none is sent behind one of its file that did not arrive.
    """
    names = [f.split(" ")[0] for f in f"{MADE}, error string{also}".split(", ")]
    more = [f.split(" ")[0] for f in also.split(", ")[1:]]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send, stopped = opened(), None
        for part in parts:
            rows = []
            for row in part.itertuples(index=False):
                if until_failure and stopped == (row.instance_id, row.log_file):
                    continue
                for attempt in range(1, retry.max_attempts + 1):
                    at, began = dt.datetime.now(), time.monotonic()
                    status, error = send(row)
                    rows.append((row.instance_id, row.engine, row.log_file, row.batch_id, attempt, status, row.n_records, row.batch_bytes, int(1000 * (time.monotonic() - began)), at, error, *(getattr(row, c) for c in more)))
                    if 200 <= status < 500 and status // 100 != 3 or status < 0 or attempt == retry.max_attempts:
                        break
                    time.sleep(retry.wait_s(attempt))
                if not 200 <= status < 300:
                    stopped = (row.instance_id, row.log_file)
            made = pd.DataFrame(rows, columns=names)
            yield made.assign(status=made["status"].clip(lower=0))

    return frame.mapInPandas(run, f"{MADE}, error string{also}")


def _webhook(url: str, gzipped: bool, timeout_s: float) -> Callable[[], Send]:
    def send(row) -> tuple[int, str | None]:
        try:
            body = row.payload.encode("utf-8", "surrogatepass")
            headers = {k: quote(v, safe=_PLAIN) for k, v in dict(row.headers).items()}
            request = urllib.request.Request(url, gzip.compress(body) if gzipped else body, headers, method="POST")
            with urllib.request.urlopen(request, timeout=timeout_s) as answer:
                return answer.status, None
        except urllib.error.HTTPError as e:
            return e.code, str(e)
        except (OSError, ValueError, http.client.HTTPException) as e:
            return 0, str(e)

    return lambda: send


_POSTED = ("instance_id", "engine", "log_file", "batch_id", "payload", "headers", "n_records", "batch_bytes")


def post_webhooks(frame: DataFrame, url: str, gzipped: bool = False, max_attempts: int = 10, initial_ms: int = 500, longest_ms: int = 60_000, multiplier: float = 2.0, timeout_s: float = 30.0) -> DataFrame:
    """Posts each batch from the executors, with retries, and returns the attempts: status 0 means no answer.

    Lazy, as any DataFrame: whoever calls must write the result once and read that (``deliver`` does), or a second action
    would post again. Header values are percent-encoded outside ASCII; whatever goes wrong with a request is an attempt that failed, and stops no other.
    """
    return _sent(frame.select(*_POSTED), _webhook(url, gzipped, timeout_s), Retry(max_attempts, initial_ms, longest_ms, multiplier)).drop("error")


def _store(root: str) -> Callable[[], Send]:
    def send(row) -> tuple[int, str | None]:
        try:
            body = "".join(line + "\n" for line in _array_items(row.payload)).encode("utf-8", "surrogatepass")
            fs, base = _file_system(root)
            path = f"{base}/{row.object_key}"
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            draft = f"{path}.{uuid.uuid4().hex}"
            with fs.open_output_stream(draft, compression=None) as f:
                f.write(gzip.compress(body, mtime=0))
            fs.move(draft, path)
            return 200, None
        except OSError as e:
            return (-1 if e.errno in _LASTING else 0), str(e)
        except ValueError as e:
            return -1, str(e)

    return lambda: send


def _keyed(batches: DataFrame, prefix: str, kms_key: str) -> DataFrame:
    key = object_key(prefix, F.col("instance_id"), F.col("engine"), basename(F.col("log_file")), F.col("timestamp"), F.col("batch_id"))
    return batches.withColumns({"object_key": key, "sse": F.lit("aws:kms" if kms_key else "AES256")})


_STORED = ("instance_id", "engine", "log_file", "batch_id", "payload", "n_records", "batch_bytes", "object_key", "sse")


def write_objects(batches: DataFrame, root: str, prefix: str = "", kms_key: str = "", retry: Retry = Retry()) -> DataFrame:
    """Writes each assembled batch as one gzip NDJSON object under its key below ``root``, from the executors, and returns the attempts.

    ``root`` is a folder or a URI of a store (file, s3, gs, hdfs). An object is written under another name first and then moved, so a reader never sees half of one, and its
    bytes and key depend on the batch and the time of fetching alone: delivering a landed batch again replaces its object. Fetching the same page anew at another time makes
    another object, a duplicate that the batch id tells. Each attempt has ``object_key`` and ``sse``; its status is 200, or 0 with the ``error``. What may pass is tried again, a missing
    or forbidden folder is not. Lazy, as ``post_webhooks``.
    """
    return _sent(_keyed(batches, prefix, kms_key).select(*_STORED), _store(root), retry, ", object_key string, sse string")


def in_order(opened: Callable[[], Send], retry: Retry = Retry()) -> Sink:
    """A sink that sends each file's batches one after another, in the order of ``place``, and none behind one that did not arrive.

    ``opened`` is called once a task and gives what sends a row (instance_id, engine, log_file, batch_id, payload, n_records, batch_bytes, timestamp, headers, object_key). Files are spread over tasks; a file's
    batches pass through its task one by one.
    """

    def sink(batches: DataFrame) -> DataFrame:
        rows = _keyed(batches, "", "").withColumn("headers", identity_headers())
        return _sent(rows.repartition("instance_id", "log_file").sortWithinPartitions("instance_id", "log_file", "place"), opened, retry, until_failure=True)

    return sink


def webhook_in_order(url: str, gzipped: bool = False, retry: Retry = Retry(), timeout_s: float = 30.0) -> Sink:
    """``post_webhooks`` in the order of each file."""
    return in_order(_webhook(url, gzipped, timeout_s), retry)


def objects_in_order(root: str, retry: Retry = Retry()) -> Sink:
    """``write_objects`` in the order of each file."""
    return in_order(_store(root), retry)


def with_retries(sink: Sink, retry: Retry = Retry()) -> Sink:
    """Any sink, tried in rounds: each sends again only what could not be sent for a reason that may pass, after a wait, until nothing is left or the attempts are used up."""

    def run(batches: DataFrame) -> DataFrame:
        due, made, base = staged(batches, "round-batches"), None, 0
        for n in range(1, retry.max_attempts + 1):
            tried = staged(sink(due), "round")
            tried = tried.withColumn("attempt", (F.col("attempt") + base).cast("int"))
            made = tried if made is None else made.unionByName(tried, allowMissingColumns=True)
            left = staged(_transient(tried), "round-left")
            if n == retry.max_attempts or left.isEmpty():
                break
            base = tried.agg(F.max("attempt")).first()[0]
            time.sleep(retry.wait_s(n))
            due = due.join(left, ["instance_id", "batch_id"], "left_semi")
        return made

    return run


def _transient(tried: DataFrame) -> DataFrame:
    """The batches whose last attempt may be tried again."""
    last = tried.groupBy("instance_id", "batch_id").agg(F.max_by("status", "attempt").alias("status"))
    return last.where(classify_status(F.col("status")) == "transient").select("instance_id", "batch_id")


def _array_items(payload: str) -> list[str]:
    """The items of a JSON array, each as it stands there."""
    decoder, found, at = json.JSONDecoder(), [], 1
    while at < len(payload) - 1:
        _, end = decoder.raw_decode(payload, at)
        found.append(payload[at:end])
        at = end + 1
    return found


def deliver(batches: DataFrame, sinks: dict[str, tuple[str, Sink]]) -> DataFrame:
    """Sends all batches to every sink ({name: (type, sink)}) and returns the attempts, written once.

    Side effects happen while the attempts are written; acknowledgements, dead letters and metrics read what was
    written.
    """
    attempts = None
    for name, (kind, sink) in sinks.items():
        one = sink(batches).withColumns({"sink_name": F.lit(name), "sink_type": F.lit(kind)})
        attempts = one if attempts is None else attempts.unionByName(one, allowMissingColumns=True)
    return staged(attempts, "attempts")


def replay(dlq: DataFrame, sinks: dict[str, tuple[str, Sink]]) -> tuple[DataFrame, DataFrame]:
    """Sends dead letters to the sinks they were meant for once more: the attempts, and the entries still to keep."""
    attempts = None
    for name, one in sinks.items():
        sent = deliver(dlq.where(F.col("sink_name") == name), {name: one})
        attempts = sent if attempts is None else attempts.unionByName(sent, allowMissingColumns=True)
    arrived = retry_outcome(attempts).where("outcome = 'ok'").select("instance_id", "sink_name", "batch_id")
    return attempts, dlq.join(arrived, ["instance_id", "sink_name", "batch_id"], "left_anti")


def required(batches: DataFrame, sinks: DataFrame) -> DataFrame:
    """Every batch for every sink, to be compared with what was acknowledged."""
    return fan_out(batches.select("instance_id", "batch_id"), sinks.select("sink_name"))
