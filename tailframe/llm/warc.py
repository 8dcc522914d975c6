"""WARC archives compressed record by record with Zstandard, and a reader that checks what it reads.

An archive starts with a skippable frame that holds the compression dictionary (itself a Zstandard frame, as the
public .warc.zst convention says), followed by one frame for each record. Every task writes an archive of its
own, trained on its own first records, under a name that no other attempt uses; the archives that count are those
in the manifest, which only finished tasks reach, so lost or repeated attempts leave no trace in the result.
The reader streams an archive frame by frame.

Edge cases: a null payload is empty; a null url is written as an empty target; a row with a null id is a response
if no row of equal payload has an id, else it revisits; rows that repeat the largest id of their payload are all
responses; a very long payload is one record, held in memory once in each step; an empty table gives no archive and no records; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailframe.llm.common import shared_dir, staged

#: Magic number of the skippable frame that holds the dictionary, and of a Zstandard frame.
DICT_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
#: A dictionary is trained on an archive's first records: at most so many, of so many bytes in all.
_SAMPLES, _SAMPLE_BYTES, _DICT_BYTES = 400, 2 << 20, 64 << 10
_READ = 1 << 20
#: Rows of a digest and an id up to which a table is broadcast.
BROADCAST_ROWS = 200_000
MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


class WarcError(ValueError):
    """An archive or a record that is not what its headers say."""


def digest32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


# -- deciding ---------------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, payload: Column, id_col: str = "page_id", min_bytes: int = 0) -> DataFrame:
    """Adds payload_sha1 (hex) and response_id: of equal payloads of ``min_bytes`` or more, the largest id.

    Digests are summed up before they are shuffled, so a payload that a third of all rows share costs one row a task. Only payloads that occur twice
    need a partner: their table is broadcast as long as it has at most ``BROADCAST_ROWS`` rows, so that payloads aren't shuffled to find few copies.
    """
    own = pages.withColumn("payload_sha1", F.sha1(F.coalesce(payload, F.lit(b""))))
    size = F.octet_length(F.coalesce(payload, F.lit(b"")))
    light = own.where(size >= min_bytes).select(F.col(id_col).alias("_id"), F.col("payload_sha1").alias("_sha1"))
    repeated = light.groupBy("_sha1").agg(F.max("_id").alias("_largest"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    repeated = staged(repeated, "warc-repeated")
    side = F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated
    joined = own.join(side, own["payload_sha1"] == side["_sha1"], "left")
    alone = F.when(F.col("_sha1").isNull() & (size >= min_bytes), F.col(id_col))
    return joined.withColumn("response_id", F.coalesce("_largest", alone)).drop("_sha1", "_largest")


# -- writing ----------------------------------------------------------------------------------------------------


def _record(page_id: int | None, url: str | None, payload: bytes, sha1: str, response_id: int | None, date: str) -> bytes:
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    target = quote(url or "", safe="%/:?#[]@!$&'()*+,;=-._~")
    revisit = response_id is not None and response_id != page_id
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest32(sha1)}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(response_id)}"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head += [f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}", f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *head, "", ""]).encode() + block + b"\r\n\r\n"


def _trained(samples: list[bytes]) -> bytes:
    """A dictionary for the samples; none if they are too few to train on."""
    try:
        return zstandard.train_dictionary(_DICT_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[bytes]:
        for batch in batches:
            for row in zip(*batch.columns):
                i, url, payload, sha1, response = (x.as_py() for x in row)
                yield _record(i, url, payload or b"", sha1, response, date)

    source = records()
    first: list[bytes] = []
    for r in source:
        first.append(r)
        if len(first) >= _SAMPLES or sum(map(len, first)) >= _SAMPLE_BYTES:
            break
    if not first:
        return
    fs, base = _opened(folder)
    name = f"part-{uuid.uuid4().hex}.warc.zst"
    fs.create_dir(base, recursive=True)
    dictionary = _trained(first)
    compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    n = size = 0
    with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
        if dictionary:
            packed = zstandard.ZstdCompressor(level=3).compress(dictionary)
            size += out.write(struct.pack("<II", DICT_MAGIC, len(packed)) + packed) or 0
        for part in (first, source):
            for r in part:
                out.write(compressor.compress(r))
                n += 1
        size = out.tell()
    yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["path", "n_records", "n_bytes"])


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for each row and returns the manifest of archives: path, n_records, n_bytes."""
    folder = folder or shared_dir(pages.sparkSession, "warc")
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.encode(F.col(payload_col), "UTF-8").alias("payload"))
    ready = with_revisits(source, F.col("payload"), min_bytes=min_bytes).select("page_id", "url", "payload", "payload_sha1", "response_id")
    return staged(ready.mapInArrow(lambda b: _write_part(b, folder, date), MANIFEST), "warc-manifest")


# -- reading ----------------------------------------------------------------------------------------------------


def _frames(stream: pa.NativeFile) -> Iterator[bytes]:
    """The record in each frame. The dictionary comes from the leading skippable frame, if there is one."""
    buffer = stream.read(8)
    if not buffer:
        return
    options = {}
    if len(buffer) == 8 and struct.unpack("<I", buffer[:4])[0] == DICT_MAGIC:
        size = struct.unpack("<I", buffer[4:])[0]
        packed = stream.read(size)
        if len(packed) < size:
            raise WarcError("the dictionary's frame is cut short")
        raw = zstandard.ZstdDecompressor().decompress(packed) if packed[:4] == struct.pack("<I", FRAME_MAGIC) else packed
        options["dict_data"] = zstandard.ZstdCompressionDict(raw)
        buffer = b""
    decompressor = zstandard.ZstdDecompressor(**options)
    while True:
        buffer = buffer or stream.read(_READ)
        if not buffer:
            return
        if len(buffer) >= 4 and struct.unpack("<I", buffer[:4])[0] != FRAME_MAGIC:
            raise WarcError("no Zstandard frame where a record should start")
        frame, out = decompressor.decompressobj(), []
        while True:
            out.append(frame.decompress(buffer))
            if frame.eof:
                buffer = frame.unused_data
                break
            buffer = stream.read(_READ)
            if not buffer:
                raise WarcError("the last frame is cut short")
        yield b"".join(out)


def _number(name: str | None) -> int | None:
    text = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return None if text in ("", "null") else int(text)


def parse_record(data: bytes, check: bool = True) -> dict:
    """One record's columns. Raises WarcError where headers, lengths or digests don't agree with the data."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise WarcError("no WARC header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in fields:
            raise WarcError(f"a header line without a name, or one given twice: {line[:80]}")
        fields[name.lower()] = value.strip()
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys():
        raise WarcError(f"missing headers: {sorted(missing)}")
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"the block has {len(rest) - 4} bytes; Content-Length says {length}")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"unknown record type {kind}")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not http.startswith(b"HTTP/"):
        raise WarcError("no HTTP header in the block")
    stated = int(fields.get("warc-payload-length", len(payload)))
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if check:
        if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}":
            raise WarcError("the block's digest is another")
        if kind == "response" and (stated != len(payload) or digest != base64.b32encode(hashlib.sha1(payload).digest()).decode()):
            raise WarcError("the payload's length or digest is another")
        if kind == "revisit" and (payload or "warc-refers-to" not in fields):
            raise WarcError("a revisit with a payload, or without the record that it refers to")
    return {
        "page_id": _number(fields["warc-record-id"]),
        "url": unquote(fields.get("warc-target-uri", "")),
        "record_type": kind,
        "refers_to": _number(fields.get("warc-refers-to")),
        "payload_bytes": stated,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def read_warc(spark: SparkSession, manifest: DataFrame, payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``manifest.path``; without ``payload`` it is checked but not returned.

    Each archive is one task's work; its counted records must agree with the manifest where that says how many.
    """
    names = [f.split(" ")[0] for f in RECORDS.split(", ")]
    kinds = dict(zip(names, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())))
    names = names if payload else names[:-1]
    schema = pa.schema([(n, kinds[n]) for n in names])
    counted = "n_records" in manifest.columns
    paths = manifest.select("path", *(["n_records"] if counted else []))

    def batches_of(path: str, expected: int | None) -> Iterator[pa.RecordBatch]:
        fs, at = _opened(path)
        rows, size, n = [], 0, 0
        with fs.open_input_stream(at, compression=None) as stream:
            for data in _frames(stream):
                row = parse_record(data)
                size += len(data) if payload else 0
                rows.append({k: row[k] for k in names})
                n += 1
                if len(rows) >= 2_000 or size >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)
        if expected is not None and n != expected:
            raise WarcError(f"{path} has {n} records; the manifest says {expected}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from batches_of(row["path"], row.get("n_records"))

    # Archives go round robin to as many tasks as there are archives to read, within what the cluster runs at once.
    tasks = max(1, min(manifest.count(), 8 * spark.sparkContext.defaultParallelism))
    return paths.repartition(tasks).mapInArrow(run, ", ".join(f for f in RECORDS.split(", ") if f.split(" ")[0] in names))
