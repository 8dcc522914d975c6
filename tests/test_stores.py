"""The dead-letter store, objects of streams, batches of chunks and live counters."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailframe.operators import batches, deadletters, lines
from tailframe.plans import queries
from tailframe.schemas import LOG_PAGE
from tailframe.sources import objects, sinks, tail
from tailframe.streaming import counters
from tailframe.streaming import tail as streams

T0 = dt.datetime(2026, 4, 19, 12)
CHUNK = T.StructType(LOG_PAGE.fields[:8])


def chunks(spark, *texts):
    return spark.createDataFrame([("i", "postgres", f"error/f{k % 2}.log", str(k), str(k + 1), t, True, T0) for k, t in enumerate(texts)], CHUNK)


TEXTS = ('a "q"\n\n b, c\n', "é\r\nend", "", None, "\n\n", "x")


def test_batches_of_chunks_are_those_of_their_records(spark):
    source = chunks(spark, *TEXTS)
    columns = [*batches.BATCH, "n_records", "batch_bytes", "timestamp", "payload"]
    narrow = batches.chunk_batches(source)
    assert "Exchange" not in narrow._jdf.queryExecution().executedPlan().toString()
    got, want = (sorted(map(tuple, df.select(*columns).collect())) for df in (narrow, batches.assemble_batches(lines.records(source))))
    assert got == want and len(got) == 3
    assert all(json.loads(r.payload) == [json.loads(x) for x in r.records] for r in narrow.collect())


def test_manifest_lists_what_was_committed(spark, tmp_path):
    folder, root, mark = (str(tmp_path / n) for n in ("landed", "root", "mark"))
    source = chunks(spark, *TEXTS)
    source.coalesce(1).write.parquet(folder)
    made = lambda: batches.chunk_batches(streams.tail_chunks(spark, folder, CHUNK))
    objects.write_stream(made(), root, mark).trigger(availableNow=True).start().awaitTermination()
    listed = objects.read_manifest(spark, root)
    assert sorted(r.n_records for r in listed.collect()) == [1, 2, 2] and {r.epoch for r in listed.collect()} == {0}
    files = {str(p.relative_to(root)) for p in (tmp_path / "root").rglob("*.gz")}
    assert files == {r.object_key for r in listed.collect()}
    assert sinks.read_ndjson(spark, f"{root}/i", recursive=True).count() == 5

    # A task that fails half-way: its micro-batch ends with an error, and nothing of it is in the manifest.
    chunks(spark, "new\n").coalesce(1).write.mode("append").parquet(folder)
    bad = made().withColumn("engine", F.when(F.col("log_file").isNotNull(), F.expr("raise_error('broken')")).otherwise("postgres"))
    with pytest.raises(Exception, match="broken"):
        objects.write_stream(bad, root, mark).trigger(availableNow=True).start().awaitTermination()
    assert objects.read_manifest(spark, root).count() == 3
    objects.write_stream(made(), root, mark).trigger(availableNow=True).start().awaitTermination()
    assert {r.epoch: r["count"] for r in objects.read_manifest(spark, root).groupBy("epoch").count().collect()} == {0: 3, 1: 1}


def test_aborting_and_repeating_a_micro_batch(tmp_path):
    writer = objects._ObjectWriter({"path": str(tmp_path)})
    from pyspark.sql import Row

    row = Row(instance_id="i", engine="e", log_file="f", batch_id="b", n_records=1, batch_bytes=1, object_key="k/b.gz", records=["{}"])
    first = writer.write(iter([row]))
    writer.abort([first, None], 0)
    assert not (tmp_path / first.part).exists()
    again = [writer.write(iter([row])), writer.write(iter([]))]
    for _ in range(2):
        writer.commit(again, 0)
    entries = [json.loads(x) for x in (tmp_path / "_manifest/epochs/0.json").read_text().splitlines()]
    assert [e["part"] for e in entries] == [m.part for m in again] and [m.n_objects for m in again] == [1, 0]


def dead(spark, *rows):
    return spark.createDataFrame([("i", s, b, "[]", "error", T0 + dt.timedelta(seconds=at)) for s, b, at in rows], "instance_id string, sink_name string, batch_id string, payload string, reason string, created_at timestamp")


def test_dead_letters_are_numbered_deleted_and_replayed(spark, tmp_path):
    store = deadletters.DeadLetters(spark, str(tmp_path / "dlq"))
    assert store.last_id() == 0 and store.list().isEmpty() and store.put(dead(spark)) == 0
    assert store.put(dead(spark, ("s", "b2", 2), ("s", "b1", 1), ("t", "b1", 3))) == 3
    assert store.put(dead(spark, ("s", "b0", 0))) == 1
    ids = lambda: {r.dlq_id: (r.sink_name, r.batch_id) for r in store.list(0).collect()}
    assert ids() == {1: ("s", "b1"), 2: ("s", "b2"), 3: ("t", "b1"), 4: ("s", "b0")}
    for _ in range(2):
        store.delete(spark.createDataFrame([(4,), (99,)], "dlq_id long"))
    assert store.last_id() == 4 and set(ids()) == {1, 2, 3}
    status = F.when(F.col("batch_id") == "b2", 503).otherwise(200)
    sink = lambda b: b.select("instance_id", "batch_id", F.lit(1).alias("attempt"), status.alias("status"))
    assert store.replay({"s": ("http", sink)}).count() == 2 and set(ids()) == {2, 3}
    new = store.compact(str(tmp_path / "new"))
    assert new.put(dead(spark, ("s", "b9", 0))) == 1 and {r.dlq_id for r in new.list().collect()} == {2, 3, 5}


def test_reads_are_counted_live(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.log").write_text("one\ntwo\n")
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    with counters.Counters(spark) as found:
        tail.land(spark, str(tmp_path / "logs"), out, mark, page_bytes="4").trigger(availableNow=True).start().awaitTermination()
    assert found.totals[counters.READS, "ok"] == 2 and found.totals[counters.READS, "bytes"] == 8
    assert [tuple(r) for r in found.api_calls().collect()] == [("read_page", "ok", 2)]


def test_many_small_files_are_read_by_few_tasks(tmp_path):
    n = 1_000
    for k in range(n):
        (tmp_path / f"{k:04}.log").write_text(f"line {k}\n" * (k % 3))
    (tmp_path / "9999.log").write_text("x\n" * 1_000)
    reader = tail.LogTail({"path": str(tmp_path), "task_bytes": "600"}).streamReader(None)
    end = reader.latestOffset()
    parts = reader.partitions({}, end)
    assert tail.APART <= len(parts) < n // 4
    rows = [r for p in parts for r in reader.read(p)]
    assert "".join(r[5] for r in rows) == "".join(f"line {k}\n" * (k % 3) for k in range(n)) + "x\n" * 1_000


def test_holes_of_one_task_are_one_note(tmp_path):
    for k in range(200):
        (tmp_path / f"{k:03}.log").write_text(f"line {k}\n")
    files = tail._Files({"path": str(tmp_path)})
    files.opened = lambda part: open(tmp_path / "nowhere")
    reader = tail._TailReader(files)
    first = reader.latestOffset()
    parts = reader.partitions({}, first)
    assert sum(r[8] is not None for p in parts for r in reader.read(p)) == 200
    assert len(os.listdir(tmp_path / ".state" / "unread")) == len(parts) < 200
    (tmp_path / "000.log").write_text("new\n")  # starts over: its hole is gone, the others of its note are not
    again = tail._TailReader(tail._Files({"path": str(tmp_path)}))
    second = again.latestOffset()
    assert sorted(r[5] for p in again.partitions(first, second) for r in again.read(p)) == sorted(["new\n", *(f"line {k}\n" for k in range(1, 200))])
    again.commit(second)
    assert os.listdir(tmp_path / ".state" / "unread") == []


def test_logs_are_written_whole_by_the_executors(spark, tmp_path):
    rows = [(f, c, n, f"é {f} {c} {n}") for f in range(7) for c in range(3) for n in range(2)]
    ordered = spark.createDataFrame(rows, "file_no long, chunk_no long, line_no int, message string").orderBy(F.rand(1))
    queries._write_logs(ordered, str(tmp_path / "logs"), "file={}/part.txt")
    for f in range(7):
        assert (tmp_path / "logs" / f"file={f}" / "part.txt").read_text() == "".join(m + "\n" for g, *_, m in rows if g == f)
    assert len(list((tmp_path / "logs").rglob("*.*"))) == 7


def test_objects_are_listed_and_read_by_tasks(spark, tmp_path):
    root = tmp_path / "root"
    odd = 'a b/ü%1.log'
    rows = [("i/1", "postgres", odd, T0, f"line {k} é", "m", b, k) for b in ("b1", "b2", "", None) for k in range(3)]
    records = spark.createDataFrame(rows, "instance_id string, engine string, log_file string, timestamp timestamp, message string, marker string, batch_id string, line_no int")
    for _ in range(2):
        sinks.write_ndjson(records, str(root))
    assert len(list(root.rglob("*.json.gz"))) == 3 and len([p for p in root.rglob("*") if p.is_file()]) == 3
    got = sinks.read_ndjson(spark, str(root))
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString().replace("FileScan parquet", "")
    assert sorted((r.batch_id or "", r.message) for r in got.collect()) == sorted((r[6] or "", r[4]) for r in rows)
    assert {(r.instance_id, r.log_file, r.timestamp) for r in got.collect()} == {("i/1", odd, T0)}
    (root / "plain").mkdir()
    (root / "plain" / "x.json").write_text('{"message": "in a plain folder"}\n\n')
    assert sinks.read_ndjson(spark, str(root)).count() == 12 and sinks.read_ndjson(spark, str(root), recursive=True).count() == 13
    assert sinks.list_objects(spark, str(root)).count() == 4
