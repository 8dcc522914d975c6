"""Small cases of each operator, with results known in advance."""

import datetime as dt
import gzip
import hashlib
import http.server
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from tailframe.functions import batches as fb
from tailframe.functions import names as fn
from tailframe.operators import audit, batches, checkpoints, delivery, lines, metrics, positions, walk
from tailframe.sources import inventory, sinks, tail
from tailframe.streaming import poll
from tailframe.streaming import tail as streams

T0 = dt.datetime(2026, 4, 19, 12)
CHUNK = "instance_id string, engine string, log_file string, prev_marker string, next_marker string, data string, additional_pending boolean, fetched_at timestamp"


def chunk(spark, *rows):
    return spark.createDataFrame([("db-1", "postgres", "error/postgresql.log", p, n, d, more, T0) for p, n, d, more in rows], CHUNK)


@pytest.mark.parametrize(
    ("engine", "name", "accepted"),
    [
        *(("postgres", n, True) for n in ("error/postgresql.log.2025-01-01", "error/postgresql.log.2025-04-01-00", "error/postgres.log", "error/POSTGRES.LOG")),
        *(("postgres", n, False) for n in ("error/mysql-error.log", "slowquery/mysql-slowquery.log", "")),
        *(("mysql", n, True) for n in ("error/mysql-error.log", "error/mysql-error-running.log", "slowquery/mysql-slowquery.log", "general/mysql-general.log", "error/mariadb-error.log", "error/postgresql.log")),
        *(("mariadb", n, False) for n in ("audit/server_audit.log", "other/something.txt")),
        ("oracle", "anything.log", True),
    ],
)
def test_accepts(spark, engine, name, accepted):
    assert spark.range(1).select(fn.accepts(F.lit(engine), F.lit(name))).head()[0] is accepted


def test_names(spark):
    row = spark.range(1).select(fn.basename(F.lit("a/b/")), fn.basename(F.lit("")), fn.file_label(F.lit("x/" + "y" * 80)), fn.last_written(F.lit(0))).head()
    assert tuple(row) == ("b", "", "y" * 64, None)


def test_split_lines(spark):
    rows = lines.records(chunk(spark, ("", "100", "line 1\nline 2\n\nline 3\n", True))).orderBy("line_no").collect()
    assert [(r.line_no, r.message) for r in rows] == [(0, "line 1"), (1, "line 2"), (3, "line 3")]
    want = hashlib.sha256(b"db-1|error/postgresql.log||100").hexdigest()[:16]
    assert {r.batch_id for r in rows} == {want} and {r.marker for r in rows} == {"100"} and {r.timestamp for r in rows} == {T0}


def test_odd_lines_are_kept(spark):
    rows = lines.split_lines(chunk(spark, ("0", "1", " \r\n\tx\n\n", False), ("1", "2", "", False), ("2", "3", None, False))).collect()
    assert sorted(r.message for r in rows) == ["\tx", " \r"]


def test_batch_id(spark):
    assert spark.range(1).select(fb.batch_id(*map(F.lit, "ifpn"))).head()[0] == "180e2751ad78796a"
    same = spark.range(1).select(fb.batch_id(F.lit("i"), F.lit("f"), F.lit(None).cast("string"), F.lit("n")) == fb.batch_id(F.lit("i"), F.lit("f"), F.lit(""), F.lit("n")))
    assert same.head()[0]


def test_positions(spark):
    listed = spark.createDataFrame([("i", "new", 10), ("i", "grown", 10), ("i", "cut", 10), ("i", "blank", 5)], "instance_id string, log_file string, size long")
    known = spark.createDataFrame([("i", "grown", "m", 9), ("i", "cut", "m", 11), ("i", "blank", "", 5), ("i", "gone", "m", 1)], "instance_id string, log_file string, marker string, file_size long")
    found = {r.log_file: (r.action, r.from_marker) for r in positions.resolve_positions(listed, known).collect()}
    assert found == {"new": ("skip_to_end", None), "grown": ("resume", "m"), "cut": ("reset", "0"), "blank": ("resume", "0")}
    assert {r.log_file: r.action for r in positions.resolve_positions(listed, known, "beginning").collect()}["new"] == "beginning"
    assert [r.log_file for r in positions.rotated_out(known, listed).collect()] == ["gone"]


def test_walks_agree(spark):
    rows = [("0", "m1", "a", True), ("m1", "m2", "b", True), ("m2", "tail", "c", False), ("tail", "x", "d", True)]
    chunks = chunk(spark, *rows).withColumn("chunk_no", F.when(F.col("prev_marker") == "0", 1).when(F.col("prev_marker") == "m1", 2).when(F.col("prev_marker") == "m2", 3).otherwise(4))
    start = spark.createDataFrame([("db-1", "error/postgresql.log", "0")], "instance_id string, log_file string, from_marker string")
    want = [("0", 1), ("m1", 2), ("m2", 3)]
    for drained in (walk.drain_by_ordinal(chunks, start), walk.drain_by_marker(chunks, start), walk.drain_recursive(chunks, start)):
        assert sorted((r.prev_marker, r.hop) for r in drained.collect()) == want
    tails = walk.tail_markers(walk.drain_by_marker(chunks, start)).head()
    assert (tails.tail_marker, tails.hops) == ("tail", 3)


def test_walk_in_a_circle_ends(spark):
    chunks = chunk(spark, ("0", "m1", "a", True), ("m1", "0", "b", True))
    start = spark.createDataFrame([("db-1", "error/postgresql.log", "0")], "instance_id string, log_file string, from_marker string")
    assert walk.drain_by_marker(chunks, start, max_hops=5).count() == 5


def test_page_landed_last_wins(spark):
    late = chunk(spark, ("0", "m2", "a\nb", False)).withColumn("fetched_at", F.lit(T0 + dt.timedelta(hours=1)))
    kept = walk.last_landed(chunk(spark, ("0", "m1", "a", True)).union(late)).collect()
    assert [r.next_marker for r in kept] == ["m2"]


def test_trail_counts_on(spark):
    drained = chunk(spark, ("m0", "m1", "a\nb\n", True), ("m1", "m2", "é\n", False)).withColumn("hop", F.when(F.col("prev_marker") == "m0", 1).otherwise(2))
    before = spark.createDataFrame([("db-1", "error/postgresql.log", 100)], "instance_id string, log_file string, bytes_written long")
    assert [(r.marker, r.bytes_written) for r in checkpoints.checkpoint_trail(drained, before).orderBy("hop").collect()] == [("m1", 104), ("m2", 107)]


def test_checkpoints(spark, tmp_path):
    schema = "instance_id string, log_file string, marker string, updated_at timestamp, seq long, deleted boolean"
    log = spark.createDataFrame([("db-1", "a", "m1", T0, 1, False), ("db-1", "a", "m2", T0, 2, False), ("db-1", "b", "m1", T0, 1, False), ("db-2", "a", "m1", T0, 1, False)], schema)
    now = checkpoints.current_checkpoints(log)
    assert {(r.instance_id, r.log_file): r.marker for r in now.collect()} == {("db-1", "a"): "m2", ("db-1", "b"): "m1", ("db-2", "a"): "m1"}
    assert checkpoints.list_checkpoints(log, "db-1").count() == 2
    gone = log.unionByName(checkpoints.tombstones(log.where("log_file = 'a'"), F.lit(T0), F.lit(9).cast("long")), allowMissingColumns=True)
    assert [r.log_file for r in checkpoints.current_checkpoints(gone).collect()] == ["b"]
    assert checkpoints.compact(gone, str(tmp_path / "compact")).count() == 1
    assert checkpoints.get_checkpoint(log, "db-9", "a").count() == 0


def test_object_key(spark):
    key = spark.range(1).select(fb.object_key("rds/", F.lit("db/1"), F.lit(""), F.lit("postgresql.log"), F.lit(T0), F.lit("b1"))).head()[0]
    assert key == f"rds/db_1/unknown/postgresql.log/2026/04/19/{int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)}-b1.ndjson.gz"


def test_kafka_frame(spark):
    r = sinks.kafka_frame(lines.records(chunk(spark, ("0", "", "x\n", False))), template="logs-{engine}-{instance}").head()
    assert (r.key, r.topic) == ("db-1|error/postgresql.log", "logs-postgres-db-1")
    assert "marker" not in json.loads(r["value"]) and json.loads(r["value"])["message"] == "x"
    assert [h.key for h in r.headers] == ["batch-id", "instance-id", "log-file", "engine"] and bytes(r.headers[1].value) == b"db-1"
    assert sinks.kafka_frame(lines.records(chunk(spark, ("0", "1", "x", False))), topic="t").head().topic == "t"


def test_status_classes(spark):
    codes = [200, 202, 299, 400, 404, 503, 302, 100, 0]
    found = [spark.range(1).select(fb.classify_status(F.lit(c))).head()[0] for c in codes]
    assert found == ["ok"] * 3 + ["permanent"] * 2 + ["transient"] * 4


def attempts(spark, *rows):
    return spark.createDataFrame([("i", b, "s", k, s, 2) for b, k, s in rows], "instance_id string, batch_id string, sink_name string, attempt int, status int, n_records long")


def test_retry_outcome(spark):
    made = [("late", k, 503 if k < 4 else 200) for k in range(1, 6)] + [("never", k, 503) for k in range(1, 6)] + [("refused", 1, 400), ("refused", 2, 200)]
    found = {r.batch_id: (r.attempts, r.outcome) for r in delivery.retry_outcome(attempts(spark, *made), 5).collect()}
    assert found == {"late": (4, "ok"), "never": (5, "transient"), "refused": (1, "permanent")}
    assert {r.batch_id: r.attempts for r in delivery.retry_outcome(attempts(spark, *made), 3).collect()}["never"] == 3


def test_dead_letters(spark):
    rows = delivery.retry_outcome(attempts(spark, ("b1", 1, 400), ("b2", 1, 200), ("b3", 1, 500)), 1)
    rows = rows.withColumn("cancelled", F.col("batch_id") == "b3")
    parked = delivery.route_dlq(rows)
    assert [(r.batch_id, r.reason, r.parked) for r in parked.collect()] == [("b1", "permanent", True)]
    acked = {r.batch_id: r.acked for r in delivery.acknowledged(rows.join(parked.select("batch_id", "parked"), "batch_id", "left"), ["s"]).collect()}
    assert acked == {"b1": True, "b2": True, "b3": False}


def test_empty_batches_are_not_parked(spark):
    rows = delivery.retry_outcome(attempts(spark, ("b", 1, 400)).withColumn("n_records", F.lit(0)), 1)
    assert delivery.route_dlq(rows).isEmpty()


def test_backoff(spark):
    waits = [spark.range(1).select(delivery.backoff_ms(F.lit(k), 500, 2.0, 60_000)).head()[0] for k in (1, 2, 7, 8, 9)]
    assert waits == [500, 1000, 32_000, 60_000, 60_000]


def test_histogram_bounds(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 9.0)], "k string, v double")
    found = {r.le: r.n for r in metrics.histogram(rows, F.col("v"), [1.0, 5.0], "k").collect()}
    assert found == {1.0: 1, 5.0: 2, None: 3}


def test_missing_and_duplicate_lines(spark):
    source = lines.records(chunk(spark, ("0", "1", "x\nx\ny", False)))
    got = source.where("line_no < 2")
    assert [r.message for r in audit.missing_lines(source, got).collect()] == ["y"]
    assert audit.dedupe_lines(got.union(got)).count() == 2
    assert audit.missing_lines(source, source.union(source)).isEmpty()


def test_directory_inventory_and_unchanged(spark, tmp_path):
    (tmp_path / "error").mkdir()
    (tmp_path / "error" / "postgresql.log").write_text("x\n")
    (tmp_path / "notes.txt").write_text("y")
    listed = inventory.list_directory(spark, str(tmp_path), "db-1", "postgres")
    found = inventory.discover_files(listed).collect()
    assert [(r.log_file, r.size) for r in found] == [("error/postgresql.log", 2)]
    known = inventory.discover_files(listed).selectExpr("instance_id", "log_file", "size as file_size", "last_written")
    assert inventory.skip_unchanged(inventory.discover_files(listed), known).isEmpty()


def test_ndjson_retry_replaces_its_object(spark, tmp_path):
    path = str(tmp_path / "out")
    both = lines.records(chunk(spark, ("0", "1", "a\nb", True), ("1", "2", "c", False)))
    sinks.write_ndjson(both, path)
    sinks.write_ndjson(both.where("message = 'c'"), path)
    assert sorted(r.message for r in sinks.read_ndjson(spark, path).collect()) == ["a", "b", "c"]
    assert len(list((tmp_path / "out").rglob("*.json.gz"))) == 2


class _Hook(http.server.BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        tries = sum(s[0] == self.headers["X-Batch-Id"] for s in self.seen)
        self.seen.append((self.headers["X-Batch-Id"], len(body)))
        self.send_response(400 if body[0]["message"] == "bad" else 503 if not tries else 200)
        self.end_headers()

    def log_message(self, *args):
        pass


def test_webhooks(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Hook)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        frame = sinks.webhook_frame(lines.records(chunk(spark, ("0", "1", "a\nb", True), ("1", "2", "bad", False), ("2", "3", "", False))))
        post = lambda b: sinks.post_webhooks(b, f"http://127.0.0.1:{server.server_port}", initial_ms=1)
        sent = sinks.deliver(frame, {"siem": ("http", post)})
        assert sorted(r.status for r in sent.collect()) == [200, 400, 503]
        assert sorted(n for _, n in _Hook.seen) == [1, 2, 2]
        assert {r.outcome for r in delivery.retry_outcome(sent).collect()} == {"ok", "permanent"}
    finally:
        server.shutdown()


def test_coalesced_batches(spark):
    sizes = spark.createDataFrame([("i", "f", k, 40) for k in range(5)], "instance_id string, log_file string, chunk_no int, batch_bytes long")
    assert [r.bucket for r in batches.coalesce_batches(sizes, 100).orderBy("chunk_no").collect()] == [0, 0, 0, 1, 1]


def test_live_tail_lands_what_is_appended(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    out, mark = str(tmp_path / "chunks"), str(tmp_path / "mark")
    for text in ("one\ntwo\n", "three\n"):
        with (logs / "postgresql.log").open("a") as f:
            f.write(text)
        tail.land(spark, str(logs), out, mark, page_bytes="5", engine="postgres").trigger(availableNow=True).start().awaitTermination()
    chunks = tail.read_chunks(spark, out)
    assert b"".join(r.data.encode() for r in sorted(chunks.collect(), key=lambda r: int(r.prev_marker))) == b"one\ntwo\nthree\n"
    assert chunks.where("not additional_pending").count() == 2


def test_failing_sink_loses_nothing(spark, tmp_path):
    """Sinks that fail, restarts on one checkpoint: every source line is delivered at least once."""
    folder, out, mark = str(tmp_path / "landed"), str(tmp_path / "got"), str(tmp_path / "mark")
    source = chunk(spark, *((str(k), str(k + 1), "".join(f"{k}-{i}\n" for i in range(25)), True) for k in range(8)))
    source.repartition(8, "prev_marker").write.parquet(folder)
    calls = []

    def flaky(rows, epoch):
        calls.append(epoch)
        if len(calls) % 3 == 1:
            raise RuntimeError("sink down")
        rows.write.mode("append").parquet(out)

    for _ in range(20):
        try:
            streams.run_to_end(streams.tail_records(spark, folder, source.schema, 1), "flaky", each=flaky, checkpoint=mark)
            break
        except Exception as e:  # the stream stops as its sink does, and is started again
            assert "sink down" in str(e)
    delivered = spark.read.parquet(out)
    assert audit.missing_lines(lines.records(source), delivered).isEmpty()
    assert audit.dedupe_lines(delivered).count() == 200


def test_polling_starts_at_once(spark, tmp_path):
    source = chunk(spark, ("0", "1", "a\nb", False))
    folder = str(tmp_path / "landed")
    source.write.parquet(folder)
    out = str(tmp_path / "out")
    query = streams.poll(streams.tail_records(spark, folder, source.schema), lambda rows, epoch: rows.write.mode("append").parquet(out), str(tmp_path / "mark"), 1)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == 2
    with pytest.raises(ValueError):
        streams.poll(source, None, "", 0)


def test_dead_letters_are_stored_and_replayed(spark, tmp_path):
    path = str(tmp_path / "dlq")
    dead = spark.createDataFrame([("i", f"b{k}", "siem", "[]", "error", T0 + dt.timedelta(days=3 - k)) for k in range(3)], "instance_id string, batch_id string, sink_name string, payload string, reason string, created_at timestamp")
    delivery.dlq_put(dead, path)
    delivery.dlq_put(dead.limit(1), path, after=3)
    stored = spark.read.parquet(path)
    assert [(r.dlq_id, r.batch_id) for r in delivery.dlq_list(stored, -1).collect()] == [(1, "b2"), (2, "b1"), (3, "b0"), (4, "b0")]
    answer = F.when(F.col("batch_id") == "b1", 503).otherwise(200)
    sink = lambda b: b.select("instance_id", "batch_id", F.lit(1).alias("attempt"), answer.alias("status"))
    attempts, left = sinks.replay(stored, {"siem": ("http", sink)})
    assert attempts.count() == 4 and [r.dlq_id for r in left.collect()] == [2]


def test_unreadable_file_holds_up_no_other(tmp_path):
    (tmp_path / "a.log").write_text("x\n")
    os.symlink(tmp_path / "nowhere", tmp_path / "b.log")
    reader = tail.LogTail({"path": str(tmp_path)}).streamReader(None)
    offset = reader.latestOffset()
    assert offset == {"a.log": 2} and [(p.name, bool(p.error)) for p in reader.partitions({}, offset)] == [("a.log", False), ("b.log", True)]
    assert [row[5] for p in reader.partitions({"a.log": 9}, offset) for row in reader.read(p)] == ["x\n", None]
    os.remove(tmp_path / "a.log")
    reader.commit(offset)
    assert reader.latestOffset() == {}


def test_dedupe_stream_keeps_late_first_deliveries(spark, tmp_path):
    folder, schema = str(tmp_path / "late"), None
    for days in (9, 5, 0, 9):  # the newest lands first; it lands again at the end
        page = chunk(spark, (f"m{days}", f"m{days + 1}", f"line of day {days}", True)).withColumn("fetched_at", F.lit(T0 + dt.timedelta(days=days)))
        page.coalesce(1).write.mode("append").parquet(folder)
        schema = page.schema
    out = streams.run_to_end(streams.dedupe_stream(streams.tail_records(spark, folder, schema, 1)), "late-deduped")
    assert sorted(r.message for r in spark.read.parquet(out).collect()) == [f"line of day {k}" for k in (0, 5, 9)]


def test_recursive_walk_goes_on_past_the_limit_of_recursion(spark):
    chunks = chunk(spark, *((str(k), str(k + 1), "a", k < 199) for k in range(200)))
    start = spark.createDataFrame([("db-1", "error/postgresql.log", "0")], "instance_id string, log_file string, from_marker string")
    assert sorted((r.hop, r.prev_marker) for r in walk.drain_recursive(chunks, start).collect()) == [(k + 1, str(k)) for k in range(200)]


def answering(status, only=""):
    """A sink that gives one status to batches with lines that begin so, and 200 to the rest."""
    answer = F.when(F.col("payload").contains(f'"message":"{only}'), status).otherwise(200).alias("status")
    return lambda b: b.select("instance_id", "engine", "log_file", "batch_id", F.lit(1).alias("attempt"), answer, "n_records", "batch_bytes", F.lit(T0).alias("attempted_at"))


LOG = "instance_id string, log_file string, marker string, bytes_written long, file_size long, last_written timestamp, updated_at timestamp, seq long, deleted boolean"


def polled(spark, known, size, pages, sink, **how):
    listed = spark.createDataFrame([("db-1", "postgres", "error/postgresql.log", size, 0)], "instance_id string, engine string, log_file string, size long, last_written_ms long")
    log = spark.createDataFrame([("db-1", "error/postgresql.log", m, b, s, T0, T0, 0, False) for m, b, s in known], LOG)
    found = poll.poll_once(listed, log, chunk(spark, *pages), {"siem": ("http", sink)}, F.lit(T0 + dt.timedelta(hours=1)), **how)
    now = checkpoints.current_checkpoints(log.unionByName(found.positions))
    return [(r.marker, r.bytes_written, r.file_size) for r in now.collect()], found


PAGES = [("m0", "m1", "a\nb\n", True), ("m1", "m2", "c\n", False), ("0", "m0", "before\n", True)]


def test_poll_resumes_and_counts_on(spark):
    now, found = polled(spark, [("m0", 7, 7)], 14, PAGES, answering(200))
    assert now == [("m2", 13, 14)] and found.attempts.count() == 2 and found.dead.isEmpty()


def test_poll_of_a_new_file_from_its_end_sends_nothing_and_stores_the_end(spark):
    now, found = polled(spark, [], 14, PAGES, answering(200))
    assert now == [("m2", 0, 14)] and found.attempts.isEmpty()


def test_poll_of_a_truncated_file_starts_over(spark):
    now, found = polled(spark, [("oldBig", 5000, 5000)], 6, [("0", "mNew", "fresh\n", False)], answering(200))
    assert now == [("mNew", 5006, 6)] and found.attempts.count() == 1  # bytes written go on counting


def test_position_waits_for_a_sink_that_fails_unless_its_batch_is_parked(spark):
    now, found = polled(spark, [("m0", 7, 7)], 14, PAGES, answering(503), park=False)
    assert now == [("m0", 7, 7)] and found.dead.isEmpty()
    now, _ = polled(spark, [("m0", 7, 7)], 14, PAGES, answering(503, "c"), park=False)
    assert now == [("m1", 11, 14)]
    now, found = polled(spark, [("m0", 7, 7)], 14, PAGES, answering(503, "c"))
    assert now == [("m2", 13, 14)] and [json.loads(r.payload)[0]["message"] for r in found.dead.collect()] == ["c"]


def test_stream_position_waits_and_what_was_refused_is_sent_again(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("landed", "out", "mark"))
    numbered = lambda *rows: chunk(spark, *rows).withColumn("chunk_no", F.col("prev_marker").cast("int")).coalesce(1)
    page = numbered(("1", "2", "a\n", True), ("2", "3", "b\n", True), ("3", "4", "c\n", True))
    page.write.mode("append").parquet(folder)
    source = lambda: streams.tail_chunks(spark, folder, page.schema)
    position = lambda: [(r.marker, r.bytes_written) for r in checkpoints.current_checkpoints(spark.read.parquet(f"{out}/positions")).collect()]
    go = lambda sink, park=False: streams.run_to_end(source(), "s", each=streams.fan_out_batch({"siem": ("http", sink)}, out, park, "chunk_no"), checkpoint=mark)
    go(answering(503, "b"))
    assert position() == [("2", 2)]
    numbered(("4", "5", "\n", True)).write.mode("append").parquet(folder)  # no lines: nothing to send, but no way past what waits
    go(answering(503, "b"))
    assert position() == [("2", 2)] and spark.read.parquet(f"{out}/attempts").count() == 4
    numbered(("5", "6", "d\n", False)).write.mode("append").parquet(folder)
    go(answering(200))
    assert position() == [("6", 9)] and spark.read.parquet(f"{out}/attempts").count() == 6
    numbered(("6", "7", "b\n", False)).write.mode("append").parquet(folder)
    go(answering(503, "b"), True)
    assert position() == [("7", 11)] and spark.read.parquet(f"{out}/dead").count() == 1


def test_live_dead_letters_and_odd_names(spark, tmp_path):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Hook)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        odd = chunk(spark, ("8", "9", "bad", False)).withColumn("log_file", F.lit("error/журнал\n.log"))
        frame = sinks.webhook_frame(lines.records(odd))
        post = lambda port: lambda b: sinks.post_webhooks(b, f"http://127.0.0.1:{port}", max_attempts=2, initial_ms=1)
        sent = sinks.deliver(frame, {"siem": ("http", post(server.server_port)), "gone": ("http", post(1))})
        outcomes = delivery.retry_outcome(sent)
        assert {(r.sink_name, r.outcome, r.log_file, r.engine) for r in outcomes.collect()} == {("siem", "permanent", "error/журнал\n.log", "postgres"), ("gone", "transient", "error/журнал\n.log", "postgres")}
        delivery.dlq_put(delivery.with_payload(delivery.route_dlq(outcomes), frame), str(tmp_path / "dlq"))
        stored = spark.read.parquet(str(tmp_path / "dlq"))
        assert sorted(r.dlq_id for r in stored.collect()) == [1, 2] and {r.message for r in delivery.dlq_records(stored).collect()} == {"bad"}
        failed = metrics.failed_total(delivery.made_attempts(sent)).collect()
        assert {(r.reason, r.n) for r in failed} == {("permanent", 1), ("error", 2)}
    finally:
        server.shutdown()


def test_dead_letters_without_a_time_are_numbered_first(spark):
    rows = [("i", "b1", "s", T0), ("i", "b2", "s", None), ("i", "b3", "s", T0 + dt.timedelta(seconds=1)), ("i", "b0", "s", T0), ("i", "b4", "s", T0 - dt.timedelta(days=3))]
    got = delivery.dlq_ids(spark.createDataFrame(rows, "instance_id string, batch_id string, sink_name string, attempted_at timestamp"), 10).collect()
    assert {r.batch_id: r.dlq_id for r in got} == {"b2": 11, "b4": 12, "b0": 13, "b1": 14, "b3": 15}


def test_objects_under_their_keys(spark, tmp_path):
    frame = batches.assemble_batches(lines.records(chunk(spark, ("0", "1", 'a "q"\nb, c', True), ("1", "2", "é", False))))
    for _ in range(2):
        sent = sinks.deliver(frame, {"cold": ("s3", lambda b: sinks.write_objects(b, str(tmp_path), "rds/", "key"))})
    made = {r.object_key: r.sse for r in sent.collect()}
    files = [p for p in tmp_path.rglob("*") if p.is_file()]
    assert {str(p.relative_to(tmp_path)) for p in files} == set(made) and set(made.values()) == {"aws:kms"}
    assert sorted(json.loads(x)["message"] for p in files for x in gzip.decompress(p.read_bytes()).decode().splitlines()) == ['a "q"', "b, c", "é"]
    broken = sinks.write_objects(frame, "/proc/nowhere")
    assert {(r.status, bool(r.error)) for r in broken.collect()} == {(0, True)}


@pytest.mark.parametrize("page", range(1, 10))
def test_pages_keep_every_byte(tmp_path, page):
    text = "aé\n日本語 😀x\n\n" + "ü" * 40 + "\nend€"
    (tmp_path / "a.log").write_text(text)
    for task in (7, 1000):
        reader = tail.LogTail({"path": str(tmp_path), "page_bytes": str(page), "task_bytes": str(task)}).reader(None)
        rows = [r for p in reader.partitions() for r in reader.read(p)]
        assert "".join(r[5] for r in rows) == text
        assert [r[3] for r in rows][1:] == [r[4] for r in rows][:-1] and [r[6] for r in rows] == [True] * (len(rows) - 1) + [False]


def test_a_growing_file_is_never_read_inside_a_character(tmp_path):
    data = "é€😀".encode()
    path, got, start = tmp_path / "a.log", "", {}
    for n in range(len(data) + 1):
        path.write_bytes(data[:n])
        reader = tail.LogTail({"path": str(tmp_path)}).streamReader(None)
        end = reader.latestOffset()
        got += "".join(r[5] for p in reader.partitions(start, end) for r in reader.read(p))
        start = end
    assert got == "é€😀"


def test_cursors_and_errors_as_rows(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    os.symlink(tmp_path / "nowhere", tmp_path / "b.log")
    rows = tail.read_pages(spark, str(tmp_path), cursors='{"a.log": 4}').collect()
    assert sorted((r.log_file, r.prev_marker, r.data, r.error is None) for r in rows) == [("a.log", "4", "two\n", True), ("b.log", "0", None, False)]


def test_published_version(spark, tmp_path):
    log = spark.createDataFrame([("db-1", "a", "m1", 0, 0, T0, T0, 1, False), ("db-1", "a", "m2", 0, 0, T0, T0, 2, False)], LOG)
    checkpoints.publish(log.where("seq = 1"), str(tmp_path))
    checkpoints.publish(log, str(tmp_path))
    assert [r.marker for r in checkpoints.published(spark, str(tmp_path)).collect()] == ["m2"]
    assert sorted(os.listdir(tmp_path))[0] == "pointer" and len(os.listdir(tmp_path)) == 3


def test_truncations_across_spans(spark):
    sizes = [5, 7, 3, 3, 9, 1, 0, 2]
    polls = spark.createDataFrame([("i", "f", k, s) for k, s in enumerate(sizes)], "instance_id string, log_file string, poll_id long, size long")
    for span in (1, 2, 3, 100):
        got = positions.truncations(polls, span).orderBy("poll_id").collect()
        assert [(r.prev_size, r.truncated, r.generation) for r in got] == [(None, False, 0), (5, False, 0), (7, True, 1), (3, False, 1), (3, False, 1), (9, True, 2), (1, True, 3), (0, False, 3)]


def test_missing_acknowledgements(spark):
    made = spark.createDataFrame([("i", "b1"), ("i", "b2")], "instance_id string, batch_id string")
    names = spark.createDataFrame([("s",), ("t",)], "sink_name string")
    assert sinks.required(made, names).count() == 4
    with pytest.raises(ValueError):
        delivery.fan_out(made, names, max_sinks=1)
