"""Delivery ledger, live source with holes, spans, epoch log and thread-safe storage."""

import datetime as dt
import json
import os
import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailframe import storage
from tailframe.functions.batches import batch_id
from tailframe.operators import batches, checkpoints, lines
from tailframe.schemas import LOG_PAGE
from tailframe.sources import sinks, tail
from tailframe.streaming import outbox
from tailframe.streaming import tail as streams

T0 = dt.datetime(2026, 4, 19, 12)
ONCE = sinks.Retry(max_attempts=1)


def page(a, b, data="x\n", error=None, generation=0, ms=0, file="f"):
    return ("i", "postgres", file, str(a), str(b), data, True, T0 + dt.timedelta(milliseconds=ms), error, generation, a)


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), LOG_PAGE)


def box(spark, tmp_path, send, **how):
    """(run an epoch on pages, positions, ok attempts): one in-order sink that answers by ``send``."""
    out = str(tmp_path / "out")
    each = outbox.fan_out_batch({"siem": ("http", sinks.in_order(lambda: send, ONCE))}, out, order=["generation", "start_byte"], **how)
    position = lambda: {r.log_file: (r.marker, r.bytes_written) for r in checkpoints.current_checkpoints(spark.read.parquet(f"{out}/positions")).collect()}
    return each, position, lambda: spark.read.parquet(f"{out}/attempts")


def answering(status, marks=()):
    """Refuses batches whose payload holds one of ``marks``."""
    return lambda row: (status if any(m in row.payload for m in marks) else 200, None)


def test_position_does_not_pass_a_page_that_was_fetched_later(spark, tmp_path):
    each, position, attempts = box(spark, tmp_path, answering(503, ["bad"]))
    each(pages(spark, page(0, 10, "bad\n", ms=5), page(10, 20, "good\n", ms=0)), 0)
    assert position() == {} and attempts().count() == 1  # nothing behind it is sent
    with pytest.raises(ValueError):
        outbox.fan_out_batch({}, str(tmp_path / "x"), order="fetched_at")(pages(spark), 0)


def test_position_does_not_pass_what_could_not_be_read(spark, tmp_path):
    each, position, attempts = box(spark, tmp_path, answering(200))
    each(pages(spark, page(0, 0, None, "unreadable"), page(10, 20), page(5, 5, None, "unreadable", file="g")), 0)
    assert position() == {} and attempts().count() == 1
    each(pages(spark), 1)
    each(pages(spark, page(0, 10, ms=9)), 2)
    assert position() == {"f": ("20", 4)}
    each(pages(spark, page(0, 10, ms=10)), 3)  # once more: sent again, the position stays
    assert position() == {"f": ("20", 4)} and attempts().count() == 3


def test_page_that_comes_twice_at_once_is_sent_once(spark, tmp_path):
    each, position, attempts = box(spark, tmp_path, answering(200))
    each(pages(spark, page(0, 10, "a\n"), page(0, 10, "a\n", ms=1), page(10, 20, "b\n")), 0)
    assert position() == {"f": ("20", 4)} and sorted(r.n_records for r in attempts().collect()) == [1, 1]


def test_page_that_has_grown_takes_the_place_of_what_it_was(spark, tmp_path):
    each, position, attempts = box(spark, tmp_path, answering(503, ["bad"]))
    each(pages(spark, page(0, 10, "bad\n")), 0)
    each(pages(spark, page(0, 15, "good\n", ms=9), page(15, 20, "more\n")), 1)  # before the sink had it
    assert position() == {"f": ("20", 10)} and attempts().count() == 3
    each(pages(spark, page(15, 30, "more and more\n", ms=9), page(30, 40, "end\n")), 2)  # after it was passed
    assert position() == {"f": ("40", 28)}
    assert outbox.Outbox(spark, str(tmp_path / "out"), LOG_PAGE, ["generation", "start_byte"]).waiting(3).isEmpty()


def test_truncated_file_goes_on_from_its_start(spark, tmp_path):
    each, position, _ = box(spark, tmp_path, answering(503, ["bad"]))
    each(pages(spark, page(0, 10)), 0)
    each(pages(spark, page(20, 30), page(0, 5, generation=1)), 1)  # what was missing between 10 and 20 is gone
    assert position() == {"f": ("5", 6)}
    each(pages(spark, page(5, 9, "bad\n", generation=1), page(0, 3, generation=2)), 2)
    assert position() == {"f": ("5", 6)}


def test_positions_go_on_from_where_files_are_known(spark, tmp_path):
    known = spark.createDataFrame([("i", "f", "10", 1_000), ("i", "g", "10", 1_000)], "instance_id string, log_file string, marker string, bytes_written long")
    each, position, _ = box(spark, tmp_path, answering(200), starts=known)
    each(pages(spark, page(10, 20), page(20, 30, file="g")), 0)
    assert position() == {"f": ("20", 1_002)}


def test_healthy_sink_gets_each_batch_once_and_an_outage_costs_one_batch_a_file(spark, tmp_path):
    out = str(tmp_path / "out")
    down = {"siem": True}
    siem = lambda b: sinks.in_order(lambda s=503 if down["siem"] else 200: lambda row: (s, None), ONCE)(b)
    good = answering(200)
    each = outbox.fan_out_batch({"siem": ("http", siem), "cold": ("s3", sinks.in_order(lambda: good, ONCE))}, out, order=["generation", "start_byte"], every=2)
    for epoch in range(5):
        each(pages(spark, page(2 * epoch, 2 * epoch + 2), page(2 * epoch, 2 * epoch + 2, file="g")), epoch)
    count = lambda: {(r.sink_name, r.status): r["count"] for r in spark.read.parquet(f"{out}/attempts").groupBy("sink_name", "status").count().collect()}
    assert count() == {("cold", 200): 10, ("siem", 503): 10}
    down["siem"] = False
    each(pages(spark), 5)
    assert count() == {("cold", 200): 10, ("siem", 503): 10, ("siem", 200): 10}
    ends = checkpoints.current_checkpoints(spark.read.parquet(f"{out}/positions")).collect()
    assert {(r.log_file, r.marker, r.bytes_written) for r in ends} == {("f", "10", 10), ("g", "10", 10)}
    each(pages(spark), 6)
    assert count()[("siem", 200)] == 10 and outbox.Outbox(spark, out, LOG_PAGE, ["generation", "start_byte"], 2).waiting(7).isEmpty()


def test_refused_batches_wait_before_they_are_sent_again(spark, tmp_path):
    each, _, attempts = box(spark, tmp_path, answering(503, ["x"]), wait=sinks.Retry(initial_ms=3_600_000, longest_ms=7_200_000))
    each(pages(spark, page(0, 2)), 0)
    each(pages(spark, page(2, 4)), 1)
    assert attempts().count() == 1


def test_repeated_epoch_changes_nothing(spark, tmp_path):
    each, position, attempts = box(spark, tmp_path, answering(503, ["bad"]))
    for epoch in (0, 1, 1, 2, 2):
        each(pages(spark, page(4 * epoch, 4 * epoch + 4, "bad\n" if epoch == 2 else "abc\n")), epoch)
        assert position()["f"] == (str(min(4 * epoch + 4, 8)), min(4 * epoch + 4, 8))
    assert attempts().count() == 3


def test_chaos(spark, tmp_path):
    """Two sinks that refuse 30 % of what they are sent, pages in any order of time and landing: each line reaches each sink, in order, and no position is ahead."""
    rng = random.Random(11)
    made = [page(10 * k, 10 * k + 10, f"{file}-{k}\n", ms=rng.randint(0, 5), file=file) for file in "fg" for k in range(4)]
    rng.shuffle(made)
    for file in "fg":  # each file's first page lands in the first micro-batch
        made.sort(key=lambda p: p[10] != 0)
    out = str(tmp_path / "out")
    flaky = lambda salt: sinks.in_order(lambda: lambda row: (503 if hash((salt, row.batch_id, row.tries)) % 10 < 3 else 200, None), ONCE)
    each = outbox.fan_out_batch({"a": ("http", flaky(1)), "b": ("s3", flaky(2))}, out, order=["generation", "start_byte"], every=3)
    key = batch_id(F.lit("i"), F.col("log_file"), F.col("prev_marker"), F.col("next_marker"))
    at = {(r.id): (r.log_file, r.start_byte) for r in pages(spark, *made).select(key.alias("id"), "log_file", "start_byte").collect()}
    for epoch in range(14):
        each(pages(spark, *made[4 * epoch : 4 * epoch + 4]), epoch)
        ok = spark.read.parquet(f"{out}/attempts").where("status = 200").collect()
        have = {s: {at[r.batch_id] for r in ok if r.sink_name == s} for s in "ab"}
        for r in checkpoints.current_checkpoints(spark.read.parquet(f"{out}/positions")).collect():
            assert all((r.log_file, b) in have[s] for s in "ab" for b in range(0, int(r.marker), 10))
        if epoch >= 1 and all(len(have[s]) == len(made) for s in "ab"):
            break
    assert all(len(have[s]) == len(made) for s in "ab") and len(ok) == 2 * len(made)
    ends = checkpoints.current_checkpoints(spark.read.parquet(f"{out}/positions")).collect()
    assert {(r.log_file, r.marker, r.bytes_written) for r in ends} == {(f, "40", 16) for f in "fg"}


def test_refused_batch_arrives_with_no_new_data(spark, tmp_path):
    folder, out = str(tmp_path / "landed"), str(tmp_path / "out")
    made = pages(spark, page(0, 2))
    made.write.parquet(folder)
    sink = sinks.in_order(lambda: lambda row: (503 if row.tries < 2 else 200, None), ONCE)
    stream = outbox.with_ticks(streams.tail_chunks(spark, folder, made.schema))
    query = streams.poll(stream, outbox.fan_out_batch({"siem": ("http", sink)}, out, order=["generation", "start_byte"]), str(tmp_path / "mark"), 1)
    try:
        outbox.wait_until_empty(spark, out, made.schema, query, ["generation", "start_byte"], seconds=120)
    finally:
        query.stop()
    assert [r.status for r in spark.read.parquet(f"{out}/attempts").orderBy("attempted_at").collect()] == [503, 503, 200]


def test_payloads_and_old_epochs_go_once_no_sink_lacks_them(spark, tmp_path):
    """A sink refuses one file for two micro-batches: what waits is kept, what every sink has goes, and a repetition finds all it needs."""
    each, position, attempts = box(spark, tmp_path, lambda row: (503 if row.log_file == "g" and row.tries < 2 else 200, None), every=2)
    names = lambda folder: sorted(p.name for p in (tmp_path / "out" / folder).iterdir() if not p.name.startswith((".", "_")))
    kept = []
    for epoch in (0, 1, 2, 3, 3, 4, 5, 5):
        each(pages(spark, page(2 * epoch, 2 * epoch + 2), *([page(0, 2, file="g")] if epoch == 1 else [])), epoch)
        kept.append([int(n[len("epoch=") :]) for n in names("payloads")])
    # The batch of "g" is taken in epoch 3, which is repeated: until 4 its payload stays.
    assert kept == [[0], [1], [1, 2], [1, 3], [1, 3], [4], [5], [5]]
    assert position() == {"f": ("12", 12), "g": ("2", 2)} and attempts().where("status = 200").count() == 7
    for log in ("lacks", "ahead", "files"):
        assert names(log) == ["epoch=4", "epoch=5", "snapshot-4", "snapshot-6"]


# -- sinks ------------------------------------------------------------------------------------------------------


def frame(spark, *texts):
    rows = [("i", "postgres", "f", str(k), str(k + 1), t, True, T0) for k, t in enumerate(texts)]
    chunks = spark.createDataFrame(rows, T.StructType(LOG_PAGE.fields[:8]))
    return batches.assemble_batches(lines.records(chunks))


def test_rounds_send_again_only_what_may_pass(spark):
    rounds = []

    def sink(b):
        rounds.append(b.count())
        status = F.when(F.col("payload").contains("bad"), 400).when(F.col("payload").contains("late") & F.lit(len(rounds) < 3), 503).otherwise(200)
        return b.select("instance_id", "batch_id", F.lit(1).alias("attempt"), status.alias("status"))

    made = sinks.with_retries(sink, sinks.Retry(5, 1))(frame(spark, "fine", "late", "bad")).collect()
    assert rounds == [3, 1, 1] and sorted((r.attempt, r.status) for r in made) == [(1, 200), (1, 400), (1, 503), (2, 503), (3, 200)]


def test_objects_are_tried_again_until_the_store_is_back(spark, tmp_path):
    root = tmp_path / "store"
    root.write_text("in the way")  # a file where the folder should be
    one = frame(spark, "a")
    assert [r.status for r in sinks.write_objects(one, str(root), retry=sinks.Retry(5, 1)).collect()] == [0]  # can't pass: tried once
    timer = threading.Timer(2, lambda: os.rename(root, tmp_path / "gone"))
    timer.start()
    made = sinks.with_retries(lambda b: sinks.write_objects(b, str(root)), sinks.Retry(20, 500, 500))(one).collect()
    assert len(made) > 1 and made[-1].status == 200 and {r.status for r in made[:-1]} == {0}


# -- live source ------------------------------------------------------------------------------------------------


class Failing(tail._Files):
    """Fails on its first reads, some bytes in."""

    fails, good = 0, 2

    def opened(self, part):
        f = super().opened(part)
        if self.fails:
            self.fails -= 1
            read, left = f.read, [self.good]

            def broken(n):
                left[0] -= 1
                if left[0] < 0:
                    raise OSError("gone")
                return read(n)

            class Half:
                seek = f.seek
                read = staticmethod(broken)
                __enter__ = lambda self: self
                __exit__ = lambda self, *a: f.close()

            return Half()
        return f


@pytest.mark.parametrize("fails", [1, 2, 5])
def test_holes_are_read_at_last(tmp_path, fails):
    text = "".join(f"line {k} of the file\n" for k in range(40)) + "x" * 100
    (tmp_path / "a.log").write_text(text)
    files = Failing({"path": str(tmp_path), "page_bytes": "64", "task_bytes": "200"})
    files.fails = fails
    reader, start, got, errors = tail._TailReader(files), {}, {}, 0
    for _ in range(12):
        end = reader.latestOffset()
        if end == start:
            break
        for p in reader.partitions(start, end):
            for r in reader.read(p):
                errors += r[8] is not None
                if r[8] is None:
                    assert r[3] not in got
                    got[r[3]] = (r[4], r[5])
        reader.commit(end)
        start = end
    assert 1 <= errors <= fails and os.listdir(tmp_path / ".state" / "unread") == []
    at, whole = "0", ""
    while at in got:
        at, data = got[at]
        whole += data
    assert whole == text


def test_holes_outlive_the_reader(tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    options = {"path": str(tmp_path), "page_bytes": "4"}
    files = Failing(options)
    files.fails = files.good = 1
    reader = tail._TailReader(files)
    first = reader.latestOffset()
    rows = [r for p in reader.partitions({}, first) for r in reader.read(p)]
    assert [r[8] is None for r in rows] == [True, False]
    again = tail._TailReader(tail._Files(options))
    second = again.latestOffset()
    assert [r[5] for p in again.partitions(first, second) for r in again.read(p)] == ["two\n"]
    assert [r[5] for p in again.partitions(first, second) for r in again.read(p)] == ["two\n"]  # a replay reads the same
    third = tail._TailReader(tail._Files(options)).latestOffset()
    assert third == {"a.log": 8}


def test_truncations_are_counted_on_after_a_restart(tmp_path):
    options = {"path": str(tmp_path)}
    start = {}
    seen = []
    for text in ("aaaa\n", "b\n", "b\ncc\n", "d\n"):
        (tmp_path / "a.log").write_text(text)
        reader = tail._TailReader(tail._Files(options))
        end = reader.latestOffset()
        seen += [(r[9], r[10], r[5]) for p in reader.partitions(start, end) for r in reader.read(p)]
        start = end
    assert seen == [(0, 0, "aaaa\n"), (1, 0, "b\n"), (1, 2, "cc\n"), (2, 0, "d\n")]


def test_filters_choose_files_before_they_are_opened(spark, tmp_path):
    (tmp_path / "postgresql.log").write_text("one\n")
    (tmp_path / "postgresql.log.1").write_text("two\n")
    os.symlink(tmp_path / "nowhere", tmp_path / "mysql.log")
    key = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(key, "true")
    try:
        read = tail.read_pages(spark, str(tmp_path))
        assert {r.log_file for r in read.collect()} == {"postgresql.log", "postgresql.log.1", "mysql.log"}
        hinted = read.where(F.contains("log_file", F.lit("postgres")))
        assert hinted.rdd.getNumPartitions() == 2 and {r.data for r in hinted.collect()} == {"one\n", "two\n"}
        one = read.where("log_file = 'postgresql.log'")
        assert one.rdd.getNumPartitions() == 1 and "= postgresql.log)" not in one._jdf.queryExecution().executedPlan().toString() and [r.data for r in one.collect()] == ["one\n"]
        assert read.where("log_file like 'mysql%'").rdd.getNumPartitions() == 1
    finally:
        spark.conf.set(key, "false")
    assert tail.read_pages(spark, str(tmp_path)).where("log_file = 'postgresql.log'").count() == 1


# -- spans ------------------------------------------------------------------------------------------------------


def test_spans():
    rng = random.Random(4)
    for _ in range(200):
        spans, held = [], set()
        for _ in range(20):
            a = rng.randint(0, 30)
            b = a + rng.randint(1, 4)
            spans, held = streams.add_span(spans, a, b), held | set(range(a, b))
            assert {x for s in spans for x in range(*s)} == held and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_chunks_are_kept_once_with_a_state_row_a_file(spark, tmp_path):
    folder = str(tmp_path / "landed")
    rows = [page(10 * k, 10 * k + 10, f"{f}{k}", generation=g, file=f) for f in "fgh" for g in (0, 1) for k in range(8)]
    for part in (rows[::2], rows[1::2], rows, rows[:5]):
        pages(spark, *part).withColumn("end", F.col("start_byte") + 10).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    out = streams.run_to_end(streams.dedupe_chunks(streams.tail_chunks(spark, folder, schema, 1), "start_byte", "end"), "deduped", checkpoint=str(tmp_path / "mark"))
    kept = spark.read.parquet(out)
    assert kept.count() == len(rows) and kept.dropDuplicates(["log_file", "generation", "start_byte"]).count() == len(rows)
    progress = [json.loads(line) for f in (tmp_path / "mark" / "commits").iterdir() if f.name.isdigit() for line in f.read_text().splitlines()[1:]]
    assert progress
    state = spark.read.format("statestore").option("stateVarName", "spans").load(str(tmp_path / "mark"))
    assert state.count() == 3


# -- storage ----------------------------------------------------------------------------------------------------


def test_scratch_keeps_other_threads_tables(spark):
    inside, done, found = threading.Event(), threading.Event(), []

    def other():
        with storage.scratch(spark):
            inside.set()
            done.wait(30)
            found.append(storage.staged(spark.range(2), "inside"))

    t = threading.Thread(target=other)
    t.start()
    inside.wait(30)
    mine = storage.staged(spark.range(3), "outside")
    done.set()
    t.join()
    assert mine.count() == 3
    with pytest.raises(Exception, match="FAILED_READ_FILE|PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        found[0].collect()


def test_setting_of_writers_is_restored_by_the_last(spark):
    spark.conf.set(storage._FREE_SHUFFLES, "false")
    with storage._freeing(spark):
        with storage._freeing(spark):
            pass
        assert spark.conf.get(storage._FREE_SHUFFLES) == "true"
    assert spark.conf.get(storage._FREE_SHUFFLES) == "false"


def test_epoch_log_reads_a_snapshot_and_what_came_since(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    log = storage.EpochLog(spark, str(tmp_path), schema, ["k"], every=4)
    want, n_files = {}, []
    for epoch in range(11):
        rows = [(epoch % 3, epoch, False), (10 + epoch, epoch, False)] + ([(10 + epoch - 1, None, True)] if epoch else [])
        for _ in range(2):  # an epoch may be repeated
            log.append(spark.createDataFrame(rows, "k long, v long, gone boolean"), epoch)
        want.update({k: v for k, v, gone in rows if not gone})
        for k, _, gone in rows:
            if gone:
                want.pop(k)
        assert {r.k: r.v for r in log.read(epoch + 1).collect()} == want
        n_files.append(len(log._folders(epoch + 1)))
    assert max(n_files) <= 4 and {r.k: r.v for r in log.read(1).collect()} == {0: 0, 10: 0}
