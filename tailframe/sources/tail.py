"""A live source of chunks: log files that grow in a folder all executors see, read page by page, as a stream or from given cursors.

A file is read by ranges of bytes, large ones by several tasks, and where there are many small ones, a task reads a run of them: the number of tasks grows
with the bytes, not with the files. Pages end at line feeds, or if a page has none, between characters; so do ranges. An offset is the byte up to which each active file has been planned, always between characters, so a replay of
the same offsets reads the same pages. Bytes that are no UTF-8 become replacement characters. Land what it yields (``land``) and run everything
else from there.

A range that can't be read holds up no other: it is a row with an error, and a hole. The task notes what it left unread in one file of the source's ``state`` folder; the next offset takes
holes up, until they are read or the file is cut shorter. A note is removed once a batch that took it up is committed, so a crash reads a hole once more and loses none. The state folder also says how far
files had been planned, so that a restarted reader counts truncations on.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

from tailframe.schemas import LOG_PAGE
from tailframe.streaming.counters import observe_reads

#: Key of an offset that is no file's name: generations of truncated files, and the holes taken up.
_MORE = ""
#: Ranges up to which each is a task of its own, and ranges of a task where there are more.
APART, TOGETHER = 64, 4_096


class _Range(InputPartition):
    """Bytes ``start`` to ``stop`` of the part of a file from ``first`` to ``end`` that is read this time; or why it can't be."""

    def __init__(self, path: str, name: str, first: int, start: int, stop: int, end: int, error: str | None = None, generation: int = 0):
        self.path, self.name, self.first, self.start, self.stop, self.end, self.error, self.generation = path, name, first, start, stop, end, error, generation


class _Run(InputPartition):
    """Ranges that one task reads one after another."""

    def __init__(self, parts: list[_Range]):
        self.parts = parts


def _tasks(found: list[_Range], task_bytes: int) -> list[InputPartition]:
    """The ranges, each alone while they are few; else runs of neighbours of about equal size, none much above ``task_bytes``."""
    if len(found) <= APART:
        return found
    size = lambda r: max(r.stop - r.start, 0)
    most = min(max(1, task_bytes), -(-sum(map(size, found)) // APART) or 1)
    longest = min(TOGETHER, -(-len(found) // APART))
    runs, run, held = [], [], 0
    for r in found:
        if run and (held + size(r) > most or len(run) >= longest):
            runs.append(_Run(run))
            run, held = [], 0
        run.append(r)
        held += size(r)
    return [*runs, _Run(run)]


def _whole(data: bytes) -> int:
    """Bytes of ``data`` without a character that its end cuts."""
    for k in range(1, min(4, len(data) + 1)):
        byte = data[-k]
        if byte >= 0xC0:
            return len(data) - k if k < (2 if byte < 0xE0 else 3 if byte < 0xF0 else 4) else len(data)
        if byte < 0x80:
            break
    return len(data)


def _after_line(f, at: int, first: int, end: int) -> int:
    """Where the first line that starts at or after ``at`` starts."""
    if at <= first or at >= end:
        return max(first, min(at, end))
    f.seek(at - 1)
    at -= 1
    while at < end and (block := f.read(min(1 << 16, end - at))):
        if (k := block.find(b"\n")) >= 0:
            return at + k + 1
        at += len(block)
    return end


class _Files:
    def __init__(self, options):
        self.path, self.page, self.task = options["path"], max(4, int(options.get("page_bytes", 1 << 20))), int(options.get("task_bytes", 64 << 20))
        self.instance, self.engine = options.get("instance_id", "local"), options.get("engine", "unknown")
        self.state = options.get("state", os.path.join(self.path, ".state"))
        self.planned: dict[str, int] = {}
        self.generations: dict[str, int] = {}
        self.errors: dict[str, str] = {}
        self.wanted: list[Filter] = []
        self._seen: dict[str, int] = {}

    def sizes(self) -> dict[str, int]:
        """Where each file ends, between characters. A file that can't be read stays where it was and does not hold up the others."""
        self.errors = {}
        for folder, below, names in os.walk(self.path, onerror=lambda e: self.errors.update({os.path.relpath(e.filename, self.path): str(e)})):
            below[:] = [n for n in below if n[0] not in "._"]
            for n in names:
                if n[0] in "._":
                    continue
                full = os.path.join(folder, n)
                name = os.path.relpath(full, self.path)
                if not all(_holds(f, name) for f in self.wanted):
                    continue
                try:
                    size = os.stat(full).st_size
                    if self._seen.get(name) != size:  # only files that have changed are opened
                        with open(full, "rb") as f:
                            f.seek(max(0, size - 3))
                            rest = f.read(3)
                        whole = size - len(rest) + _whole(rest)
                        if size < self.planned.get(name, 0):
                            self.generations[name] = self.generations.get(name, 0) + 1
                        self._seen[name], self.planned[name] = size, whole
                except OSError as e:
                    self.errors[name] = str(e)
        return dict(self.planned)

    def ranges(self, start: dict, end: dict) -> list[InputPartition]:
        found, more = [], end.get(_MORE, {})
        generations = more.get("generations", {})
        for n, size in sorted((n, size) for n, size in end.items() if n != _MORE):
            # A file that is smaller than before was truncated and starts over.
            first = start.get(n, 0) if start.get(n, 0) <= size else 0
            found += [_Range(os.path.join(self.path, n), n, first, at, min(at + self.task, size), size, None, generations.get(n, 0)) for at in range(first, size, self.task)]
        found += [_Range(os.path.join(self.path, n), n, *span, None, g) for _, n, g, *span in more.get("holes", [])]
        found += [_Range(os.path.join(self.path, n), n, at := self.planned.get(n, 0), at, at, at, e, self.generations.get(n, 0)) for n, e in sorted(self.errors.items())]
        return _tasks(found, self.task)

    def opened(self, part: _Range):
        return open(part.path, "rb")

    def read(self, partition: _Range | _Run, note: bool = False) -> Iterator[tuple]:
        """The pages of a task's ranges; ``note`` puts down what could not be read, when all others are."""
        unread: list[list] = []
        for part in partition.parts if isinstance(partition, _Run) else [partition]:
            yield from self.pages(part, unread)
        if note and unread:
            self._note(unread)

    def pages(self, part: _Range, unread: list[list]) -> Iterator[tuple]:
        """The pages of a range; what could not be read goes into ``unread``."""
        now = dt.datetime.now(dt.timezone.utc)
        row = lambda a, b, data, error=None: (self.instance, self.engine, part.name, str(a), str(b), data, error is None and b < part.end, now, error, part.generation, a)
        if part.error:
            yield row(part.start, part.start, None, part.error)
            return
        at, first = part.start, part.first
        try:
            with self.opened(part) as f:
                at, stop = _after_line(f, part.start, part.first, part.end), _after_line(f, part.stop, part.first, part.end)
                first = at  # what is left from here on starts here, wherever lines do
                f.seek(at)
                while at < stop:
                    data = f.read(min(self.page, stop - at))
                    if not data:
                        raise OSError(f"ends at {at}, before {stop}: truncated meanwhile")
                    if at + len(data) < stop:
                        data = data[: data.rfind(b"\n") + 1 or _whole(data)]
                        f.seek(at + len(data))
                    begin, at = at, at + len(data)
                    first = at
                    yield row(begin, at, data.decode("utf-8", "replace"))
        except OSError as e:
            unread.append([part.name, part.generation, min(first, at), at, part.stop, part.end])
            yield row(at, at, None, str(e))

    # -- holes --------------------------------------------------------------------------------------------------

    def _note(self, unread: list[list]) -> None:
        """Written by the task that could not read, one note for all; if even that fails, so does the task."""
        os.makedirs(f"{self.state}/unread", exist_ok=True)
        number = uuid.uuid4().hex
        with open(f"{self.state}/unread/.{number}", "w") as f:
            json.dump([[number, *hole] for hole in unread], f)
        os.rename(f"{self.state}/unread/.{number}", f"{self.state}/unread/{number}")

    def holes(self, but: set[str]) -> list[list]:
        """The holes that can still be read, each with its note's number, without the notes numbered ``but``."""
        try:
            numbers = sorted(n for n in os.listdir(f"{self.state}/unread") if n[0] != "." and n not in but)
        except FileNotFoundError:
            return []
        found = []
        for n in numbers:
            with open(f"{self.state}/unread/{n}") as f:
                noted = json.load(f)
            noted = noted if isinstance(noted[0], list) else [noted]  # a note of a single hole, as they were before
            left = [hole for hole in noted if hole[2] == self.generations.get(hole[1], 0)]
            found += left
            if not left:  # the files have started over, and what was not read is gone
                os.remove(f"{self.state}/unread/{n}")
        return found

    def forget(self, numbers: Iterable[str]) -> None:
        for n in numbers:
            try:
                os.remove(f"{self.state}/unread/{n}")
            except FileNotFoundError:
                pass

    def remember(self, taken_up: set[str]) -> None:
        """Called when a batch is planned, so its offset is written."""
        os.makedirs(self.state, exist_ok=True)
        with open(f"{self.state}/.planned", "w") as f:
            json.dump([self.planned, self.generations, sorted(taken_up)], f)
        os.rename(f"{self.state}/.planned", f"{self.state}/planned")

    def recall(self) -> None:
        """What a reader before knew. Notes that one of its batches took up stand in that batch's offset, from which it is run again if it wasn't committed."""
        try:
            with open(f"{self.state}/planned") as f:
                self.planned, self.generations, taken_up = json.load(f)
        except FileNotFoundError:
            return
        self.forget(taken_up)


def _holds(f: Filter, name: str) -> bool:
    """Whether a file's name may pass a filter."""
    match f:
        case EqualTo(("log_file",), value):
            return name == value
        case In(("log_file",), value):
            return name in value
        case StringStartsWith(("log_file",), value):
            return name.startswith(value)
        case StringEndsWith(("log_file",), value):
            return name.endswith(value)
        case StringContains(("log_file",), value):
            return value in name
    return True


class LogTail(DataSource):
    """``spark.dataSource.register(LogTail)``; options path, instance_id, engine, page_bytes, task_bytes; for a stream ``state``, a folder all executors see (``.state`` below path);
    for a batch ``cursors``, JSON of the byte to start from by file, and ``choose`` ("true" where ``spark.sql.python.filterPushdown.enabled`` is set): filters on log_file (names
    and parts of names) then choose the files, and others are neither opened nor reported."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self):
        return LOG_PAGE

    def streamReader(self, schema):
        return _TailReader(_Files(self.options))

    def reader(self, schema):
        return (_ChoosingReader if self.options.get("choose") == "true" else _BatchReader)(self.options)


class _BatchReader(DataSourceReader):
    def __init__(self, options):
        self.files, self.cursors = _Files(options), json.loads(options.get("cursors", "{}"))

    def partitions(self) -> list[InputPartition]:
        return self.files.ranges(self.cursors, self.files.sizes())

    def read(self, partition: _Range | _Run):
        return self.files.read(partition)


class _ChoosingReader(_BatchReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters on names choose files before they are opened; Spark applies the others."""
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith, StringEndsWith, StringContains)) and f.attribute == ("log_file",):
                self.files.wanted.append(f)
            else:
                yield f


class _TailReader(DataSourceStreamReader):
    def __init__(self, files: _Files):
        self.files, self.taken_up = files, set()
        self.files.recall()

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        offset: dict = self.files.sizes()
        more: dict = {"generations": g} if (g := {n: g for n, g in self.files.generations.items() if n in offset}) else {}
        if holes := self.files.holes(self.taken_up):
            more |= {"holes": holes, "taken_up": time.time_ns()}
        return offset | ({_MORE: more} if more else {})

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.taken_up |= {note[0] for note in end.get(_MORE, {}).get("holes", [])}
        self.files.remember(self.taken_up)
        return self.files.ranges(start, end)

    def read(self, partition: _Range | _Run):
        return self.files.read(partition, note=True)

    def commit(self, end: dict) -> None:
        """Files that are gone need no offset any more: it is written in every batch, so only live files are kept."""
        read = {note[0] for note in end.get(_MORE, {}).get("holes", [])}
        self.files.forget(read)
        self.taken_up -= read
        for name in [n for n in self.files.planned if not os.path.exists(os.path.join(self.files.path, n))]:
            del self.files.planned[name]


def read_pages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The pages of the files below ``path``, from the given cursors on. Where the session allows it, a filter on log_file chooses the files that are opened."""
    spark.dataSource.register(LogTail)
    choose = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("log_tail").options(path=path, choose=choose, **options).load()


def land(spark: SparkSession, path: str, out: str, checkpoint: str, source: type[DataSource] = LogTail, **options: str):
    """A stream that appends the pages of the files below ``path`` to the chunk table ``out``. What can't be read is landed as an error, and read again later."""
    spark.dataSource.register(source)
    own = checkpoint.removeprefix("file://")
    if "://" not in own:  # a folder that all executors see as well; else the source keeps its state beside the logs
        options.setdefault("state", f"{own.rstrip('/')}/log_tail_state")
    return observe_reads(spark.readStream.format(source.name()).options(path=path, **options).load()).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The landed pages, with those that could not be read (``error``)."""
    return spark.read.schema(LOG_PAGE).parquet(path)
