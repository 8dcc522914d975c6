"""Conversations to training text: turns marked by a template, control strings in texts escaped, a loss flag on each segment.

A template says declaratively what a turn of each role looks like, as segments with or without loss, and which role may follow which, as a
finite-state machine. ``format_chats`` deals the turns by ranges of (conversation, turn) and formats each by itself, so no task holds a conversation. The machine
runs over the roles alone, in blocks: what a block does to every state it could begin in is a small map, and maps are put together along
the conversation (``check_order``). ``read_back`` streams the formatted text through a parser, conversation by conversation, with what a digest of it needs in
memory: a digest over a whole conversation can't be made of digests of its parts, so a task reads a conversation to its end, however long.

Escaping: between ``<`` and ``|`` in a text, with any number of backslashes between them, one backslash more is put in. So no text has a ``<|``, with which all control
strings begin, and taking one backslash out again gives the text back. In roles, line feeds and backslashes are escaped as well.

Edge cases: a null text or role is empty; roles that the template doesn't know are formatted as its ``other`` turn and break the order, as empty conversations of no
turns don't exist; turns come in ascending order, null first, rows of one turn by role and a digest of the text, and equal rows are turns of their own; null ids make one conversation; very long texts are
formatted whole, one at a time; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailframe.llm.common import staged

ROLE, TEXT = "{role}", "{text}"
#: Turns whose roles one block of the state machine has at most.
BLOCK_BITS = 12
BROKEN = -1


@dataclass(frozen=True)
class ChatTemplate:
    """``turns``: by role its segments (literal, ``ROLE`` or ``TEXT``; whether it counts for the loss). ``moves``: by state and role the next state."""

    turns: dict[str, tuple[tuple[str, bool], ...]]
    other: tuple[tuple[str, bool], ...]
    moves: dict[str, dict[str, str]]
    start: str = "start"
    begin: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    states: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        found = {self.start, *self.moves, *(s for m in self.moves.values() for s in m.values())}
        object.__setattr__(self, "states", (self.start, *sorted(found - {self.start})))
        for segments in (*self.turns.values(), self.other):
            whole = "".join(s for s, _ in segments)
            if not (whole.startswith(self.begin + ROLE + "\n") and whole.endswith(self.end) and whole.count(TEXT) == 1 and self.begin.startswith("<|") and self.end.startswith("<|")):
                raise ValueError(f"a turn is {self.begin!r}, its role, a line feed, its text and {self.end!r}: {whole!r}")


def _turn(loss: bool) -> tuple[tuple[str, bool], ...]:
    return (("<|im_start|>", False), (ROLE, False), ("\n", False), (TEXT, loss), ("<|im_end|>\n", False))


#: Turns between markers. The texts of the assistant count for the loss; a system turn may come first, then user and assistant take turns.
TEMPLATE = ChatTemplate(
    turns={"system": _turn(False), "user": _turn(False), "assistant": _turn(True)},
    other=_turn(False),
    moves={"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"}, "assistant": {"user": "user"}},
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


_ESCAPED = re.compile(r"<(\\*)\\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def unescape_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def segments(role: Column, text: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """array<struct<text, loss>>: the turn's segments, neighbours of one flag put together."""

    def made(parts: tuple[tuple[str, bool], ...]) -> Column:
        runs: list[tuple[list[Column], bool]] = []
        for part, loss in parts:
            c = escape_role(role) if part == ROLE else escape(text) if part == TEXT else F.lit(part)
            if runs and runs[-1][1] == loss:
                runs[-1][0].append(c)
            else:
                runs.append(([c], loss))
        return F.array(*(F.struct(F.concat(*cs).alias("text"), F.lit(loss).alias("loss")) for cs, loss in runs))

    out = made(template.other)
    for name, parts in template.turns.items():
        if parts != template.other:
            out = F.when(role == name, made(parts)).otherwise(out)
    return out


def format_chats(turns: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """One row a turn, written once: conv_id, place (ascending along each conversation), role and ``segments``."""
    own = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Ranges are found from samples of the keys on the driver, so a digest stands for the text there; the last key splits rows that repeat.
    keys = ["conv_id", "turn", "role", "digest", "tie"]
    keyed = own.withColumns({"digest": F.xxhash64("text"), "tie": F.monotonically_increasing_id()})
    placed = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    return staged(placed.select("conv_id", "place", "role", segments(F.col("role"), F.col("text"), template).alias("segments")), "formatted")


# -- the order of roles -----------------------------------------------------------------------------------------


def check_order(formatted: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """conv_id, ``valid`` (each turn was allowed), ``n_valid`` (turns before the first that was not) and ``ends_in``, the last state if valid."""
    states, roles = template.states, sorted({r for m in template.moves.values() for r in m})
    number = {s: k for k, s in enumerate(states)}
    table = F.array(*(F.lit(number.get(template.moves.get(s, {}).get(r, ""), BROKEN)) for s in states for r in roles))
    role = F.lit(None).cast("int")
    for k, r in enumerate(roles):
        role = F.when(F.col("role") == r, k).otherwise(role)
    # A map has for each state it may begin in the state it ends in and the turns up to there or to the first that was not allowed.
    begin = F.array(*(F.struct(F.lit(k).alias("state"), F.lit(0).cast("long").alias("n")) for k in range(len(states))))

    def step(so_far: Column, r: Column) -> Column:
        def moved(x: Column) -> Column:
            to = F.coalesce(F.get(table, x["state"] * len(roles) + r), F.lit(BROKEN))
            return F.when(x["state"] == BROKEN, x).otherwise(F.struct(to.alias("state"), (x["n"] + F.when(to == BROKEN, 0).otherwise(1)).alias("n")))

        return F.transform(so_far, moved)

    def joined(so_far: Column, further: Column) -> Column:
        def moved(x: Column) -> Column:
            y = F.get(further, x["state"])
            return F.when(x["state"] == BROKEN, x).otherwise(F.struct(y["state"].alias("state"), (x["n"] + y["n"]).alias("n")))

        return F.transform(so_far, moved)

    light = formatted.select("conv_id", F.shiftright("place", BLOCK_BITS).alias("block"), "place", role.alias("role"))
    blocks = light.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("place", "role"))).alias("roles"))
    maps = blocks.select("conv_id", "block", F.aggregate("roles", begin, lambda a, r: step(a, r["role"])).alias("map"))
    whole = maps.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "map"))).alias("maps"))
    end = whole.select("conv_id", F.get(F.aggregate("maps", begin, lambda a, m: joined(a, m["map"])), F.lit(0)).alias("end"))
    return end.select("conv_id", (F.col("end.state") != BROKEN).alias("valid"), F.col("end.n").alias("n_valid"), F.get(F.array(*map(F.lit, states)), F.when(F.col("end.state") != BROKEN, F.col("end.state"))).alias("ends_in"))


# -- reading back -----------------------------------------------------------------------------------------------


class _Conversation:
    """Parses the formatted text of one conversation as it comes, and digests what it finds."""

    def __init__(self, template: ChatTemplate):
        self.template, self.waiting = template, ""
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, text: str, loss: bool) -> None:
        self.formatted_chars += len(text)
        if loss:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self.waiting += text
        if self.waiting.endswith(self.template.end):
            for turn in self.waiting.split(self.template.end)[:-1]:
                role, gap, said = turn.removeprefix(self.template.begin).partition("\n")
                if not gap or not turn.startswith(self.template.begin):
                    raise ValueError(f"no turn: {turn[:80]!r}")
                self.turns.update(f"{unescape_role(role)}\n{unescape(said)}\n".encode("utf-8", "surrogatepass"))
                self.n_turns += 1
            self.waiting = ""

    def result(self) -> tuple:
        if self.waiting:
            raise ValueError(f"the last turn has no end: {self.waiting[:80]!r}")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


_FOUND = {"n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}


def _read(batches: Iterator[pa.RecordBatch], template: ChatTemplate) -> Iterator[pa.RecordBatch]:
    ids: list = []
    found: list[tuple] = []
    kind, now = None, None

    def out() -> pa.RecordBatch:
        columns = zip(*found) if found else [[]] * len(_FOUND)
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), *(pa.array(c, t) for c, t in zip(columns, _FOUND.values()))], names=["conv_id", *_FOUND])

    for batch in batches:
        kind = batch.column(0).type
        for k, conv in enumerate(batch.column(0).to_pylist()):
            if now is None or conv != ids[-1]:
                if now is not None:
                    found.append(now.result())
                    if len(ids) >= 10_000:
                        yield out()
                        ids, found = [], []
                ids.append(conv)
                now = _Conversation(template)
            for s in batch.column(2)[k]:
                now.add(s["text"].as_py(), s["loss"].as_py())
    if now is not None:
        found.append(now.result())
        yield out()


def read_back(formatted: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """Per conversation, from the formatted text alone: turns and their digest, characters and digest of what counts for the loss, characters in all."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    sorted_ = formatted.select("conv_id", "place", "segments").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return sorted_.mapInArrow(lambda b: _read(b, template), f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
