"""SentencePiece encoding and decoding with a shared-prefix Viterbi search.

A text is normalised as the model says (dummy prefix, spaces to the marker U+2581) and cut into marked words,
each a run of markers and what follows up to the next marker; a word is cut again where letters meet other characters, if no piece
holds both. No piece crosses such a cut (checked on loading), so words are encoded one by one, and each distinct word of a slice of rows once: the distinct words are sorted,
which lays out their trie in depth-first order, and walking it keeps a stack of forward states, one for each
character. A word starts from the states of the prefix that it shares with the word before it.

The forward state depends on the kind of model. For a unigram model it is the best log probability of any
segmentation of the prefix, and the piece that ends it. For a BPE model the segmentation of a prefix is the one
the merges give, and it is found the same way: exactly one piece can end it, that which the merges leave whole
next to the last piece of the prefix before it. Both are Viterbi recurrences over the same lattice of pieces; for
BPE a transition scores 0 if the two pieces are stable side by side, and is forbidden if not. Characters that no piece covers
become byte pieces or the unknown piece.

Memory: a slice of rows is encoded at a time, a very long text in blocks of words; the words kept for later slices
are bounded in bytes and freed when the task ends.

Edge cases: null and empty texts have no ids; null decodes to an empty text; repeated rows are encoded alike; ties
between segmentations go to the library's choice (BPE: the leftmost merge; unigram: the shortest last piece); a text of
one very long word takes time and memory in proportion to its length; an empty table gives no rows. Other
columns pass through; one that bears the name of an added column is replaced by it.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: Rows and characters of a slice of rows, and words that are looked up at once.
_ROWS, _CHARS, _WORDS_AT_ONCE = 1_000, 1 << 20, 1 << 16
#: Bytes that the words kept for later slices may take, and what one takes besides its characters (a string, packed ids, a
#: dictionary entry); pairs of pieces whose stability, and character groups whose arcs are remembered.
_BYTES, _ENTRY, _PAIRS, _ARCS = 64 << 20, 220, 200_000, 60_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class PieceModel:
    """What encoding needs of a model file. ``parse`` reads it; the object is small and is broadcast."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    bpe: bool
    dummy_prefix: bool
    squeeze: bool
    escape: bool
    digest: str = ""
    _memo: dict[str, dict[int, bool]] = field(default_factory=dict, repr=False)
    _pairs: int = field(default=0, repr=False)

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        pieces, scores, kinds, trainer, norm = [], [], [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                pieces.append(own[1].decode())
                scores.append(struct.unpack("<f", own.get(2, bytes(4)))[0])
                kinds.append(own.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                norm = dict(_fields(value))
        if norm.get(2):
            raise ValueError("models with a character map are not supported; normalise texts first")
        if trainer.get(3, 1) not in (1, 2) or trainer.get(24, 0):
            raise ValueError("only unigram and BPE models with spaces as prefixes are supported")
        if USER in kinds:
            raise ValueError("user-defined pieces are not supported")
        if any(MARK in p.lstrip(MARK) for p, k in zip(pieces, kinds) if k == NORMAL):
            raise ValueError("a piece holds a space behind another character; words can't be encoded one by one")
        return cls(pieces, scores, kinds, trainer.get(3, 1) == 2, bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1)), hashlib.sha256(data).hexdigest())

    def __getstate__(self) -> dict:
        made = ("ids", "words", "longest", "long_ends", "arcs", "_arcs", "packed", "byte_ids", "unknown", "floor", "ends", "high", "plain", "plain_array", "is_high")
        return {k: v for k, v in self.__dict__.items() if k not in made} | {"_memo": {}, "_pairs": 0}

    def prepare(self) -> None:
        """Lookup tables, made once for each worker."""
        if hasattr(self, "ids"):
            return
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.words = self._words()
        self.longest = max(map(len, self.ids), default=1)
        self.byte_ids = [None] * 256
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds)):
            if k == BYTE:
                self.byte_ids[int(p[1:-1], 16)] = i
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.floor = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0  # of a character without a piece
        # Lengths of the pieces that end with three given characters, longest first: the lattice's arcs into a place.
        ends: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) > 2:
                ends.setdefault(p[-3:], set()).add(len(p))
        self.ends = {c: tuple(sorted(n, reverse=True)) for c, n in ends.items()}
        self.long_ends: dict[str, tuple[int, ...]] = {}
        for p in self.ids if self.bpe else ():
            if len(p) > 4:
                self.long_ends[p[-4:]] = tuple(sorted({len(p), *self.long_ends.get(p[-4:], ())}, reverse=True))
        self.arcs = [(len(p), i, p) for i, p in enumerate(self.pieces)]
        self._arcs = {}
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.pieces))]
        # What each id decodes to by itself; bytes of longer characters only mean something together.
        high = {i for b, i in enumerate(self.byte_ids) if b > 127 and i is not None}
        self.high = frozenset(high)
        self.plain = [self._plain(i) for i in range(len(self.pieces))]
        self.plain_array = pa.array(self.plain, pa.string())
        self.is_high = np.isin(np.arange(len(self.pieces)), sorted(high))

    def _words(self) -> re.Pattern[str]:
        """Cuts a text into words: at markers, and where a character of the largest class meets one of another class.

        Characters that stand side by side in a piece, not counting markers, are of one class; so no piece holds characters of two.
        """
        of: dict[str, str] = {}

        def root(c: str) -> str:
            while (up := of.setdefault(c, c)) != c:
                of[c] = of[up]
                c = up
            return c

        for p in self.ids:
            p = p.lstrip(MARK)
            for a, b in zip(p, p[1:]):
                of[root(a)] = root(b)
        classes: dict[str, list[str]] = {}
        for c in list(of):
            classes.setdefault(root(c), []).append(c)
        if not classes:
            return re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        inner = "".join(map(re.escape, max(classes.values(), key=len)))
        return re.compile(f"{MARK}*[{inner}]+|{MARK}*[^{inner}{MARK}]+|{MARK}+")

    def _plain(self, i: int) -> str:
        if self.kinds[i] == BYTE:
            return chr(int(self.pieces[i][1:-1], 16))
        if self.kinds[i] == UNKNOWN:
            return " ⁇ "
        return "" if self.kinds[i] == CONTROL else self.pieces[i].replace(MARK, " ")

    def normalize(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        if self.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.escape else text

    def _keeps(self, left: str, right: str) -> bool:
        """Whether merging the characters of both, the best-scoring adjacent pair first and the leftmost among equals, ends with these two."""
        if left + right in self.ids:
            return False
        ids_get, scores = self.ids.get, self.scores
        parts, cut = [*left, *right], len(left)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids_get(parts[k] + parts[k + 1])
                if i is not None and (best is None or scores[i] > best):
                    best, at = scores[i], k
            if best is None:
                break
            if at == cut - 1:  # across both, which no later merge undoes
                return False
            cut -= at < cut
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return len(parts) == 2

    def _whole(self, piece: str) -> bool:
        """Whether merging the characters of a piece gives it."""
        parts = list(piece)
        while len(parts) > 1:
            found = [(-self.scores[i], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if (i := self.ids.get(a + b)) is not None]
            if not found:
                return False
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def _stable(self, left: str, right: str, known: dict[int, bool]) -> bool:
        """Whether the merges leave these two pieces as they are, side by side; ``known`` keeps it for ``left``."""
        self._pairs += 1
        if self._pairs > _PAIRS:
            self.forget()
        verdict = known[self.ids[right]] = self._keeps(left, right) if left else self._whole(right)
        return verdict

    def encode_words(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of each word. ``words`` are distinct and sorted, so that neighbours share the longest prefixes."""
        self.prepare()
        for packed in self.packed_words(words):
            ids = array("i")
            ids.frombytes(packed)
            yield ids.tolist()

    def packed_words(self, words: list[str]) -> Iterator[bytes]:
        """The same with the ids of a word as 32-bit integers in a row."""
        forward = self._forward_bpe if self.bpe else self._forward_unigram
        # Of each prefix: its forward state, the length of the piece that ends it, and the ids so far.
        stack = [(self._memo.setdefault("", {}) if self.bpe else 0.0, 0, b"")]
        before = ""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del stack[shared + 1 :]
            forward(word, shared, stack)
            before = word
            yield stack[-1][2]

    def _single(self, character: str) -> bytes:
        """Packed ids of one character, by its piece, its bytes or as unknown."""
        i = self.ids.get(character)
        if i is not None:
            return self.packed[i]
        if None in self.byte_ids:
            return self.packed[self.unknown]
        return b"".join(self.packed[self.byte_ids[b]] for b in character.encode("utf-8", "replace"))

    def _forward_unigram(self, word: str, start: int, stack: list[tuple]) -> None:
        ids_get, scores, ends = self.ids.get, self.scores, self.ends
        for end in range(start + 1, len(word) + 1):
            found, length = ids_get(word[end - 1]), 1
            best = stack[end - 1][0] + (self.floor if found is None else scores[found])
            for n in (2, *ends.get(word[end - 3 : end], ())) if end > 2 else (2,):
                if n <= end and (i := ids_get(word[end - n : end])) is not None and (s := stack[end - n][0] + scores[i]) > best:
                    best, length, found = s, n, i
            stack.append((best, length, stack[end - length][2] + (self._single(word[end - 1]) if found is None else self.packed[found])))

    def _arcs_into(self, last: str) -> tuple:
        """Pieces that can end a place after these (at most four) characters: length, id, piece; longer ones by length alone."""
        longer = [(n, None, None) for n in self.long_ends.get(last, ())] if len(last) == 4 else []
        short = [self.arcs[i] for n in range(len(last), 1, -1) if (i := self.ids.get(last[-n:])) is not None]
        if len(self._arcs) >= _ARCS:
            self._arcs.clear()
        found = self._arcs[last] = (*longer, *short)
        return found

    def _forward_bpe(self, word: str, start: int, stack: list[tuple]) -> None:
        """The state of a prefix is what is known of the pieces that may follow its last piece."""
        ids_get, memo, arcs_get, packed = self.ids.get, self._memo, self._arcs.get, self.packed
        for end in range(start + 1, len(word) + 1):
            before = word[end - 4 if end > 4 else 0 : end]
            arcs = arcs_get(before)
            for n, i, piece in self._arcs_into(before) if arcs is None else arcs:
                if i is None:
                    if n > end:
                        continue
                    piece = word[end - n : end]
                    i = ids_get(piece)
                    if i is None:
                        continue
                begin = end - n
                left, length, so_far = stack[begin]
                known = left.get(i)
                if known is None:
                    known = self._stable(word[begin - length : begin], piece, left)
                if known:
                    so_far += packed[i]
                    break
            else:
                n, piece = 1, word[end - 1]
                i = ids_get(piece)
                so_far = stack[end - 1][2] + (self._single(piece) if i is None else packed[i])
            follow = memo.get(piece)
            if follow is None:
                follow = memo[piece] = {}
            stack.append((follow, n, so_far))

    def decode(self, ids: list[int] | None) -> str:
        self.prepare()
        ids = ids or []
        if self.high.isdisjoint(ids):
            text = "".join(map(self.plain.__getitem__, ids))
        else:
            out, run = [], bytearray()
            for i in ids:
                if self.kinds[i] == BYTE:
                    run.append(int(self.pieces[i][1:-1], 16))
                    continue
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                out.append(self.plain[i])
            out.append(run.decode("utf-8", "replace"))
            text = "".join(out)
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def decode_all(self, starts: np.ndarray, ids: np.ndarray) -> list[str]:
        """Decodes many texts at once. Those with bytes of longer characters are decoded one by one."""
        parts = pa.ListArray.from_arrays(pa.array(starts), self.plain_array.take(pa.array(ids)))
        texts = pc.binary_join(parts, "").to_pylist()
        if self.dummy_prefix:
            texts = [t[1:] if t.startswith(" ") else t for t in texts]
        odd = np.flatnonzero(self.is_high[ids]) if len(ids) else ()
        for k in np.unique(np.searchsorted(starts, odd, side="right") - 1) if len(odd) else ():
            texts[k] = self.decode(ids[starts[k] : starts[k + 1]].tolist())
        return texts

    def forget(self) -> None:
        """Drops what was found out about pairs of pieces."""
        self._memo.clear()
        self._arcs.clear()
        self._pairs = 0


class _Encoder:
    """Encodes slices of texts; keeps the packed ids of words seen by this task, up to ``_BYTES`` of memory."""

    def __init__(self, model: PieceModel):
        self.model, self.young, self.old, self.held = model, {}, {}, 0
        model.prepare()

    def _ids(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of a block's words. Words in use stay in the young half of what is kept; the old half is dropped when that is full."""
        found = {w: x for w in words if (x := self.young.get(w) or self.old.get(w)) is not None}
        order = sorted(words.difference(found))
        found.update(zip(order, self.model.packed_words(order)))
        for w in words.difference(self.young):
            self.held += len(w) + _ENTRY
            if 2 * self.held > _BYTES:
                self.young, self.old, self.held = {}, self.young, len(w) + _ENTRY
            self.young[w] = found[w]
        return found

    def __call__(self, normal: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of normalised texts: where each one's ids start, and all ids in a row."""
        done = [b""] * len(normal)
        block: list[tuple[int, list[str]]] = []
        n_words = 0

        def flush() -> None:
            ids_of = self._ids(set().union(*(words for _, words in block))).__getitem__
            for k, words in block:
                done[k] += b"".join(map(ids_of, words))
            block.clear()

        for k, text in enumerate(normal):
            found = self.model.words.finditer(text) if len(text) > _CHARS else None
            while words := [m[0] for m in islice(found, _WORDS_AT_ONCE)] if found else self.model.words.findall(text):
                block.append((k, words))
                n_words += len(words)
                if n_words >= _WORDS_AT_ONCE:
                    flush()
                    n_words = 0
                if not found:
                    break
        if block:
            flush()
        starts = np.zeros(len(done) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in done], out=starts[1:])
        return starts, np.frombuffer(b"".join(done), np.dtype("<i4"))

    def close(self) -> None:
        """Frees what the task has gathered: workers live on, and what they keep adds to what later stages need."""
        self.young, self.old, self.held = {}, {}, 0
        self.model.forget()


def _slices(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Rows in runs of bounded number and length: the first row's place and the texts."""
    rows: list[str | None] = []
    size = start = 0
    for k, x in enumerate(column):
        x = x.as_py()
        rows.append(x)
        size += len(x or "")
        if len(rows) >= _ROWS or size >= _CHARS:
            yield start, rows
            rows, size, start = [], 0, k + 1
    if rows:
        yield start, rows


def _per_slice(df: DataFrame, model: PieceModel, text_col: str, added: list[T.StructField], new: Callable, keep_text: bool) -> DataFrame:
    """Adds the columns that ``new(encoder, texts)`` gives for each slice of rows."""
    df = df.drop(*(f.name for f in added))
    at = df.columns.index(text_col)
    kept = [k for k in range(len(df.columns)) if keep_text or k != at]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(shared.value)
        try:
            for batch in batches:
                for start, texts in _slices(batch.column(at)):
                    part = batch.slice(start, len(texts))
                    columns = [*(part.column(k) for k in kept), *new(encoder, texts)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*(part.schema.names[k] for k in kept), *(f.name for f in added)])
        finally:
            encoder.close()

    return df.mapInArrow(run, T.StructType([*(df.schema.fields[k] for k in kept), *added]))


def _id_lists(starts: np.ndarray, ids: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(ids))


def encode(df: DataFrame, model: PieceModel, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """Adds ``out_col``, the array of ids of the whole text."""

    def new(encoder: _Encoder, texts: list[str | None]) -> list[pa.Array]:
        return [_id_lists(*encoder([encoder.model.normalize(t or "") for t in texts]))]

    return _per_slice(df, model, text_col, [T.StructField(out_col, T.ArrayType(T.IntegerType()))], new, True)


def decode(df: DataFrame, model: PieceModel, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds ``out_col``, the text that the ids stand for."""
    df = df.drop(out_col)
    schema, at = T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType())]), df.columns.index(ids_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [shared.value.decode(x.as_py()) for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out_col])

    return df.mapInArrow(run, schema)


def encode_and_verify(df: DataFrame, model: PieceModel, text_col: str = "text") -> DataFrame:
    """Replaces the text by ``ids``, ``n_tokens`` and ``round_trip``: whether decoding gives the normalised text back."""
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())]

    def new(encoder: _Encoder, texts: list[str | None]) -> list[pa.Array]:
        model = encoder.model
        normal = [model.normalize(t or "") for t in texts]
        starts, ids = encoder(normal)
        cut = 1 if model.dummy_prefix else 0
        same = [got == want.replace(MARK, " ")[cut:] for got, want in zip(model.decode_all(starts, ids), normal)]
        return [_id_lists(starts, ids), pa.array(np.diff(starts).astype(np.int64)), pa.array(same, pa.bool_())]

    return _per_slice(df, model, text_col, added, new, False)


def load_model(df: DataFrame, path: str) -> PieceModel:
    """The model file, read by Spark's file reader, so that any store it knows will do."""
    return PieceModel.parse(bytes(df.sparkSession.read.format("binaryFile").load(path).select(F.col("content")).head()[0]))
