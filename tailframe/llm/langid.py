"""Language ID by error-correcting output codes over byte n-grams.

Each language gets a binary codeword. For every bit a binary classifier (log odds of hashed 1- to 4-byte grams
between the languages whose bit is 1 and the others) says how strongly a text leans to 1 or 0. Decoding weighs
each bit's loss by the strength of its answer and chooses the nearest codeword; a small margin to the second
nearest flags the text as ambiguous. All codewords differ in at least three bits, so one wrong bit is corrected: with two or three languages there are too
few splits for that, and each split is learned more than once, each time from another share of the grams.

All classifiers come from one table, the gram counts of each language, which Spark sums over all training rows:
tasks combine their own rows first. Languages are counted before, and their counts (``DIM`` each) are fetched a block of languages at a time.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as is every text if nothing was
learned; with one language learned it is predicted with score 1; repeated rows are predicted alike; between
languages equally near the first by name is chosen, and the text is ambiguous; very long texts are counted in slices, whole; rows with a
null language are never learned from; a null id makes ``held_out`` null in the query; an empty table gives no rows. Other columns pass through; one that bears the
name of an added column is replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailframe.llm.common import staged

DIM = 1 << 15
UNKNOWN = "und"
_CHUNK = 1 << 20
_NO_LETTERS = re.compile(r"[\W\d_]+")


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed 1- to 4-byte grams of the lower-cased whole text, letters and spaces only."""
    data = np.frombuffer(_NO_LETTERS.sub(" ", f" {text.lower()} ").encode("utf-8", "replace"), np.uint8)
    out = np.zeros(DIM, np.int64)
    for start in range(0, len(data), _CHUNK):
        part = data[max(0, start - 3) : start + _CHUNK].astype(np.uint32)
        code = np.zeros(len(part) + 1, np.uint32)
        for n in range(1, 5):
            code = (code[: len(part) - n + 1] << np.uint32(8)) | part[n - 1 :]
            fresh = code if not start else code[4 - n :]  # grams that the chunk before has not counted
            hashed = (fresh ^ np.uint32(n * 0x51ED2705 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
            out += np.bincount(hashed >> np.uint32(32 - 15), minlength=DIM)
    return out


def _count_by_lang(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, text = lang.as_py(), text.as_py()
            if _has_letter(text):
                sums[lang] = sums.get(lang, 0) + gram_counts(text)
    for lang, counts in sums.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], schema=schema)


def codewords(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n rows of +1 and -1, and of each bit the share of the grams that it is learned from: (number, of how many).

    Up to 7 languages: every split of them into two sides, as often as it takes to keep all pairs three bits apart.
    Beyond: rows drawn by a fixed seed, long enough to keep all pairs far apart.
    """
    if n <= 1:
        return np.ones((n, 1)), np.array([[0, 1]])
    if n <= 7:
        splits = np.array([[1 if (s >> k) & 1 else -1 for k in range(n)] for s in range(1, 1 << (n - 1))]).T
        times = -(-3 // (1 << (n - 2)))  # two rows differ in half of all splits
        return np.tile(splits, times), np.repeat([(t, times) for t in range(times)], splits.shape[1], axis=0)
    bits = 15 + 10 * int(np.ceil(np.log2(n)))
    rng = np.random.default_rng(0)
    drawn = [rng.choice([-1, 1], (n, bits)) for _ in range(50)]
    drawn = [m for m in drawn if (abs(m.sum(axis=0)) < n).all()] or drawn
    apart = lambda m: ((bits - m @ m.T) / 2 + np.eye(n) * bits).min()
    return max(drawn, key=apart), np.array([[0, 1]] * bits)


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray  # bits x DIM

    def predict(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the runner-up is too near."""
        if text is None or not self.langs or not _has_letter(text):
            return UNKNOWN, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        counts = gram_counts(text)
        at = np.flatnonzero(counts)
        lean = self.weights[:, at] @ counts[at] / np.sqrt(counts.sum())
        strength = np.abs(lean) / max(np.abs(lean).sum(), 1e-12)
        # Logistic loss of each bit against each codeword, weighed by how sure the bit is.
        loss = (np.logaddexp(0, -self.codes * lean) * strength).sum(axis=1)
        odds = np.exp(loss.min() - loss)
        odds /= odds.sum()
        first, second = np.argsort(-odds, kind="stable")[:2]
        return self.langs[first], float(odds[first]), bool(odds[first] - odds[second] < margin)


#: Languages whose counts are fetched at once.
BLOCK = 16


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_langs: int = 500) -> LanguageModel:
    """Learns from all rows with a language and a text. More than ``max_langs`` languages are refused, never cut."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if rows.select("lang").distinct().limit(max_langs + 1).count() > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("at", T.IntegerType()), T.StructField("n", T.LongType())])
    arrow = pa.schema([("lang", pa.string()), ("at", pa.int32()), ("n", pa.int64())])
    counts = staged(rows.mapInArrow(lambda b: _count_by_lang(b, arrow), schema).groupBy("lang", "at").agg(F.sum("n").alias("n")), "gram-counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    table = np.zeros((len(langs), DIM))
    for start in range(0, len(langs), BLOCK):
        part = langs[start : start + BLOCK]
        got = counts.where(F.col("lang").isin(part)).toArrow()
        row = pc.index_in(got.column("lang"), value_set=pa.array(part, pa.string())).to_numpy()
        table[start + row, got.column("at").to_numpy()] = got.column("n").to_numpy()
    return learn(langs, table)


def learn(langs: list[str], table: np.ndarray) -> LanguageModel:
    """The model of gram counts (languages x ``DIM``). Languages count alike, however much text they have."""
    shares = (table + 0.05) / (table.sum(axis=1, keepdims=True) + 0.05 * DIM)
    codes, folds = codewords(len(langs))
    weights = np.zeros((codes.shape[1], DIM), np.float32)
    for b in range(codes.shape[1]) if len(langs) > 1 else ():
        one, zero = codes[:, b] > 0, codes[:, b] < 0
        fold, of = folds[b]
        own = np.arange(DIM) % of == fold
        weights[b, own] = np.log(shares[one].mean(axis=0)[own]) - np.log(shares[zero].mean(axis=0)[own]) if one.any() and zero.any() else 0
    return LanguageModel(tuple(langs), codes, weights)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep_text: bool = True, margin: float = 0.2) -> DataFrame:
    """Adds lang_pred, score and ambiguous. The model is small (bits x ``DIM`` floats) and is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    docs = docs.drop(*(f.name for f in added))
    at = docs.columns.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.predict(x.as_py(), margin) for x in batch.column(at)]
            new = [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            kept = [k for k in range(batch.num_columns) if keep_text or k != at]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *new], names=[*(batch.schema.names[k] for k in kept), *(f.name for f in added)])

    kept = [f for k, f in enumerate(docs.schema.fields) if keep_text or k != at]
    return docs.mapInArrow(predict, T.StructType([*kept, *added]))
