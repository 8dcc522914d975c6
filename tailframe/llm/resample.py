"""Importance resampling towards a target distribution, by hashed n-grams.

Every n-gram of a text falls into a bucket by its CRC-32. A bucket's gain is the logarithm of how much commoner it is in the target's texts than in all
documents; a document's weight is the mean gain of its n-grams, and those with the highest sums of weight and random noise are drawn.

Texts are worked on in pieces of about a megabyte. A piece's n-grams are interned in an open-addressed table: the place of each is looked for from its XXH64 on, and one
counts as found only if all its bytes agree. A place holds the n-gram's bucket and how often it occurs, so a bucket is worked out once for each
different n-gram; each occurrence keeps the number of its place, by which it then gathers its gain.

Counts are made over all texts, added up by task and then by bucket: at most ``BUCKETS`` of them reach the driver.

Edge cases: null and empty texts have no n-grams, the weight zero, and too few words to be drawn; a text of any length is worked on in pieces, with the last words of one piece
taken along to the next; repeated rows are documents of their own, which count and may be drawn each; ties go to the smaller doc_id, then to the row with fewer n-grams, null ids last; without
target texts or documents all gains follow from the same formula; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailframe.llm.common import ranked, staged

BUCKETS, LONGEST, SEED = 10_000, 2, 7
#: Bytes of text in a piece; single words may be longer.
PIECE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_SPACE = np.array([32], np.uint8)
# The primes of XXH64; the table of CRC-32 follows from its polynomial.
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number. ``data`` ends with eight bytes that belong to no n-gram."""
    return np.ndarray(max(0, len(data) - 7), "<u8", data, strides=(1,))


def hashed(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 with seed 0 of the slices of ``data``, all at once; slices of 32 bytes and more one by one."""
    eights = _eights(data)
    h = size.astype(np.uint64) + _P5
    for k in range(3):
        m = np.flatnonzero(size >= 8 * (k + 1))
        x = _rotated(eights[start[m] + 8 * k] * _P2, 31) * _P1
        h[m] = _rotated(h[m] ^ x, 27) * _P1 + _P4
    at = start + (size & ~7)
    m = np.flatnonzero(size & 4)
    h[m] = _rotated(h[m] ^ (eights[at[m]] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
    at[m] += 4
    for k in range(3):
        m = np.flatnonzero((size & 3) > k)
        h[m] = _rotated(h[m] ^ data[at[m] + k] * _P5, 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    long = np.flatnonzero(size >= 32)
    h[long] = [xxhash.xxh64_intdigest(data[a : a + n]) for a, n in zip(start[long].tolist(), size[long].tolist())]
    return h


def crc32(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of the slices of ``data``, a byte of each at a time; of slices of 32 bytes and more one by one."""
    c, k, m = np.full(len(start), 0xFFFFFFFF, np.uint32), 0, np.flatnonzero((size > 0) & (size < 32))
    while len(m):
        c[m] = (c[m] >> np.uint32(8)) ^ _CRC[(c[m] ^ data[start[m] + k]) & np.uint32(255)]
        k += 1
        m = m[size[m] > k]
    c ^= np.uint32(0xFFFFFFFF)
    long = np.flatnonzero(size >= 32)
    c[long] = [zlib.crc32(data[a : a + n]) for a, n in zip(start[long].tolist(), size[long].tolist())]
    return c


def _same_bytes(eights: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    same, k, m = np.ones(len(a), bool), 0, np.arange(len(a))
    while len(m):
        rest = np.minimum(size[m] - k, 8)
        same[m] = (eights[a[m] + k] ^ eights[b[m] + k]) << (64 - 8 * rest).astype(np.uint64) == 0
        k += 8
        m = m[same[m] & (size[m] > k)]
    return same


def intern(data: np.ndarray, keys: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each n-gram in an open-addressed table, and for each place which n-gram holds it (-1: none)."""
    n, eights = len(keys), _eights(data)
    mask = (1 << max(1, (2 * n).bit_length())) - 1
    holder = np.full(mask + 1, -1, np.int64)
    place = (keys & np.uint64(mask)).astype(np.int64)
    left = np.arange(n)
    while len(left):
        at = place[left]
        free = holder[at] < 0
        holder[at[free]] = left[free]  # of several that want one place, one gets it
        held = holder[at]
        same = (keys[held] == keys[left]) & (size[held] == size[left])
        other = np.flatnonzero(same & (held != left))
        same[other] = _same_bytes(eights, start[held[other]], start[left[other]], size[left[other]])
        left = left[~same]
        place[left] = (place[left] + 1) & mask
    return place, holder


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(row numbers, ends of their bytes, lower-cased bytes, how many words at its start the piece before has counted)."""
    texts = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(ends, ends[row] + PIECE, "right")) - 1)
        if ends[to] - ends[row] <= PIECE:
            yield np.arange(row, to), ends[row + 1 : to + 1] - ends[row], _LOWER[raw[ends[row] : ends[to]]], 0
        else:
            yield from _parts(row, _LOWER[raw[ends[row] : ends[row + 1]]])
        row = to


def _parts(row: int, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """A long text in parts that end outside words; each but the first begins with the last ``LONGEST - 1`` words of what came before."""
    outside = np.flatnonzero(~_IN_WORD[text])
    at, taken, carried = 0, np.empty(0, np.uint8), 0
    while at < len(text):
        k = int(np.searchsorted(outside, at + PIECE))
        stop = int(outside[k]) if k < len(outside) else len(text)
        part = np.concatenate((taken, _SPACE, text[at:stop]))
        yield np.array([row]), np.array([len(part)]), part, carried
        inside = _IN_WORD[part]
        begins = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        at, carried = stop, min(LONGEST - 1, len(begins))
        taken = part[begins[-carried] :] if carried else part[:0]


def _occurrences(ends: np.ndarray, text: np.ndarray, carried: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words with one space between them, start and size of each n-gram there, index of its text among ``ends``, words of each text)."""
    inside = _IN_WORD[text]
    cut = np.zeros(len(text) + 1, bool)
    cut[0] = cut[ends] = True
    before, after = np.concatenate(([False], inside[:-1])), np.concatenate((inside[1:], [False]))
    begin = np.flatnonzero(inside & (~before | cut[:-1]))
    length = np.flatnonzero(inside & (~after | cut[1:])) + 1 - begin
    of = np.searchsorted(ends, begin, "right")
    at = np.cumsum(length + 1) - length - 1
    words = np.full(int((length + 1).sum()) + 8, 32, np.uint8)
    words[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = text[inside]
    starts, sizes, owners = [], [], []
    for n in range(1, LONGEST + 1):
        first = np.arange(max(0, len(begin) - n + 1))
        first = first[of[first] == of[first + n - 1]]
        first = first[first + n > carried]
        last = first + n - 1
        starts.append(at[first])
        sizes.append(at[last] + length[last] - at[first])
        owners.append(of[first])
    counts = np.bincount(of, minlength=len(ends))
    counts[:1] -= carried
    return words, np.concatenate(starts), np.concatenate(sizes), np.concatenate(owners), counts


def _interned(data: np.ndarray, start: np.ndarray, size: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each occurrence, bucket at each place, occurrences at each place)."""
    place, holder = intern(data, hashed(data, start, size), start, size)
    used = np.flatnonzero(holder >= 0)
    bucket = np.zeros(len(holder), np.int64)
    bucket[used] = crc32(data, start[holder[used]], size[holder[used]]) % np.uint32(buckets)
    return place, bucket, np.bincount(place, minlength=len(holder))


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, ends, text, carried in _pieces(batch.column(0)):
            words, start, size, _, _ = _occurrences(ends, text, carried)
            if len(start):
                _, bucket, times = _interned(words, start, size, buckets)
                np.add.at(total, bucket[times > 0], times[times > 0])
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])


def _weigh(batches: Iterator[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        features, sums, words = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for rows, ends, text, carried in _pieces(batch.column(1)):
            spaced, start, size, of, n_words = _occurrences(ends, text, carried)
            words[rows] += n_words
            if len(start):
                place, bucket, _ = _interned(spaced, start, size, len(gains))
                features[rows] += np.bincount(of, minlength=len(ends))
                np.add.at(sums, rows[of], gains[bucket][place])
        weight = sums // np.maximum(features, 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (words, features, weight))], names=["doc_id", "n_words", "n_features", "weight"])


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): n-grams of all texts by bucket, for buckets that have any."""
    parts = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(lambda b: _count(b, buckets), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def learn_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, in thousandths: a count of one is added to each bucket on both sides."""
    s = staged(bucket_counts(docs, text_col, buckets), "source-counts").withColumnRenamed("n", "s")
    t = staged(bucket_counts(target, target_col, buckets), "target-counts").withColumnRenamed("n", "t")
    both = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left").fillna(0)
    sums = [x.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for x, c in ((s, "s"), (t, "t"))]
    share = ((F.col("t") + 1).cast("double") * float(sums[0] + buckets)) / ((F.col("s") + 1).cast("double") * float(sums[1] + buckets))
    rows = both.select("bucket", F.floor(F.lit(1000.0) * F.ln(share)).alias("gain")).collect()
    gains = np.zeros(buckets, np.int64)
    gains[[r.bucket for r in rows]] = [r.gain for r in rows]
    return gains


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a digest of the seed and the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """Every document's n_features, weight and score, and the rank of those drawn: ``percent`` of the documents of ``min_words`` or more."""
    gains = docs.sparkSession.sparkContext.broadcast(learn_gains(docs, target, buckets=buckets))
    weighed = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lambda b: _weigh(b, gains.value), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")
    scored = weighed.withColumns({"score": F.col("weight") + noise(F.col("doc_id"), seed), "tie": F.monotonically_increasing_id()})
    scored = staged(scored, "weighed")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    placed = ranked(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("tie").asc()])
    rank = F.when(F.col("rank") < drawn, F.col("rank") + 1)
    kept = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*kept, rank.alias("rank")).unionByName(scored.where(F.col("n_words") < min_words).select(*kept, F.lit(None).cast("long").alias("rank")))
