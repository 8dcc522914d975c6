"""URL filters: host and path rules, and exact key lists as Bloom filter cascades.

A cascade is built over the complete universe of keys that the corpus holds. Level 1 encodes the listed keys;
level 2 the other keys of the universe that level 1 lets through; level 3 the listed keys that level 2 lets
through; and so on until nothing slips by. For every key of the universe the first level that says no settles
the matter, so membership is exact, and it is a pure expression over small bitmap literals: no join, no shuffle.

Edge cases: a null url, or one without ``://``, has an empty host and path, which fit no rule and no key; an
empty table has an empty universe; an empty list gives a cascade that lists nothing; repeated urls are judged alike; urls of any length are
judged whole; of rules of equal length the first given counts; columns of the input named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailframe.llm.common import let, staged

#: Bytes of a bitmap that reach the driver as one row.
STRETCH = 4_096

def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column) -> Column:
    """``a.b.c`` gives ``[a.b.c, b.c, c]``; an empty host gives none."""
    parts = F.split(host, r"\.")
    suffixes = let(parts, lambda p: F.transform(F.sequence(F.lit(1), F.size(p)), lambda k: F.array_join(F.slice(p, k, F.size(p) - k + 1), ".")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(suffixes)


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit("." + self.host))) & F.startswith(path, F.lit(self.path))


def longest_rule(host: Column, path: Column, rules: list[UrlRule]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest fitting rule, null where none fits. Among equals the first counts."""
    text = verdict = None
    for r in sorted(rules, key=lambda r: -len(r.host + r.path)):
        fits = r.fits(host, path)
        text = F.when(fits, r.host + r.path) if text is None else text.when(fits, r.host + r.path)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


@dataclass(frozen=True)
class BloomLevel:
    n_bits: int
    n_hashes: int
    bitmap: bytes

    def positions(self, key: Column, level: int) -> Column:
        """Double hashing; the second step is odd, and each level has hashes of its own."""
        one, two = F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1)).bitwiseOR(F.lit(1))
        # Halved so that sums stay within 64 bits.
        one, two = F.shiftrightunsigned(one, 8), F.shiftrightunsigned(two, 16)
        return F.array(*(F.pmod(one + i * two, F.lit(self.n_bits)) for i in range(self.n_hashes)))

    def has(self, key: Column, level: int) -> Column:
        bits = F.lit(self.bitmap)

        def on(at: Column) -> Column:
            byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            return F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1

        return F.forall(self.positions(key, level), on)


@dataclass(frozen=True)
class BloomCascade:
    levels: tuple[BloomLevel, ...]

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe that the cascade was built over."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            verdict = F.when(self.levels[k].has(key, k), verdict).otherwise(F.lit(k % 2 == 1))
        return verdict


def _level(keys: DataFrame, n_keys: int, rate: float, level: int) -> BloomLevel:
    n_bits = max(64, 8 * math.ceil(n_keys * -math.log(rate) / math.log(2) ** 2 / 8))
    empty = BloomLevel(n_bits, max(1, round(-math.log2(rate))), b"")
    at = F.explode(empty.positions(F.col("key"), level)).alias("at")
    bit = F.call_function("shiftleft", F.lit(1), F.col("at").bitwiseAND(F.lit(7)).cast("int"))
    # Bytes are put together by stretches of ``STRETCH`` of them, as hex digits, so that the driver gets few rows.
    byte = keys.select(at).groupBy(F.shiftright("at", 3).alias("byte")).agg(F.bit_or(bit).alias("bits"))
    part = byte.groupBy(F.floor(F.col("byte") / STRETCH).cast("long").alias("part")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("byte") % STRETCH).cast("int"), F.lpad(F.hex("bits"), 2, "0")))).alias("at"))
    packed = part.select("part", F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(STRETCH - 1)), lambda k: F.coalesce(F.try_element_at("at", k), F.lit("00"))), "")).alias("bytes"))
    bitmap = bytearray(n_bits // 8 + STRETCH)
    for r in packed.toLocalIterator():
        bitmap[r["part"] * STRETCH : (r["part"] + 1) * STRETCH] = r["bytes"]
    return BloomLevel(n_bits, empty.n_hashes, bytes(bitmap[: n_bits // 8]))


def build_cascade(universe: DataFrame, listed: DataFrame, max_listed: int = 1_000_000) -> BloomCascade:
    """A cascade for the listed keys over all keys of the corpus. Both tables have one column ``key``.

    ``max_listed`` bounds the list, and with it the bitmaps on the driver and in the plan: the first level's rate
    of false positives shrinks as the universe outgrows the list, so that about as many keys slip through as are
    listed, and each later level halves what is left. A longer list is refused, never cut.
    """
    clean = lambda df: df.select("key").where("key is not null").distinct()
    listed = staged(clean(listed), "listed")
    n_listed = listed.count()
    if n_listed > max_listed:
        raise ValueError(f"{n_listed} listed keys; max_listed is {max_listed}")
    if not n_listed:
        return BloomCascade(())
    others = staged(clean(universe).join(listed, "key", "left_anti"), "universe")
    inside, n_inside, outside = listed, n_listed, others
    rate = min(0.5, max(1e-9, n_listed * math.sqrt(0.5) / max(others.count(), 1)))
    levels: list[BloomLevel] = []
    while n_inside:
        k = len(levels)
        levels.append(_level(inside, n_inside, rate, k))
        slipped = staged(outside.where(levels[k].has(F.col("key"), k)), "slipped")
        inside, n_inside, outside, rate = slipped, slipped.count(), inside, 0.5
    return BloomCascade(tuple(levels))


def judge_urls(pages: DataFrame, rules: list[UrlRule], listed: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict: the longest rule's, else block if the host or a parent domain is listed."""
    parsed = pages.withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))})
    universe = parsed.select("host").distinct().select(F.explode(host_suffixes(F.col("host"))).alias("key"))
    cascade = build_cascade(universe, listed)
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.exists(host_suffixes(F.col("host")), cascade.contains), "block").otherwise("allow")
    return parsed.withColumns({"rule": rule, "verdict": F.coalesce(verdict, by_list)})
