"""SimHash near-duplicates: fingerprints of 3-word shingles, pigeonhole blocks, verified links, components.

Equal fingerprints are collapsed first, by an aggregation that combines before it shuffles. Two fingerprints that
differ in at most 2 of 64 bits agree in at least two of four 16-bit blocks, so each distinct fingerprint is
placed under six keys, one for each pair of blocks, and what shares a key is verified by Hamming distance.
A key with more than ``BUCKET`` distinct fingerprints would give too many pairs. Its fingerprints are linked by
an exact way without pairs: two fingerprints lie within 2 bits just if some 64-bit word lies within 1 bit of
both, so each emits itself and its 64 one-bit neighbours, and whoever meets at a word is linked (at most 65 can
meet). Components come from rounds that move nodes to their smallest neighbours and drop the edges inside.

Fingerprints of texts that share four fifths of their shingles differ in up to a dozen bits, which no pigeonhole
blocks find at a bearable cost. ``similar_texts`` therefore goes two steps, both checked by the Jaccard similarity of the shingle
sets itself. First the fingerprints: what they put into one component is compared with one text of it (``link_by_fingerprint``), which links most of a large group without pairs. Then an exact
join of what is not linked by then: two such sets share a shingle among the first ``n - need + 1`` of each in one common
order (prefix filter), and whatever meets there is verified. See ``link_similar``.

Edge cases: null and empty texts have fingerprint zero and link like any other; a null id is never a component's
name, and a component of null ids alone has a null name; repeated rows get the same component; equal ids or fingerprints
are no special case; very long texts are hashed in slices, and a shingle set takes memory in proportion to its text; other columns, whatever their
names, are not carried along by ``near_duplicates`` and come back unchanged from ``one_of_each``; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailframe.llm.common import bounded_sample, scratch, shared_dir, staged, staged_for_good, write

#: Distinct fingerprints of one key up to which all its pairs are verified.
BUCKET = 32
SEED = 42
_CHUNK = 1 << 15
#: Texts in which common shingles are counted, and how many of the commonest are kept apart.
SAMPLE, COMMON = 4_096, 1 << 16
#: Sets of a key that all its sets meet first, before all that is not linked by then meets.
ROUNDS = 3
#: Rows of two longs up to which a side of a join is broadcast; larger sides are shuffled.
BROADCAST_ROWS = 1 << 20
#: Longs of a sketch up to which it stands beside the key in a large key's second meeting; longer ones are folded.
SHORT = 64
#: Keys of a task that counts them.
KEYS_A_TASK = 400_000
_AT_BITS = 20
_ALL = (1 << 64) - 1
_AT_MOST = (1 << _AT_BITS) - 1


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint, signed as Spark's long."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    shingles = map(b" ".join, zip(w, w[1:], w[2:])) if len(w) > 2 else iter((b" ".join(w),))
    hashes = map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED))
    ones, n = np.zeros(64, np.int64), max(1, len(w) - 2)
    while len(part := np.fromiter(itertools.islice(hashes, _CHUNK), np.dtype("<u8"))):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _add_fingerprints(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [fingerprint(x.as_py()) for x in batch.column(at)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.int64())], names=[*batch.schema.names, "fp"])


def with_fingerprints(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``fp`` (long) and drops the text, of which whatever follows has no need."""
    df = df.drop("fp")
    at = df.columns.index(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField("fp", T.LongType())])
    return df.mapInArrow(lambda batches: _add_fingerprints(batches, at), schema).drop(text_col)


def _forest(fps: list[int]) -> Iterator[tuple[int, int]]:
    """Edges from fingerprints to the smallest of these that is reachable over links of 2 bits or fewer among these."""
    rest = sorted(fps)
    while rest:
        least, *rest = rest
        todo = [least]
        while todo and rest:
            at = todo.pop()
            near = [x for x in rest if ((x ^ at) & _ALL).bit_count() <= 2]
            if near:
                rest = [x for x in rest if x not in near]
                todo += near
                yield from ((x, least) for x in near)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        edges = [e for fps in batch.column(0).to_pylist() for e in _forest(fps)]
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["src", "dst"])


def link_fingerprints(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (src > dst) whose components are those of "differs in at most 2 bits" among the distinct ``fp``.

    They are a few for each fingerprint, however many lie close to it: a small key gives a spanning forest of its links. At a word of a
    large key's fingerprints not these themselves link, but the smallest that each has met at any word, of which most are the same.
    """
    block = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    keys = [F.struct(F.lit(n).alias("n"), block[i].alias("a"), block[j].alias("b")) for n, (i, j) in enumerate(itertools.combinations(range(4), 2))]
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    keyed = staged(keyed.join(sizes, "key").select("fp", "key.*", "size"), "simhash-keys")
    few = keyed.where(F.col("size") <= bucket).groupBy("n", "a", "b").agg(F.collect_list("fp").alias("all"))
    pairs = few.select("all").mapInArrow(_forests, "src long, dst long")
    many = keyed.where(F.col("size") > bucket).select("fp").distinct()
    middles = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64)))

    def meets(rows: DataFrame, who: str) -> DataFrame:
        met = rows.select(F.col(who).alias("who"), F.explode(middles).alias("m")).groupBy("m").agg(F.collect_set("who").alias("all")).where(F.size("all") > 1)
        return met.select(F.explode("all").alias("src"), F.array_min("all").alias("dst"))

    lowest = staged(meets(many, "fp").groupBy("src").agg(F.min("dst").alias("dst")), "simhash-lowest")
    across = meets(lowest.select(F.col("src").alias("fp"), "dst"), "dst")
    return pairs.union(lowest).union(across).where("src <> dst").distinct()


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, label): label is the smallest node reachable. Nodes without an edge have no row.

    A round moves each node to the smallest of its neighbours and itself, from there on likewise to the end, and keeps the edges between different nodes that this leaves, once each.
    Two rounds at least halve the nodes with edges, and the join of edges and moves gets a row for each edge that is left, not for each edge and round.
    """
    left, moves = staged(edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "links"), []
    for _ in range(max_rounds):
        both = left.union(left.select("dst", "src"))
        up = staged(both.groupBy(F.col("src").alias("node")).agg(F.least(F.first("src"), F.min("dst")).alias("label")), "up")
        moved = up
        for _ in range(max_rounds):  # to the end of the chain; each jump doubles its length
            above = moved.select(F.col("node").alias("at"), F.col("label").alias("jump"))
            jumped = staged(moved.join(above, moved["label"] == above["at"]).select("node", F.col("label").alias("old"), F.col("jump").alias("label")), "moved")
            moved = jumped.select("node", "label")
            if jumped.where("old <> label").isEmpty():
                break
        moves.append(moved)
        half = staged(left.join(moved, left["src"] == moved["node"]).select(F.col("label").alias("src"), "dst"), "links-half")
        whole = half.join(moved, half["dst"] == moved["node"]).select("src", F.col("label").alias("dst")).where("src <> dst")
        left = staged(whole.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "links-left")
        if left.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    labels = moves.pop()
    while moves:
        last, moved = labels.select(F.col("node").alias("at"), F.col("label").alias("end")), moves.pop()
        labels = staged(moved.join(last, moved["label"] == last["at"], "left").select("node", F.coalesce("end", "label").alias("label")), "labels")
    return labels


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct hashes of the text's shingles, ascending; of fewer words than ``width`` all make one."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, np.int64)
    runs = map(b" ".join, zip(*(w[k:] for k in range(width)))) if len(w) > width else iter((b" ".join(w),))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, runs, itertools.repeat(SEED)), np.dtype("<u8")).view("<i8"))


def _set_digest(s: np.ndarray) -> int:
    return int(np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED)], np.uint64).view(np.int64)[0]) if len(s) else 0


def _add_sets(batches: Iterator[pa.RecordBatch], at: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1_000):
            part = batch.slice(start, 1_000)
            sets = [shingles(x.as_py(), width) for x in part.column(at)]
            new = [pa.array(map(_set_digest, sets), pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "fp", "set"])


def _add_prefixes(batches: Iterator[pa.RecordBatch], at: int, width: int, percent: int, common: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1_000):
            part = batch.slice(start, 1_000)
            fps, sizes, prefixes, rares, sketches, prints = [], [], [], [], [], []
            for x in part.column(at):
                s = shingles(x.as_py(), width)
                prints.append(fingerprint(x.as_py()))
                place = np.minimum(np.searchsorted(common, s), len(common) - 1)
                seen = np.where(common[place] == s, counts[place], 0)
                order = np.lexsort((s, seen))
                fps.append(_set_digest(s))
                sizes.append(len(s))
                bits = 64 << max(1, (len(s) // 32).bit_length())
                odd = np.bincount(s & (bits - 1), minlength=bits) & 1
                sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                prefixes.append(s[order[: len(s) + percent * len(s) // -100 + 1]])
                rares.append(int((seen == 0).sum()))
            new = [pa.array(fps, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(rares, pa.int32()), pa.array(sketches, pa.list_(pa.int64())), pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "fp", "n", "keys", "rare", "sketch", "print"])


def with_sets(df: DataFrame, text_col: str, width: int) -> DataFrame:
    """Adds ``fp``, a digest of the shingle set, and ``set``, and drops the text."""
    df = df.drop("fp", "set")
    at = df.columns.index(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField("fp", T.LongType()), T.StructField("set", T.ArrayType(T.LongType()))])
    return df.mapInArrow(lambda batches: _add_sets(batches, at, width), schema).drop(text_col)


def with_prefixes(df: DataFrame, width: int, percent: int) -> DataFrame:
    """Adds ``fp``, the set's size ``n``, its prefix ``keys``, its ``sketch`` and the text's fingerprint ``print`` to rows with a ``text``, which is replaced by its hash.

    Shingles stand in the order of their number in a sample, then of their hash. Any order gives the same links;
    this one keeps shingles of many texts out of the prefixes. The first ``rare`` shingles are not common in the sample. A sketch's bits are the parities of the numbers of
    shingles that fall to each; there are two to four bits a shingle, by powers of two, so that a longer sketch can be folded.
    """
    seen = with_sets(bounded_sample(df.select("text"), "text", SAMPLE), "text", width).select(F.explode("set").alias("s"))
    rows = seen.groupBy("s").agg(F.count("*").alias("c")).where("c > 2").orderBy(F.desc("c"), "s").limit(COMMON).collect()
    found = np.array(sorted((r.s, r.c) for r in rows) or [(0, 0)], np.int64)
    shared = df.sparkSession.sparkContext.broadcast((found[:, 0].copy(), found[:, 1].copy()))
    at = df.columns.index("text")
    schema = T.StructType([*df.schema.fields, T.StructField("fp", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("rare", T.IntegerType()), T.StructField("sketch", T.ArrayType(T.LongType())), T.StructField("print", T.LongType())])
    return df.mapInArrow(lambda batches: _add_prefixes(batches, at, width, percent, *shared.value), schema).withColumn("text", F.xxhash64("text"))


def _sets_of(fps: DataFrame, nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``fp`` and ``set`` of the given sets, made from one text of each again: carrying all sets along would cost more."""
    some = staged(nodes.join(fps, "fp").select("one.*").select(F.col("doc_id").alias("_id"), F.col("text").alias("_hash")), "close-texts")
    few = F.broadcast(some) if some.count() <= BROADCAST_ROWS else some
    whole = texts.join(few, texts["doc_id"].eqNullSafe(few["_id"]) & (F.xxhash64(texts["text"]) == few["_hash"]), "left_semi").select("text")
    return staged(with_sets(whole, "text", width).groupBy("fp").agg(F.first("set").alias("set")), "shingle-sets")


def _differ(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ, the longer one folded to the length of the shorter."""
    half = (F.greatest(F.size(a), F.size(b)) / 2).cast("int")
    fold = lambda x: F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))
    same = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda total, n: total + n)
    return F.when(F.size(a) == F.size(b), same(a, b)).when(F.size(a) > F.size(b), same(fold(a), b)).otherwise(same(a, fold(b)))


def _short(sketch: Column) -> Column:
    """The sketch folded to ``SHORT`` longs, if it is longer: it still differs from another in no more bits than their sets in shingles."""
    long = lambda k: F.aggregate(F.sequence(F.lit(0), F.floor(F.size(sketch) / SHORT).cast("int") - 1), F.lit(0).cast("long"), lambda x, i: x.bitwiseXOR(F.get(sketch, i * SHORT + k)))
    return F.when(F.size(sketch) <= SHORT, sketch).otherwise(F.transform(F.sequence(F.lit(0), F.lit(SHORT - 1)), long))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (src, dst) those whose sets' Jaccard similarity is ``percent`` or more. Each join is one of two tables."""
    spark, path = pairs.sparkSession, shared_dir(pairs.sparkSession, "pairs-verified")
    with scratch(spark):  # a set for each pair: the largest table here, so it goes at once
        half = staged(pairs.join(sets.select(F.col("fp").alias("src"), F.col("set").alias("a")), "src"), "close-half")
        both = half.join(sets.select(F.col("fp").alias("dst"), F.col("set").alias("b")), "dst")
        overlap = F.size(F.array_intersect("a", "b"))
        write(both.where((100 + percent) * overlap >= percent * (F.size("a") + F.size("b"))).select("src", "dst"), path)
    return spark.read.schema(pairs.select("src", "dst").schema).parquet(path)


def _shared_keys(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (key, fp, place) of keys of more than one set, with the key's number of ``rows`` and its ``low`` and ``high`` row.

    ``place`` is the set's size and the key's place in it; places from ``_AT_MOST`` on count as that, which keeps more pairs and loses none.
    Nearly all keys are of one set. Those that a sample doesn't know as common have a small share of the rows each: they are
    shuffled once, as they are, and both counted and picked where they arrive. A common key may have a third of all rows: its
    rows are combined before they are shuffled, and picked by a join whose large partitions can be split.
    """
    each = rows.select("fp", "n", "rare", F.posexplode("keys").alias("at", "key")).where("key is not null")
    place = F.shiftleft(F.col("n").cast("long"), _AT_BITS).bitwiseOR(F.least("at", F.lit(_AT_MOST)).cast("long")).alias("place")
    # The first shingle of a pair in the common order lies among the first 1 - 2p/(1 + p) of the smaller set: keys that do in no set are not needed.
    n, at = F.shiftright("place", _AT_BITS), F.col("place").bitwiseAND(F.lit(_AT_MOST))
    early = (100 + percent) * (n - at) >= 2 * percent * n
    own = F.struct("fp", "place")

    def held(some: DataFrame) -> DataFrame:
        found = some.groupBy("key").agg(F.min(own).alias("low"), F.max(own).alias("high"), F.count("*").alias("rows"), F.bool_or(early).alias("early"))
        return found.where("low.fp <> high.fp and early").drop("early")

    total = rows.agg(F.sum(F.size("keys").cast("long"))).first()[0] or 0
    rare = each.where("at < rare").select("key", "fp", place).repartition(int(total // KEYS_A_TASK) + 1, "key")
    common = each.where("at >= rare").select("key", "fp", place)
    picked = rare.join(held(rare).hint("shuffle_hash"), "key").unionByName(common.join(staged(held(common), "common-keys"), "key"))
    return picked.select("key", "fp", "place", "rows", "low", "high")


def link_by_fingerprint(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (x, y) of a set and that chosen by hash in its component of fingerprints, with their sketches: as many as there are sets at most."""
    prints = staged(nodes.select(F.col("print").alias("fp")).distinct(), "prints")
    labels = staged(components(link_fingerprints(prints, bucket)), "print-labels")
    named = staged(nodes.join(labels, nodes["print"] == labels["node"], "left").select("fp", "n", "sketch", F.coalesce("label", "print").alias("of")), "print-sets")
    one = named.groupBy("of").agg(F.min_by(F.struct("fp", "n", "sketch"), F.xxhash64("fp")).alias("y"), F.count("*").alias("sets")).where("sets > 1").drop("sets")
    pairs = named.join(one, "of").select(F.struct("fp", "n", "sketch").alias("x"), "y")
    return pairs.where("x.fp <> y.fp")


def link_similar(rows: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges (src > dst) whose components are those of "Jaccard similarity of ``percent`` or more" among distinct ``fp``.

    ``rows`` are those of ``with_prefixes``, ``texts`` has the columns ``doc_id`` and ``text``. A large group of near copies would
    give pairs by the square of its size. So what fingerprints link goes first, and every set then meets few sets of each of its keys that it isn't linked with: that with the most
    shared keys, which is the text the others were made from if there is one, and some chosen by hash. What is linked by
    then need not meet any more: of each key, all outside its largest component so far meet all of another component.
    Pairs are made only if their sizes, the keys' places and their sketches leave the similarity possible: two sketches
    differ in no more bits than their sets in shingles. In the second meeting of keys of more than ``BUCKET`` sets, sketches stand beside the
    keys, so that such a key's pairs are made only if they leave it possible.
    """
    nodes = staged(rows.groupBy("fp").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("print").alias("print"), F.min(F.struct("doc_id", "text")).alias("one")), "sets")
    shared = staged(_shared_keys(rows, percent), "shared-keys")
    # Two rows are one pair; keys with more go on.
    size_at = lambda place: (F.shiftright(place, _AT_BITS).cast("int").alias("n"), place.bitwiseAND(F.lit(_AT_MOST)).cast("int").alias("at"))
    side = lambda c: F.struct(F.col(f"{c}.fp"), *size_at(F.col(f"{c}.place")))
    twos = shared.where("rows = 2 and fp = low.fp").select(side("low").alias("x"), side("high").alias("y"))
    keyed = staged(shared.where("rows > 2").select("key", "fp", *size_at(F.col("place"))).distinct(), "keyed-sets")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    central = staged(keyed.groupBy("fp").agg((F.count("*") / F.first(prefix)).alias("share")), "central-sets")
    keyed = staged(keyed.join(central, "fp"), "keyed-central")
    sketches = nodes.select("fp", "sketch")
    total = F.col("x.n") + F.col("y.n")

    def fits(pairs: DataFrame) -> DataFrame:
        rest = 1 + F.least(F.col("x.n") - F.col("x.at") - 1, F.col("y.n") - F.col("y.at") - 1)
        return pairs.where(F.col("x.fp") != F.col("y.fp")).where((100 + percent) * rest >= percent * total)

    def close(pairs: DataFrame) -> DataFrame:
        differ = _differ(F.col("x.sketch"), F.col("y.sketch"))
        return pairs.where((100 + percent) * (total - F.coalesce(differ, F.lit(0))) >= 2 * percent * total).select(F.greatest("x.fp", "y.fp").alias("src"), F.least("x.fp", "y.fp").alias("dst")).distinct()

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("src").alias("fp")).union(pairs.select(F.col("dst").alias("fp"))).distinct()

    ids = [F.col(c).alias(n) for c, n in (("x.fp", "a"), ("x.n", "an"), ("y.fp", "b"), ("y.n", "bn"))]

    def sketched(pairs: DataFrame) -> DataFrame:
        half = staged(staged(pairs, "pairs").join(sketches, F.col("a") == F.col("fp")).select(F.struct(F.col("a").alias("fp"), F.col("an").alias("n"), "sketch").alias("x"), "b", "bn"), "pairs-half")
        return close(half.join(sketches, F.col("b") == F.col("fp")).select("x", F.struct(F.col("b").alias("fp"), F.col("bn").alias("n"), "sketch").alias("y")))

    # By fingerprints first.
    printed = staged(close(link_by_fingerprint(nodes)), "pairs-printed")
    first = staged(ends(printed), "printed-sets")
    sets = _sets_of(first, nodes, texts, width)
    linked = _verified(printed, sets, percent)
    labels = staged(components(linked), "printed-labels")
    keyed = staged(keyed.join(labels, keyed["fp"] == labels["node"], "left").select(*keyed.columns, F.coalesce("label", "fp").alias("label")), "keyed-printed")

    row = F.struct("fp", "n", "at", "label")
    one = [F.max_by(row, F.struct("share", "fp")), *(F.min_by(row, F.xxhash64(F.lit(k), "fp")) for k in range(1, ROUNDS))]
    met = staged(keyed.groupBy("key").agg(F.array_distinct(F.array(*one)).alias("ones")).select("key", F.explode("ones").alias("one")).select("key", "one.*"), "met")
    met = keyed.alias("x").join(met.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label")))
    pairs = fits(met).select(*ids).union(fits(twos).select(*ids)).distinct()
    pairs = staged(sketched(pairs).join(printed, ["src", "dst"], "left_anti"), "pairs-close")
    wanted = staged(ends(pairs).union(first).distinct(), "close-sets")
    further = staged(wanted.join(first, "fp", "left_anti"), "close-further")
    sets = sets.unionByName(_sets_of(further, nodes, texts, width))
    edges = staged(linked.unionByName(_verified(pairs, sets, percent)), "edges")
    labels = components(edges)
    # Each key's rows with their component so far, and whether that is the key's largest. Two sets of a key have met.
    named = staged(keyed.drop("label").join(labels, keyed["fp"] == labels["node"], "left").select("key", "fp", "n", "at", F.coalesce("label", "fp").alias("label")), "keyed-labels")
    sizes = staged(named.groupBy("key", "label").agg(F.count("*").alias("size")), "label-sizes")
    largest = sizes.groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("largest"), F.count("*").alias("labels"), F.sum("size").alias("all")).where("labels > 1 and all > 2").select("key", "largest", "all")
    open_ = staged(named.join(staged(largest, "largest"), "key"), "keyed-open")
    large = open_.where(F.col("all") > BUCKET).join(nodes.select("fp", _short(F.col("sketch")).alias("short")), "fp")
    open_ = staged(large.unionByName(open_.where(F.col("all") <= BUCKET), allowMissingColumns=True), "keyed-short")
    near = F.coalesce((100 + percent) * (total - _differ(F.col("x.short"), F.col("y.short"))) >= 2 * percent * total, F.lit(True))
    apart = fits(open_.where("label <> largest").alias("x").join(open_.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label")))).where(near)
    apart = sketched(apart.select(*ids).distinct())
    pairs = staged(staged(apart, "pairs-apart").join(pairs.union(printed), ["src", "dst"], "left_anti"), "pairs-left")
    more = staged(ends(pairs).join(wanted, "fp", "left_anti"), "close-more")
    if not more.isEmpty():
        sets = sets.unionByName(_sets_of(more, nodes, texts, width))
    return edges.unionByName(_verified(pairs, sets, percent)).distinct()


def _name_components(rows: DataFrame, link) -> DataFrame:
    """Adds ``label``, which all rows of a component share, and ``component_id`` to rows with ``doc_id`` and ``fp``."""
    fps = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    labels = components(link(fps))
    linked = fps.join(labels, fps["fp"] == labels["node"])
    names = linked.groupBy(F.col("label").alias("of")).agg(F.min("least").alias("name"))
    named = linked.join(names, F.col("label") == F.col("of")).select("node", "label", "name")
    ids = fps.join(named, fps["fp"] == named["node"], "left").select(F.col("fp").alias("_fp"), F.coalesce("label", "fp").alias("label"), F.coalesce("name", "least").alias("component_id"))
    # Written first, so that the last join is one of two tables, whose large partitions can be split.
    ids = staged(ids, "components")
    return rows.join(ids, rows["fp"] == ids["_fp"]).drop("_fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per document: id, fp (long), component_id, the smallest id reachable over links of 2 bits or fewer."""
    rows = staged(with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))), "fingerprints")
    return _name_components(rows, lambda fps: link_fingerprints(fps.select("fp"), bucket)).select("doc_id", "fp", "component_id")


def _classes(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(with_prefixes(own, width, percent), "set-prefixes")
    named = _name_components(rows.select("doc_id", "fp", "text"), lambda _: link_similar(rows, own, width, percent))
    return named.select("doc_id", F.col("text").alias("hash"), "fp", "label", "component_id")


def similar_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The same with links between texts whose sets of ``width``-word shingles have a Jaccard similarity of ``percent`` or more.

    ``fp`` is a digest of the set; equal sets link, those without words too.
    """
    return _classes(docs, id_col, text_col, width, percent).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay: one of each component of ``similar_texts``. Columns as given.

    It is that with the smallest id, null ids last, and of different texts under one id that with the smallest hash;
    of rows that repeat both, one stays. Only ids and hashes are shuffled, and not the documents: what goes is the smaller part, and is broadcast as
    long as it has at most ``BROADCAST_ROWS`` rows.
    """
    with scratch(docs.sparkSession):
        light = staged(_classes(docs, id_col, text_col, width, percent).select("doc_id", "hash", "label"), "classes")
        row = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "hash")
        best = staged(light.groupBy("label").agg(F.min(row).alias("best")), "class-best")
        judged = light.join(best, "label").select("doc_id", "hash", row.eqNullSafe(F.col("best")).alias("stays"))
        counted = judged.groupBy("doc_id", "hash", "stays").agg(F.count("*").alias("n")).where("n > 1 or not stays")
        marked = staged_for_good(counted.select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"), "stays"), "class-marks")
    size = marked.count()

    def met(how: str, rows: DataFrame) -> DataFrame:
        side = F.broadcast(rows) if size <= BROADCAST_ROWS else rows
        return docs.join(side, docs[id_col].eqNullSafe(side["__id"]) & (F.xxhash64(docs[text_col]) == side["__hash"]), how)

    again = marked.where("stays")
    out = met("left_anti", marked)
    if again.isEmpty():
        return out
    packed = met("left_semi", again).select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    # Rows may have columns that can't be compared, so one of each is taken by what tells them apart.
    first = packed.groupBy(F.col("_row")[id_col], F.xxhash64(F.col("_row")[text_col])).agg(F.first("_row").alias("_row"))
    return out.unionByName(first.select("_row.*"))
