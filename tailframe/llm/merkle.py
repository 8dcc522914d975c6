"""A Merkle tree over the rows of a dataset, by group, with a proof for each row.

Leaves are digests of a row's columns. Each group's leaves are ranked by ``common.ranked``, and the bits of a rank say where the leaf lies: the low
``BITS`` bits are its place in a block, the others the block's number. Within a block the bits are grouped away one after another, the
lowest first: a group of two becomes a node with its digest, the nodes below nested in it. All these groupings share one exchange, as all have the
block among their keys. Blocks are then the leaves of the next tier of blocks, until one is left; and the groups' roots are leaves of one more such tree.

Proofs come from the top down: a transform of the nested nodes gives each one the digests beside its way, and an explode makes them rows,
without joins inside a block. **What lies above a block reaches it by a join of blocks, one row for 256 leaves**: nesting everything up to the root in one row
would need no join, but would hold the whole dataset in one task.

Edge cases: nulls are marked in the digest, so they differ from empty values; rows with a null order come first, rows with a null group are a group, before all others;
rows of equal order are ordered by digest; equal rows are leaves of their own; very long texts are digested whole, and only digests are shuffled; a group of one row has
the leaf as its root, and so has a table of one group; an empty table has no root and no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailframe.llm.common import ranked, staged

#: Levels of the tree in a block at most, which so has up to 256 leaves.
BITS = 8


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of strings, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*columns: Column) -> Column:
    """Of each column ``-`` if null, else its bytes in UTF-8, a colon and its value."""
    texts = [c.cast("string") for c in columns]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda so_far, step: digest(step["left"], so_far, step["right"]))


def proof_digest(proof: Column) -> Column:
    """Digest of a proof's siblings, from the leaf to the root."""
    return digest(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""))


def _rolled(nodes: DataFrame, bits: int) -> DataFrame:
    """(g, block, n, node): each block's nodes (g, rank, n, h, item) nested in one. ``n`` counts the group's nodes on this tier."""
    digits = [F.shiftright("rank", k).bitwiseAND(F.lit(1)).cast("int").alias(f"d{k}") for k in range(bits)]
    t = nodes.select("g", F.shiftright("rank", bits).alias("block"), "n", *digits, F.struct("h", "item").alias("node")).repartition("g", "block")
    for k in range(bits):
        keys = ["g", "block", "n", *(f"d{j}" for j in range(k + 1, bits))]
        t = t.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(f"d{k}", "node"))).alias("run"))
        first, second = F.get("run", F.lit(0))["node"]["h"], F.get("run", F.lit(1))["node"]["h"]
        # A run of one is hashed as well, but for the one node that is left of a group.
        h = F.when(F.col("n") > (1 << k), digest(first, F.coalesce(second, F.lit("")))).otherwise(first)
        t = t.select(*keys, F.struct(h.alias("h"), "run").alias("node"))
    return t


def _unrolled(blocks: DataFrame, bits: int, above: list[str]) -> DataFrame:
    """(g, item, h, path, *above): the nodes nested in each block, with the steps from each to the root; ``path`` holds those from the block."""

    def children(hashed: Column):
        def below(way: Column) -> Column:
            run = way["node"]["run"]
            beside = lambda i: F.coalesce(F.get(run, F.lit(i))["node"]["h"], F.lit(""))
            step = lambda i: F.struct(F.when(i == 1, beside(0)).otherwise("").alias("left"), F.when(i == 0, beside(1)).otherwise("").alias("right"))
            path = lambda i: F.when(hashed, F.concat(F.array(step(i)), way["path"])).otherwise(way["path"])
            return F.transform(run, lambda child, i: F.struct(child["node"].alias("node"), path(i).alias("path")))

        return below

    ways = F.array(F.struct("node", "path"))
    for k in reversed(range(bits)):
        ways = F.flatten(F.transform(ways, children(F.col("n") > (1 << k))))
    rows = blocks.select("g", *above, F.explode(ways).alias("way"))
    return rows.select("g", "way.node.item", "way.node.h", "way.path", *above)


def _tiers(nodes: DataFrame) -> list[tuple[DataFrame, int]]:
    """Blocks of nodes, blocks of those blocks and so on, up to one for each group; and the levels in each."""
    left = nodes.agg(F.max("n")).first()[0] or 0
    tiers: list[tuple[DataFrame, int]] = []
    while not tiers or left > 1:
        bits = max(1, min(BITS, (left - 1).bit_length()))
        tiers.append((staged(_rolled(nodes, bits), "merkle-blocks"), bits))
        left = (left + (1 << bits) - 1) >> bits
        n = F.shiftright(F.col("n") + ((1 << bits) - 1), bits)
        nodes = tiers[-1][0].select("g", F.col("block").alias("rank"), n.alias("n"), "node.h", F.struct("block").alias("item"))
    return tiers


def _proved(tiers: list[tuple[DataFrame, int]], tops: DataFrame, above: list[str]) -> DataFrame:
    """(item, h, path, *above) of the lowest tier's nodes; ``tops`` gives each group's ``path`` and what else comes from above."""
    paths = tops.select("g", F.lit(0).cast("long").alias("block"), "path", *above)
    for blocks, bits in reversed(tiers[1:]):
        paths = _unrolled(blocks.join(paths, ["g", "block"]), bits, above).select("g", "item.block", "path", *above)
        paths = staged(paths, "merkle-paths")
    blocks, bits = tiers[0]
    return _unrolled(blocks.join(paths, ["g", "block"]), bits, above).select("item", "h", "path", *above)


def merkle_manifest(rows: DataFrame, leaf: Column, order: Column, group: Column, *carried: Column) -> DataFrame:
    """The columns ``carried`` of each row with ``leaf``, ``subroot`` (its group's root), ``root`` and ``proof``, steps of a left and a right sibling (one of them empty, both for a run of one).

    A proof leads over the subroot to the root. ``order`` is an integer or a string, ``group`` a string.
    """
    named = F.coalesce(F.concat(F.lit("="), group), F.lit("-"))  # null sorts before all names
    light = staged(rows.select(named.alias("g"), order.alias("o"), leaf.alias("h"), F.struct(*carried).alias("item"), F.monotonically_increasing_id().alias("tie")), "leaves")
    nodes = ranked(light, ["o", "h", "tie"], ["g"]).select("g", "rank", F.col("of").alias("n"), "h", "item")
    tiers = _tiers(staged(nodes, "merkle-leaves"))
    subroots = tiers[-1][0].select("g", "node.h")
    nodes = ranked(subroots, ["g"]).select(F.lit("").alias("g"), "rank", F.col("of").alias("n"), "h", F.struct("g").alias("item"))
    upper = _tiers(staged(nodes, "merkle-subroots"))
    no_steps = F.array().cast("array<struct<left: string, right: string>>")
    root = upper[-1][0].select("g", no_steps.alias("path"), F.col("node.h").alias("root"))
    tops = staged(_proved(upper, root, ["root"]).select("item.g", F.col("h").alias("subroot"), "path", "root"), "merkle-tops")
    return _proved(tiers, tops, ["subroot", "root"]).select("item.*", F.col("h").alias("leaf"), "subroot", "root", F.col("path").alias("proof"))


def prove_documents(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """The manifest of documents by lang, and whether each row's proof leads to the root.

    Where ``tampered`` holds, n_chars is one more than it was when the tree was built. Returns doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.
    """
    fields = lambda n_chars: leaf_digest(docs["doc_id"], docs["source"], docs["lang"], n_chars, docs["text"])
    changed = F.when(F.coalesce(tampered, F.lit(False)), fields(docs["n_chars"] + 1)) if tampered is not None else F.lit(None).cast("string")
    made = merkle_manifest(docs, fields(docs["n_chars"]), docs["doc_id"], docs["lang"], docs["doc_id"].alias("doc_id"), changed.alias("changed"))
    found = made.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), fold(F.coalesce("changed", "leaf"), F.col("proof")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
