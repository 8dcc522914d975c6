"""Mixing sources to target weights: hierarchical token budgets and seeded epochs, in DataFrame operations only.

The levels (domain, language, source) form a tree. A token budget flows down it by weight. A node can take no
more than its documents' tokens times ``max_epochs``; what it cannot take goes to its siblings in proportion to
their weights, and only when a whole subtree is exhausted to the siblings of its ancestors. This is water filling
among siblings on the capacities of subtrees, exact in whole tokens (fractions of a token are left over).

A leaf's budget is that many full epochs of its documents, and of the next epoch, whose order is a hash of seed,
epoch and id, the prefix that reaches the budget (so a leaf is over by less than its last document). The place
where a prefix ends is found in two steps, over sums of hash ranges and then inside one range of a leaf, about
the square root of the leaf in both, so a source with a third of all rows burdens no single task.

Edge cases: a null in a level is the node ``unknown``; null and empty texts have no tokens, so they come along only in
full epochs or before the end of a prefix; a leaf without tokens yields nothing; rows with null ids count as one
id; repeated rows share one place in the order and are taken or left together; very long texts count with all their tokens, and the one in which a
prefix ends is taken whole; leaves of equal weight and capacity are treated alike; an empty table gives no rows.
Columns are kept, but those named like a level or ``epoch`` are replaced (a document of two epochs comes twice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailframe.llm.common import SPACE, staged

UNKNOWN = "unknown"


def token_count(text: Column) -> Column:
    """White-space words of the whole text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACE.replace("[", "[^") + "+")).cast("long")


def _weight(level: str, weights: dict[str, int], default: int) -> Column:
    if any(w < 1 for w in (*weights.values(), default)):
        raise ValueError("weights must be positive whole numbers")
    out = F.lit(default)
    for value, w in weights.items():
        out = F.when(F.col(level) == value, w).otherwise(out)
    return out.cast("long")


def _whole(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def fill(nodes: DataFrame, parents: list[str], order: str) -> DataFrame:
    """Shares each group's ``budget`` by ``weight``, none above ``capacity``: adds ``share`` (long).

    Siblings are ordered by capacity over weight. One is full just if the budget covers what all siblings would hold at
    its own level of filling, so the full ones come first; the others share what is left by weight.
    """
    group = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    upto = group.orderBy(F.col("capacity") / F.col("weight"), order).rowsBetween(Window.unboundedPreceding, 0)
    covered = _whole("capacity") * (F.col("all_weight") - F.col("weight_upto")) <= _whole(F.col("budget") - F.col("capacity_upto")) * F.col("weight")
    return (
        nodes.withColumns({"all_weight": F.sum("weight").over(group), "weight_upto": F.sum("weight").over(upto), "capacity_upto": F.sum("capacity").over(upto)})
        .withColumn("full", covered)
        .withColumns({"full_capacity": F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(group), F.lit(0)), "full_weight": F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(group), F.lit(0))})
        .withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("cast(cast(budget - full_capacity as decimal(38,0)) * weight div (all_weight - full_weight) as bigint)")))
        .drop("all_weight", "weight_upto", "capacity_upto", "full", "full_capacity", "full_weight", "budget", "weight")
    )


def leaf_budgets(light: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget_percent: int, max_epochs: int, default: int = 1) -> DataFrame:
    """One row per leaf: levels, tokens, n_docs, budget. ``light`` has the levels and ``n_tokens``."""
    leaves = light.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    leaves = staged(leaves.withColumn("capacity", F.col("tokens") * max_epochs), "mix-leaves")
    budgets = leaves.agg(F.expr(f"coalesce(sum(tokens), 0) * {int(budget_percent)} div 100").alias("share"))
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(level, weights.get(level, {}), default))
        above = budgets.withColumnRenamed("share", "budget")
        nodes = nodes.join(above, path[:-1]) if depth else nodes.crossJoin(F.broadcast(above))  # the root is one row
        budgets = fill(nodes, path[:-1], level).select(*path, "share")
    return leaves.drop("capacity").join(budgets.withColumnRenamed("share", "budget"), levels)


def _place(seed: int, epoch: Column, key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), key).cast("binary"))


def select_mixture(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], budget_percent: int = 80, max_epochs: int = 2, seed: int = 42, id_col: str = "doc_id", n_tokens: Column | None = None) -> DataFrame:
    """The documents of the mixture, with the levels and ``epoch``. ``budget_percent`` is of all tokens there are."""
    tokens = token_count(F.col("text")) if n_tokens is None else n_tokens
    names = list(levels)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    tree = {n: F.coalesce(c.cast("string"), F.lit(UNKNOWN)) for n, c in levels.items()}
    light = staged(docs.select(key.alias("_key"), *(c.alias(n) for n, c in tree.items()), tokens.alias("n_tokens")), "mix-light")
    leaves = leaf_budgets(light, names, weights, budget_percent, max_epochs)
    leaves = leaves.select(*names, F.expr("budget div greatest(tokens, 1)").alias("_full"), F.pmod("budget", F.greatest("tokens", F.lit(1))).alias("_rest"), F.ceil(F.sqrt("n_docs")).cast("long").alias("_parts"))
    leaves = staged(leaves, "mix-budgets")

    # Where the last epoch's prefix ends: first among hash ranges, then within one range of each leaf.
    placed = light.join(leaves.where("_rest > 0"), names).withColumn("_at", _place(seed, F.col("_full"), F.col("_key")))
    placed = placed.withColumn("_part", F.shiftright(F.conv(F.substring("_at", 1, 8), 16, 10).cast("long") * F.col("_parts"), 32))
    sums = placed.groupBy(*names, "_part").agg(F.sum("n_tokens").alias("_sum"), F.max("_rest").alias("_rest"))
    before = F.sum("_sum").over(Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_sum")
    ends = sums.withColumn("_before", before).where("_before < _rest and _rest <= _before + _sum").select(*names, "_part", "_before")
    # A row a leaf, written so that its size is known: then only the ranges in which prefixes end are shuffled.
    inside = placed.join(staged(ends, "mix-ends"), [*names, "_part"])
    so_far = F.sum("n_tokens").over(Window.partitionBy(*names, "_part").orderBy("_at", "_key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    last = inside.withColumn("_so_far", F.col("_before") + so_far).where("_so_far < _rest").groupBy(*names).agg(F.max(F.struct("_at", "_key")).alias("_last"))
    plan = staged(leaves.join(last, names, "left").select(*names, "_full", "_last"), "mix-plan")

    # The plan has a row a leaf and is read from files, so Spark knows its size and broadcasts it only if small.
    own = [c for c in docs.columns if c not in (*names, "epoch")]
    rows = docs.select(F.struct(*(docs[c] for c in own)).alias("_row"), key.alias("_key"), *(c.alias(n) for n, c in tree.items()))
    taken = F.coalesce(F.struct(_place(seed, F.col("_full"), F.col("_key")).alias("_at"), F.col("_key").alias("_key")) <= F.col("_last"), F.lit(False))
    return (
        rows.join(plan, names)
        .withColumn("_times", F.col("_full") + taken.cast("long"))
        .where("_times > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)))
        .select("_row.*", *names, "epoch")
    )
