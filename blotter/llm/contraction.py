"""Subtree totals of a forest's tree by parallel contraction.

A round compresses unary chains and rakes the leaves: a leaf's weight goes to
its parent, a chain's inner node is spliced out and its weight travels with the
node below it. Each removal is recorded, and re-expansion walks the rounds
backwards: a raked node's total is what it had gathered, a spliced node's total
is its chain's lower end plus what lay between.

Odd rounds compress runs: neighbours on the same ``label`` (a path through the
tree) within a block of depths collapse at once, in one window. Even rounds
splice by coins: a unary node whose coin shows one and whose child's shows zero
goes, so no two neighbours go at once and a quarter of any chain does, whatever
its labels. Rounds are therefore logarithmic in the tree's size, and chains along
one label take one round per ``BLOCK`` of depth.

No step gathers a node's children: per parent there are sums, a count and a
minimum, aggregated map-side. Every round's tables lie in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_BITS, WIDER = 12, 6  # a run's block has 2**12 depths, 2**6 times more with each further round


def _coin(node: Column, number: int) -> Column:
    return F.xxhash64(node, F.lit(number)).bitwiseAND(1)


def _runs(tree: DataFrame, weights: list[str], number: int) -> tuple[DataFrame, DataFrame]:
    """Collapse runs of unary nodes into their lower ends: (tree, spliced)."""
    bits = min(62, BLOCK_BITS + WIDER * (number // 2))
    tree = tree.withColumn("blk", F.shiftright("depth", bits))
    w = Window.partitionBy("label", "blk").orderBy("depth")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    link = (F.col("n") == 1) & F.col("parent").isNotNull() & F.lead("v").over(w).eqNullSafe(F.col("only"))
    runs = tree.withColumn("link", F.coalesce(link, F.lit(False)))
    for c in weights:  # sums above a node, without its own weight and with its own edge
        runs = runs.withColumn(f"{c}_a", F.sum(c).over(so_far) - F.col(c)).withColumn(f"{c}_b", F.sum(f"{c}_e").over(so_far))
    runs = runs.withColumn("begins", F.when(F.lag("link").over(w), 0).otherwise(1)) \
        .withColumn("run", F.sum("begins").over(so_far))
    whole = Window.partitionBy("label", "blk", "run")
    ends = ["v"] + [f"{c}_{s}" for c in weights for s in "ab"]
    tops = ["parent"] + [f"{c}_a" for c in weights] + [f"{c}_top" for c in weights]
    for c in weights:
        runs = runs.withColumn(f"{c}_top", F.col(f"{c}_b") - F.col(f"{c}_e"))
    runs = runs.withColumn("low", F.max(F.struct("depth", *ends)).over(whole)) \
        .withColumn("top", F.min(F.struct("depth", *tops)).over(whole))
    done = cut(runs, f"op12-runs{number}")
    spliced = done.where("link").select("v", F.col("low.v").alias("into"), *[
        (F.col(f"low.{c}_a") - F.col(f"{c}_a") + F.col(f"low.{c}_b") - F.col(f"{c}_b")).alias(c) for c in weights])
    left = done.where("not link").select(
        "v", F.col("top.parent").alias("parent"), "label", "depth", "n", "only", *weights,
        *[(F.col(f"{c}_b") - F.col(f"top.{c}_top") + F.col(f"{c}_a") - F.col(f"top.{c}_a")).alias(f"{c}_e") for c in weights])
    return left, spliced


def _mates(tree: DataFrame, weights: list[str], number: int) -> tuple[DataFrame, DataFrame]:
    """Splice unary nodes chosen by coins into their children: (tree, spliced)."""
    goes = (F.col("n") == 1) & F.col("parent").isNotNull() & (_coin(F.col("v"), number) == 1) & (_coin(F.col("only"), number) == 0)
    tree = tree.withColumn("goes", F.coalesce(goes, F.lit(False)))
    above = tree.where("goes").select(F.col("only").alias("v"), F.col("v").alias("mate"), F.col("parent").alias("over"),
                                      *[F.col(c).alias(f"{c}_m") for c in weights], *[F.col(f"{c}_e").alias(f"{c}_me") for c in weights])
    done = cut(tree.join(above, "v", "left"), f"op12-mates{number}")
    spliced = done.where("mate is not null").select(
        F.col("mate").alias("v"), F.col("v").alias("into"), *[(F.col(f"{c}_m") + F.col(f"{c}_e")).alias(c) for c in weights])
    left = done.where("not goes").select(
        "v", F.when(F.col("mate").isNotNull(), F.col("over")).otherwise(F.col("parent")).alias("parent"), "label", "depth", "n", "only",
        *weights, *[(F.col(f"{c}_e") + F.coalesce(F.col(f"{c}_m") + F.col(f"{c}_me"), F.lit(0))).alias(f"{c}_e") for c in weights])
    return left, spliced


def _rake(tree: DataFrame, weights: list[str]) -> DataFrame:
    """The tree without its leaves, whose weights their parents take over."""
    inner = F.col("n") > 0
    taken = [F.sum(F.when(~inner, F.col(c) + F.col(f"{c}_e")).otherwise(0)).alias(f"{c}_k") for c in weights]
    kids = tree.where("parent is not null").groupBy("parent").agg(
        F.count(F.when(inner, 1)).alias("n_k"), F.min(F.when(inner, F.col("v"))).alias("only_k"), *taken) \
        .withColumnRenamed("parent", "v")
    return tree.where("n > 0 or parent is null").join(kids, "v", "left").select(
        "v", "parent", "label", "depth", F.coalesce("n_k", F.lit(0)).alias("n"), F.col("only_k").alias("only"),
        *[(F.col(c) + F.coalesce(f"{c}_k", F.lit(0))).alias(c) for c in weights], *[f"{c}_e" for c in weights])


def subtree_totals(nodes: DataFrame, weights: list[str]) -> DataFrame:
    """(v, *weights) with every weight summed over the node's subtree.

    ``nodes``: v, parent (null for the root), label, depth (one more than the
    parent's), and the long columns ``weights``. One root; (label, depth) is
    unique. Labels may be any, the same along a chain at best. No nodes, no rows.
    """
    kids = nodes.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("only"))
    tree = cut(nodes.select("v", "parent", "label", "depth", *weights, *[F.lit(0).cast("long").alias(f"{c}_e") for c in weights])
               .join(kids.withColumnRenamed("parent", "v"), "v", "left").withColumn("n", F.coalesce("n", F.lit(0))), "op12-tree0")
    rounds, number = [], 0
    while tree.where("parent is not null").limit(1).count():
        number += 1
        left, spliced = (_runs if number % 2 else _mates)(tree, weights, number)
        rounds.append((left.where("n = 0 and parent is not null").select("v", *weights), spliced))
        tree = cut(_rake(left, weights), f"op12-tree{number}")
    totals = tree.select("v", *weights)
    for raked, spliced in reversed(rounds):
        known = totals.unionByName(raked)
        low = known.select(F.col("v").alias("into"), *[F.col(c).alias(f"{c}_t") for c in weights])
        more = spliced.join(low, "into").select("v", *[(F.col(c) + F.col(f"{c}_t")).alias(c) for c in weights])
        totals = cut(known.unionByName(more), "op12-totals")
    return totals


def label_of(length: Column, key: Column) -> Column:
    """Aggregate: the key of the longest member, the smallest of equals. Along a
    chain of unary nodes it does not change."""
    return F.max(F.struct(length, (-key).alias("k")))
