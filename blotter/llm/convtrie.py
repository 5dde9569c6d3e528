"""Prefix trie of conversations that share their first turns.

Turns are numbered within their conversation after a range shuffle over
(conversation, turn), so one very long conversation is dealt over many tasks;
only its offset at each task's begin is looked up, one row a task at most.
Every conversation is then rebuilt: its first turns come from another one (see
``rebuilt``). A prefix is named by its length and 128 bits of running sums over
hashes of (place, role, text), taken in blocks of ``BLOCK`` turns with the
blocks' sums before them, and a node is a distinct name. Texts are read once, for
their MD5 and size.

Subtree totals come from tree contraction (contraction.py). The digest of a node's
ends is sequential by nature: ids are sorted and joined in blocks of 1,024
neighbouring ids in parallel, and one pass streams the joined blocks of a node
through SHA-256 in constant memory.

Null role or text is empty. Turns of a conversation with the same ``turn`` (null
comes first) are ordered by the MD5 of role and text; repeated rows count as
turns of their own. Rows with a null conv_id are left out. Empty table: no
conversation, so no node, not even the root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship, shuffle_partitions
from .contraction import label_of, subtree_totals

BLOCK_BITS = 12
HEADS = 8  # turns at most that come from another conversation
ENDS_BITS = 10
_LOW = 0xFFFFFFFF


def _number(batches):
    """Places of turns within the task's part of their conversation; rows come sorted."""
    from pyspark import TaskContext
    part, last, done = TaskContext.get().partitionId(), None, 0
    for b in batches:
        conv = b.column(0).to_numpy()
        if not len(conv):
            continue
        at = np.arange(len(conv))
        new = np.ones(len(conv), bool)
        new[1:] = conv[1:] != conv[:-1]
        first = np.maximum.accumulate(np.where(new, at, 0))
        pos = at - first
        if conv[0] == last:
            pos[first == 0] += done
        last, done = conv[-1], int(pos[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), part, np.int32)), b.column(0), pa.array(pos), b.column(1), b.column(2)],
                                         ["part", "conv_id", "pos", "digest", "size"])


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns with their place from 0, conversations with their length)."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = cut(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("row")), "op12-turns")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest", "row"]
    parts = cut(turns.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                .select("conv_id", "digest", "size")
                .mapInArrow(_number, "part int, conv_id long, pos long, digest binary, size long"), "op12-numbered")
    per_part = cut(parts.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("start", F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")), "op12-parts")
    # a task's rows continue one conversation at most, so there is one row a task at most
    starts = per_part.where("start > 0").select("conv_id", "part", "start")
    turns = parts.join(F.broadcast(starts), ["conv_id", "part"], "left") \
        .select("conv_id", (F.col("pos") + F.coalesce("start", F.lit(0))).alias("pos"), "digest", "size")
    return turns, per_part.groupBy("conv_id").agg(F.sum("n").alias("len"))


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversation c gets the first h turns of conversation c - c % 5 (as many as
    there are) in place of its own first h, with h the CRC-32 of c's decimal form
    modulo 9: (turns with their depth from 1, conversations with their length)."""
    own_base = F.col("conv_id") % 5 == 0
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5) \
        .withColumn("h", F.when(own_base, 0).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9))
    bases = convs.where(own_base).select(F.col("conv_id").alias("base"), F.least("len", F.lit(HEADS)).alias("base_len"))
    convs = cut(convs.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("base_len", F.lit(0))))
                .withColumn("total", F.col("m") + F.greatest(F.col("len") - F.col("h"), F.lit(0))), "op12-convs")
    # conversations meet their turns block by block, so a long one is no hot key
    by_block = convs.select("conv_id", "h", "m", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("len") - 1, BLOCK_BITS))).alias("blk"))
    own = turns.withColumn("blk", F.shiftright("pos", BLOCK_BITS)).join(by_block, ["conv_id", "blk"]).where("pos >= h") \
        .select("conv_id", "blk", (F.col("m") + F.col("pos") - F.col("h") + 1).alias("depth"), "digest", "size", "total")
    heads = turns.where(own_base & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "base") \
        .join(convs.where("m > 0").select("base", "conv_id", "m", "total"), "base").where("pos < m") \
        .select("conv_id", F.lit(0).cast("long").alias("blk"), (F.col("pos") + 1).alias("depth"), "digest", "size", "total")
    return own.unionByName(heads), convs


def _name(depth, sums):
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums])))


def prefixes(turns: DataFrame) -> DataFrame:
    """Every turn with the names of the prefix that it ends (``pid``) and of the one before (``up``)."""
    a, b = F.xxhash64("depth", "digest"), F.xxhash64(F.lit(1), "depth", "digest")
    lanes = ["x1", "x2", "x3", "x4"]
    turns = turns.select("*", *[x.alias(n) for x, n in zip((F.shiftrightunsigned(a, 32), a.bitwiseAND(_LOW), F.shiftrightunsigned(b, 32), b.bitwiseAND(_LOW)), lanes)])
    w = Window.partitionBy("conv_id", "blk").orderBy("depth")
    sums = turns.select("*", *[F.sum(x).over(w).alias(f"s{x}") for x in lanes])
    blocks = turns.where(F.col("total") >= 1 << BLOCK_BITS).groupBy("conv_id", "blk").agg(*[F.sum(x).alias(x) for x in lanes])
    before = Window.partitionBy("conv_id").orderBy("blk")
    blocks = blocks.select("conv_id", "blk", *[(F.sum(x).over(before) - F.col(x)).alias(f"b{x}") for x in lanes]).where("blk > 0")
    sums = sums.join(blocks, ["conv_id", "blk"], "left") \
        .select("conv_id", "depth", "size", "total", *lanes, *[(F.col(f"s{x}") + F.coalesce(f"b{x}", F.lit(0))).alias(f"s{x}") for x in lanes])
    whole = [F.col(f"s{x}") for x in lanes]
    return sums.select("conv_id", "depth", "size", "total", _name(F.col("depth"), whole).alias("pid"),
                       _name(F.col("depth") - 1, [s - F.col(x) for s, x in zip(whole, lanes)]).alias("up"))


def _digests(batches):
    """SHA-256 of each name's joined ids; rows come sorted by (name, block)."""
    now, state = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["pid", "ends_sha256"])
    for b in batches:
        for pid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if pid != now:
                if state is not None:
                    yield row()
                now, state = pid, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
    if state is not None:
        yield row()


def _ends(rows: DataFrame, convs: DataFrame, root) -> DataFrame:
    last = rows.where("depth = total").select("pid", "conv_id").unionByName(convs.where("total = 0").select(root.alias("pid"), "conv_id"))
    blocks = last.groupBy("pid", F.shiftright("conv_id", ENDS_BITS).alias("blk")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    return blocks.select("pid", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"), "blk") \
        .repartition("pid").sortWithinPartitions("pid", "blk").select("pid", "text") \
        .mapInArrow(_digests, "pid binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    ship(conversations.sparkSession)
    turns, convs = rebuilt(*numbered(conversations))
    rows = cut(prefixes(turns), "op12-prefixes")
    zero = F.lit(0).cast("long")
    root = _name(zero, [zero] * 4)
    nodes = rows.groupBy("pid").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
                                    F.min("size").alias("size"), F.min("up").alias("up"), label_of(F.col("total"), F.col("conv_id")).alias("longest"))
    top = convs.agg(F.min("conv_id").alias("conv_id"), zero.alias("depth"), F.count(F.lit(1)).alias("n_convs"), zero.alias("size"),
                    label_of(F.col("total"), F.col("conv_id")).alias("longest")).where("n_convs > 0") \
        .withColumn("pid", root).withColumn("up", F.lit(None).cast("binary"))
    nodes = cut(nodes.unionByName(top).withColumn("v", F.monotonically_increasing_id()), "op12-nodes")
    above = nodes.select(F.col("pid").alias("up"), F.col("v").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = cut(nodes.join(above, "up", "left"), "op12-linked")
    kids = nodes.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "v")
    nodes = cut(nodes.join(kids, "v", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "op12-children")
    weighed = nodes.select("v", "parent", (-F.col("longest.k")).alias("label"), "depth",
                           F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                           ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    totals = subtree_totals(weighed, ["n_leaves", "saved_tokens"])
    empty = hashlib.sha256(b"").hexdigest()
    return nodes.join(totals, "v").join(_ends(rows, convs, root), "pid", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
