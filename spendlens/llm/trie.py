"""Conversation prefix trie by the Euler-tour technique.

Every distinct sequence of a conversation's first d turns is a node. Each node has an enter
and an exit arc; an arc's successor follows from the node's first child, next sibling and
parent. Ranking this linked list gives every arc its position in the tour; a subtree is the
stretch between a node's two arcs, so its leaves and savings are differences of prefix sums
taken at these positions.

* Turns are numbered through a sort by ranges: a conversation of very many turns lies in
  several partitions, whose rows are numbered apart and shifted.
* A prefix is known by two running exclusive-ors over hashes of (position, role, text), 120
  bits of SHA-256 together, taken in chunks of 4096 turns; afterwards a node is its
  smallest member and its depth.
* Siblings are linked inside 1024 hash buckets, then bucket to bucket, so that a node with
  very many children is not ordered in one task.
* List ranking is random-mate contraction (an arc whose coin is 1 takes over its successor
  whose coin is 0, about a quarter goes each round) down to ``SHORT`` arcs, pointer doubling
  there, and re-insertion. Work is proportional to the arcs; every step is a join on arc ids.
* Prefix sums run inside 65,536 positions each, then over the sums of these, twice.

Defined results: rows without conv_id belong to no conversation; null turns come first; rows
of one turn follow each other by role and text; null roles and texts are empty; a
remainder has the sign of its conv_id. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import map_arrow, stage, unstage

CHUNK, BUCKETS, SHORT = 4096, 1024, 1 << 20
#: Digits of a position: prefix sums are taken by the last 16 bits, then the 16 before, then the rest.
DIGIT = 16


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, i, x1, x2, chars``: the turns of each conversation from 1, by turn, role and text."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    lane = lambda k: F.conv(F.substring("said", 1 + 15 * k, 15), 16, 10).cast("long")
    dealt = (rows.where("conv_id IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order)
             .select("conv_id", F.monotonically_increasing_id().alias("seq"), said.alias("said"), F.length("text").cast("long").alias("chars"))
             .select("conv_id", "seq", F.shiftright("seq", 33).alias("part"), lane(0).alias("x1"), lane(1).alias("x2"), "chars"))
    dealt = stage(dealt, "turns")
    parts = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("m"))
    before = F.sum("m").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    own = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("seq"))
    return dealt.withColumn("own", own).join(parts.select("conv_id", "part", F.coalesce(before, F.lit(0)).alias("before")), ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("own")).alias("i"), "x1", "x2", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, turns`` of every conversation, and its rows, after its first turns were exchanged.

    Conversation c takes the first h turns of c - c % 100 for its own first h, with h the
    crc32 of its decimal number modulo 6.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = sizes.select("conv_id", "n", F.expr("conv_id - conv_id % 100").alias("base"), (F.crc32(F.col("conv_id").cast("string")) % 6).alias("h"))
    lent = sizes.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("lent"))
    convs = stage(convs.join(lent, "base", "left").withColumn("got", F.least("h", F.coalesce("lent", F.lit(0)))), "convs")
    heads = turns.where("conv_id % 100 = 0 AND i <= 5").withColumnRenamed("conv_id", "base")
    first = convs.select("conv_id", "base", "h").join(heads, "base").where("i <= h").select("conv_id", F.col("i").alias("pos"), "x1", "x2", "chars")
    after = turns.join(convs.select("conv_id", "h", "got"), "conv_id").where("i > h").select(
        "conv_id", (F.col("i") - F.col("h") + F.col("got")).alias("pos"), "x1", "x2", "chars")
    return convs.select("conv_id", (F.col("got") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")), first.union(after)


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id, pos, k1, k2, p1, p2, chars``: the key of every prefix, and of the one a turn shorter."""
    lanes = stage(rows.select("conv_id", "pos", F.xxhash64("x1", "pos").alias("l1"), F.xxhash64("x2", "pos").alias("l2"), "chars",
                              F.floor((F.col("pos") - 1) / CHUNK).alias("chunk")), "lanes")
    local = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = lanes.groupBy("conv_id", "chunk").agg(F.bit_xor("l1").alias("s1"), F.bit_xor("l2").alias("s2"))
    sums = sums.select("conv_id", "chunk", F.bit_xor("s1").over(ahead).alias("a1"), F.bit_xor("s2").over(ahead).alias("a2")).where("chunk > 0")
    out = lanes.withColumn("r1", F.bit_xor("l1").over(local)).withColumn("r2", F.bit_xor("l2").over(local)).join(sums, ["conv_id", "chunk"], "left")
    key = lambda k: F.expr(f"r{k} ^ coalesce(a{k}, 0L)")
    return out.withColumn("k1", key(1)).withColumn("k2", key(2)).select(
        "conv_id", "pos", "k1", "k2", F.expr("k1 ^ l1").alias("p1"), F.expr("k2 ^ l2").alias("p2"), "chars")


def _digests(batches):
    """SHA-256 of each node's ids, comma-joined; its rows come one after the other in order of id."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    key, digest = None, None
    for batch in batches:
        out = []
        for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (k1, k2):
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (k1, k2), sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, digest.hexdigest()), strict=True))], schema=schema)


def ends(convs: DataFrame, keys: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256`` of every prefix that is a whole conversation.

    A digest is one stream of ids by its definition: sorted on disk, read past in bounded memory.
    """
    last = keys.join(convs, "conv_id").where("pos = turns").select("k1", "k2", "conv_id")
    empty = convs.where("turns = 0").select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "conv_id")
    dealt = last.union(empty).repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id")
    return map_arrow(dealt, _digests, "k1 long, k2 long, ends_sha256 string")


def nodes(convs: DataFrame, keys: DataFrame) -> DataFrame:
    """``conv_id, depth, k1, k2, parent_conv_id, n_convs, saved`` of every node."""
    zero = F.lit(0).cast("long")
    every = (keys.groupBy(F.col("pos").alias("depth"), "k1", "k2")
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars")))
    root = convs.groupBy(zero.alias("depth")).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).select(
        "depth", zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("chars"))
    every = stage(every.union(root), "nodes")
    up = every.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    return every.join(up, ["p1", "p2", "depth"], "left").select(
        "conv_id", "depth", "k1", "k2", "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))


def _arc(conv: str | Column, depth: str | Column, leaving: int) -> list[Column]:
    depth = F.col(depth) if isinstance(depth, str) else depth
    return [F.col(conv) if isinstance(conv, str) else conv, depth * 2 + leaving]


def tour(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, n_children`` of the nodes that have children, and the arcs.

    An arc is ``(c, a)`` with c the node's conv_id and a twice its depth, plus one if it
    leaves the node; ``(nc, na)`` is its successor, null at the end.
    """
    family = ["parent_conv_id", "depth"]
    kids = tree.where("depth > 0").select("conv_id", *family, F.expr(f"pmod(xxhash64(conv_id), {BUCKETS})").alias("bucket"))
    buckets = stage(kids.groupBy(*family, "bucket").agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("m")), "buckets")
    onward = buckets.select(*family, "bucket", F.lead("first").over(Window.partitionBy(*family).orderBy("bucket")).alias("onward"))
    linked = (kids.withColumn("next", F.lead("conv_id").over(Window.partitionBy(*family, "bucket").orderBy("conv_id")))
              .join(onward, [*family, "bucket"]).select("conv_id", *family, F.coalesce("next", "onward").alias("sibling")))
    parents = buckets.groupBy(*family).agg(F.min(F.struct("bucket", "first")).alias("f"), F.sum("m").alias("n_children")).select(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), F.col("f.first").alias("child"), "n_children")
    entering = tree.select("conv_id", "depth").join(parents, ["conv_id", "depth"], "left")
    has, more = F.col("child").isNotNull(), F.col("sibling").isNotNull()
    (c, a), (c1, a1), (c2, a2) = _arc("conv_id", "depth", 0), _arc("child", F.col("depth") + 1, 0), _arc("conv_id", "depth", 1)
    arcs = entering.select(c.alias("c"), a.alias("a"), F.when(has, c1).otherwise(c2).alias("nc"), F.when(has, a1).otherwise(a2).alias("na"))
    (s, b), (p, d) = _arc("sibling", "depth", 0), _arc("parent_conv_id", F.col("depth") - 1, 1)
    arcs = arcs.union(linked.select(c2.alias("c"), a2.alias("a"), F.when(more, s).otherwise(p).alias("nc"), F.when(more, b).otherwise(d).alias("na")))
    none = F.lit(None).cast("long")
    return parents.drop("child"), arcs.union(tree.where("depth = 0").select(c2, a2, none, none))


def _coin(c: str, a: str, turn: int) -> str:
    return f"(xxhash64({c}, {a}, {turn}) & 1)"


def ranked(arcs: DataFrame, short: int = SHORT) -> DataFrame:
    """``c, a, dist``: how many arcs there are from each arc to the end of the list, itself included."""
    now, removed, turn = stage(arcs.select("c", "a", "nc", "na", F.lit(1).cast("long").alias("w")), "arcs"), [], 0
    left_over = now.count()
    while left_over > short:
        takes = f"nc IS NOT NULL AND {_coin('c', 'a', turn)} = 1 AND {_coin('nc', 'na', turn)} = 0"
        taken = f"{_coin('c', 'a', turn)} = 0"
        takers = now.where(takes).select(F.col("c").alias("tc"), F.col("a").alias("ta"), F.col("nc").alias("c"), F.col("na").alias("a"), F.col("w").alias("tw"))
        met = stage(now.where(taken).join(takers, ["c", "a"], "left"), "met")
        removed.append(met.where("tc IS NOT NULL").select("c", "a", "nc", "na", "w"))
        joined = met.select(F.coalesce("tc", "c").alias("c"), F.when(F.col("tc").isNull(), F.col("a")).otherwise(F.col("ta")).alias("a"), "nc", "na",
                            (F.col("w") + F.coalesce("tw", F.lit(0))).alias("w"))
        now = stage(now.where(f"NOT ({taken}) AND NOT ({takes})").union(joined), "arcs")
        left_over, turn = now.count(), turn + 1
    for _ in range(max(0, left_over - 1).bit_length()):  # every arc's successor moves twice as far on
        further = now.select(F.col("c").alias("nc"), F.col("a").alias("na"), F.col("nc").alias("nc2"), F.col("na").alias("na2"), F.col("w").alias("w2"))
        moved = now.where("nc IS NOT NULL").join(further, ["nc", "na"]).select(
            "c", "a", F.col("nc2").alias("nc"), F.col("na2").alias("na"), (F.col("w") + F.col("w2")).alias("w"))
        last, now = now, stage(now.where("nc IS NULL").union(moved), "arcs")
        unstage(last)
    dist = now.select("c", "a", F.col("w").alias("dist"))
    for gone in reversed(removed):
        back = gone.where("nc IS NOT NULL").join(dist.select(F.col("c").alias("nc"), F.col("a").alias("na"), "dist"), ["nc", "na"]).select(
            "c", "a", (F.col("w") + F.col("dist")).alias("dist"))
        dist = stage(dist.union(gone.where("nc IS NULL").select("c", "a", F.col("w").alias("dist"))).union(back), "dist")
    return dist


def running(rows: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """``values`` summed over all rows up to each one's ``pos``."""
    rows = rows.withColumn("b1", F.shiftright("pos", DIGIT)).withColumn("b2", F.shiftright("pos", 2 * DIGIT))
    blocks = rows.groupBy("b2", "b1").agg(*(F.sum(v).alias(v) for v in values))
    uppers = blocks.groupBy("b2").agg(*(F.sum(v).alias(v) for v in values))  # 2**32 rows each
    before = lambda w: [F.coalesce(F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) for v in values]
    uppers = uppers.select("b2", *(x.alias(f"u_{v}") for v, x in zip(values, before(Window.orderBy("b2")), strict=True)))
    blocks = blocks.select("b2", "b1", *(x.alias(f"b_{v}") for v, x in zip(values, before(Window.partitionBy("b2").orderBy("b1")), strict=True))).join(uppers, "b2")
    own = Window.partitionBy("b2", "b1").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({v: F.sum(v).over(own) for v in values}).join(blocks, ["b2", "b1"])
    return summed.withColumns({v: F.col(v) + F.col(f"b_{v}") + F.col(f"u_{v}") for v in values}).drop(*(f"{x}_{v}" for v in values for x in "bu"), "b1", "b2")


def op13_prefix_trie(conversations: DataFrame, short: int = SHORT) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node."""
    convs, rows = rebuilt(stage(numbered(conversations), "numbered"))
    convs = stage(convs, "sizes")
    keys = stage(prefixes(rows), "prefixes")
    tree = stage(nodes(convs, keys), "tree")
    parents, arcs = tour(tree)
    tree = stage(tree.join(parents, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "tree")
    dist = ranked(arcs, short)
    entered = tree.select(F.col("conv_id").alias("c"), (F.col("depth") * 2).alias("a"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), "saved")
    # the later an arc, the nearer the end: sums from the end, an arc's own included
    valued = dist.join(entered, ["c", "a"], "left").select(
        "c", "a", F.col("dist").alias("pos"), F.coalesce("leaves", F.lit(0)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"))
    sums = running(valued, ("leaves", "saved"))
    stretch = (sums.groupBy(F.col("c").alias("conv_id"), F.shiftright("a", 1).alias("depth"))
               .agg(*((F.max(v) - F.min(v)).alias(n) for v, n in (("leaves", "n_leaves"), ("saved", "saved_tokens")))))
    return (tree.join(stretch, ["conv_id", "depth"]).join(ends(convs, keys), ["k1", "k2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256")))
