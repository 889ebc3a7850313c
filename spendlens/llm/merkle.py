"""Merkle manifest of a dataset, with leaf coordinates from bitmap ranks.

Every row is a leaf; the leaves of one language ascend by doc_id and are hashed eight by
eight up to the language's subroot, the subroots likewise to the root.

* Coordinates come without sorting rows: a task sets bits of the doc_ids that it reads in
  64-bit words, words of one number are merged by or, empty words are not kept. A
  popcount directory gives the rows before each word: sums over the ids' upper bits, level
  by level (16 bits each, 10 for the words), so no group of it has more than 65,537 entries.
  A row's rank is its word's offset plus the bits set below its own.
* Words that hold fewer ids than rows (repeated ids) rank these rows by id and leaf: equal
  rows are counted first, the others are dealt by the leaf's first 16 bits.
* Levels are reduced in blocks of 4096 = 8^4 nodes keyed by coordinate: a block's digests go
  to their slots in an array, which shrinks eightfold four times. Blocks of block digests
  follow, so a pass has 1/4096 of the rows of the one before. The way down hands every block
  its own siblings above it; leaves fold their proofs block by block.

Defined results: null doc_ids come first in their language; rows of one doc_id follow each
other by leaf, equal rows in any order, each with a coordinate of its own; the null language
is a group (first); a null doc_id is never tampered with. Extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ship, stage

FAN, PASS = 8, 4
BLOCK = FAN ** PASS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Directory keys from the highest bits of an id to its word; null ids stand before the least.
KEYS = ("k1", "k2", "k3", "word")
_NO_ID = -(1 << 15) - 1


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """``lk, doc_id, leaf, changed``: the language's sort key, the leaf, and the leaf after tampering (or null)."""
    def digest(text: Column) -> Column:
        return F.sha2(F.concat(*(_field(F.col(c)) for c in FIELDS[:-1]), _field(text)), 256)

    doc_id = F.col("doc_id").cast("long")
    lower = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(doc_id.cast("string")) % 3 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("lk"), doc_id.alias("doc_id"),
        digest(F.col("text")).alias("leaf"), F.when(tampered, digest(lower)).alias("changed"))


def _keyed(rows: DataFrame) -> DataFrame:
    value = F.coalesce("doc_id", F.lit(0))
    return (rows.withColumn("k1", F.coalesce(F.shiftright("doc_id", 48), F.lit(_NO_ID)))
            .withColumn("word", F.shiftright(value, 6)).withColumn("bit", F.expr("CAST(coalesce(doc_id, 0) & 63 AS INT)")))


def words(rows: DataFrame) -> DataFrame:
    """The non-empty words (``lk``, directory keys, ``bits``, rows ``n``) with the rows before each (``before``) and of its language (``total``)."""
    merged = (_keyed(rows).groupBy("lk", "k1", "word")
              .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count(F.lit(1)).alias("n"))
              .withColumn("k2", F.shiftright("word", 26)).withColumn("k3", F.shiftright("word", 10)))
    merged = stage(merged, "words")
    out = merged.groupBy("lk").agg(F.sum("n").alias("total")).withColumn("before", F.lit(0).cast("long"))
    for k, key in enumerate(KEYS):
        group = ["lk", *KEYS[:k]]
        entries = merged if key == KEYS[-1] else merged.groupBy(*group, key).agg(F.sum("n").alias("n"))
        ahead = F.sum("n").over(Window.partitionBy(*group).orderBy(key).rowsBetween(Window.unboundedPreceding, -1))
        out = (entries.withColumn("ahead", F.coalesce(ahead, F.lit(0))).join(out.select(*group, "before", "total"), group)
               .withColumn("before", F.col("before") + F.col("ahead")).drop("ahead"))
    return out


def _of_crowded_words(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """Positions of the rows of words in which an id has several rows."""
    key, place = ["lk", "k1", "word"], ["lk", "k1", "word", "bit", "lead"]
    kinds = (_keyed(rows).join(crowded.select(*key), key, "left_semi")
             .groupBy(*key, "bit", "doc_id", "leaf", "changed").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("lead", F.substring("leaf", 1, 4)))
    kinds = stage(kinds, "kinds")
    leads = kinds.groupBy(*place).agg(F.sum("n").alias("m"))
    ahead = F.sum("m").over(Window.partitionBy(*key).orderBy("bit", "lead").rowsBetween(Window.unboundedPreceding, -1))
    own = F.sum("n").over(Window.partitionBy(*place).orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1))
    first = (kinds.withColumn("own", F.coalesce(own, F.lit(0)))
             .join(leads.select(*place, F.coalesce(ahead, F.lit(0)).alias("ahead")), place)
             .join(crowded.select(*key, "before", "total"), key)
             .withColumn("first", F.col("before") + F.col("ahead") + F.col("own")))
    # equal rows are told out again in runs, each of them anywhere
    runs = first.withColumn("at", F.explode(F.expr(f"sequence(0L, n - 1, {BLOCK}L)"))).repartition("lk", "first", "at")
    return (runs.withColumn("pos", F.explode(F.expr(f"sequence(first + at, first + least(at + {BLOCK}L, n) - 1)")))
            .select(F.col("lk").alias("g"), "pos", F.col("total").alias("n"), F.col("leaf").alias("digest"), "doc_id", "changed"))


def placed(rows: DataFrame) -> DataFrame:
    """``g, pos, n, digest, doc_id, changed``: every leaf with its coordinate in its language."""
    directory = stage(words(rows), "directory")
    crowded = directory.where("n > bit_count(bits)")
    alone = directory.where("n = bit_count(bits)").select("lk", "k1", "word", "bits", "before", "total")
    below = F.expr("CAST(bit_count(bits & ~shiftleft(-1L, bit)) AS BIGINT)")
    out = _keyed(rows).join(alone, ["lk", "k1", "word"]).select(
        F.col("lk").alias("g"), (F.col("before") + below).alias("pos"), F.col("total").alias("n"), F.col("leaf").alias("digest"), "doc_id", "changed")
    return out if crowded.isEmpty() else out.unionByName(_of_crowded_words(rows, crowded))


def parents(digests: list[bytes]) -> list[bytes]:
    return [sha256(b"".join(digests[i:i + FAN])).hexdigest().encode() for i in range(0, len(digests), FAN)]


def _levels(n: int) -> int:
    """How many levels a pass reduces in a group of n nodes."""
    levels = 0
    while n > 1 and levels < PASS:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _slots(block: pa.Table) -> tuple[list[bytes], np.ndarray, int]:
    """The block's digests in their slots, the slot of each row, and the size of the group."""
    slot = block["pos"].to_numpy() % BLOCK
    digests = np.empty(block.num_rows, "S64")
    digests[slot] = block["digest"].to_numpy(zero_copy_only=False).astype("S64")
    return digests.tolist(), slot, block["n"][0].as_py()


def _up(block: pa.Table) -> pa.Table:
    digests, _, n = _slots(block)
    levels = _levels(n)
    for _ in range(levels):
        digests = parents(digests)
    return pa.table({"g": [block["g"][0].as_py()], "pos": [block["pos"][0].as_py() // BLOCK],
                     "n": [-(-n // FAN ** levels)], "digest": [digests[0].decode()]})


def _siblings(digests: list[bytes], levels: int) -> list[list[bytes]]:
    """For every level, the nodes' left and right siblings as ``left:right;``."""
    out = []
    for _ in range(levels):
        sides = []
        for i in range(0, len(digests), FAN):
            run = digests[i:i + FAN]
            sides += [b"".join(run[:k]) + b":" + b"".join(run[k + 1:]) + b";" for k in range(len(run))]
        out.append(sides)
        digests = parents(digests)
    return out


def _path(sides: list[list[bytes]], slot: int) -> bytes:
    return b"".join(level[slot // FAN ** k] for k, level in enumerate(sides))


def _down(block: pa.Table, above: pa.Table) -> pa.Table:
    """The paths of a block's nodes: their siblings in the block, then the block's path."""
    digests, slot, n = _slots(block)
    sides, rest = _siblings(digests, _levels(n)), above["path"][0].as_py().encode()
    return pa.table({"g": block["g"], "pos": block["pos"], "path": [(_path(sides, int(k)) + rest).decode() for k in slot],
                     "subroot": pa.repeat(above["subroot"][0], len(slot)), "root": pa.repeat(above["root"][0], len(slot))})


def _steps(path: bytes) -> list[tuple[bytes, bytes]]:
    return [tuple(step.split(b":")) for step in path.split(b";")[:-1]]


def fold(digest: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in steps:
        digest = sha256(left + digest + right).hexdigest().encode()
    return digest


def _prove(block: pa.Table, above: pa.Table) -> pa.Table:
    """Proof digest and folded root of every leaf of a block."""
    digests, slot, n = _slots(block)
    sides, rest = _siblings(digests, _levels(n)), above["path"][0].as_py().encode()
    upper, upper_digests = _steps(rest), rest.translate(None, b":;")
    root = above["root"][0].as_py().encode()
    proofs, folded = [], []
    for k, leaf, changed in zip(slot.tolist(), block["digest"].to_pylist(), block["changed"].to_pylist(), strict=True):
        path = _path(sides, k)
        proofs.append(sha256(path.translate(None, b":;") + upper_digests).hexdigest())
        folded.append(fold(fold((changed or leaf).encode(), _steps(path)), upper))
    return pa.table({"doc_id": block["doc_id"], "leaf": block["digest"], "subroot": pa.repeat(above["subroot"][0], len(slot)),
                     "root": pa.repeat(above["root"][0], len(slot)), "proof_sha256": proofs,
                     "folded_root": [f.decode() for f in folded], "verified": [f == root for f in folded]})


_NODE = "g string, pos long, n long, digest string"
_ABOVE = "g string, pos long, path string, subroot string, root string"
_PROVED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _blocks(nodes: DataFrame):
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("g", "block")


def reduced(nodes: DataFrame) -> list[DataFrame]:
    """The nodes after each pass, until every group has one."""
    out = []
    while True:
        nodes = stage(_blocks(nodes).applyInArrow(_up, _NODE), "nodes")
        out.append(nodes)
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return out


def _carried(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """The paths of the first of ``passes``, from those of the last pass's nodes."""
    for nodes in reversed(passes[:-1]):
        above = stage(_blocks(nodes).cogroup(above.withColumn("block", F.col("pos")).groupBy("g", "block")).applyInArrow(_down, _ABOVE), "paths")
    return above


def _ranked(groups: DataFrame) -> DataFrame:
    """``g, digest`` with ``pos`` by ``g`` (bytewise) and ``n``."""
    dealt = stage(groups.repartitionByRange("g").select("g", "digest", F.spark_partition_id().alias("part")), "groups")
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("m"))
    # one row for each partition
    sizes = sizes.select("part", F.sum("m").over(Window.orderBy("part")).alias("upto"), "m", F.sum("m").over(Window.partitionBy(F.lit(1))).alias("n"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("g"))
    return dealt.withColumn("own", own).join(sizes, "part").select(
        "g", (F.col("upto") - F.col("m") + F.col("own") - 1).cast("long").alias("pos"), "n", "digest")


def op12_manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row."""
    ship(docs.sparkSession)
    nodes = stage(placed(stage(leaves(docs), "leaves")), "placed")
    passes = reduced(nodes.select("g", "pos", "n", "digest"))
    groups = stage(_ranked(passes[-1].select("g", "digest")), "subroots")
    tops = [groups.select(F.lit("").alias("g"), "pos", "n", "digest")]
    tops += reduced(tops[0])
    top = tops[-1].select("g", "pos", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    over_groups = _carried(tops, top)
    above = groups.join(over_groups.select("pos", "path", "root"), "pos").select(
        "g", F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root")
    above = _carried(passes, above)
    return _blocks(nodes).cogroup(above.withColumn("block", F.col("pos")).groupBy("g", "block")).applyInArrow(_prove, _PROVED)
