"""SimHash near-dedup by tiled exact comparison.

A fingerprint has 64 bits; bit k is 1 if more than half of the XXH64 values (seed 42) of a
text's 3-word shingles, repeats included, have it. All pairs of fingerprints that differ
in at most ``RADIUS`` bits are found by comparing tiles with exclusive-or and bit counts.

* Rows of equal fingerprints are one class; only distinct fingerprints are compared.
* A tile holds fingerprints of equal population counts, taken in ``parts`` equal parts of
  the 64 bits (one part: the population count itself). Fingerprints within the radius have
  counts that differ by the radius at most, summed over the parts; other tile pairs are
  skipped. More rows take more parts (``parts_for``), so that a tile keeps its size and the
  comparisons for one fingerprint stay about the same; no part layout loses a pair.
* A tile of more than ``TILE`` members (many near copies) is cut by hash and its cuts are
  compared with each other, so no task holds more than two cuts. A tile pair returns a
  spanning forest of its links, never the pairs themselves.

Defined results: a null text or one without words has the fingerprint zero, which is linked
like any other; rows that share a doc_id are one document, linked by each of its texts; a
null doc_id takes its component's smallest id (null if the component has none). Repeated
rows give repeated rows. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import arrow_rows, map_arrow, stage, texts_of

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Members of a tile on average (many more are cut into several), rows compared at once.
TILE, ROWS = 4096, 256
#: Bytes of a text that are taken apart at once; hashes whose bits are counted at once.
PIECE, HASHES = 1 << 20, 1 << 18

_U = np.uint64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LANES = _U(0x0101010101010101)


def shingle_hashes(text: str):
    """Arrays of the hashes of a text's shingles; of the whole sequence if it has fewer words."""
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER)
    hashed, at, words, any_yet = xxhash.xxh64_intdigest, 0, [], False
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        # bytes.split() splits at exactly the white space of _SPACE; two words overlap
        words = words[1 - SHINGLE:] + data[at:end].split()
        at = end
        n = len(words) - SHINGLE + 1
        if n > 0:
            any_yet = True
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = np.concatenate([[0], ends[:n - 1]]).tolist()
            yield np.fromiter((hashed(line[i:j], SEED) for i, j in zip(starts, (ends[SHINGLE - 1:] - 1).tolist(), strict=True)), _U, n)
    if words and not any_yet:
        yield np.array([hashed(b" ".join(words), SEED)], _U)


def add_bits(counts: np.ndarray, owner: np.ndarray, hashes: np.ndarray) -> None:
    """Add to ``counts[text, bit]`` how many of its hashes have the bit; owners ascend."""
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    place = np.arange(len(owner)) - np.repeat(first, np.diff(first, append=len(owner)))
    starts = np.flatnonzero(place % 255 == 0)  # a lane of 8 bits counts up to 255
    own = np.flatnonzero(np.diff(owner[starts], prepend=-1))
    for s in range(8):
        lanes = np.add.reduceat((hashes >> _U(s)) & _LANES, starts).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts[owner[first], s::8] += np.add.reduceat(lanes.astype(np.int64), own, axis=0)


def fingerprints_of(texts: list[str]) -> np.ndarray:
    """The 64-bit fingerprint of every text."""
    counts, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    waiting, size = [], 0

    def count():
        nonlocal waiting, size
        if waiting:
            add_bits(counts, np.repeat([k for k, _ in waiting], [len(h) for _, h in waiting]), np.concatenate([h for _, h in waiting]))
        waiting, size = [], 0

    for k, text in enumerate(texts):
        for h in shingle_hashes(text):
            total[k] += len(h)
            waiting.append((k, h))
            size += len(h)
            if size >= HASHES:
                count()
    count()
    return np.packbits(2 * counts > total[:, None], axis=1, bitorder="little").view("<u8").ravel()


_SIGNED = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def _sign(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            yield arrow_rows(_SIGNED, doc_id=part.column(0), fp=fingerprints_of(texts_of(part, "text")).view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed 64-bit number) of every row."""
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     _sign, "doc_id long, fp long")


def parts_for(n: int, tile: int = TILE) -> int:
    """Parts of the fingerprint so that, with fair bits, a fingerprint shares its tile with ``tile`` others at most."""
    for parts in (1, 2, 4, 8):
        width = 64 // parts
        if n * (comb(2 * width, width) / 4 ** width) ** parts <= tile:
            return parts
    return 16


def _steps(parts: int, radius: int) -> list[int]:
    """Key differences, none negative, of tiles whose counts differ by the radius at most."""
    base = 64 // parts + 1 + radius  # no sum of a count and a step carries into the next part
    reach = {0: {0}}  # key difference -> spent radius
    for part in range(parts):
        reach = {d + step * base ** part: {spent + abs(step)}
                 for d, used in reach.items() for spent in used for step in range(-radius, radius + 1) if spent + abs(step) <= radius}
    return sorted(d for d in reach if d >= 0)


def tile_key(fp: str, parts: int, radius: int = RADIUS):
    """The population counts of a fingerprint's parts, as one number."""
    width, base = 64 // parts, 64 // parts + 1 + radius
    mask = "" if parts == 1 else f" & {(1 << width) - 1}"
    return F.expr(" + ".join(f"CAST(bit_count(shiftrightunsigned({fp}, {k * width}){mask}) AS BIGINT) * {base ** k}" for k in range(parts)))


def forest(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, hub) that join up what the links between ``a`` and ``b`` (or inside ``a``) connect."""
    every = a if b is None else np.concatenate([a, b])
    other, shift = (a, 0) if b is None else (b, len(a))
    label = np.arange(len(every))
    for k in range(0, len(a), ROWS):
        i, j = np.nonzero(np.bitwise_count(a[k:k + ROWS, None] ^ other[None, :]) <= radius)
        i, j = i + k, j + shift
        while len(i):
            x, y = label[i], label[j]
            open_ = x != y
            i, j, x, y = i[open_], j[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                short = label[label]
                if (short == label).all():
                    break
                label = short
    on = np.flatnonzero(label != np.arange(len(every)))
    return every[on], every[label[on]]


def _compare(batches, radius: int):
    """Edges of tile pairs (members, others); without others, of one tile."""
    for batch in batches:
        for own, others in zip(batch.column(0), batch.column(1), strict=True):
            a = own.values.to_numpy(zero_copy_only=False).view(_U)
            b = others.values.to_numpy(zero_copy_only=False).view(_U) if others.is_valid else None
            x, y = forest(a, b, radius)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])


def tiles(fps: DataFrame, parts: int, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``key, cut, members`` of distinct fingerprints (column ``fp``)."""
    keyed = fps.select("fp", tile_key("fp", parts, radius).alias("key"))
    cuts = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("cuts"))
    return (keyed.join(cuts, "key").groupBy("key", F.expr("CAST(pmod(xxhash64(fp), cuts) AS INT)").alias("cut"))
            .agg(F.collect_list("fp").alias("members")))


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges ``a, b`` whose components are those of all pairs of distinct fingerprints within the radius."""
    parts = parts_for(fps.count(), tile)
    cut = stage(tiles(fps, parts, radius, tile), "tiles")
    near = F.explode(F.array(*(F.lit(d).cast("long") for d in _steps(parts, radius))))
    left = cut.select("key", "cut", near.alias("step")).select("key", "cut", (F.col("key") + F.col("step")).alias("key2"))
    right = cut.select(F.col("key").alias("key2"), F.col("cut").alias("cut2"))
    pairs = left.join(right, "key2").where("key <> key2 OR cut <= cut2")
    members = cut.select(F.col("key").alias("key2"), F.col("cut").alias("cut2"), F.col("members").alias("others"))
    both = (pairs.join(cut, ["key", "cut"]).join(members, ["key2", "cut2"])
            .select("members", F.when(F.expr("key <> key2 OR cut <> cut2"), F.col("others")).alias("others")))
    return map_arrow(both, partial(_compare, radius=radius), "a long, b long")


def op11_near_duplicates(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    signed = stage(fingerprints(docs), "fingerprints")
    classes = stage(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    # rows of one doc_id with different texts are one document
    texts = signed.where("doc_id IS NOT NULL").distinct()
    several = texts.groupBy("doc_id").agg(F.min("fp").alias("b"), F.max("fp").alias("last")).where("b <> last")
    own = texts.join(several, "doc_id").select(F.col("fp").alias("a"), "b")
    found = components(links(classes.select("fp"), radius, tile).union(own))
    grouped = classes.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = grouped.select("fp", "component").join(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    return signed.join(ids.select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
