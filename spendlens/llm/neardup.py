"""MinHash near-dedup by a multi-index Hamming join.

A document is the set of its distinct 5-word shingles. Its signature has 64 symbols of 16
bits, each from one minhash. Two documents of resemblance 0.85 differ in 9.6 symbols on
average; all pairs that differ in at most 22 (``DISTANCE``) are found: 12 chunks share
these 22 errors, so some chunk has one error at most, and leaving out each symbol of each
chunk in turn enumerates it. A pair at 0.85 exactly differs in more than 22 symbols with a
chance of 3e-5, and is then mostly found too, since few pairs spread errors that evenly.
For another link threshold ``layout`` derives the three numbers with the same chance.

* Equal sets are one class before anything is joined, so exact copies cost nothing more.
* In a bucket only edges to its smallest member are kept, first within each batch, then
  across: a bucket of any size gives as many edges as members. Their components hold every
  pair that shares a bucket, and with many documents of one template also many that are
  far apart.
* So the signatures of each component are compared, in tiles of ``TILE`` members, and only
  pairs that differ in at most the covered number of symbols are links; a tile pair returns
  a spanning forest of them. Components of these links are what is confirmed.
* Their full sets are compared in blocks of at most ``BLOCK`` members and
  ``BLOCK_SHINGLES`` shingles, every block with every other one; a block pair returns a
  spanning forest of its confirmed links, never the pairs themselves.

Defined results: a text that is null or without words has the empty set and is linked with
nothing; rows that share a doc_id are one document, linked by any of its texts; a null
doc_id takes its component's smallest id (null if the component has none, and is kept
then). Ids lie below 2**62: classes without an id of their own are numbered from there.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_arrays as ta
from .graph import components, joined
from .shared import arrow_rows, map_arrow, stage, text_parts, unstage

SHINGLE = 5
BLOCK, BLOCK_SHINGLES = 256, 400_000
#: Members of a tile of signatures; rows of it that are compared at once.
TILE, TILE_ROWS = 2048, 64
#: Classes without an id of their own (no row has one, or a smaller text has it) are numbered from here.
NO_ID = 1 << 62
#: Two sets are linked if 100 * intersection >= LINK * union.
LINK = 85
#: The most chance that a pair at the link threshold differs in more symbols than are covered.
MISS = 3e-5
#: Chunks of fewer symbols on average would be shared by too many pairs far below the threshold.
LEAST_CHUNK = 5


def layout(link: int) -> tuple[int, int, int]:
    """``(symbols, distance, chunks)`` of the shortest signatures for a link threshold."""
    miss = (100 - link) / 100
    for symbols in range(32, 1024, 32):
        chance, distance = 1.0, -1
        while chance > MISS:
            distance += 1
            chance -= comb(symbols, distance) * miss ** distance * (1 - miss) ** (symbols - distance)
        chunks = distance // 2 + 1  # some chunk has one error at most
        if symbols >= LEAST_CHUNK * chunks:
            return symbols, distance, chunks
    raise ValueError(f"no signature finds pairs at a link threshold of {link}")


SYMBOLS, DISTANCE, CHUNKS = layout(LINK)

_U = np.uint64
_SEEDS = ta.mix(np.arange(1, 1024, dtype=_U) * _U(0xA0761D6478BD642F))
_FACTORS = ta.mix(_SEEDS) | _U(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    lower = ta.LOWER[data]
    starts, ends, text = ta.word_spans(lower, offsets)
    words = ta.range_hashes(lower, starts, ends)
    at, h = ta.windows(words, text, SHINGLE)
    n = len(offsets) - 1
    first = np.searchsorted(text, np.arange(n + 1))
    cut = np.searchsorted(at, first)
    out = []
    for i in range(n):
        size = first[i + 1] - first[i]
        if size >= SHINGLE:
            out.append(np.unique(h[cut[i]:cut[i + 1]]))
        elif size:  # the whole sequence is one shingle
            one = np.array([size], _U)
            for w in words[first[i]:first[i + 1]]:
                one = ta.mix(one * _U(0x2545F4914F6CDD1D) + w)
            out.append(one)
        else:
            out.append(np.zeros(0, _U))
    return out


def signatures(sets: list[np.ndarray], symbols: int = SYMBOLS) -> np.ndarray:
    """(sets, symbols) 16-bit symbols of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), symbols), np.uint16)
    for k in range(symbols):
        low = np.minimum.reduceat((flat ^ _SEEDS[k]) * _FACTORS[k], starts)
        out[:, k] = ta.mix(low) & _U(0xFFFF)
    return out


_SIGNED = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("signature", pa.binary())])


def sign(docs: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``doc_id, text_hash, n_shingles``, a 128-bit set hash ``h1, h2`` and the signature of every row."""
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_parts(batch, "text"):
                sets = shingle_sets(data, offsets)
                full = [s for s in sets if len(s)]
                sig = iter(signatures(full, symbols)) if full else iter(())
                yield arrow_rows(
                    _SIGNED, doc_id=batch.column(0).slice(i, j - i), text_hash=batch.column(1).slice(i, j - i), n_shingles=[len(s) for s in sets],
                    h1=np.array([ta.mix(s).sum(dtype=_U) for s in sets], _U).view(np.int64),
                    h2=np.array([ta.mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) for s in sets], _U).view(np.int64),
                    signature=[next(sig).astype("<u2").tobytes() if len(s) else None for s in sets])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, text_hash long, n_shingles long, h1 long, h2 long, signature binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def chunk_keys(symbols: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """(rows, symbols) bucket keys: a chunk without each of its symbols in turn."""
    out = np.empty(symbols.shape, _U)
    wide = symbols.astype(_U)
    bounds = np.linspace(0, symbols.shape[1], chunks + 1).astype(int)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        for j in range(a, b):
            h = np.full(len(symbols), j + 1, _U)
            for k in range(a, b):
                if k != j:
                    h = ta.mix(h * _U(0x10001) + wide[:, k])
            out[:, j] = h
    return out


_KEYED = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _keys(batches, symbols: int = SYMBOLS, chunks: int = CHUNKS):
    """Bucket rows (key, class), and edges (class, smaller class) between rows of one batch."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, symbols)
        for i in range(0, len(ids), 4096):
            keys = chunk_keys(sig[i:i + 4096], chunks).ravel()
            own = np.repeat(ids[i:i + 4096], symbols)
            order = np.lexsort((own, keys))
            keys, own = keys[order], own[order]
            head = np.ones(len(keys), bool)
            head[1:] = keys[1:] != keys[:-1]
            hub = own[np.flatnonzero(head)[np.cumsum(head) - 1]]
            pairs = np.unique(np.stack([own[~head], hub[~head]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(keys[head].view(np.int64)), pa.array(own[head]), pa.nulls(int(head.sum()), pa.int64())], schema=_KEYED)
            if pairs.size:
                spread = ta.mix(pairs[0].astype(_U) * _U(31) + pairs[1].astype(_U)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(pairs[0]), pa.array(pairs[1])], schema=_KEYED)


def _bucket_edges(batches):
    """Edges from each bucket's rows (sorted by key) to the first of them."""
    last_key = last_id = None
    for batch in batches:
        key, a, b = (batch.column(k) for k in range(3))
        edge = np.array(b.is_valid())
        ea, eb = a.to_numpy()[edge], b.drop_null().to_numpy()
        k, own = key.to_numpy()[~edge], a.to_numpy()[~edge]
        if len(k):
            head = np.ones(len(k), bool)
            head[1:] = k[1:] != k[:-1]
            carried = last_key is not None and k[0] == last_key
            hub = own[np.flatnonzero(head)[np.cumsum(head) - 1]]
            if carried:
                hub[:len(k) if head.sum() == 1 else int(np.flatnonzero(head)[1])] = last_id
            last_key, last_id = k[-1], hub[-1]
            on = own != hub
            ea, eb = np.concatenate([ea, own[on]]), np.concatenate([eb, hub[on]])
        if len(ea):
            pairs = np.unique(np.stack([ea, eb]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def candidate_edges(classes: DataFrame, symbols: int = SYMBOLS, chunks: int = CHUNKS) -> DataFrame:
    """Edges (a, b), some repeated, whose components hold all pairs of classes that share a bucket."""
    keyed = map_arrow(classes.select("class_id", "signature"), partial(_keys, symbols=symbols, chunks=chunks), "key long, a long, b long")
    return map_arrow(keyed.repartition("key").sortWithinPartitions("key", "a"), _bucket_edges, "a long, b long")


def near(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``i, j`` of all rows of ``a`` and ``b`` (signatures) that differ in at most ``distance`` symbols."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for k in range(0, len(a), TILE_ROWS):
        apart = np.zeros((min(TILE_ROWS, len(a) - k), len(b)), np.uint16)
        for symbol in range(a.shape[1]):
            apart += a[k:k + TILE_ROWS, symbol, None] != b[None, :, symbol]
        i, j = np.nonzero(apart <= distance)
        found.append((i + k, j))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _near_tiles(batches, symbols: int, distance: int):
    """Edges of tile pairs (ids, signatures, other ids, other signatures); without others, of one tile."""
    def side(ids, signatures):
        own = ids.values.to_numpy(zero_copy_only=False)
        return own, np.frombuffer(b"".join(signatures.as_py()), "<u2").reshape(len(own), symbols)

    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            ids, a = side(row[0], row[1])
            if row[2].is_valid:
                others, b = side(row[2], row[3])
                i, j = near(a, b, distance)
                ids, j = np.concatenate([ids, others]), j + len(a)
            else:
                i, j = near(a, a, distance)
            label = joined(len(ids), i, j)
            on = np.flatnonzero(label != np.arange(len(ids)))
            if len(on):
                yield pa.RecordBatch.from_arrays([pa.array(ids[on]), pa.array(ids[label[on]])], names=["a", "b"])


def near_edges(classes: DataFrame, blobs: DataFrame, symbols: int = SYMBOLS, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Edges whose components are those of all pairs within ``distance`` inside blobs (``node, component``)."""
    members = classes.select("class_id", "signature").join(
        blobs.select(F.col("node").alias("class_id"), F.col("component").alias("blob")), "class_id")
    sizes = members.groupBy("blob").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("nb"))
    tiles = stage(members.join(sizes, "blob").groupBy("blob", F.expr("CAST(pmod(xxhash64(class_id), nb) AS INT)").alias("tile"))
                  .agg(F.collect_list(F.struct("class_id", "signature")).alias("m"))
                  .select("blob", "tile", F.col("m.class_id").alias("ids"), F.col("m.signature").alias("signatures")), "tiles")
    pairs = tiles.select("blob", "tile").join(tiles.select("blob", F.col("tile").alias("tile2")), "blob").where("tile <= tile2")
    other = tiles.select("blob", F.col("tile").alias("tile2"), F.col("ids").alias("ids2"), F.col("signatures").alias("signatures2"))
    apart = F.expr("tile <> tile2")
    rows = pairs.join(tiles, ["blob", "tile"]).join(other, ["blob", "tile2"]).select(
        "ids", "signatures", F.when(apart, F.col("ids2")).alias("ids2"), F.when(apart, F.col("signatures2")).alias("signatures2"))
    return map_arrow(rows, partial(_near_tiles, symbols=symbols, distance=distance), "a long, b long")


def confirm(ids: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], link: int = LINK) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks' members (or inside one block)."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets])
    if n <= 6:
        inter = np.zeros((n, n))
        for i in range(n):
            for j in range(i):
                if min(sizes[i], sizes[j]) * 100 >= link * max(sizes[i], sizes[j]):
                    inter[i, j] = inter[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        member = np.repeat(np.arange(n), sizes)
        shared = count > 1
        number, member = (np.cumsum(shared) - 1)[number[shared[number]]], member[shared[number]]
        order = np.argsort(number, kind="stable")
        number, member = number[order], member[order]
        inter, width = np.zeros((n, n)), 4096
        for a in range(0, int(shared.sum()), width):
            i, j = np.searchsorted(number, [a, a + width])
            x = np.zeros((n, width), np.float32)
            x[member[i:j], number[i:j] - a] = 1
            inter += x @ x.T
    linked = 100 * inter >= link * (sizes[:, None] + sizes[None, :] - inter)
    if blocks.min() != blocks.max():
        linked &= blocks[:, None] != blocks[None, :]
    np.fill_diagonal(linked, True)
    label = np.arange(n)
    while True:
        new = np.where(linked, label[None, :], n).min(axis=1)
        if (new == label).all():
            break
        label = new
    return [(int(ids[i]), int(ids[k])) for i, k in enumerate(label) if i != k]


def _confirm_groups(batches, link: int = LINK):
    """Links of each (blob, i, k) group; its rows come one after the other."""
    key, ids, blocks, sets = None, [], [], []

    def flush():
        links = confirm(np.array(ids), np.array(blocks), sets, link) if len(ids) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        for blob, i, k, block, own, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (blob, i, k):
                if len(ids) > 1:
                    yield flush()
                key, ids, blocks, sets = (blob, i, k), [], [], []
            if ids and ids[-1] == own:  # a repeated row
                continue
            ids.append(own)
            blocks.append(block)
            sets.append(np.frombuffer(raw, "<u8"))
    if len(ids) > 1:
        yield flush()


def confirmed_links(docs: DataFrame, classes: DataFrame, blobs: DataFrame, link: int = LINK) -> DataFrame:
    """Edges whose components are those of all confirmed links inside blobs."""
    members = classes.select("class_id", "n_shingles", "rep").join(blobs.select(F.col("node").alias("class_id"), F.col("component").alias("blob")), "class_id")
    sizes = members.groupBy("blob").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("nb"))
    # one row of each class: of its least doc_id, the text of least hash
    placed = members.join(sizes, "blob").select(
        F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("text_hash"), "class_id", "blob", "nb",
        F.expr("CAST(pmod(xxhash64(class_id), nb) AS INT)").alias("block"))

    def sets(batches):
        for batch in batches:
            for i, j, data, offsets in text_parts(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, j - i) for k in range(4)),
                     pa.array([s.astype("<u8").tobytes() for s in shingle_sets(data, offsets)], pa.binary())],
                    names=["class_id", "blob", "nb", "block", "shingles"])

    texts = _texts(docs).join(placed, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.xxhash64("text") == F.col("text_hash")))
    rows = map_arrow(texts.select("class_id", "blob", "nb", "block", "text"), sets,
                     "class_id long, blob long, nb int, block int, shingles binary")
    paired = (rows.withColumn("other", F.explode(F.expr("sequence(0, nb - 1)")))
              .select("blob", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("k"), "block", "class_id", "shingles"))
    return map_arrow(paired.repartition("blob", "i", "k").sortWithinPartitions("blob", "i", "k", "class_id"), partial(_confirm_groups, link=link), "a long, b long")


def op4_near_duplicates(docs: DataFrame, link: int = LINK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash, node`` of every document.

    ``node`` is the component, numbered also where it has no id; null for the empty set.
    """
    symbols, distance, chunks = layout(link)
    signed = stage(sign(docs, symbols), "signed")
    found = stage(signed.where("n_shingles > 0").groupBy("n_shingles", "h1", "h2")
                  .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("rep"), F.first("signature").alias("signature")),
                  "found")
    shared = (found.groupBy(F.col("rep.doc_id").alias("shared_id")).agg(F.count(F.lit(1)).alias("n"), F.min("rep.text_hash").alias("least"))
              .where("n > 1 AND shared_id IS NOT NULL").drop("n"))
    own = F.when(F.col("least").isNull() | (F.col("least") == F.col("rep.text_hash")), F.col("rep.doc_id"))
    number = F.coalesce(own, F.lit(NO_ID) + F.pmod(F.xxhash64("n_shingles", "h1", "h2"), F.lit(1 << 61)))
    classes = stage(found.join(shared, F.col("rep.doc_id") == F.col("shared_id"), "left").withColumn("class_id", number).drop("shared_id", "least"), "classes")
    unstage(found)
    blobs = stage(components(candidate_edges(classes, symbols, chunks)), "blobs")
    close = components(near_edges(classes, blobs, symbols, distance))
    unstage(blobs)
    # rows of one doc_id with different texts are one document
    numbered = signed.join(classes.select("n_shingles", "h1", "h2", "class_id"), ["n_shingles", "h1", "h2"], "left")
    of_class = stage(numbered.where("doc_id IS NOT NULL AND class_id IS NOT NULL").select("doc_id", "class_id").distinct(), "of_class")
    least = of_class.groupBy("doc_id").agg(F.min("class_id").alias("b"), F.max("class_id").alias("last")).where("b <> last")
    same = of_class.join(least, "doc_id").select(F.col("class_id").alias("a"), "b")
    links = stage(components(confirmed_links(docs, classes, close, link).union(same)), "links").withColumnRenamed("node", "class_id")
    with_words = numbered.where("n_shingles > 0").join(links, "class_id", "left").withColumn("node", F.coalesce("component", "class_id"))
    by_doc = of_class.join(links, "class_id", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "class_id")).alias("node"))
    columns = ["doc_id", "n_shingles", "text_hash", "node"]
    out = with_words.select(columns).union(signed.where("n_shingles = 0").join(by_doc, "doc_id", "left").select(columns))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).when(F.col("node") < NO_ID, F.col("node"))
    return out.withColumn("component_id", component).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"), "text_hash", "node")
