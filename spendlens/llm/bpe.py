"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over 8 bytes cuts every text into chunks whose borders depend on nearby
content only, so a passage gives the same chunks in whatever document it stands. A census
over all documents finds the chunks that occur twice or more; those that save most are
encoded once, in Spark, and given to every worker (a table of proven size: ``MOST_SHARED``
chunks of at most ``LONGEST`` bytes). Other chunks are encoded once per worker, which
remembers a bounded number of them.

Joins between chunks are repaired: from a chunk's ids only those between certain
boundaries are taken (a white-space byte after a visible ASCII one parts pre-tokens
whatever stands around it), and the text from the last such boundary on the left to the
first on the right is encoded anew. If a chunk holds none, the window widens over the next
chunks until both sides agree from a boundary on, so the ids are those of the whole text.

Latin text goes through the rank form of the vocabulary, other text through the tokenizers
library itself; both give the same ids (tests compare them on random text).

Defined results: a null or empty text has no ids and decodes to the empty text; repeated
rows are encoded each; a null doc_id stays null; an empty table gives no rows. Extra
columns are ignored. Decoding ids of broken UTF-8 puts U+FFFD as the library does.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import text_arrays as ta
from .shared import map_arrow, text_parts
from .word_tokens import _byte_letters

#: Chunks in the table that every worker gets, and a chunk's bytes there at most.
MOST_SHARED, LONGEST = 16_384, 2_048
#: Chunks that a worker remembers besides; it starts anew beyond it (results do not change).
MOST_KNOWN = 20_000
#: How Latin text is cut before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_WINDOW, _MASK = 8, np.uint32(0xFF)  # 256 bytes between cuts on average
_GEAR = ta._VALUES.astype(np.uint32)
_BOUNDARY = re.compile(rb"(?<=[!-~])[ \t\n]")
_BEYOND = re.compile(rb"[\xca-\xff]")  # a code point from U+0280 on, safely past Latin


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all chunks of the texts; a text's end is always one, code points stay whole."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n >= _WINDOW:
        gear = _GEAR[data]
        h = np.zeros(n - _WINDOW + 1, np.uint32)
        for k in range(_WINDOW):
            h += gear[k:k + len(h)] << np.uint32(_WINDOW - 1 - k)
        cut[_WINDOW:] = (h >> np.uint32(5)) & _MASK == 0
        cut[:n] &= (data & 0xC0) != 0x80
        cut[0] = False
    cut[offsets] = True
    cut[0] = False
    ends = np.flatnonzero(cut)
    return ends


class Encoder:
    """Encodes texts of one vocabulary, reusing chunks."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = {t.content: k for k, t in self.library.get_added_tokens_decoder().items()}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): k for token, k in self.library.get_vocab(False).items() if token not in special}
        self.special = {s.encode() for s in special}
        self.ranks = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.shared: dict[bytes, tuple] = {}
        self.known: dict[bytes, tuple] = {}

    def plain(self, part: bytes) -> bytes:
        """Ids (little-endian 32-bit) of a text by itself."""
        if not part:
            return b""
        if _BEYOND.search(part) or (b"<|" in part and any(s in part for s in self.special)):
            ids = self.library.encode(part.decode(), add_special_tokens=False).ids
        else:
            ids = self.ranks.encode_ordinary(part.decode())
        return np.array(ids, "<u4").tobytes()

    def chunk(self, chunk: bytes) -> tuple[bytes, bytes | None, bytes]:
        """Text before the first boundary, ids between the first and the last, text after.

        Without two boundaries everything is text of the join.
        """
        found = self.shared.get(chunk) or self.known.get(chunk)
        if found is None:
            first = _BOUNDARY.search(chunk)
            last = max(chunk.rfind(b" "), chunk.rfind(b"\n"), chunk.rfind(b"\t"))
            while last > 0 and not 0x21 <= chunk[last - 1] <= 0x7E:
                last = max(chunk.rfind(b" ", 0, last), chunk.rfind(b"\n", 0, last), chunk.rfind(b"\t", 0, last))
            if first is None or last <= first.start():
                found = chunk, None, b""
            else:
                a = first.start()
                found = chunk[:a], self.plain(chunk[a:last]), chunk[last:]
            if len(chunk) <= LONGEST:
                if len(self.known) >= MOST_KNOWN:
                    self.known.clear()
                self.known[chunk] = found
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Ids of every text ``data[offsets[i]:offsets[i + 1]]``."""
        raw, ends = data.tobytes(), chunk_ends(data, offsets).tolist()
        out, k = [], 0
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            ids, join = [], []  # join: text not yet encoded, since the last boundary
            while a < b:
                end = ends[k]
                k += 1
                head, core, tail = self.chunk(raw[a:end])
                join.append(head)
                if core is not None:
                    ids.append(self.plain(b"".join(join)))
                    ids.append(core)
                    join = [tail]
                elif len(join) > 64:
                    join = [b"".join(join)]
                a = end
            ids.append(self.plain(b"".join(join)))
            out.append(b"".join(ids))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, shared: dict[bytes, tuple] | None = None) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    e = _ENCODERS[path]
    if shared is not None:
        e.shared = shared
    return e


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _chunks(batch: pa.RecordBatch):
    """``(raw bytes, starts, ends, hashes)`` of the chunks of slices of a batch."""
    for _, _, data, offsets in text_parts(batch, "text"):
        ends = chunk_ends(data, offsets)
        ends = ends[(ends > 0) & (ends <= len(data))]
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        yield data, starts, ends, ta.range_hashes(data, starts, ends).view(np.int64)


def shared_chunks(docs: DataFrame, tokenizer: str, most: int = MOST_SHARED) -> dict[bytes, tuple]:
    """The chunks that occur most often across all documents, encoded once each."""
    def census(batches):
        for batch in batches:
            for _, starts, ends, hashes in _chunks(batch):
                fit = ends - starts <= LONGEST
                h, first, n = np.unique(hashes[fit], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array((ends - starts)[fit][first]), pa.array(n)], names=["h", "size", "n"])

    top = (map_arrow(_texts(docs), census, "h long, size long, n long")
           .groupBy("h").agg(F.sum("n").alias("n"), F.max("size").alias("size")).where("n > 1")
           .orderBy(F.desc(F.expr("(n - 1) * size")), "h").limit(most).select("h").collect())
    wanted = np.sort(np.array([r["h"] for r in top], np.int64))
    if not len(wanted):
        return {}

    def pick(batches):
        seen: set[int] = set()
        for batch in batches:
            for data, starts, ends, hashes in _chunks(batch):
                at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                on = np.flatnonzero((wanted[at] == hashes) & (ends - starts <= LONGEST))
                new = [i for i in on if hashes[i] not in seen and not seen.add(hashes[i])]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[new]), pa.array([data[starts[i]:ends[i]].tobytes() for i in new], pa.binary())], names=["h", "chunk"])

    def encode(batches):
        e = encoder(tokenizer, {})
        for batch in batches:
            chunks = batch.column(0).to_pylist()
            cut = [e.chunk(c) for c in chunks]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunks, pa.binary()), *(pa.array([c[k] for c in cut], pa.binary()) for k in range(3))],
                names=["chunk", "head", "core", "tail"])

    one = map_arrow(_texts(docs), pick, "h long, chunk binary").groupBy("h").agg(F.min("chunk").alias("chunk")).select("chunk")
    rows = map_arrow(one, encode, "chunk binary, head binary, core binary, tail binary").collect()
    return {bytes(r[0]): (bytes(r[1]), None if r[2] is None else bytes(r[2]), bytes(r[3])) for r in rows}


def _encoding(tokenizer: str, shared):
    """Batches (doc_id, text) to batches (doc_id, ids), a slice at a time."""
    def run(batches):
        e = encoder(tokenizer, shared.value)
        for batch in batches:
            for i, j, data, offsets in text_parts(batch, "text"):
                ids = e.encode(data, offsets)
                ends = np.cumsum([0, *map(len, ids)]) // 4
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=["doc_id", "ids"])

    return run


def _decoding(tokenizer: str):
    """Batches (doc_id, ids) to batches (doc_id, ids, text), some rows at a time."""
    def run(batches):
        table = _token_bytes(tokenizer)
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                column = batch.column(1)
                flat = column.flatten().to_numpy()
                ends = np.cumsum([0, *column.value_lengths().fill_null(0).to_pylist()]).tolist()
                texts = [b"".join(map(table.__getitem__, flat[a:b].tolist())).decode("utf-8", "replace")
                         for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return run


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids`` (array of int) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, tokenizer))
    return map_arrow(_texts(docs), _encoding(tokenizer, shared), "doc_id long, ids array<int>")


def decode(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids, text``: the text of every row's ids (null ids: empty)."""
    return map_arrow(rows.select("doc_id", "ids"), _decoding(tokenizer), "doc_id long, ids array<int>, text string")


_BYTES: dict[str, list[bytes]] = {}


def _token_bytes(path: str) -> list[bytes]:
    if path not in _BYTES:
        library, letters = encoder(path).library, _byte_letters()
        special = {t.content for t in library.get_added_tokens_decoder().values()}
        table = [b""] * (max(library.get_vocab().values()) + 1)
        for token, k in library.get_vocab().items():
            table[k] = token.encode() if token in special else bytes(letters[c] for c in token)
        _BYTES[path] = table
    return _BYTES[path]


def digests(rows: DataFrame) -> DataFrame:
    """Counts and digests of ``doc_id, ids, text`` rows."""
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op1_encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to.

    Both steps run in one Python worker, a slice of about 2 MB at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, tokenizer))
    encoding, decoding = _encoding(tokenizer, shared), _decoding(tokenizer)
    return digests(map_arrow(_texts(docs), lambda batches: decoding(encoding(batches)), "doc_id long, ids array<int>, text string"))
