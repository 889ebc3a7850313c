"""Edit-aware token counts with a segment tree per document.

A text is cut into segments of pre-tokens at certain boundaries (a white-space byte after a
visible ASCII one parts pre-tokens whatever stands around it), so its tokens are the sum of
its segments'. A tree over the segments keeps the sums of bytes and tokens. An edit goes
down the tree to the segments it touches; only these, with neighbours for context until
both edges are certain boundaries again, are encoded anew, and the sums above them updated.

Trees are kept: ``segment_trees`` gives every document's segment sizes and counts as columns
(the sums above them are additions), to be stored beside the text; ``edit_trees`` takes them
with edits and gives the new text with its tree, for the edits that follow. Neither the first
count of an edited text nor a later one encodes more than the touched regions.

Edits refer to the text they come with in code points, ``[start, stop)`` and a replacement.

Defined results: a null text counts as empty; null edits are none; positions outside the
text are clipped, a null position or ``stop < start`` drops the edit, a null replacement
deletes; an edit that starts before an earlier one's end is dropped (of equal starts the
first of the array stays); repeated rows are counted each; an empty table gives no rows; a
tree that is null or whose sizes do not add up to its text's bytes is built anew, and these
bytes count as encoded.
Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Encoder, encoder
from .shared import map_arrow, quoted, text_parts

SEGMENT = 256  # bytes, about

EDITS = "array<struct<start:long,stop:long,text:string>>"
TREE = "sizes array<int>, counts array<int>"

#: Personal data and secrets, and what redaction puts in their place.
REDACTIONS = (
    (r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+\.[A-Za-z]+", "<email>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<address>"),
    (r"\bAKIA[0-9A-Z]{16}\b", "<key>"),
    (r"\b\d{13,19}\b", "<card>"),
    (r"\+\d{1,2} \(\d{3}\) \d{3}-\d{4}", "<phone>"),
)


def segment_ends(data: np.ndarray, size: int = SEGMENT) -> np.ndarray:
    """Ends of a text's segments: the first certain boundary after each ``size`` bytes."""
    n = len(data)
    if n <= size:
        return np.array([n] if n else [], np.int64)
    at = np.flatnonzero(((data[1:] == 0x20) | (data[1:] == 0x0A) | (data[1:] == 0x09)) & (data[:-1] > 0x20) & (data[:-1] < 0x7F)) + 1
    pick = np.searchsorted(at, np.arange(size, n, size))
    return np.append(np.unique(at[pick[pick < len(at)]]), n)


class SegmentTree:
    """Sums of bytes and tokens over the segments of one text.

    ``kept`` are the sizes and counts of the text's segments from an earlier tree.
    """

    def __init__(self, raw: bytes, encode: Encoder, kept: tuple[list[int], list[int]] | None = None):
        self.encode, self.touched = encode, set()
        self.encoded = 0  # bytes encoded anew
        if kept is None:
            ends = segment_ends(np.frombuffer(raw, np.uint8)).tolist()
        else:
            ends = np.cumsum(kept[0], dtype=np.int64).tolist()
        self.parts = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if kept is None:
            self.encoded = len(raw)
            counts = [self.tokens(p) for p in self.parts]
        else:
            counts = kept[1]
        self.base = 1 << max(0, (len(self.parts) - 1).bit_length())
        self.size, self.count = [0] * (2 * self.base), [0] * (2 * self.base)
        for i, p in enumerate(self.parts):
            self.size[self.base + i], self.count[self.base + i] = len(p), counts[i]
        for i in range(self.base - 1, 0, -1):
            self.size[i], self.count[i] = self.size[2 * i] + self.size[2 * i + 1], self.count[2 * i] + self.count[2 * i + 1]

    def leaves(self) -> tuple[list[int], list[int]]:
        """Sizes and counts of the segments, to be kept; those that edits made long are cut."""
        sizes, counts = [], []
        for k, part in enumerate(self.parts):
            if k in self.touched and len(part) > 2 * SEGMENT:
                ends = segment_ends(np.frombuffer(part, np.uint8)).tolist()
                if len(ends) > 1:
                    self.encoded += len(part)
                    sizes += np.diff([0, *ends]).tolist()
                    counts += [self.tokens(part[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
                    continue
            if part:
                sizes.append(len(part))
                counts.append(self.count[self.base + k])
        return sizes, counts

    def tokens(self, part: bytes) -> int:
        return len(self.encode.plain(part)) // 4

    @property
    def total(self) -> int:
        return self.count[1] if self.parts else 0

    def find(self, at: int) -> tuple[int, int]:
        """The segment that holds byte ``at`` (the last one, at the end) and the byte's place there."""
        i = 1
        while i < self.base:
            i *= 2
            if at >= self.size[i] and self.size[i + 1]:
                at -= self.size[i]
                i += 1
        return i - self.base, at

    def put(self, k: int, part: bytes) -> None:
        self.parts[k] = part
        self.touched.add(k)
        i = self.base + k
        self.size[i], self.count[i] = len(part), self.tokens(part) if part else 0
        i //= 2
        while i:
            self.size[i], self.count[i] = self.size[2 * i] + self.size[2 * i + 1], self.count[2 * i] + self.count[2 * i + 1]
            i //= 2

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put ``new`` in place of bytes ``[start, stop)``."""
        if not self.parts:
            self.parts.append(b"")
        (i, a), (j, b) = self.find(start), self.find(stop)
        text = self.parts[i][:a] + new + self.parts[j][b:]
        while True:
            p = next((k for k in range(i - 1, -1, -1) if self.parts[k]), None)
            q = next((k for k in range(j + 1, len(self.parts)) if self.parts[k]), None)
            if p is not None and not (text and _certain(self.parts[p][-1], text[0])):
                text, i = self.parts[p] + text, p
            elif q is not None and not (text and _certain(text[-1], self.parts[q][0])):
                text, j = text + self.parts[q], q
            else:
                break
        self.encoded += len(text)
        for k in range(i + 1, j + 1):
            if self.parts[k]:
                self.put(k, b"")
        self.put(i, text)


def _certain(before: int, after: int) -> bool:
    return 0x21 <= before <= 0x7E and after in (0x20, 0x0A, 0x09)


def usable_edits(edits, n: int) -> list[tuple[int, int, str]]:
    """Edits by start, clipped to a text of ``n`` code points, without overlaps."""
    out, end = [], 0
    for e in sorted((e for e in edits or () if e and e["start"] is not None and e["stop"] is not None and e["start"] <= e["stop"]),
                    key=lambda e: min(max(e["start"], 0), n)):
        a, b = min(max(e["start"], 0), n), min(max(e["stop"], 0), n)
        if a >= end or not out:
            out.append((a, b, e["text"] or ""))
            end = b
    return out


def segment_trees(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text, sizes, counts`` of every row: the tree's segments in bytes and tokens.

    The columns named by ``keep`` come along, after these.
    """
    names = ["doc_id", "text", "sizes", "counts", *keep]

    def run(batches):
        e = encoder(tokenizer, {})
        for batch in batches:
            for i, j, data, offsets in text_parts(batch, "text"):
                trees = [SegmentTree(data[offsets[k]:offsets[k + 1]].tobytes(), e).leaves() for k in range(j - i)]
                own = [c.slice(i, j - i) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*own[:2], *_tree_columns(trees), *own[2:]], names=names)

    rows = _documents(docs, *(F.col(quoted(c)) for c in keep))
    schema = rows.schema
    return map_arrow(rows, run, f"doc_id long, text string, {TREE}" + "".join(f", {quoted(c)} {schema[c].dataType.simpleString()}" for c in keep))


def edit_trees(trees: DataFrame, tokenizer: str) -> DataFrame:
    """Every row (doc_id, text, sizes, counts, edits) after its edits, with its new tree.

    ``doc_id, text, sizes, counts`` are as ``segment_trees`` gives them for the new text;
    counts of tokens before and after, of segments, edits used and bytes encoded follow.
    """
    numbers = ["n_segments", "tokens_before", "n_edits", "tokens_after", "bytes_before", "bytes_encoded"]

    def run(batches):
        e = encoder(tokenizer, {})
        for batch in batches:
            for i, j, data, offsets in text_parts(batch, "text"):
                sizes, counts, edits = (batch.column(c).slice(i, j - i).to_pylist() for c in (2, 3, 4))
                texts, after, out = [], [], []
                for k in range(j - i):
                    raw = data[offsets[k]:offsets[k + 1]].tobytes()
                    tree = SegmentTree(raw, e, _fitting(sizes[k], counts[k], len(raw)))
                    before, segments, used = tree.total, len(tree.parts), 0
                    if edits[k]:
                        text = raw.decode()
                        use = usable_edits(edits[k], len(text))
                        used = len(use)
                        for start, stop, new in reversed(_in_bytes(text, use)):  # earlier places stay as they were
                            tree.replace(start, stop, new)
                        raw = b"".join(tree.parts)
                    texts.append(raw.decode())
                    total = tree.total
                    after.append(tree.leaves())
                    out.append((segments, before, used, total, int(offsets[k + 1] - offsets[k]), tree.encoded))
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(texts, pa.string()), *_tree_columns(after), *columns],
                                                 names=["doc_id", "text", "sizes", "counts", *numbers])

    rows = _documents(trees, F.col("sizes").cast("array<int>").alias("sizes"), F.col("counts").cast("array<int>").alias("counts"),
                      F.col("edits").cast(EDITS).alias("edits"))
    return map_arrow(rows, run, f"doc_id long, text string, {TREE}, " + ", ".join(f"{n} long" for n in numbers))


def _documents(docs: DataFrame, *more) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def _tree_columns(trees: list[tuple[list[int], list[int]]]) -> list[pa.Array]:
    return [pa.array([t[c] for t in trees], pa.list_(pa.int32())) for c in (0, 1)]


def _fitting(sizes, counts, n: int) -> tuple[list[int], list[int]] | None:
    """The kept tree, if it is one of a text of ``n`` bytes."""
    if sizes is None or counts is None or len(sizes) != len(counts) or None in sizes or None in counts:
        return None
    return (sizes, counts) if sum(sizes) == n and min(sizes, default=1) > 0 else None


def _in_bytes(text: str, use: list[tuple[int, int, str]]) -> list[tuple[int, int, bytes]]:
    """Edits by code points as edits by bytes."""
    at = last = 0
    places = []
    for a, b, new in use:
        at += len(text[last:a].encode())
        start = at
        at += len(text[a:b].encode())
        last = b
        places.append((start, at, new.encode()))
    return places


def count_edited(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Token counts before and after the edits of every row of ``docs`` (doc_id, text, edits).

    The trees are made on the way; ``bytes_encoded`` is what the edits alone took.
    """
    edited = docs.select("doc_id", "text", F.col("edits").cast(EDITS).alias("edits"))
    return edit_trees(segment_trees(edited, tokenizer, ("edits",)), tokenizer).drop("text", "sizes", "counts")


def redactions(docs: DataFrame) -> DataFrame:
    """``doc_id, text, edits``: every row with the edits that redact personal data."""
    patterns = [(re.compile(p), new) for p, new in REDACTIONS]
    hint = re.compile(r"[0-9@]")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("text", pa.string())]))

    def run(batches):
        for batch in batches:
            edits = []
            for text in batch.column(1).to_pylist():
                found = []
                if text and hint.search(text):
                    for p, new in patterns:
                        found.extend({"start": m.start(), "stop": m.end(), "text": new} for m in p.finditer(text))
                edits.append(found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, kind)], names=["doc_id", "text", "edits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, f"doc_id long, text string, edits {EDITS}")


def op8_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Token counts of every document before and after its redaction."""
    return count_edited(redactions(docs), tokenizer)
