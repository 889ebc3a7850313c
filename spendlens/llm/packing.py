"""Packing by cutting-stock column generation.

Documents become token ids (with an end id) and are cut into full sequences and one
remainder each. The remainders' length histogram (at most ``CLASSES`` numbers, whatever
the corpus) is a cutting-stock problem: its linear program over patterns is solved by
column generation, a knapsack dynamic program prices new patterns, and the optimum is
rounded down, the rest filled first-fit. Each piece has a rank among those of its length
class, and the ranks of a class are dealt to the pattern slots of that class, so the
assignment is one range look-up per piece and needs no global order.

Defined results: a null or empty text is one piece holding the end id; repeated rows are
packed each; a null doc_id stays null; an empty table gives no rows. Every id lies in
exactly one piece. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_rows, map_arrow, stage
from .word_tokens import encoder

CAPACITY = 4096
#: Lengths are rounded up to multiples of CAPACITY / CLASSES when patterns are chosen.
CLASSES = 512
END_ID = 2

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def cut_pieces(docs: DataFrame, tokenizer: str, longest: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens`` of every document.

    A document is cut every ``longest`` ids.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encode = encoder(tokenizer).encode
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, j in _by_bytes(texts, 4 << 20):
                out = {f.name: [] for f in _PIECES}
                for doc, tokens in zip(ids[i:j], encode([t or b"" for t in texts.slice(i, j - i).to_pylist()]), strict=True):
                    tokens += end
                    n = len(tokens) // 4
                    view = memoryview(tokens)
                    for s in range(0, n, longest):
                        e = min(n, s + longest)
                        for k, v in zip(out.values(), (doc, s, e - s, zlib.crc32(view[4 * s:4 * e]), n), strict=True):
                            k.append(v)
                yield arrow_rows(_PIECES, **out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_arrow(rows, cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def _by_bytes(column: pa.Array, most: int):
    """Ranges of rows holding at most ``most`` bytes of text together (one row at least)."""
    sizes = np.cumsum([0, *(len(x) if x else 0 for x in column.to_pylist())])
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(sizes, sizes[i] + most, side="right")) - 1)
        yield i, j
        i = j


@dataclass
class Plan:
    """Patterns: how often each is used and how many pieces of each class it holds."""

    uses: list[int]
    patterns: list[dict[int, int]]

    def slots(self) -> dict[int, np.ndarray]:
        """Per class, rows (first rank, pieces a sequence, first sequence, first slot)."""
        out: dict[int, list] = {}
        taken: dict[int, int] = {}
        base = 0
        for n, pattern in zip(self.uses, self.patterns, strict=True):
            slot = 0
            for c, a in sorted(pattern.items(), reverse=True):
                out.setdefault(c, []).append((taken.get(c, 0), a, base, slot))
                taken[c] = taken.get(c, 0) + a * n
                slot += a
            base += n
        return {c: np.array(v, np.int64) for c, v in out.items()}


def price(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: items of size w (1..capacity) are worth ``values[w]``."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        v = values[1:c + 1] + best[c - 1::-1][:c]
        k = int(np.argmax(v))
        if v[k] > best[c - 1]:
            best[c], took[c] = v[k], k + 1
        else:
            best[c], took[c] = best[c - 1], 0
    pattern, c = np.zeros(capacity + 1, np.int64), capacity
    while c > 0:
        if took[c]:
            pattern[took[c]] += 1
            c -= took[c]
        else:
            c -= 1
    return float(best[capacity]), pattern


def solve(histogram: dict[int, int], classes: int = CLASSES, gap: float = 5e-4, most_steps: int = 4_000) -> Plan:
    """Column generation for ``histogram`` (class -> pieces), classes sized 1..``classes``.

    The revised simplex method starts from the basis that greedy filling gives; it stops
    when no pattern prices out, when Farley's bound or the total size proves that the rest is
    within ``gap``, or after ``most_steps`` pivots (a worse plan, never a wrong one). A small
    fixed perturbation of the demands keeps degenerate pivots from cycling.
    """
    sizes = np.array(sorted(c for c, n in histogram.items() if n > 0), np.int64)
    if not len(sizes):
        return Plan([], [])
    demand = np.array([histogram[int(c)] for c in sizes], float)
    columns = _greedy_basis(sizes, demand, classes)  # one pattern a column
    inverse = _inverse(columns)
    moved = demand * (1 + 1e-4 * np.random.default_rng(len(sizes)).random(len(sizes)))
    x = np.maximum(_times(inverse, moved), 0)
    least = (sizes * demand).sum() / classes
    for step in range(most_steps):
        if x.sum() <= (1 + gap) * least:
            break
        y = inverse.sum(axis=0)  # duals: every pattern costs one sequence
        values = np.zeros(classes + 1)
        values[sizes] = np.maximum(y, 0)
        worth, pattern = price(values, classes)
        if worth <= 1 + 1e-9 or x.sum() * (1 - 1 / worth) <= gap * x.sum():
            break
        entering = pattern[sizes].astype(float)
        direction = _times(inverse, entering)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(direction > 1e-9, x / direction, np.inf)
        leave = int(np.argmin(ratio))
        columns[:, leave] = entering
        if step % 200 == 199:
            inverse = _inverse(columns)
        else:
            row = inverse[leave] / direction[leave]
            inverse -= np.outer(direction, row)
            inverse[leave] = row
        x = np.maximum(_times(inverse, moved), 0)

    x = np.maximum(_times(inverse, demand), 0)
    uses, patterns, left = [], [], demand.astype(np.int64).copy()
    for k in np.argsort(-x):
        pattern = columns[:, k].round().astype(np.int64)
        on = pattern > 0
        n = int(min(np.floor(x[k] + 1e-6), (left[on] // pattern[on]).min()))
        if n > 0:
            uses.append(n)
            patterns.append({int(sizes[i]): int(pattern[i]) for i in np.flatnonzero(on)})
            left -= n * pattern
    _first_fit(sizes, left, classes, uses, patterns)
    return Plan(uses, patterns)


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """A product that starts no threads: the driver's are Spark's."""
    return (matrix * vector).sum(axis=1)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination with row pivoting (at most ``CLASSES`` rows)."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for i in range(n):
        k = i + int(np.argmax(np.abs(both[i:, i])))
        if k != i:
            both[[i, k]] = both[[k, i]]
        both[i] /= both[i, i]
        rows = np.flatnonzero(both[:, i])
        rows = rows[rows != i]
        both[rows] -= np.outer(both[rows, i], both[i])
    return both[:, n:].copy()


def _greedy_basis(sizes, demand, classes) -> np.ndarray:
    """Patterns filled with the largest classes left, each used until a class runs out."""
    left, columns = demand.copy(), np.zeros((len(sizes), len(sizes)))
    for _ in range(len(sizes)):
        room, pattern = classes, np.zeros(len(sizes))
        for i in range(len(sizes) - 1, -1, -1):
            if left[i] > 0 and sizes[i] <= room:
                pattern[i] = max(1, min(np.ceil(left[i]), room // sizes[i]))
                room -= pattern[i] * sizes[i]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(pattern > 0, left / pattern, np.inf)
        out = int(np.argmin(ratio))
        left = np.maximum(left - ratio[out] * pattern, 0)
        left[out] = 0
        columns[:, out] = pattern
        for i in np.flatnonzero((left <= 1e-9) & (columns.sum(axis=0) == 0)):  # ran out together
            columns[i, i], left[i] = classes // sizes[i], 0
        if not (left > 0).any():
            break
    return columns


def _first_fit(sizes, left, classes, uses, patterns) -> None:
    """Fill sequences with what rounding left, the largest fitting class first."""
    left = left.copy()
    while left.sum() > 0:
        room, pattern = classes, {}
        for i in range(len(sizes) - 1, -1, -1):
            a = int(min(left[i], room // sizes[i]))
            if a:
                pattern[int(sizes[i])] = a
                room -= a * int(sizes[i])
        n = min(int(left[np.searchsorted(sizes, c)]) // a for c, a in pattern.items())
        uses.append(n)
        patterns.append(pattern)
        for c, a in pattern.items():
            left[np.searchsorted(sizes, c)] -= n * a


def assign(pieces: DataFrame, capacity: int = CAPACITY, classes: int = CLASSES, most_waste: float | None = None
           ) -> DataFrame | None:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` ids.

    None if the plan pads more than ``most_waste`` of the ids (beyond one sequence).
    """
    spark = pieces.sparkSession
    unit = capacity // classes
    spread = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = (pieces.withColumn("_class", F.ceil(F.col("length") / unit).cast("int"))
            # a class may hold a third of all pieces: its ranks are counted in salted parts
            .withColumn("_part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(spread)).cast("int")))
    counts = stage(rows.groupBy("_class", "_part").agg(F.count(F.lit(1)).alias("_n"), F.sum("length").alias("_ids")),
                   "pack-counts")
    lengths = counts.groupBy("_class").agg(F.sum("_n").alias("n"), F.sum("_ids").alias("ids")).collect()
    plan = solve({r["_class"]: r["n"] for r in lengths}, classes)
    ids = sum(r["ids"] for r in lengths)
    if most_waste is not None and sum(plan.uses) > -(-ids // capacity) * (1 + most_waste) + 1:
        return None
    slots = plan.slots()
    before = Window.partitionBy("_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_class", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    order = Window.partitionBy("_class", "_part").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    ranked = (rows.withColumn("_local", F.row_number().over(order) - 1)
              .join(offsets, ["_class", "_part"])
              .withColumn("_rank", (F.col("_local") + F.col("_before")).cast("long")))

    def deal(batches):
        for batch in batches:
            cls, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("_class", "_rank"))
            sequence, slot = np.empty(len(cls), np.int64), np.empty(len(cls), np.int64)
            for c in np.unique(cls):
                on = cls == c
                runs, r = slots[int(c)], rank[on]
                k = np.searchsorted(runs[:, 0], r, side="right") - 1
                first, each, base, at = runs[k].T
                sequence[on] = base + (r - first) // each
                slot[on] = at + (r - first) % each
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(slot)],
                names=[*batch.schema.names[:5], "sequence_id", "_slot"])

    names = _PIECES.names
    dealt = map_arrow(ranked.select(*names, "_class", "_rank"), deal,
                      ", ".join(f"{c} long" for c in [*names, "sequence_id", "_slot"]))
    earlier = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.select(*names, "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))


def op7_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, most_waste: float = 0.02) -> DataFrame:
    """Pieces of every document with their place in the packed sequences.

    Lengths that fit badly together (say, all of 3000 ids) are cut into shorter pieces:
    the first cut whose plan pads at most ``most_waste`` is taken.
    """
    for longest in (capacity, capacity // 4):
        packed = assign(stage(cut_pieces(docs, tokenizer, longest), "pack-pieces"), capacity, most_waste=most_waste)
        if packed is not None:
            return packed
    return assign(stage(cut_pieces(docs, tokenizer, capacity // 16), "pack-pieces"), capacity)
