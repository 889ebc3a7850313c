"""Exact top-k search with multi-resolution segment statistics.

Vectors are cut into segments; a segment's mean and deviation bound its share of the
distance of two vectors from below (and so their inner product from above):
``<q, x> <= sum over segments of length * (mean_q * mean_x + dev_q * dev_x)``. Few long
segments give a coarse bound for all pairs, more segments a finer one for the survivors,
and what still reaches the query's k-th best score is scored exactly in integers.

Queries are dealt into blocks of at most about ``QUERY_BLOCK`` and every block meets all
vectors, which stream past it in small batches; blocks are spread over ``salt`` parts of
the vectors, so no task holds all vectors, and a part returns k rows a query.

Defined results: a vector that is null, empty or holds a null or non-finite component, or
whose id is null, takes no part; vectors of another length than the query's are no
candidates of it; ties go to the smaller id; query rows that share an id are one query
(the smallest by its bytes), and no row of the query's own id is its candidate; a repeated
other row is a candidate each time. Extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import map_arrow, stage

QUERY_BLOCK = 4096
LEVELS = (4, 16)  # segments, coarse to fine
_CANDIDATES, _PAIRS = 1024, 100_000


def quantise(rows: DataFrame, scale: float = 256.0) -> DataFrame:
    """``id, vec``: floor(scale * component) as little-endian 64-bit integers; bad rows go."""
    def run(batches):
        for batch in batches:
            vec, ids = batch.column(1), batch.column(0)
            if isinstance(vec, pa.ChunkedArray):
                vec = vec.combine_chunks()
            flat = np.asarray(vec.flatten().to_numpy(zero_copy_only=False), float)  # null: nan
            sizes = np.asarray(vec.value_lengths().fill_null(0))
            ends = np.cumsum(sizes)
            bad = np.zeros(len(flat) + 1, np.int64)
            np.cumsum(~np.isfinite(flat), out=bad[1:])
            ok = (sizes > 0) & (bad[ends] == bad[ends - sizes]) & np.asarray(ids.is_valid()) & np.asarray(vec.is_valid())
            whole = np.floor(scale * np.where(np.isfinite(flat), flat, 0)).astype("<i8")
            keep = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keep)), pa.array([whole[ends[i] - sizes[i]:ends[i]].tobytes() for i in keep], pa.binary())], names=["id", "vec"])

    return map_arrow(rows, run, "id long, vec binary")


def features(x: np.ndarray, segments: int) -> np.ndarray:
    """Scaled segment means and deviations; their inner product bounds that of the vectors."""
    cuts = np.unique(np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int))
    size = np.diff(cuts)
    sums = np.add.reduceat(x, cuts[:-1], axis=1)
    squares = np.add.reduceat(x * x, cuts[:-1], axis=1)
    # the deviations are raised by what rounding may have taken, so the bound stays one
    spread = np.maximum(squares - sums * sums / size, 0) + 1e-12 * squares
    return np.hstack([sums / np.sqrt(size), np.sqrt(spread)])


class QueryBlock:
    """Queries of one length with their best ``k`` so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [features(vectors.astype(float), s) for s in LEVELS]
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def exact(self, q: np.ndarray, c: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        out = np.empty(len(q), np.int64)
        for i in range(0, len(q), _PAIRS):
            out[i:i + _PAIRS] = np.einsum("ij,ij->i", self.vectors[q[i:i + _PAIRS]], vectors[c[i:i + _PAIRS]])
        return out

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Search a batch of candidates."""
        x = vectors.astype(float)
        levels = [features(x, s) for s in LEVELS]
        bound = self.levels[0] @ levels[0].T
        bound[self.ids[:, None] == ids[None, :]] = -np.inf
        # the k most promising candidates of each query set its first threshold
        k = min(self.k, len(ids))
        first = np.argpartition(-bound, k - 1, axis=1)[:, :k]
        q, c = np.repeat(np.arange(len(self.ids)), k), first.ravel()
        own = np.isfinite(bound[q, c])
        self._merge(q[own], ids[c[own]], self.exact(q[own], c[own], vectors))
        bound[q, c] = -np.inf  # done
        q, c = np.nonzero(bound >= self._least(np.arange(len(self.ids)), bound)[:, None])
        for mine, theirs in zip(self.levels[1:], levels[1:], strict=True):
            keep = np.empty(len(q), bool)
            for i in range(0, len(q), _PAIRS):
                a, b = q[i:i + _PAIRS], c[i:i + _PAIRS]
                finer = np.einsum("ij,ij->i", mine[a], theirs[b])
                keep[i:i + _PAIRS] = finer >= self._least(a, finer)
            q, c = q[keep], c[keep]
        self._merge(q, ids[c], self.exact(q, c, vectors))

    def _least(self, q: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The k-th best scores, less what rounding may take from a bound."""
        t = self.scores[q, -1].astype(float)
        return t - 1e-6 - 1e-9 * np.abs(t)

    def _merge(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        better = (scores > self.scores[q, -1]) | ((scores == self.scores[q, -1]) & (ids < self.found[q, -1]))
        q, ids, scores = q[better], ids[better], scores[better]
        if not len(q):
            return
        touched = np.unique(q)
        q = np.concatenate([q, np.repeat(touched, self.k)])
        ids = np.concatenate([ids, self.found[touched].ravel()])
        scores = np.concatenate([scores, self.scores[touched].ravel()])
        order = np.lexsort((ids, -scores, q))
        order = order[np.argsort(scores[order] == np.iinfo(np.int64).min, kind="stable")]  # unfilled places last
        order = order[np.argsort(q[order], kind="stable")]
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        top = rank < self.k
        self.scores[q[top], rank[top]] = scores[order][top]
        self.found[q[top], rank[top]] = ids[order][top]

    def rows(self) -> pa.RecordBatch:
        q, r = np.nonzero(self.scores > np.iinfo(np.int64).min)
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(self.found[q, r]), pa.array(self.scores[q, r])],
                                          names=["query_id", "vec_id", "score"])


def _search(k: int):
    def run(batches):
        part, waiting, blocks = None, [], {}

        def open_blocks():
            for size in {len(v) for _, v in waiting}:
                own = [(i, v) for i, v in waiting if len(v) == size]
                blocks[size] = QueryBlock(np.array([i for i, _ in own]), _matrix([v for _, v in own]), k)
            waiting.clear()

        for batch in batches:
            qb, salt, query, ids, vec = (c.to_pylist() for c in batch.columns)
            i = 0
            while i < len(ids):
                if (qb[i], salt[i]) != part:
                    yield from (b.rows() for b in blocks.values())
                    part, blocks = (qb[i], salt[i]), {}
                    waiting.clear()  # a part without candidates
                j = i
                while j < len(ids) and (qb[j], salt[j]) == part and query[j] == query[i] and j - i < _CANDIDATES:
                    j += 1
                if query[i]:
                    waiting.extend(zip(ids[i:j], vec[i:j], strict=True))
                else:
                    if waiting:
                        open_blocks()
                    for size, block in blocks.items():
                        own = [x for x in range(i, j) if len(vec[x]) == size]
                        if own:
                            block.offer(np.array([ids[x] for x in own]), _matrix([vec[x] for x in own]))
                i = j
        yield from (b.rows() for b in blocks.values())

    return run


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<i8").reshape(len(vectors), -1)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of every query.

    ``vectors`` has id and vec as ``quantise`` gives them.
    """
    spark = vectors.sparkSession
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    queries = vectors.where(is_query).groupBy("id").agg(F.min("vec").alias("vec"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = (queries.withColumn("qb", F.expr(f"CAST(pmod(xxhash64(id), {blocks}) AS INT)"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
             .select("qb", "salt", F.lit(True).alias("query"), "id", "vec"))
    offered = (vectors.withColumn("salt", F.expr(f"CAST(pmod(xxhash64(id, vec), {salts}) AS INT)"))
               .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
               .select("qb", "salt", F.lit(False).alias("query"), "id", "vec"))
    dealt = asked.unionByName(offered).repartition("qb", "salt").sortWithinPartitions("qb", "salt", F.desc("query"))
    found = map_arrow(dealt, _search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_top_k(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """Rows whose vec_id is divisible by ``every``, searched against all rows."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return top_k(stage(quantise(rows), "vectors"), F.col("id") % every == 0, k)
