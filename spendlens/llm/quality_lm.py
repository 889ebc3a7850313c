"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

Symbols are the UTF-8 bytes of a text (white space as a space, digits as ``0``), n-grams
have four of them. The model's counts come from all trusted text (rows whose doc_id is
labelled so); continuation counts and discounts of the lower orders follow from them.

All documents' distinct n-grams are counted across the corpus and joined, sharded by key,
with the count tables of every order; that gives each n-gram of the corpus its
interpolated probability once. The ``HEAD`` most frequent n-grams (a table of proven size)
go to every task, which sums them where the text is; each text's other n-grams are counted
and joined, sharded by key, with the probabilities, and their sums return to the text.

A document is rejected if its perplexity lies above a quantile of the trusted documents of
its language, times a margin. Short texts are drawn towards their language's mean, since a
few words say little.

Defined results: a null or empty text has no perplexity and is not kept; a null language,
or one without trusted documents, takes the threshold over all of them; without any
trusted document nothing is rejected for its perplexity; repeated rows are judged each.
Labels other than quality 1 (and toxic 1) are not trusted. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text_arrays as ta
from .shared import map_arrow, stage, text_parts

ORDER = 4
HEAD_BITS = 20  # the head table has at most 2**HEAD_BITS n-grams
_U = np.uint64

_SYMBOL = np.arange(256, dtype=np.uint32)
_SYMBOL[ta.SPACE] = 0x20
_SYMBOL[0x30:0x3A] = 0x30


def ngrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte; a text begins after spaces."""
    n, texts = len(data), len(offsets) - 1
    pad = ORDER - 1
    wide = np.full(n + pad * texts, 0x20, np.uint32)
    at = np.arange(n) + pad * np.repeat(np.arange(1, texts + 1), np.diff(offsets))
    wide[at] = _SYMBOL[data]
    out = np.zeros(n, np.uint32)
    for k in range(ORDER):
        out |= wide[at - k] << np.uint32(8 * k)
    return out


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - bits)


def ngram_counts(docs: DataFrame) -> DataFrame:
    """``g, c``: how often each n-gram occurs in all texts."""
    def run(batches):
        keys, counts = [], []

        def merged():
            k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            c = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
            return k, c

        for batch in batches:
            for _, _, data, offsets in text_parts(batch, "text"):
                k, c = np.unique(ngrams(data, offsets), return_counts=True)
                keys.append(k)
                counts.append(c)
                if sum(map(len, keys)) > 2_000_000:
                    k, c = merged()
                    keys, counts = [k], [c]
                    if len(k) > 1_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(c)], names=["g", "c"])
                        keys, counts = [], []
        if keys:
            k, c = merged()
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(c)], names=["g", "c"])

    return map_arrow(docs.select(F.col("text").cast("string").alias("text")), run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def _low(symbols: int) -> Column:
    """The last symbols of an n-gram."""
    return F.col("g").bitwiseAND(F.lit((1 << 8 * symbols) - 1))


class KneserNey:
    """Count tables of every order: ``g, c``, and per context ``h`` its sums."""

    def __init__(self, counts: DataFrame):
        tables = {ORDER: stage(counts, "kn-counts")}
        for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct symbols before
            tables[k] = stage(tables[k + 1].groupBy(_low(k).alias("g")).agg(F.count(F.lit(1)).alias("c")), "kn-counts")
        self.tables, self.contexts = tables, {}
        self.discounts = {}
        for k, t in tables.items():
            n = {r["c"]: r["n"] for r in t.where("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
            self.discounts[k] = d = modified_discounts([n.get(i, 0) for i in range(1, 5)])
            self.contexts[k] = t.groupBy(F.shiftright("g", 8).alias("h")).agg(
                F.sum("c").alias("total"),
                F.sum(F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])).alias("taken"))

    def probabilities(self, grams: DataFrame) -> DataFrame:
        """``grams`` (with g) and the log probability ``lp`` of its last symbol after the others."""
        p = F.lit(1 / 256)
        for k in range(1, ORDER + 1):
            d = self.discounts[k]
            own = self.tables[k].select(F.col("g").alias("_g"), F.col("c").alias("_c"))
            context = self.contexts[k].withColumnRenamed("h", "_h")
            if k <= 2:  # at most 256**2 rows
                own, context = F.broadcast(own), F.broadcast(context)
            c = F.coalesce("_c", F.lit(0))
            less = F.when(c == 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])
            grams = (grams.withColumn("_g", _low(k)).join(own, "_g", "left")
                     .withColumn("_h", F.shiftright("_g", 8)).join(context, "_h", "left")
                     .withColumn("p", F.when(F.col("total").isNull(), p).otherwise((c - less + F.col("taken") * p) / F.col("total")))
                     .drop("_g", "_h", "_c", "total", "taken"))
            p = F.col("p")
        return grams.withColumn("lp", F.log("p")).drop("p")


def modified_discounts(n: list[int]) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more from the numbers of n-grams seen 1 to 4 times."""
    if not n[0] or not n[1]:
        return [0.5, 0.75, 0.75]  # too little text for the estimates
    y = n[0] / (n[0] + 2 * n[1])
    d = [i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0.75 for i in range(3)]
    return [float(min(max(x, 0.05), i + 0.95)) for i, x in enumerate(d)]


def log_probabilities(docs: DataFrame, model: KneserNey, bits: int = HEAD_BITS) -> DataFrame:
    """``doc_id, text_hash, n_symbols, log_prob`` of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    known = stage(model.probabilities(ngram_counts(docs)), "kn-known")
    head = known.orderBy(F.desc("c"), "g").limit(1 << bits - 1).select("g", "lp").toArrow()
    slot_key, slot_lp = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
    keys = head["g"].to_numpy()[::-1]  # the most frequent of a slot stays
    slot_key[_slot(keys, bits)], slot_lp[_slot(keys, bits)] = keys, head["lp"].to_numpy()[::-1]
    shared = spark.sparkContext.broadcast((slot_key, slot_lp))
    names = ["doc_id", "th", "g", "n", "lp", "tail"]

    def run(batches):
        slot_key, slot_lp = shared.value
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            for i, j, data, offsets in text_parts(batch, "text"):
                g = ngrams(data, offsets)
                slot = _slot(g, bits)
                hit = slot_key[slot] == g
                sums = np.zeros(len(g) + 1)
                np.cumsum(np.where(hit, slot_lp[slot], 0.0), out=sums[1:])
                text = np.repeat(np.arange(j - i, dtype=np.uint64), np.diff(offsets))[~hit]
                pair, n = np.unique(text << _U(32) | g[~hit].astype(_U), return_counts=True)
                of = (pair >> _U(32)).astype(np.int64)
                th = hashes.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), th, pa.nulls(j - i, pa.int64()), pa.array(np.diff(offsets).astype(np.int64)),
                     pa.array(sums[offsets[1:]] - sums[offsets[:-1]]), pa.array(np.bincount(of, n, j - i).astype(np.int64))], names=names)
                if len(of):
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(of), pa.int64()), th.take(pa.array(of)), pa.array((pair & _U(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64)),
                         pa.nulls(len(of), pa.float64()), pa.nulls(len(of), pa.int64())], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    scored = stage(map_arrow(rows, run, "doc_id long, th long, g long, n long, lp double, tail long"), "kn-scored")
    # equal texts send their tails several times: their share is the tail's length in all sent
    tails = (scored.where("g IS NOT NULL").select("th", "g", "n").join(known.select("g", F.col("lp").alias("p")), "g")
             .groupBy("th").agg(F.sum(F.col("n") * F.col("p")).alias("sent_lp"), F.sum("n").alias("sent")))
    return (scored.where("g IS NULL").drop("g").join(tails, "th", "left")
            .select("doc_id", F.col("th").alias("text_hash"), F.col("n").alias("n_symbols"),
                    (F.col("lp") + F.coalesce(F.col("sent_lp") * F.col("tail") / F.col("sent"), F.lit(0.0))).alias("log_prob")))


def _may_be_in(docs: DataFrame, ids: DataFrame, bits: int = 25) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``ids``, and some others: a bitmap of ``2**bits``
    hashes, a few MB at any size, keeps most other texts out of the shuffle of an exact join."""
    h = 1 + F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << bits))
    maps = (ids.select(h.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("_bits")))
    at = F.bitmap_bit_position(h).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", 1 + F.floor(at / 8).cast("int"), 1)), 16, 10).cast("int")
    marked = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0
    return docs.withColumn("_bucket", F.bitmap_bucket_number(h)).join(F.broadcast(maps), "_bucket").where(marked).select(docs.columns)


def _quantiles(scores: DataFrame, quantile: float) -> DataFrame:
    """``lang, limit``: the quantile of ``x`` per language, from counts of 1/500 steps."""
    steps = scores.groupBy("lang", F.floor(F.col("x") * 500).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    below = Window.partitionBy("lang").orderBy("step")
    return (steps.withColumn("below", F.sum("n").over(below)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
            .where(F.col("below") >= quantile * F.col("all"))
            .groupBy("lang").agg(((F.min("step") + 1) / 500).alias("limit")))


def op9_quality(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, margin: float = 0.1, prior: int = 200) -> DataFrame:
    """``doc_id, n_symbols, perplexity, limit, drawn_perplexity, kept, text_hash`` of every
    document (perplexity per byte; drawn: towards the language's mean).

    The model is fitted on, and quantiles are taken over, all trusted documents. ``margin``
    is added to a limit's logarithm; ``prior`` symbols at the language's mean are added to
    every text before it is compared.
    """
    trusted = (labels.where("doc_id IS NOT NULL AND quality = 1 AND coalesce(toxic, 0) = 0")
               .select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    trusted = stage(trusted, "kn-trusted")
    # ids are distinct; a semi join would be pushed below the bitmap, and a broadcast has no bound
    text = _may_be_in(docs.select("doc_id", "text"), trusted).join(trusted.hint("shuffle_hash"), "doc_id")
    scores = log_probabilities(docs, KneserNey(ngram_counts(text)))
    langs = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("lang").alias("lang"))
    scores = scores.join(langs, "doc_id", "left").withColumn("lang", F.concat(F.lit("="), F.col("lang").cast("string")))
    scores = stage(scores, "kn-scores")

    good = scores.where("n_symbols > 0").join(trusted, "doc_id", "left_semi")
    good = good.where("lang IS NOT NULL").unionByName(good.withColumn("lang", F.lit("*"))).select("lang", "n_symbols", "log_prob")
    means = good.groupBy("lang").agg((-F.sum("log_prob") / F.sum("n_symbols")).alias("mean"))
    drawn = (-F.col("log_prob") + prior * F.col("mean")) / (F.col("n_symbols") + prior)
    limits = means.join(_quantiles(good.join(F.broadcast(means), "lang").withColumn("x", drawn), quantile), "lang")
    limits = stage(limits.withColumn("limit", F.col("limit") + margin), "kn-limits")
    anyone = limits.where("lang = '*'")
    judged = (scores.join(limits, "lang", "left")
              .withColumn("mean", F.coalesce("mean", anyone.select("mean").scalar()))
              .withColumn("limit", F.coalesce("limit", anyone.select("limit").scalar())))
    return judged.select(
        "doc_id", "n_symbols", F.when(F.col("n_symbols") > 0, F.exp(-F.col("log_prob") / F.col("n_symbols"))).alias("perplexity"),
        F.exp("limit").alias("limit"), F.exp(drawn).alias("drawn_perplexity"),
        (F.col("n_symbols") > 0).__and__(F.coalesce(drawn <= F.col("limit"), F.lit(True))).alias("kept"), "text_hash")
