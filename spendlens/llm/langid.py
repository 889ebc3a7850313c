"""Language ID: averaged hashed subword embeddings, linear softmax, calibrated rejection.

A text's subwords are the 3- and 4-byte grams of its words (lower-cased A-Z, letters only,
with word ends). Each gram is hashed to a bucket with an embedding; the mean embedding goes
through a linear softmax. Embeddings and weights are trained by stochastic gradient descent
in numpy on a bounded, stratified sample of labelled rows; part of it sets a temperature
and the confidence under which a prediction is rejected. For prediction, embedding and
weights are multiplied out once (the mean of a linear map is the linear map of the mean),
so a text costs one table look-up per gram and language.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and
rejected; a text whose letters give no gram gets the most frequent language's bias;
without any labelled row every document is ``und``. Rows with a null label, text or
doc_id are not learned from; of rows that repeat an id and label one is learned from, and
each is judged. The pipeline's stage (``known_language``) judges alike, but without any
labelled row it keeps every text with a letter. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text_arrays as ta
from .shared import arrow_rows, labelled_bucket, map_arrow, text_parts

BUCKETS = 1 << 16
UNKNOWN = "und"

#: Letters stay (A-Z lower-cased, bytes of other letters as they are), the rest parts words.
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def grams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(position, bucket)`` of every subword, for each gram size.

    Positions index the byte buffer. A gram lies in one text; white space may only be its
    first or last byte, where it marks a word's end.
    """
    b = _LETTERS[data].astype(np.uint32)
    space = b == 0x20
    inside = np.ones(len(b), bool)  # whether the next byte belongs to the same text
    cuts = offsets[1:-1]
    inside[cuts[cuts > 0] - 1] = False
    out = []
    for size in (3, 4):
        n = len(b) - size + 1
        if n <= 0:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        ok = ~(space[:n] & space[size - 1:])
        key = np.full(n, size, np.uint32)
        for k in range(size):
            key = key * np.uint32(257) + b[k:k + n]
            if 0 < k < size - 1:
                ok &= ~space[k:k + n]
            if k < size - 1:
                ok &= inside[k:k + n]
        at = np.flatnonzero(ok)
        out.append((at, (key[at] * np.uint32(2654435761) >> np.uint32(16)).astype(np.int64)))
    return out


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter (of any script)."""
    ascii_letter = np.zeros(len(data) + 1, np.int64)
    np.cumsum((_LETTERS[data] != 0x20) & (data < 0x80), out=ascii_letter[1:])
    high = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data >= 0x80, out=high[1:])
    found = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for i in np.flatnonzero(~found & (high[offsets[1:]] > high[offsets[:-1]])):
        text = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(map(str.isalpha, text))
    return found


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (languages, BUCKETS): a gram's share of the logits
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0  # predictions under this score are rejected

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        total, count = np.zeros((n, len(self.languages))), np.zeros(n)
        for at, bucket in grams(data, offsets):
            if len(at):
                first = np.searchsorted(at, offsets)
                sums = np.zeros(len(at) + 1)
                count += np.diff(first)
                for k in range(len(self.languages)):
                    np.cumsum(self.table[k][bucket], out=sums[1:])
                    total[:, k] += sums[first[1:]] - sums[first[:-1]]
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = softmax(self.logits(data, offsets) / self.temperature)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


_BAGS = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("lang", pa.string()), ("buckets", pa.binary()), ("counts", pa.binary())])


def _bags(batches):
    """Gram counts of each training text, at most BUCKETS numbers a text."""
    for batch in batches:
        ids, h, lang = batch.column(0), batch.column(1), batch.column(2)
        for i, j, data, offsets in text_parts(batch, "text"):
            keys, counts = [], []
            parts = grams(data, offsets)
            for k in range(j - i):
                both = np.concatenate([b[np.searchsorted(at, offsets[k]):np.searchsorted(at, offsets[k + 1])] for at, b in parts])
                u, c = np.unique(both, return_counts=True)
                keys.append(u.astype("<u2").tobytes())
                counts.append(c.astype("<u4").tobytes())
            yield arrow_rows(_BAGS, doc_id=ids.slice(i, j - i), h=h.slice(i, j - i), lang=lang.slice(i, j - i), buckets=keys, counts=counts)


def train(docs: DataFrame, per_language: int = 1_000, most_rows: int = 20_000, most_labels: int = 256, dimension: int = 16,
          epochs: int = 6, rate: float = 0.3, error: float = 0.01, seed: int = 7) -> Model | None:
    """Fit on about ``per_language`` rows of each label (``most_rows`` in all), one of each doc_id and label.

    Of the labels the ``most_labels`` with most rows in the sample are learned, which bounds
    the model (``BUCKETS`` numbers a label) where dirty labels abound.

    A label's rows are dealt into 16 parts by hash and each part gives its smallest ones, so
    a label that most rows carry is not ranked in one task.

    ``docs`` holds text and lang of the rows that may be learned from.
    """
    h = labelled_bucket(F.col("doc_id"), "lang")
    ranks = Window.partitionBy("lang", "part").orderBy("h", "doc_id")
    chosen = (docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
              .select(h.alias("h"), "doc_id", F.col("lang").cast("string").alias("lang"))
              .withColumn("part", F.pmod(F.xxhash64("h"), F.lit(16)))
              .withColumn("r", F.row_number().over(ranks)).where(F.col("r") <= -(-per_language // 16))
              .orderBy("r", "lang", "h", "doc_id").limit(most_rows).select("doc_id", "lang").distinct())
    sample = (docs.where("lang IS NOT NULL AND text IS NOT NULL")
              .select("doc_id", h.alias("h"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
              .join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select(F.col("doc_id").cast("long").alias("doc_id"), "h", "lang", "text"))
    # of rows that repeat an id and label one bag leaves each task, and one stays
    rows = (map_arrow(sample, _bags, "doc_id long, h long, lang string, buckets binary, counts binary")
            .groupBy("doc_id", "h", "lang").agg(F.min(F.struct("buckets", "counts")).alias("bag")).select("h", "lang", "bag.*").collect())
    rows = sorted((r["h"], r["lang"], bytes(r["buckets"]), bytes(r["counts"])) for r in rows)[:most_rows]
    often = Counter(r[1] for r in rows if r[2])
    learned = set(sorted(often, key=lambda k: (-often[k], k))[:most_labels])
    bags = [(np.frombuffer(b, "<u2"), np.frombuffer(c, "<u4"), lang) for _, lang, b, c in rows if b and lang in learned]
    return fit(bags, dimension, epochs, rate, error, seed) if bags else None


def fit(bags, dimension, epochs, rate, error, seed) -> Model:
    """Stochastic gradient descent with per-coordinate steps; a fifth of the bags calibrates.

    Each bag is seen whole and as a random draw of a few grams, so short texts are learned.
    """
    rng = np.random.default_rng(seed)
    languages = sorted({b[2] for b in bags})
    number = {k: i for i, k in enumerate(languages)}
    y = np.array([number[b[2]] for b in bags])
    fifth = rng.permutation(len(bags)) % 5 == 0 if len(bags) >= 50 else np.zeros(len(bags), bool)
    embed = rng.uniform(-1, 1, (BUCKETS, dimension)) / dimension
    weight, bias = np.zeros((len(languages), dimension)), np.zeros(len(languages))
    seen_e, seen_w, seen_b = np.full((BUCKETS, dimension), 1e-8), np.full(weight.shape, 1e-8), np.full(len(languages), 1e-8)

    def short(keys, counts):
        size = int(rng.integers(8, 80))
        return np.unique(rng.choice(keys, size, p=counts / counts.sum()), return_counts=True)

    weight += rng.normal(0, 0.1, weight.shape)
    for _ in range(epochs):
        for i in rng.permutation(np.flatnonzero(~fifth)):
            for keys, counts in (bags[i][:2], short(*bags[i][:2])):
                w = (counts / counts.sum())[:, None]
                rows = embed[keys]
                hidden = (rows * w).sum(axis=0)
                g = (weight * hidden).sum(axis=1) + bias
                g = np.exp(g - g.max())
                g /= g.sum()
                g[y[i]] -= 1
                back = (weight * g[:, None]).sum(axis=0)
                step = g[:, None] * hidden
                seen_w += step * step
                weight -= rate * step / np.sqrt(seen_w)
                seen_b += g * g
                bias -= rate * g / np.sqrt(seen_b)
                step = w * back
                seen_e[keys] += step * step
                embed[keys] = rows - rate * 0.3 * step / np.sqrt(seen_e[keys])
    table = np.zeros((len(languages), BUCKETS))
    for k in range(dimension):
        table += weight[:, k:k + 1] * embed[:, k]
    model = Model(languages, table, bias)
    if fifth.any():
        _calibrate(model, [b for b, f in zip(bags, fifth, strict=True) if f], y[fifth], short, error)
    return model


def _calibrate(model: Model, bags, y, short, error: float) -> None:
    """Temperature by likelihood; the least score that keeps accepted errors under ``error``."""
    x, truth = [], []
    for (keys, counts, _), t in zip(bags, y, strict=True):
        for k, c in ((keys, counts), short(keys, counts)):
            x.append((model.table[:, k] * c).sum(axis=1) / c.sum() + model.bias)
            truth.append(t)
    x, truth = np.array(x), np.array(truth)
    at = np.arange(len(truth))
    grid = np.geomspace(0.5, 5, 60)
    model.temperature = float(min(grid, key=lambda t: -np.log(np.maximum(softmax(x / t)[at, truth], 1e-12)).mean()))
    p = softmax(x / model.temperature)
    score, wrong = p.max(axis=1), p.argmax(axis=1) != truth
    order = np.argsort(-score)
    share = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share <= error)
    # every calibration row may be accepted: only guesses below all of them are rejected
    model.least = 1.0 if not len(good) else float(score[order][good[-1]]) if good[-1] + 1 < len(order) else 0.5 * float(score.min())


def op5_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every document, from its text alone."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers a language

    def judge(batches):
        model = shared.value
        for batch in batches:
            for i, j, data, offsets in text_parts(batch, "text"):
                known = has_letter(data, offsets) if model else np.zeros(j - i, bool)
                best, score = model.predict(data, offsets) if model else (np.zeros(j - i, int), np.zeros(j - i))
                score = np.where(known, score, 0.0)
                lang = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                yield arrow_rows(schema, doc_id=batch.column(0).slice(i, j - i), lang_pred=lang, score=score,
                                 rejected=~known | (score < (model.least if model else 1)))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, judge, "doc_id long, lang_pred string, score double, rejected boolean")


def known_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, whole, whose language is not rejected; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        model = shared.value
        for batch in batches:
            for i, j, data, offsets in text_parts(batch, "text"):
                known = has_letter(data, offsets)
                if model:
                    known &= model.predict(data, offsets)[1] >= model.least
                yield batch.slice(i, j - i).filter(pa.array(known))

    return map_arrow(docs, keep, docs.schema)


def language_of(docs: DataFrame, **options) -> DataFrame:
    """Train on the rows that are not held out and judge every row."""
    may = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    out = op5_language(docs, train(may.select("doc_id", "text", "lang"), **options))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
