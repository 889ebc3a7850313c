"""Line dedup with a log-template tree.

A line's place in the tree is its token count, its two leading tokens and the rest of its
tokens in four quarters. Tokens with a digit or ``@`` are variable fields everywhere
(``<*>``), and in lines of six tokens or more one whole quarter may be a variable field
too, so a line has up to five templates: itself and itself with one quarter open. A
template has at least ``LEAST_CONSTANT`` constant tokens; a line with fewer (a table row of
numbers) is its own template, word for word. A template that occurs in two different texts
is recurring, and lines of recurring templates are dropped from all documents.

Documents that consist mostly of such lines (more than ``MOST_SHARE`` of their tokens) are
copies of each other, or hold little else: among those that carry a template the first (of
least doc_id) keeps its lines, the others lose them. So a recurring line stays nowhere, or
in one document that it makes up, and near copies do not delete each other. Texts that are
equal count as one. With groups of texts (the pipeline's near-duplicate classes) a group
counts as one in the same way, for recurrence and as the first carrier.

A token is a run of non-spaces; in scripts written without spaces (Han, kana, Thai, Lao,
Khmer, Myanmar) it is one code point, so that such lines have templates too.

Templates are 64-bit keys. A key's least and largest text, pre-aggregated in each task, tell
whether it recurs; the lines of recurring keys are then picked by a join that splits hot
keys. No task holds the rows of a template.

Defined results: a null text stays null; lines of fewer than ``LEAST_TOKENS`` tokens are
never dropped; a null doc_id comes after all others as a carrier; among carriers of one
doc_id the one of least text hash is first; repeated rows are cleaned alike; all columns,
whatever their names, come back as they are but for the text (a count whose name is taken
gets ``_`` appended); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_arrays as ta
from .shared import free_name, map_arrow, quoted, stage, text_parts, unstage

LEADING, QUARTERS, LEAST_TOKENS, LEAST_OPEN, LEAST_CONSTANT = 2, 4, 3, 6, 2
#: Of documents with a larger share of their tokens in recurring lines, one carrier keeps a line.
MOST_SHARE = 0.5
#: Code points that are tokens of their own: scripts written without spaces (fixed Unicode blocks).
SINGLE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
          (0xF900, 0xFAFF), (0x20000, 0x3FFFF))

_U = np.uint64
_FIELD = np.zeros(256, bool)
_FIELD[[*range(0x30, 0x3A), ord("@")]] = True
_VARIABLE = _U(0x632BE59BD9B4E019)


def token_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, text index)`` of every token."""
    starts, ends, text = ta.word_spans(data, offsets)
    lead = np.flatnonzero(data >= 0xE0)  # of code points of three bytes or four
    if not len(lead):
        return starts, ends, text
    b = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) for k in range(4)]
    three = ((b[0] & 0x0F) << 12) | ((b[1] & 0x3F) << 6) | (b[2] & 0x3F)
    four = ((b[0] & 0x07) << 18) | ((b[1] & 0x3F) << 12) | ((b[2] & 0x3F) << 6) | (b[3] & 0x3F)
    code = np.where(b[0] >= 0xF0, four, three)
    own = np.zeros(len(code), bool)
    for low, high in SINGLE:
        own |= (code >= low) & (code <= high)
    single = lead[own]
    if not len(single):
        return starts, ends, text
    after = single + np.where(data[single] >= 0xF0, 4, 3)
    after = after[after < ends[np.searchsorted(starts, single, side="right") - 1]]
    cut = np.unique(np.concatenate([starts, single, after]))
    word = np.searchsorted(starts, cut, side="right") - 1
    return cut, np.minimum(np.append(cut[1:], len(data)), ends[word]), text[word]


def line_templates(data: np.ndarray, offsets: np.ndarray):
    """``(text index, line number, tokens, keys, use)`` of the lines that have templates.

    keys: (lines, 1 + QUARTERS) template keys, of which ``use`` says which there are.
    """
    starts, ends, text = token_spans(data, offsets)
    exact = ta.range_hashes(data, starts, ends)
    fields = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_FIELD[data], out=fields[1:])
    variable = fields[ends] > fields[starts]
    token = np.where(variable, _VARIABLE, exact)
    ls, le, lt = ta.line_spans(data, offsets)
    number = np.arange(len(ls)) - np.searchsorted(lt, lt)
    first, last = np.searchsorted(starts, ls), np.searchsorted(starts, le)
    on = last - first >= LEAST_TOKENS
    first, last, lt, number = first[on], last[on], lt[on], number[on]
    n = last - first
    place = np.zeros(len(token), np.int64)
    at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum())) if len(n) else np.zeros(0, np.int64)
    place[at] = at - np.repeat(first, n)
    placed = place.astype(_U) * _U(0x9E6C63D0876A9A47)

    def running(values, kind):
        out = np.zeros(len(values) + 1, kind)
        np.cumsum(values, out=out[1:])
        return out

    sums, words, constant = running(ta.mix(token + placed), _U), running(ta.mix(exact + placed), _U), running(~variable, np.int64)
    lead = sums[first + LEADING] - sums[first]
    rest = n - LEADING
    cuts = [first + LEADING + rest * k // QUARTERS for k in range(QUARTERS + 1)]
    parts = [sums[b] - sums[a] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    keys, use = np.empty((len(n), 1 + QUARTERS), _U), np.ones((len(n), 1 + QUARTERS), bool)
    held = constant[last] - constant[first]
    for opened in range(-1, QUARTERS):
        h = ta.mix(n.astype(_U) * _U(0x8CB92BA72F3D8DD7) + lead)
        for k, p in enumerate(parts):
            h = ta.mix(h * _U(31) + (_U(0x3C6EF372) if k == opened else ta.mix(p)))
        keys[:, opened + 1] = h
        if opened >= 0:
            outside = held - (constant[cuts[opened + 1]] - constant[cuts[opened]])
            use[:, opened + 1] = (n >= LEAST_OPEN) & (outside >= LEAST_CONSTANT)
    few = held < LEAST_CONSTANT
    keys[few, 0] = ta.mix((words[last] - words[first])[few] + n[few].astype(_U) * _U(0xD6E8FEB86659FD93))
    return lt, number, n, keys, use


_ROWS = "key long, text_hash long, line int, tokens int, total int"


def _template_rows(batches):
    names = ["key", "text_hash", "line", "tokens", "total"]
    for batch in batches:
        hashes = batch.column(0).to_numpy()
        for i, j, data, offsets in text_parts(batch, "text"):
            lt, number, n, keys, use = line_templates(data, offsets)
            own = hashes[i:j]
            fresh = ~ta.seen_before(own)  # equal texts of one slice count once anyway
            _, _, text = token_spans(data, offsets)
            total = ta.counts_by(text, j - i)
            use &= fresh[lt][:, None]
            line, which = np.nonzero(use)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[line, which].view(np.int64)), pa.array(own[lt[line]]), pa.array(number[line].astype(np.int32)),
                 pa.array(n[line].astype(np.int32)), pa.array(total[lt[line]].astype(np.int32))], names=names)


def _recurring(rows: DataFrame, of: str) -> DataFrame:
    """The keys that occur with two values of ``of``."""
    return rows.groupBy("key").agg(F.min(of).alias("low"), F.max(of).alias("high")).where("low <> high").select("key")


def _hits(docs: DataFrame) -> DataFrame:
    """``key, text_hash, line, tokens, total`` of the templates that occur in two texts."""
    rows = map_arrow(docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text")),
                     _template_rows, _ROWS)
    return rows.join(stage(_recurring(rows, "text_hash"), "recurring").hint("merge"), "key")


def recurring_lines(docs: DataFrame, most_share: float = MOST_SHARE, groups: DataFrame | None = None) -> DataFrame:
    """``text_hash, lines``: the line numbers to drop from each text.

    ``groups`` (``text_hash, group``) counts the texts of a group as one.
    """
    least = docs.where("text IS NOT NULL").groupBy(F.xxhash64("text").alias("text_hash")).agg(F.min(F.col("doc_id").cast("long")).alias("least"))
    # a carrier's rank: its least doc_id, null ids last, then its text or group
    rank = F.struct(F.col("least").isNull().alias("unknown"), F.coalesce("least", F.lit(0)).alias("least"), F.col("group").alias("group"))
    if groups is None:
        carriers = least.select("text_hash", F.col("text_hash").alias("group"), "least")
    else:
        one = groups.groupBy("text_hash").agg(F.min("group").alias("group"))
        known = least.join(one, "text_hash", "left").select("text_hash", F.coalesce("group", "text_hash").alias("group"), "least")
        first = known.groupBy("group").agg(F.min("least").alias("least"))
        carriers = known.drop("least").join(first, "group").select("text_hash", "group", "least")
    hits = stage(_hits(docs).distinct().join(carriers.select("text_hash", "group", rank.alias("rank")).hint("merge"), "text_hash"), "hits")
    if groups is not None:  # only what recurs in texts can recur in groups
        every, hits = hits, stage(hits.join(_recurring(hits, "group").hint("merge"), "key"), "hits")
        unstage(every)
    over = (hits.select("text_hash", "line", "tokens", "total").distinct().groupBy("text_hash")
            .agg((F.sum("tokens") > most_share * F.max("total")).alias("over")))
    known = hits.join(over.hint("merge"), "text_hash")
    first = known.where("over").groupBy("key").agg(F.min("rank").alias("first"))
    later = known.where("over").join(first.hint("merge"), "key").where("rank > first")
    return (known.where("NOT over").select("text_hash", "line").union(later.select("text_hash", "line"))
            .groupBy("text_hash").agg(F.collect_set("line").alias("lines")))


def op6_line_dedup(docs: DataFrame, most_share: float = MOST_SHARE, groups: DataFrame | None = None) -> DataFrame:
    """``docs`` with recurring lines dropped from ``text``, and ``n_lines``, ``n_dropped``."""
    drop = stage(recurring_lines(docs, most_share, groups), "lines")
    # the lists grow with the corpus: a merge join at every size, never a broadcast
    rows = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("doc"), F.xxhash64("text").alias("text_hash"))
    out = rows.join(drop.hint("merge"), "text_hash", "left")
    text = F.col("doc.text")
    parts = F.split(text, "\n", -1)
    keep = F.filter(parts, lambda x, i: ~F.array_contains("lines", i))
    clean = F.when(F.col("lines").isNull(), text).otherwise(F.array_join(keep, "\n"))
    counts = {"n_lines": F.when(text.isNotNull(), F.size(parts)).otherwise(0), "n_dropped": F.coalesce(F.size("lines"), F.lit(0))}
    return out.select(*[clean.alias(c) if c == "text" else F.col(f"doc.{quoted(c)}").alias(c) for c in docs.columns],
                      *[c.cast("long").alias(free_name(docs, n)) for n, c in counts.items()])
