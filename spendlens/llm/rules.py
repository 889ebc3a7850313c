"""Quality rules: a learned decision list over text statistics (sequential covering).

``statistics`` gives one row of counts per document. ``learn`` grows and prunes rules
(conjunctions of thresholds on ratios of these counts) for the rejected class, one after
the other, on labelled rows; ``DecisionList.verdict`` is the list as one ordered Spark
CASE expression, so judging a document runs inside the plan.

Defined results: a null text counts as empty; documents whose label is null or neither 0
nor 1 are not learned from; an empty label table, or labels of one class, give an empty
list (everything kept but what fails the base rules); repeated rows are kept as they are.
Extra columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text_arrays as ta
from .shared import arrow_rows, labelled_bucket, map_arrow, text_parts

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_distinct_words", "n_upper", "n_digits", "n_marks")
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

#: Ratios that rules put thresholds on: name -> (numerator, denominator).
FEATURES = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines_per_line": ("n_dup_lines", "n_lines"),
    "repeat_words_per_word": ("n_repeat_words", "n_words"),
    "distinct_words_per_word": ("n_distinct_words", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}


def _byte_table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[list(chars)] = 1
    return t


_SYMBOL, _UPPER = _byte_table(SYMBOLS), _byte_table(bytes(range(65, 91)))
_DIGIT, _MARK = _byte_table(b"0123456789"), _byte_table(b"!?")
_LEAD = np.ones(256, np.int64)
_LEAD[0x80:0xC0] = 0
_LEAD[ta.SPACE] = 0


def _sums(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(table[data], out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def count_texts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``COUNTS`` of the texts ``data[offsets[i]:offsets[i + 1]]`` (UTF-8)."""
    n = len(offsets) - 1
    starts, ends, text = ta.word_spans(data, offsets)
    words = ta.range_hashes(data, starts, ends)
    salt = ta.mix(np.arange(1, n + 1, dtype=np.uint64))
    out = {"n_words": ta.counts_by(text, n)}
    for name, t in (("word_chars", _LEAD), ("n_symbols", _SYMBOL), ("n_upper", _UPPER),
                    ("n_digits", _DIGIT), ("n_marks", _MARK)):
        out[name] = _sums(t, data, offsets)
    own = ta.mix(words ^ salt[text]) if len(words) else words
    out["n_distinct_words"] = ta.counts_by(text[~ta.seen_before(own)], n)

    at, window = ta.windows(words, text, WINDOW)
    again = at[ta.repeated(ta.mix(window ^ salt[text[at]]))] if len(at) else at
    edge = np.bincount(again, minlength=len(words) + 1) - np.bincount(again + WINDOW, minlength=len(words) + 1)[:len(words) + 1]
    covered = np.cumsum(edge)[:len(words)] > 0
    out["n_repeat_words"] = ta.counts_by(text[covered], n)

    ls, le, lt = ta.line_spans(data, offsets)
    worded = np.searchsorted(starts, ls) < np.searchsorted(starts, le)
    ls, le, lt = ls[worded], le[worded], lt[worded]
    out["n_lines"] = ta.counts_by(lt, n)
    lines = ta.mix(ta.range_hashes(data, ls, le) ^ salt[lt]) if len(ls) else np.zeros(0, np.uint64)
    out["n_dup_lines"] = ta.counts_by(lt[ta.seen_before(lines)], n)
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS)])


def _count_batches(batches):
    for batch in batches:
        ids = batch.column(0)
        for i, j, data, offsets in text_parts(batch, "text"):
            yield arrow_rows(_SCHEMA, doc_id=ids.slice(i, j - i), **count_texts(data, offsets))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every row of ``docs`` (doc_id, text); no shuffle."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, _count_batches, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def feature(name: str) -> Column:
    a, b = FEATURES[name]
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        f = feature(self.feature)
        return f > F.lit(self.threshold) if self.above else f <= F.lit(self.threshold)

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; the first whose conditions all hold rejects the document."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def verdict(self) -> Column:
        out = None
        for rule in self.rules:
            when = rule[0].column()
            for c in rule[1:]:
                when = when & c.column()
            out = F.when(when, F.lit(False)) if out is None else out.when(when, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def rule_number(self) -> Column:
        """Which rule decided (from 1), 0 if none."""
        out = F.lit(0)
        for k in range(len(self.rules), 0, -1):
            when = self.rules[k - 1][0].column()
            for c in self.rules[k - 1][1:]:
                when = when & c.column()
            out = F.when(when, F.lit(k)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules)


def _covers(rule, x, n) -> np.ndarray:
    on = np.ones(n, bool)
    for c in rule:
        on &= c.holds(x)
    return on


def _best_condition(x, bad, on, cuts: int) -> Condition | None:
    """The threshold with the largest FOIL gain among quantile cuts of the covered rows."""
    p0, n0 = int((on & bad).sum()), int((on & ~bad).sum())
    base = np.log2(p0 / (p0 + n0))
    best, gain = None, 1e-9
    for name, v in x.items():
        values = np.unique(v[on])
        if len(values) < 2:
            continue
        mids = (values[1:] + values[:-1]) / 2
        if len(mids) > cuts:
            # half of the cuts by rank of values, half by rank of rejected rows' values
            mids = np.unique(np.concatenate([mids[np.linspace(0, len(mids) - 1, cuts // 2).astype(int)],
                                             np.quantile(v[on & bad], np.linspace(0, 1, cuts // 2)) - 1e-9,
                                             np.quantile(v[on & bad], np.linspace(0, 1, cuts // 2)) + 1e-9]))
        pos, neg = np.sort(v[on & bad]), np.sort(v[on & ~bad])
        le_p, le_n = np.searchsorted(pos, mids, side="right"), np.searchsorted(neg, mids, side="right")
        for above in (False, True):
            p = p0 - le_p if above else le_p
            n = n0 - le_n if above else le_n
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(p > 0, p * (np.log2(p / (p + n)) - base), -1.0)
            k = int(np.argmax(g))
            if g[k] > gain:  # cuts that split the rows alike: the middle of the gap
                tied = mids[(p == p[k]) & (n == n[k])]
                best, gain = Condition(name, above, float(tied.min() + tied.max()) / 2), g[k]
    return best


def learn_from(x: dict[str, np.ndarray], bad: np.ndarray, order: np.ndarray, most_rules: int = 16,
               most_conditions: int = 4, least_precision: float = 0.95, cuts: int = 64) -> DecisionList:
    """Sequential covering: two thirds of the rows grow a rule, the rest prune it.

    A rule enters the list only if at least ``least_precision`` of the pruning rows that it
    covers (and of the growing rows) are labelled for rejection, so clean rows stay.
    """
    out = DecisionList()
    grow, left = order % 3 != 0, np.ones(len(bad), bool)
    while len(out.rules) < most_rules:
        g, v = left & grow, left & ~grow
        if (g & bad).sum() < 5:
            break
        rule: list[Condition] = []
        on = g.copy()
        while (on & ~bad).any() and len(rule) < most_conditions:
            c = _best_condition(x, bad, on, cuts)
            if c is None:
                break
            rule.append(c)
            on &= c.holds(x)
        if not rule:
            break

        def worth(r):
            hit = _covers(r, x, len(bad)) & v
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - n) / max(p + n, 1), p

        short = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (*worth(r), -len(r)))
        hit = _covers(short, x, len(bad)) & left
        if not (hit & bad).any() or (hit & bad).sum() < least_precision * hit.sum():
            short = rule
            hit = _covers(short, x, len(bad)) & left
            if (hit & bad).sum() < max(5, least_precision * hit.sum()):
                break
        out.rules.append(tuple(short))
        left &= ~hit
    return out


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, **options) -> DecisionList:
    """Learn from a bounded sample: the ``most_rows`` labelled rows of smallest hash.

    Rows that fail the base rules are left out, as the list never judges them. The sample's
    ids (at most ``most_rows``) go to the documents, so no text is shuffled.
    """
    lab = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
           .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"),
                   labelled_bucket(F.col("doc_id"), "rules").alias("h"))
           .orderBy("h", "doc_id", "quality").limit(most_rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(lab.select("doc_id").distinct()), "doc_id", "left_semi")
    rows = (statistics(texts).where(~base_failed())
            .select("doc_id", *(feature(f).alias(f) for f in FEATURES))
            .join(F.broadcast(lab), "doc_id")
            .orderBy("h", "doc_id", *FEATURES).limit(most_rows).toPandas())
    if rows.empty or rows.quality.nunique() < 2:
        return DecisionList()
    x = {f: rows[f].to_numpy(float) for f in FEATURES}
    return learn_from(x, rows.quality.to_numpy() == 0, rows.h.to_numpy(np.int64) & 0xFFFF, **options)


def judge(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """The counts with ``base_failed``, ``rule`` (deciding rule, 0: none) and ``kept``."""
    return (stats.withColumn("base_failed", base_failed()).withColumn("rule", rules.rule_number())
            .withColumn("kept", ~F.col("base_failed") & rules.verdict()))


def op10_rules(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """Statistics, base rules and learned verdict of every document."""
    return judge(statistics(docs), learn(docs, labels, most_rows))
