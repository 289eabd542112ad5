"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a fixed list of measures (``FEATURES``), each cut into bins at
quantiles of the training rows.  Cyclic boosting fits one lookup table a
measure: round after round, every measure in turn gets a shallow tree (three
splits at most) fitted to the gradient of the logistic loss over its bins, and
the tree's leaves are added, shrunk, to the table.  Then the pairs of measures
whose joint bins explain most of what is left get tables of their own, boosted
in the same way by trees of depth two over both measures.  The score of a text is
the logistic function of the sum of the looked-up cells, a few vectorised gathers.

Fitting uses at most ``sample_rows`` labelled rows (a documented bound: half for
each class, chosen by a hash of the id; a class's rows are weighted back to
its share of all labelled rows).  Prediction reads every whole text.  The ids,
labels, language and source of a document are never measured.

Defined results: null and empty texts have all-zero measures and get a score like any
other text.  Rows with a null label, or one other than 0 and 1, are not learned; without
rows of both classes every score is the share of label 1 (0.5 without any rows).  A
document labelled twice is learned twice; repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgepole.llm.common import cut

SAMPLE_ROWS = 20_000
MAX_BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 150
PAIR_ROUNDS = 50
RATE = 0.1
_RIDGE = 5.0
_MIN_ROWS = 4.0
FEATURES = (
    "log_chars", "log_words", "mean_word", "longest_word",
    "letters", "digits", "blanks", "marks", "upper", "beyond_ascii",
    "bare_marks", "marked_words", "shouted_words", "capital_words", "distinct_words", "commonest_word",
    "doubled_words", "distinct_lines", "words_a_line", "ended_lines", "commonest_mark", "one_letter_words",
)
_LETTERS = re.compile(r"[^\W\d_]+")
_ASCII_CLASS = np.zeros(256, np.int64)  # 0 mark, 1 letter, 2 digit, 3 blank, 4 part of a longer code point
for _c in range(256):
    _ASCII_CLASS[_c] = 4 if _c > 127 else 1 if chr(_c).isalpha() else 2 if chr(_c).isdigit() else 3 if chr(_c).isspace() else 0


def measures(text: str | None) -> list[float]:
    """The values of ``FEATURES`` for one whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    seen = np.bincount(raw, minlength=256)
    kinds = np.bincount(_ASCII_CLASS, weights=seen, minlength=5) / len(raw)
    upper = seen[65:91].sum()
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lengths = list(map(len, words))
    lines = text.split("\n")
    filled = [x for x in lines if x and not x.isspace()]
    m = max(1, len(filled))
    bare = marked = shouted = capital = single = 0
    for w, k in counts.items():
        if w.isalpha():
            if w.isupper() and len(w) > 1:
                shouted += k
            elif w[0].isupper():
                capital += k
            single += k * (len(w) == 1)
            continue
        inner = _LETTERS.search(w)
        if inner is None:
            bare += k
        else:
            marked += k * (len(w) - inner.end() > 1)
            core = inner.group()
            if core.isupper() and len(core) > 1:
                shouted += k
            elif core[0].isupper():
                capital += k
            single += k * (len(core) == 1)
    marks = np.where(_ASCII_CLASS == 0, seen, 0)
    return [
        math.log1p(len(text)), math.log1p(len(words)), sum(lengths) / n, math.log1p(max(lengths, default=0)),
        kinds[1], kinds[2], kinds[3], kinds[0], upper / max(1, seen[97:123].sum() + upper), kinds[4],
        bare / n, marked / n, shouted / n, capital / n, len(counts) / n, max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, len(set(filled)) / m, len(words) / m,
        sum(x.rstrip()[-1] in ".!?:;\"'”»)" for x in filled) / m, marks.max() / len(raw), single / n,
    ]


@dataclass
class AdditiveModel:
    """Cut points a measure, a table a measure, and tables over the bins of pairs."""

    start: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # a measure's bin -> its bin in pairs
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, values: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, values[:, i], side="right") for i, c in enumerate(self.cuts)]

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of measures."""
        total = np.full(len(values), self.start)
        if self.cuts and len(values):
            at = self.bins(values)
            for table, b in zip(self.tables, at, strict=True):
                total += table[b]
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[self.coarse[i][at[i]], self.coarse[j][at[j]]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -500, 500)))


def _cut_points(values: np.ndarray, most: int) -> np.ndarray:
    """Ends between bins, halfway between neighbouring values near the quantiles."""
    distinct = np.unique(values)
    if len(distinct) <= most:
        return (distinct[1:] + distinct[:-1]) / 2
    return np.unique(np.quantile(values, np.linspace(0, 1, most + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + _RIDGE)


def _best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins (place 0: none)."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    gain[(left_n < _MIN_ROWS) | (n.sum() - left_n < _MIN_ROWS)] = 0.0
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 1e-9 else (0.0, 0)


def _line_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Step for each bin from a tree of at most ``leaves`` leaves over one measure."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        options = [(*_best_split(g[a:b], h[a:b], n[a:b]), k) for k, (a, b) in enumerate(parts)]
        gain, at, k = max(options)
        if at == 0:
            break
        a, b = parts[k]
        parts[k : k + 1] = [(a, a + at), (a + at, b)]
    step = np.zeros(len(g))
    for a, b in parts:
        step[a:b] = -g[a:b].sum() / (h[a:b].sum() + _RIDGE)
    return step


def _plane_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best depth-two tree that cuts one measure, then the other in each half."""
    best = (0.0, np.zeros_like(g))
    for flip in (False, True):
        a, b, c = (g.T, h.T, n.T) if flip else (g, h, n)
        for cut in range(1, len(a)):
            gain, step = 0.0, np.zeros_like(a)
            for rows in (slice(0, cut), slice(cut, len(a))):
                rg, rh, rn = a[rows].sum(axis=0), b[rows].sum(axis=0), c[rows].sum(axis=0)
                at = _best_split(rg, rh, rn)[1]
                for cols in (slice(0, at), slice(at, len(rg))):
                    gain += float(_gain(rg[cols].sum(), rh[cols].sum()))
                    step[rows, cols] = -rg[cols].sum() / (rh[cols].sum() + _RIDGE)
            gain -= float(_gain(a.sum(), b.sum()))
            if gain > best[0]:
                best = (gain, step.T if flip else step)
    return best


def boost(
    values: np.ndarray, labels: np.ndarray, weights: np.ndarray, max_bins: int = MAX_BINS, pair_bins: int = PAIR_BINS,
    pairs: int = PAIRS, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, rate: float = RATE,
) -> AdditiveModel:
    """Fit the tables by cyclic boosting on rows of measures with 0/1 labels."""
    share = float(np.average(labels, weights=weights)) if len(labels) else 0.5
    if not 0 < share < 1:
        return AdditiveModel(start=0.0 if len(labels) == 0 else 20.0 if share else -20.0)
    model = AdditiveModel(start=math.log(share / (1 - share)))
    model.cuts = [_cut_points(values[:, i], max_bins) for i in range(values.shape[1])]
    at = model.bins(values)
    sizes = [len(c) + 1 for c in model.cuts]
    model.tables = [np.zeros(k) for k in sizes]
    total = np.full(len(labels), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return weights * (p - labels), weights * np.maximum(p * (1 - p), 1e-6)

    rows = [np.bincount(b, minlength=k).astype(float) for b, k in zip(at, sizes, strict=True)]
    for _ in range(rounds):
        for i, (b, k) in enumerate(zip(at, sizes, strict=True)):
            g, h = slopes()
            step = rate * _line_tree(np.bincount(b, g, k), np.bincount(b, h, k), rows[i])
            model.tables[i] += step
            total += step[b]
    model.coarse = [np.arange(k) * min(k, pair_bins) // k for k in sizes]
    wide = [c[b] for c, b in zip(model.coarse, at, strict=True)]
    ends = [int(c[-1]) + 1 for c in model.coarse]

    def plane(i: int, j: int, w: np.ndarray | None) -> np.ndarray:
        return np.bincount(wide[i] * ends[j] + wide[j], w, ends[i] * ends[j]).reshape(ends[i], ends[j]).astype(float)

    g, h = slopes()
    found = [(_plane_tree(plane(i, j, g), plane(i, j, h), plane(i, j, None))[0], i, j) for i in range(len(sizes)) for j in range(i)]
    model.pairs = [(i, j) for gain, i, j in sorted(found, reverse=True)[:pairs] if gain > 0]
    model.pair_tables = [np.zeros((ends[i], ends[j])) for i, j in model.pairs]
    counts = [plane(i, j, None) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            g, h = slopes()
            step = rate * _plane_tree(plane(i, j, g), plane(i, j, h), counts[k])[1]
            model.pair_tables[k] += step
            total += step[wide[i], wide[j]]
    return model


def measured(column: Column) -> Column:
    """The measures of a text column, as an array."""

    @F.pandas_udf("array<double>")
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series([measures(x) for x in t])

    return apply(column)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, **options) -> AdditiveModel:
    """Learn ``labels[label]`` from the texts of the labelled documents (a bounded sample of them)."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("y")).filter("y in (0, 1)")
    # ids alone are joined with all labels; only the sample, bounded by its parameter, meets the texts
    paired = docs.select("doc_id").join(known, F.col("doc_id") == F.col("__id")).select("__id", "y", F.xxhash64("doc_id").alias("h"))
    paired = cut(paired)
    counts = {r["y"]: r["n"] for r in paired.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [paired.filter(F.col("y") == y).orderBy("h", "__id").limit(sample_rows // 2) for y in sorted(counts)]
    if not chosen:
        return AdditiveModel()
    # a pair a row: a document and a label that both occur n times are n * n rows
    sample = cut(reduce(DataFrame.union, chosen)).groupBy("__id", "y").agg(F.count(F.lit(1)).alias("n"))
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("__id"))
    found = own.select("y", F.xxhash64("doc_id", "text").alias("h"), measured(F.col("text")).alias("x")).orderBy("h", "y", "x").limit(sample_rows).collect()
    y = np.array([r["y"] for r in found], float)
    x = np.array([r["x"] for r in found], float)
    taken = Counter(y.tolist())
    weights = np.array([counts[int(v)] / taken[v] for v in y])
    return boost(x, y, weights * len(y) / weights.sum(), **options)


def scorer(model: AdditiveModel):
    """A column function text -> score; the model holds a few thousand numbers."""

    @F.pandas_udf("double")
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(model.score(np.array([measures(x) for x in t], float).reshape(len(t), len(FEATURES))))

    return apply


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) modulo 5 is 0; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def classify(docs: DataFrame, model: AdditiveModel, threshold: float) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer(model)(F.col("text").cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
