"""Language identification by word-first backoff.

A word seen in training is scored by its log frequency in each language.  An
unseen word falls back to its character n-grams, longest first: the first
length of which any n-gram is known scores the word, shorter ones are not
asked.  A word with no known character says nothing.

Fitting uses a bounded sample of the labelled rows (``sample_rows``, chosen by
a hash of the text, so that it does not depend on the partitioning) and keeps
``max_words`` words and ``max_grams`` n-grams, the most frequent ones.  On top
of that each language has at least an equal share of each bound (all its rows,
words and n-grams if they are fewer), so that a rare one is learned as well; no
bound is exceeded more than twofold.  They also bound what is broadcast.
Prediction reads every whole text.

Defined results: null text and text without letters give ``und`` with score 0;
so does every text if nothing was learned.  Letters of no known n-gram give the
first language by name with the uniform score.  Ties go to the first language
by name.  Repeated rows are predicted alike.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 5_000
MAX_WORDS = 60_000
MAX_GRAMS = 60_000
MAX_GRAM = 4
UNKNOWN = "und"
_WORD = regex.compile(r"\p{L}+")  # as in ``fit``
_HASH_RANGE = 1 << 30
_MAX_CACHED = 200_000


class _Rows(dict):
    """Words met so far, each with its row in a growing table of scores."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.scores = np.zeros((1024, len(model.langs)))

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[row] = self.model._backoff(word)
        self[word] = row
        return row


@dataclass
class LanguageModel:
    langs: tuple[str, ...]
    words: dict[str, int]  # word -> row of word_scores
    word_scores: np.ndarray
    grams: dict[str, int]  # padded n-gram of any length -> row of gram_scores
    gram_scores: np.ndarray
    max_gram: int
    _rows: _Rows = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self._rows = _Rows(self)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_rows"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._rows = _Rows(self)

    def word(self, word: str) -> np.ndarray:
        """Log-probability of a word for each language, by backoff."""
        return self._rows.scores[self._rows[word]]

    def _backoff(self, word: str) -> np.ndarray:
        row = self.words.get(word)
        if row is not None:
            return self.word_scores[row]
        padded = f" {word} "
        for n in range(self.max_gram, 0, -1):
            rows = [self.grams[g] for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) in self.grams and g != " "]
            if rows:
                return self.gram_scores[rows].mean(axis=0)
        return np.zeros(len(self.langs))

    def predict(self, text: str | None) -> tuple[str, float]:
        found = Counter(_WORD.findall(text.lower())) if text else {}
        if not found or not self.langs:
            return UNKNOWN, 0.0
        if len(self._rows) > _MAX_CACHED:
            self._rows = _Rows(self)
        rows = list(map(self._rows.__getitem__, found))
        total = np.fromiter(found.values(), float, len(found)) @ self._rows.scores[rows]
        best = int(np.argmax(total))
        return self.langs[best], float(1.0 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def _scores(rows: pa.Table, langs: tuple[str, ...], of: str) -> tuple[dict[str, int], np.ndarray]:
    """Smoothed log frequencies of the keys, with the mean over languages taken off.

    What a key not seen in a language gets is the same for all languages, half a
    count in the largest one: few rows do not make a language likelier.
    """
    keys = rows.column(of).to_pylist()
    index: dict[str, int] = {}
    for key in keys:
        index.setdefault(key, len(index))
    counts = np.zeros((len(index), len(langs)))
    column = {lang: i for i, lang in enumerate(langs)}
    for key, lang, n in zip(keys, rows.column("lang").to_pylist(), rows.column("n").to_pylist(), strict=True):
        counts[index[key], column[lang]] += n
    totals = np.maximum(counts.sum(axis=0, keepdims=True), 1.0)
    logs = np.log(counts / totals + 0.5 / totals.max()) if len(index) else counts
    return index, logs - logs.mean(axis=1, keepdims=True) if len(index) else logs


def _most_frequent(keys: DataFrame, of: str, most: int, langs: int) -> pa.Table:
    """The ``most`` most frequent (lang, key) rows, and of each language at least its equal share of them.

    They come as Arrow columns: rows as objects take several times the driver's memory."""
    order = [F.desc("n"), "lang", of]
    own = keys.withColumn("__nth", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("__nth") <= math.ceil(most / langs)).drop("__nth")
    return keys.orderBy(*order).limit(most).select("lang", of, "n").union(own.select("lang", of, "n")).distinct().orderBy(*order).toArrow()


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS, max_gram: int = MAX_GRAM) -> LanguageModel:
    """Learn from rows (text, lang); rows with a null in either are left out."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
    hashed = rows.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(_HASH_RANGE)))
    counts = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least")).collect()
    n, share_of = sum(r["n"] for r in counts), max(1, len(counts))
    # its share of all rows, or an equal share of the sample if that is more; the least hash is always in
    # one number a language, looked up in the plan: nothing is shuffled by language
    limits = [(r["lang"], max(math.ceil(min(1.0, max(sample_rows / n, sample_rows / share_of / r["n"])) * _HASH_RANGE), r["least"] + 1)) for r in counts]
    below = F.create_map(*[F.lit(x) for limit in limits for x in limit])[F.col("lang")] if limits else F.lit(0)
    sample = hashed.filter(F.col("h") < below).select("text", "lang")
    words = (
        sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .persist()
    )
    try:
        top_words = _most_frequent(words.filter("n > 1"), "word", max_words, share_of)
        padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
        lengths = F.sequence(F.lit(1), F.least(F.lit(max_gram), F.length(padded)))
        grams = F.flatten(F.transform(lengths, lambda k: F.transform(F.sequence(F.lit(1), F.length(padded) - k + 1), lambda i: F.substring(padded, i, k))))
        all_grams = words.select("lang", "n", F.explode(grams).alias("gram")).filter("gram != ' '").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        top_grams = _most_frequent(all_grams, "gram", max_grams, share_of)
    finally:
        words.unpersist()
    langs = tuple(sorted({lang for top in (top_words, top_grams) for lang in top.column("lang").unique().to_pylist()}))
    return LanguageModel(langs, *_scores(top_words, langs, "word"), *_scores(top_grams, langs, "gram"), max_gram)


def predictor(docs: DataFrame, model: LanguageModel):
    """A column function text -> struct(lang_pred, score); the model's size is bounded by ``fit``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        learned = shared.value
        for t in texts:
            yield pd.DataFrame([learned.predict(x) for x in t], columns=["lang_pred", "score"])

    return predict


def held_out(doc_id: str | Column) -> Column:
    """True where crc32(doc_id as text) modulo 4 is 2; a null id is not held out."""
    key = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    predict = predictor(docs, model)
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), predict("text").alias("found")).select("doc_id", "held_out", "found.lang_pred", "found.score")
