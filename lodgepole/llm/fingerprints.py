"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into LZ78 phrases: each is the shortest piece that is no
phrase yet.  The set of phrases is what a compressor would keep in its
dictionary, so texts that compress well together share phrases.  Every phrase
is hashed; the fingerprint is the ``size`` smallest hashes, and the likeness of
two fingerprints is the share of common hashes among the smallest of both (an
estimate of the Jaccard likeness of the phrase sets).

The set of phrases is prefix-closed, so the end of a phrase is found by
galloping with slices.  All phrase hashes of a text come from prefix sums of
hashed code points, so the cost of hashing does not depend on the phrases.
The parse of an edited text goes on from the parse of the part that it shares
with the text.

Fingerprints are hex strings of 32-bit hashes, ascending.  Defined results: null
text counts as empty; the empty text has the empty fingerprint, which is fully
like itself and unlike all others; equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgepole.llm.common import U64, mix, prefix_hash, span_hash, written

SIZE = 64


def code_points(text: str) -> np.ndarray:
    """Hashed code points (lone surrogates cannot occur in a Spark string)."""
    return mix(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(U64) + U64(1))


def parse(text: str, start: int = 0, phrases: set[str] | None = None, ends: list[int] | None = None) -> tuple[set[str], list[int]]:
    """LZ78 phrases of text from ``start`` on, added to what was parsed before.

    ``ends`` holds the end of every phrase; the last one may be an old phrase.
    """
    phrases = set() if phrases is None else phrases
    ends = [] if ends is None else ends
    n, i, guess = len(text), start, 4
    add, out = phrases.add, ends.append
    while i < n:
        size = guess
        piece = text[i : i + size]
        if piece in phrases:
            while piece in phrases and i + size <= n:
                size += 1
                piece = text[i : i + size]
        else:
            while size > 1 and (shorter := text[i : i + size - 1]) not in phrases:
                size -= 1
                piece = shorter
        add(piece)
        guess = size
        i += size
        out(i if i < n else n)
    return phrases, ends


def phrase_hashes(values: np.ndarray, ends: list[int], start: int = 0) -> np.ndarray:
    """Hashes of the phrases that end at ``ends``; the first begins at ``start``.  The place does not matter."""
    if not ends:
        return np.zeros(0, np.uint32)
    end = np.array(ends, np.int64) - start
    begin = np.concatenate(([0], end[:-1]))
    return (span_hash(prefix_hash(values[start:]), begin, end) >> U64(32)).astype(np.uint32)


def smallest(hashes: np.ndarray, size: int) -> np.ndarray:
    """The smallest distinct hashes, ascending."""
    ordered = np.sort(hashes)  # np.unique costs several times the sort of so few
    return ordered[np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))[: len(ordered)])[:size]]


def signature(values: np.ndarray, ends: list[int], size: int) -> np.ndarray:
    """The smallest distinct hashes of the phrases that end at ``ends``."""
    return smallest(phrase_hashes(values, ends), size)


def fingerprint(text: str | None, size: int = SIZE) -> str:
    text = text or ""
    return signature(code_points(text), parse(text)[1], size).astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Share of the smallest hashes of both that both have; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = np.sort(np.concatenate((a, b)))
    twice = both[1:] == both[:-1]  # of a hash that both have, the first
    firsts = np.flatnonzero(np.concatenate(([True], ~twice)))[:size]
    return int(np.count_nonzero(twice[: firsts[-1] + 1])) / len(firsts)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class _Parsed:
    """A text's parse, with the state at the place where its edited text branches off."""

    def __init__(self, text: str, size: int) -> None:
        self.text, self.size = text, size
        self.values = code_points(text)
        self.keep = len(text) - len(text) // 2
        phrases, self.kept_ends = parse(text[: self.keep])
        if len(phrases) < len(self.kept_ends):
            self.kept_ends.pop()  # an old phrase: the text goes on in it
        self.at = self.kept_ends[-1] if self.kept_ends else 0
        self.kept_phrases = phrases.copy()
        self.phrases, self.ends = parse(text, self.at, phrases, self.kept_ends.copy())
        self.hashes = phrase_hashes(self.values, self.ends)
        self.signature = smallest(self.hashes, size)

    def edit(self, following: _Parsed) -> tuple[str, np.ndarray]:
        half, shared = len(self.text) - self.keep, len(self.kept_ends)
        changed = self.text[: self.keep] + following.text[:half]
        ends = parse(changed, self.at, self.kept_phrases.copy(), [])[1]
        values = np.concatenate((self.values[: self.keep], following.values[:half]))
        return changed, smallest(np.concatenate((self.hashes[:shared], phrase_hashes(values, ends, self.at))), self.size)


_ROW = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_SQL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_PART = pa.schema([*_ROW, ("part", pa.int32()), ("first", pa.string()), ("last", pa.string())])


def _row(doc: int | None, now: _Parsed, nxt: _Parsed) -> tuple:
    changed, sig = now.edit(nxt)
    hexed = lambda s: s.astype(">u4").tobytes().hex()
    return (doc, len(now.text), hashlib.sha256(changed.encode()).hexdigest(), hexed(now.signature), hexed(sig), likeness(now.signature, sig, now.size), likeness(now.signature, nxt.signature, now.size))


def _walk(size: int):
    """Rows of a task in order; each meets the next.  The edges of the task are handed on.

    The first row's text goes with the mark row of its task (``first``), and the
    last row, whose next row is in a later task, is left open (``last``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, rows = TaskContext.get().partitionId(), None, []
        first = None
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                now = _Parsed(text, size)
                if before is None:
                    first = text
                else:
                    rows.append((*_row(before[0], before[1], now), part, None, None))
                before = (doc, now)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _PART, strict=True)], schema=_PART)
                rows = []
        if before is not None:
            yield pa.RecordBatch.from_pylist([{"doc_id": before[0], "part": part, "first": first, "last": before[1].text}], schema=_PART)

    return run


def compare_with_next(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The next document is the one that follows in descending doc_id (null last;
    rows with one doc_id by their text, descending; repeated rows follow each
    other); after the last comes the first.  The edited text is the text with
    the last floor(n/2) code points replaced by the first as many (or all) of
    the next one.

    Rows are dealt to tasks by ranges of doc_id and text, so rows that share one
    id can be split, and read in order; only one row at each edge of a task is
    left over.  A second, small step joins the edges of neighbouring tasks.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.desc("digest")]
    keyed = rows.withColumn("digest", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    walked = written(
        keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order, F.desc("text")).select("doc_id", "text").mapInArrow(_walk(size), _SQL + ", part int, first string, last string"),
        "fingerprints",
    )
    inner = walked.filter("last is null").drop("part", "first", "last")
    edges = walked.filter("last is not null").select("doc_id", "part", "first", "last")
    # one row per task that has rows: numbering them is bounded by the number of tasks, not of documents
    ranks = edges.select("part").agg(F.sort_array(F.collect_list("part")).alias("parts")).select(F.posexplode("parts").alias("rank", "part"), F.size("parts").alias("n"))
    ranked = edges.join(ranks, "part")
    ahead = ranked.select(F.pmod(F.col("rank") - 1, F.col("n")).alias("rank"), F.col("first").alias("next"))
    joined = ranked.select("doc_id", "rank", "last").join(ahead, "rank").select("doc_id", "last", "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(_ROW)
        for b in batches:
            out = [_row(doc, _Parsed(last, size), _Parsed(nxt, size)) for doc, last, nxt in zip(*(b.column(c).to_pylist() for c in ("doc_id", "last", "next")), strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return inner.unionByName(joined.mapInArrow(close, _SQL))
