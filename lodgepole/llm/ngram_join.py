"""N-gram Jaccard join by MinHash banding, verified on the full n-gram sets.

1. Every text becomes the set of hashes of its word n-grams (5 lower-case words
   between white space; a shorter text is one n-gram).  Texts with equal sets
   are copies: the smallest doc_id stands for them (``copy_of``).
2. The bands of the MinHash signature of each representative are shuffled.  Band
   and row counts follow from the target recall at the threshold.  Within a
   band value every document is tied to the smallest one only - never to all
   others - and the connected sets of these ties are the candidate sets.
3. A candidate set is split into blocks of bounded size by a hash of the id,
   and each pair of blocks is verified by one task: for all pairs of documents
   that share a band value, the full sets are counted.  Only the number of
   links of each document and one spanning tree of the links leave a task, so
   no list of all pairs is ever made, however large a group of near copies is.
4. Connected links make the classes.

Defined results: one row per row of the input.  A text without words (null,
empty, white space) has no n-gram: it is like nothing and a class of its own.
A null doc_id is no name for a class: such rows come back with a null class_id
and no links.  Rows that share a doc_id are judged each by its own text, repeated
rows are copies.  Similarity >= threshold is compared in integers, so ties count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgepole.llm.common import U64, cut, mix, sliced, small_batches, written

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.99999
MAX_HASHES = 160
_SALTS = 64
_HOT, _HOT_ROWS = 1000, 200
BLOCK_DOCS = 1024
BLOCK_GRAMS = 400_000


def bands_for(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows - the fewest false candidates - that reach the recall."""
    for rows in range(16, 0, -1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError("no banding within max_hashes reaches the recall")


def ngrams(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams."""
    w = text.lower().split() if text else []
    if not w:
        return np.zeros(0, U64)
    one = xxhash.xxh3_64_intdigest
    h = mix(np.fromiter((one(x) for x in w), U64, len(w)))
    n = min(words, len(w))
    out = h[: len(w) - n + 1].copy()
    for i in range(1, n):
        out = mix(out * U64(0x9E3779B97F4A7C15) + h[i : len(w) - n + 1 + i])
    return np.unique(out)


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One hash per set and band over the MinHashes of the band's rows; no set is empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=U64)).reshape(bands, rows, 2)
    out = np.zeros((len(sets), bands), U64)
    for b in range(bands):
        for r in range(rows):
            least = np.minimum.reduceat((flat ^ seeds[b, r, 0]) * (seeds[b, r, 1] | U64(1)), starts)
            out[:, b] = mix(out[:, b] * U64(31) + least)
    return out


_SKETCH_SQL = "doc_id long, set_id binary, n_grams int, bands array<long>"
_SKETCH = pa.schema([("doc_id", pa.int64()), ("set_id", pa.binary()), ("n_grams", pa.int32()), ("bands", pa.list_(pa.int64()))])


def _set_id(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def _sketch(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            sets = [ngrams(t, words) for t in b.column("text").to_pylist()]
            some = [i for i, g in enumerate(sets) if len(g)]
            told: list = [None] * len(sets)
            if some:
                for i, sig in zip(some, signatures([sets[i] for i in some], bands, rows).view(np.int64).tolist(), strict=True):
                    told[i] = sig
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip((b.column("doc_id").to_pylist(), [_set_id(g) for g in sets], [len(g) for g in sets], told), _SKETCH, strict=True)], schema=_SKETCH)

    return run


_MEMBER = ("node", "label", "block", "blocks", "set_id", "bands")
_GRAMS_SQL = "node long, label long, block int, blocks int, bands binary, grams binary"
_GRAMS = pa.schema([("node", pa.int64()), ("label", pa.int64()), ("block", pa.int32()), ("blocks", pa.int32()), ("bands", pa.binary()), ("grams", pa.binary())])


def _full_sets(words: int):
    """The n-gram sets of candidates; rows of another text under the same id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            out = []
            for text, node, label, block, blocks, set_id, bands in zip(*(b.column(c).to_pylist() for c in ("text", *_MEMBER)), strict=True):
                g = ngrams(text, words)
                if _set_id(g) == set_id:
                    out.append((node, label, block, blocks, np.array(bands, np.int64).tobytes(), g.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _GRAMS, strict=True)], schema=_GRAMS)

    return run


def _hot_keys(rows: DataFrame, key: str) -> list[int]:
    """Keys that hold more than a thousandth of the rows and ``_HOT_ROWS``: fewer than a thousand, whatever the size."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return [r[0] for r in counts.filter(F.col("n") > _HOT_ROWS).filter(F.col("n") * _HOT > rows.agg(F.count(F.lit(1))).scalar()).select(key).collect()]


def _salted_join(rows: DataFrame, lookup: DataFrame, key: str, hot: list[int]) -> DataFrame:
    """``rows`` joined with ``lookup`` (one row a key); rows of hot keys are spread over copies of its row."""
    if not hot:
        return rows.join(lookup, key)
    is_hot = F.col(key).isin(hot)
    one, last = F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long")
    salted = rows.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("node"), F.lit(_SALTS))).otherwise(one))
    copies = lookup.withColumn("salt", F.explode(F.when(is_hot, F.sequence(one, last)).otherwise(F.array(one))))
    return salted.join(copies, [key, "salt"]).drop("salt")


def components(ties: DataFrame) -> DataFrame:
    """(a, b) ties -> (node, label): the smallest node that each node is connected to.

    Every round takes the smallest label among a node's neighbours and then the
    label's own label, so paths shrink by halves.  Each round is checkpointed.
    """
    both = cut(ties.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(ties.select(F.col("b").alias("node"), F.col("a").alias("near"))).distinct())
    labels = cut(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("label")))
    hot = _hot_keys(both, "near")
    while True:
        near = _salted_join(both, labels.select(F.col("node").alias("near"), "label"), "near", hot).groupBy("node").agg(F.min("label").alias("least"))
        lower = cut(labels.join(near, "node").select("node", "label", F.least("label", "least").alias("next")))
        # a label is a node: it may know a smaller one itself
        hop = lower.select(F.col("node").alias("next"), F.col("next").alias("hop"))
        new = cut(_salted_join(lower, hop, "next", _hot_keys(lower, "next")).select("node", F.col("label").alias("old"), F.least("next", "hop").alias("label")))
        labels = new.select("node", "label")
        if new.filter("old != label").isEmpty():
            return labels


def _verify(threshold: Fraction):
    """All links between the documents of two blocks (or inside one)."""
    over, under = threshold.numerator, threshold.denominator

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node").sort_values("node", ignore_index=True)
        nodes = rows["node"].to_numpy(np.int64)
        mine = rows["block"].to_numpy(np.int64)
        lo, hi = int(key[1]), int(key[2])
        bands = np.stack([np.frombuffer(b, np.int64) for b in rows["bands"]])
        sets = [np.frombuffer(g, U64) for g in rows["grams"]]
        size = np.array([len(s) for s in sets], np.int64)
        ends = np.cumsum(size)
        starts = ends - size
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        has = np.zeros(codes.max() + 1, bool)
        links = np.zeros(len(nodes), np.int64)
        parent = list(range(len(nodes)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        right = np.flatnonzero(mine == hi)
        for i in np.flatnonzero(mine == lo).tolist():
            others = right[right > i] if lo == hi else right
            others = others[(bands[others] == bands[i]).any(axis=1)]
            if not len(others):
                continue
            own = codes[starts[i] : ends[i]]
            has[own] = True
            common = np.array([np.count_nonzero(has[codes[a:b]]) for a, b in zip(starts[others].tolist(), ends[others].tolist(), strict=True)], np.int64)
            has[own] = False
            linked = others[under * common >= over * (size[i] + size[others] - common)]
            links[i] += len(linked)
            links[linked] += 1
            for j in linked.tolist():
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        some = np.flatnonzero(links).tolist()
        return pd.DataFrame({"node": nodes[some], "n_links": links[some], "tie": nodes[[root(x) for x in some]]})

    return run


def near_duplicates(
    docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, block_docs: int = BLOCK_DOCS, block_grams: int = BLOCK_GRAMS, id_col: str = "doc_id"
) -> DataFrame:
    """doc_id, class_id, copy_of, n_links; ``id_col`` names the column that stands for the doc_id.

    ``class_id`` is the smallest doc_id of all documents connected by links of
    at least ``threshold``, ``copy_of`` the smallest with the same n-grams, and
    ``n_links`` the number of other distinct n-gram sets linked to the
    document's own (each is stood for by its ``copy_of``).
    """
    small_batches(docs.sparkSession)
    bands, rows = bands_for(threshold, recall)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = written(texts.filter("doc_id is not null").mapInArrow(_sketch(words, bands, rows), _SKETCH_SQL), "sketches")
    sets = (
        sketches.filter("n_grams > 0")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("copy_of"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"))
    )
    sets = written(sets.select(F.monotonically_increasing_id().alias("node"), "*"), "ngram-sets")

    # candidates: ties to the smallest document of each band value
    banded = sets.select("node", F.posexplode("bands").alias("band", "value"))
    least = banded.groupBy("band", "value").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z").drop("z")
    ties = banded.join(least, ["band", "value"]).filter("a < node").select("a", F.col("node").alias("b"))
    labels = components(ties)
    known = labels.join(sets, "node").select("node", "label", "copy_of", "set_id", "bands", "n_grams")
    per_label = known.groupBy("label").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_docs), F.ceil(F.sum("n_grams") / block_grams)).cast("int").alias("blocks")
    )
    members = cut(known.join(per_label, "label").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).select("copy_of", *_MEMBER))

    # links: every pair of blocks of a candidate set is verified by one task
    full = texts.join(members, F.col("doc_id") == F.col("copy_of")).select("text", *_MEMBER).mapInArrow(_full_sets(words), _GRAMS_SQL)
    met = full.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("label", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "node", "block", "bands", "grams")
    links = cut(met.groupBy("label", "lo", "hi").applyInPandas(_verify(Fraction(str(threshold))), "node long, n_links long, tie long"))

    # classes: connected links
    groups = components(links.filter("node != tie").select(F.col("tie").alias("a"), F.col("node").alias("b")))
    counted = links.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    of_set = sets.select("node", "set_id", "copy_of").join(groups, "node", "left").join(counted, "node", "left")
    of_set = of_set.withColumn("label", F.coalesce("label", "node"))
    smallest = of_set.groupBy("label").agg(F.min("copy_of").alias("class_id"))
    of_set = cut(of_set.join(smallest, "label").select("set_id", "copy_of", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    found = sketches.select("doc_id", "set_id", "n_grams").join(of_set, "set_id", "left")
    alone = F.col("n_grams") == 0
    out = found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    nameless = texts.filter("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(nameless)
