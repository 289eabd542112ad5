"""Importance resampling towards a target distribution, by hashed word n-grams.

A text becomes words (A-Z lower-cased, all other bytes below 128 that are
neither digits nor letters are separators); its features are all runs of 1 to
``max_n`` consecutive words, joined by one space.  A scan first collapses the
separators to single spaces; then, for each run length, an overlapped regular
expression with look-arounds at word boundaries emits the span of every run,
and the CRC-32 of a span's bytes modulo ``buckets`` is its feature's bucket.

With S features of raw texts, s of them in a bucket, and T, t of the target, the
gain of a bucket is floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))).  A text's
weight is the floored mean of its features' gains; its score adds Gumbel noise
drawn from its id, so that taking the highest scores draws without replacement.

Every text is scanned once, whole; its buckets are written (compressed, two bytes
a feature) and read again for the counts and the weights.  Counts leave a task
as one row a bucket.  Ranks come from a range partitioning by score and the
row counts of its partitions: no task sees all rows.

Defined results: a null or wordless text has no features, weight 0 and is not
eligible unless ``min_words`` is 0.  Equal scores rank by doc_id (null first),
then by the text's features.  Repeated rows count as often as they occur and each
is ranked.  A null doc_id draws as the empty string.  Empty tables give no rows;
an empty target gives gains of (S+buckets)/((s+1) buckets).
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgepole.llm.common import release, sliced, written

BUCKETS = 10_000
MAX_N = 2
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_BLANKED = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))
_ROW_BITS = 33  # monotonically_increasing_id: rows below, partitions above


def run_patterns(max_n: int) -> list:
    """One pattern a run length; overlapped matching starts a run at every word."""
    return [regex.compile(rb"(?<![^ ])[^ ]++" + rb" [^ ]++" * (n - 1)) for n in range(1, max_n + 1)]


def spaced_words(text: str | None) -> bytes:
    """The words of a text, lower-cased and joined by single spaces."""
    return b" ".join((text or "").encode().lower().translate(_BLANKED).split())


def feature_buckets(text: str | None, patterns: list, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words and the bucket of every feature."""
    line = spaced_words(text)
    found = [np.fromiter((crc32(line[m.start() : m.end()]) for m in p.finditer(line, overlapped=True)), np.uint32) for p in patterns]
    return len(found[0]), (np.concatenate(found) % np.uint32(buckets)).astype("<u4")


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def scanned(docs: DataFrame, keys: list[str], text: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """``keys``, n_words, n_features and the packed buckets of every row."""
    rows = docs.select(*[F.col(k) for k in keys], F.col(text).cast("string").alias("__scan"))
    schema = rows.select(*keys, F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_features"), F.lit(b"").alias("buckets")).schema
    kind = _width(buckets)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, packer = run_patterns(max_n), zstandard.ZstdCompressor(level=1)
        for b in sliced(batches):
            words, features, packed = [], [], []
            for t in b.column("__scan").to_pylist():
                n, found = feature_buckets(t, patterns, buckets)
                words.append(n)
                features.append(len(found))
                packed.append(packer.compress(found.astype(kind).tobytes()))
            made = [pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keys] + made, names=[*keys, "n_words", "n_features", "buckets"])

    return rows.mapInArrow(scan, schema)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows; each task adds up its rows first."""
    kind = _width(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, reader = np.zeros(buckets, np.int64), zstandard.ZstdDecompressor()
        for b in batches:
            for blob in b.column("buckets").to_pylist():
                total += np.bincount(np.frombuffer(reader.decompress(blob), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return features.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket from the (bucket, n) counts of raw and target texts."""
    spark = raw.sparkSession
    total = lambda counts: F.coalesce(counts.agg(F.sum("n")).scalar(), F.lit(0)).cast("double")
    both = (
        spark.range(buckets).withColumnRenamed("id", "bucket")
        .join(raw.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t"))
    )
    ratio = ((F.col("t") + 1) * (total(raw) + buckets)) / ((F.col("s") + 1) * (total(target) + buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def weighted(features: DataFrame, gains: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``features`` with ``weight`` in place of the packed buckets.

    The gains are one long a bucket, so their size is set by ``buckets`` alone."""
    table = np.zeros(buckets, np.int64)
    for r in gains.collect():
        table[r["bucket"]] = r["gain"]
    kept = [c for c in features.columns if c != "buckets"]
    kind = _width(buckets)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for b in sliced(batches, 4096):
            weights = []
            for blob in b.column("buckets").to_pylist():
                found = np.frombuffer(reader.decompress(blob), kind)
                weights.append(int(table[found].sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(weights, pa.int64())], names=[*kept, "weight"])
        release()

    return features.mapInArrow(weigh, features.select(*kept, F.lit(0).cast("long").alias("weight")).schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256("<seed>:<doc_id>")."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their place in ``order`` as ``place`` (from 1), without a task that sees all of them.

    Rows are dealt by range and sorted inside the partitions; a partition's first place
    follows from the row counts of the partitions before it, one row a partition.
    """
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", _ROW_BITS)
    sizes = dealt.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    row = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return dealt.withColumn("__part", part).join(starts, "__part").withColumn("place", F.col("__before") + row + 1).drop("__part", "__before", "__at")


def resample(
    raw: DataFrame, target: DataFrame, percent: int, seed: int, min_words: int, text: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N
) -> DataFrame:
    """One row a raw document: doc_id, n_features, weight, score and, for the drawn ones, rank.

    Of the N documents with at least ``min_words`` words, floor(percent N / 100) are drawn.
    """
    features = written(scanned(raw, ["doc_id"], text, buckets, max_n), "features")
    wanted = bucket_counts(scanned(target, [], text, buckets, max_n), buckets)
    gains = bucket_gains(written(bucket_counts(features, buckets), "raw-counts"), written(wanted, "target-counts"), buckets)
    tie = features.withColumn("__tie", F.xxhash64("buckets"))
    kept = ["doc_id", "n_words", "n_features", "__tie", "buckets"]
    scored = weighted(tie.select(*kept), gains, buckets).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = written(scored, "scored")
    eligible = F.col("n_words") >= min_words
    drawn = scored.filter(eligible).agg(F.floor(F.count(F.lit(1)) * percent / 100)).scalar()
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("__tie")]
    places = ranked(scored.filter(eligible), order).withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return places.select(*columns).unionByName(rest.select(*columns))
