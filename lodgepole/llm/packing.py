"""Best-fit packing with bound-certified repacking.

Documents are tokenized once; only (document, piece, length) rows take part in
packing.  A round deals the rows to partitions, packs each partition by
best-fit decreasing and certifies its number of bins by a lower bound from dual
feasible functions.  A partition that meets its bound is proven optimal and
closed.  A partition with a gap gives back the documents of its emptiest bins,
as many as make up the gap; these are exchanged - dealt anew to fewer
partitions - and packed again, until one partition is left (or a round closes next
to nothing, see ``pack``).  Whatever gap remains over all is reported by
``certificate``.

Dual feasible functions: for lengths of at most ``capacity`` and a threshold t,
lengths over capacity - t count as a whole bin, lengths under t as nothing and
the rest as they are (f0); and rounding functions u(k) that count a length x as
floor((k+1) x / capacity) / k unless (k+1) x is a multiple of capacity, which
keeps x (f1).  The largest bound over all t and k is taken.

Defined results: null text counts as empty, a document of one closing token;
repeated rows are documents of their own; a null doc_id stays null; longer
documents are cut so that all pieces but the first are full; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import json
import math
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodgepole.llm.common import cut, written

CAPACITY = 1024
CLOSING_ID = 2
PARTITION_ROWS = 20_000
LEAST_CLOSED = 0.02
_MAX_K = 64


@lru_cache(maxsize=2)
def _tokenizer(path: str, pattern: str):
    """``texts -> lists of ids`` as ``encode_batch(texts, add_special_tokens=False)`` gives them:
    nothing is added, but the string of an added token in a text becomes that token.

    A byte-level BPE file of this kind (vocabulary in merge order, the standard
    split pattern) gives the same ids as its ranks in ``tiktoken``, five times as
    fast.  Files of any other kind run in ``tokenizers`` itself.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
    merged = [m if isinstance(m, str) else " ".join(m) for m in spec["model"].get("merges", [])]
    vocab = spec["model"].get("vocab", {})
    in_order = plain and spec["model"]["type"] == "BPE" and all(vocab.get(m.replace(" ", "")) == 256 + i for i, m in enumerate(merged))
    added = spec.get("added_tokens", [])
    if not in_order or any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        tok = Tokenizer.from_file(path)
        return lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    special = {t["content"]: t["id"] for t in added}
    byte_of = _byte_letters()
    ranks = {bytes(byte_of[c] for c in w): i for w, i in vocab.items() if w not in special}
    enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return lambda texts: [enc.encode(t, allowed_special="all") for t in texts]


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document: full ones, the first may be shorter."""
    head = n % capacity
    return ([head] if head else []) + [capacity] * (n // capacity)


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())])
_PIECES_SQL = "doc_id long, piece int, start long, length int, ids_crc32 long"


def _tokenize(path: str, pattern: str, capacity: int, closing: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path, pattern)
        for b in batches:
            doc_ids, texts = (b.column(c).to_pylist() for c in ("doc_id", "text"))
            out: list[tuple] = []
            for doc, text in zip(doc_ids, texts, strict=True):
                ids = encode([text or ""])[0]
                ids.append(closing)
                raw = np.array(ids, "<u4").tobytes()
                start = 0
                for piece, n in enumerate(cut_lengths(len(ids), capacity)):
                    out.append((doc, piece, start, n, zlib.crc32(raw[4 * start : 4 * (start + n)])))
                    start += n
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return run


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, closing: int = CLOSING_ID) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: item, doc_id, piece, start, length, ids_crc32."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut_up = rows.mapInArrow(_tokenize(path, pattern, capacity, closing), _PIECES_SQL)
    return cut_up.select(F.monotonically_increasing_id().alias("item"), "*")


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs; count[x] is the number of items of length x."""
    x = np.arange(capacity + 1, dtype=np.int64)
    total = np.cumsum(count * x)
    number = np.cumsum(count)
    t = np.arange(0, capacity // 2 + 1)
    # f0: over capacity - t whole bins, from t to capacity - t their length
    below = np.where(t > 0, total[np.maximum(t - 1, 0)], 0)
    middle = total[capacity - t] - below
    best = int(np.max((number[-1] - number[capacity - t]) + -(-middle // capacity)))
    for k in range(1, _MAX_K + 1):
        scaled = (k + 1) * x
        whole = scaled % capacity == 0
        # in units of 1 / (k * capacity)
        value = np.where(whole, x * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin.

    Bins are kept by the room they have left; one bit of a number says whether
    any bin has that room, so the tightest bin is the lowest bit at or over the
    length.  Ties take the bin opened last; equal items go by their order.
    """
    order = np.argsort(-lengths, kind="stable")
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits, fill = 0, array("q")
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = bits >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                bits &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bin_of[i], offset[i] = b, fill[b]
        fill[b] += n
        if room > n:
            rooms[room - n].append(b)
            bits |= 1 << (room - n)
    return bin_of, offset, np.frombuffer(fill, np.int64).copy() if len(fill) else np.zeros(0, np.int64)


_PLACED_SQL = "item long, length int, sequence_id long, offset long, closed boolean"


def _give_back(fill: np.ndarray, bound: int, capacity: int) -> np.ndarray:
    """Bins to open again: the emptiest, until their room makes up the gap and one bin more."""
    gap = len(fill) - bound
    if gap <= 0:
        return np.zeros(len(fill), bool)
    room = capacity - fill
    order = np.argsort(-room, kind="stable")
    enough = int(np.searchsorted(np.cumsum(room[order]), (gap + 1) * capacity)) + 1
    back = np.zeros(len(fill), bool)
    back[order[:enough]] = True
    return back & (room > 0)


def _pack(capacity: int, turn: int, last: bool):
    """Pack one partition and certify it; one with a gap gives documents back."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "item"], ascending=[False, True], ignore_index=True)
        lengths = rows["length"].to_numpy(np.int64)
        bin_of, offset, fill = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        back = np.zeros(len(fill), bool) if last else _give_back(fill, bound, capacity)
        number = (turn << 57) | (int(rows["part"].iloc[0]) << 33)
        return pd.DataFrame({"item": rows["item"], "length": rows["length"], "sequence_id": number + bin_of, "offset": offset, "closed": ~back[bin_of]})

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, partition_rows: int = PARTITION_ROWS, least_closed: float = LEAST_CLOSED) -> DataFrame:
    """(item, length) -> (item, sequence_id, offset).

    Rounds go on until one partition is left or a round closes less than
    ``least_closed`` of its documents: with lengths whose bounds are weak, every
    partition keeps its gap however often its documents are exchanged.

    ``item`` is unique and at least 0, ``length`` at most ``capacity``; the rows
    must not change between reads (written or checkpointed).  A full item is a
    sequence of its own, numbered below 0; packed sequences are numbered by
    round, partition and bin.
    """
    placed = items.filter(F.col("length") == capacity).select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.filter(F.col("length") < capacity).select("item", "length")
    left, turn = rest.count(), 1
    while left:
        parts = math.ceil(left / partition_rows)
        dealt = rest.withColumn("part", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(parts)).cast("long"))
        now = cut(dealt.groupBy("part").applyInPandas(_pack(capacity, turn, parts == 1), _PLACED_SQL))
        rest, before = now.filter("not closed").select("item", "length"), left
        left = rest.count()
        if parts > 1 and before - left < least_closed * before:
            placed, left = placed.unionByName(now.select("item", "sequence_id", "offset")), 0
        else:
            placed = placed.unionByName(now.filter("closed").select("item", "sequence_id", "offset"))
        turn += 1
    return placed


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences, lower bound) of a whole packing; the histogram has ``capacity`` rows at most."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in packed.groupBy("length").count().collect():
        count[length] = n
    return packed.select("sequence_id").distinct().count(), lower_bound(count, capacity) if count.any() else 0


def pack_documents(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, closing: int = CLOSING_ID, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    items = written(pieces(docs, path, pattern, capacity, closing), "pieces")
    placed = pack(items, capacity, partition_rows)
    return items.join(placed, "item").select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
