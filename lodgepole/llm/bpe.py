"""Byte-level BPE by a global shuffle of distinct words.

1. Texts are split by the tokenizer's pattern into pre-tokens.  A chunk of
   documents (one task's batch) is shuffled as the sequence of its pre-tokens,
   each given by its number among the chunk's distinct words: the positions.
2. The distinct words of all chunks are shuffled by the hash of the word, as
   compressed blocks.  In a block every distinct word is encoded once, however
   many chunks hold it.
3. The ids go back to the chunks, where they are placed by position, cut into
   documents and digested.  Decoding joins each id with the token-byte table
   (as many rows as the vocabulary, a bound known before).

A word that a third of all rows hold is in each chunk once, so no block is
hot.  Positions and words leave the splitting step in one shuffle, which both
the encoding and the placing step read, so texts are split once and nothing is
written twice.

Encoding gives the ids of the ``tiktoken`` library with the same ranks and
pattern and no special tokens: strings that look like special tokens are
ordinary text.  Defined results: null text counts as empty (no ids); repeated
rows and rows with a null doc_id are encoded each on their own; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import math
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgepole.llm.common import gathered, small_batches, text_bytes

CHUNK_CHARS = 24 << 20
BLOCK_BYTES = 64 << 20
MIN_BLOCK_BYTES = 4 << 20


@lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoding_of(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all bytes by id, start and length of each."""
    ranks = ranks_of(path)
    by_id = [b""] * (max(ranks.values()) + 1)
    for b, i in ranks.items():
        by_id[i] = b
    size = np.array([len(b) for b in by_id], np.int64)
    return np.frombuffer(b"".join(by_id), np.uint8), np.cumsum(size) - size, size


def split_pattern(pattern: str) -> regex.Pattern:
    r"""The pattern for the ``regex`` library; ``\s`` is spelt out as Unicode White_Space."""
    return regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenation of flat[start:start+size] for all pairs."""
    ends = np.cumsum(size)
    return flat[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def _zip(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _unzip(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _word_block(words: list[bytes]) -> bytes:
    return _zip(np.array([len(words), *map(len, words)], np.uint32).tobytes() + b"".join(words))


def _block_words(blob: bytes) -> list[bytes]:
    raw = _unzip(blob)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = np.cumsum(np.frombuffer(raw, np.uint32, n, 4).astype(np.int64)) + 4 * (n + 1)
    return [raw[a:b] for a, b in zip(np.concatenate(([4 * (n + 1)], ends[:-1])).tolist(), ends.tolist(), strict=True)] if n else []


def _name(ids: list, counts: list[int], planes: bytes, words: list[bytes]) -> str:
    """Name of a chunk from all it holds: only chunks of equal rows share one, and these have equal blocks."""
    h = hashlib.sha256(np.array([i is None for i in ids], np.uint8).tobytes())
    h.update(np.array([0 if i is None else i for i in ids], np.int64).tobytes())
    h.update(np.array([len(ids), *counts, *map(len, words)], np.int64).tobytes())
    h.update(planes)
    for w in words:
        h.update(w)
    return h.hexdigest()


# A shuffled row: positions of a chunk (key c<chunk>) or words of a chunk in a block (key b<block>).
_PART = pa.schema([("key", pa.string()), ("chunk", pa.string()), ("block", pa.int32()), ("doc_id", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())), ("blob", pa.binary())])
_PART_SQL = "key string, chunk string, block int, doc_id array<long>, n_words array<int>, blob binary"


def _split(pattern: str, blocks: int):
    """Chunks: pre-tokens by position, and their distinct words by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = split_pattern(pattern).findall
        for ids, texts in gathered(batches, CHUNK_CHARS, ("doc_id", "text"), "text"):
            numbers = _Numbers()
            places, counts = array("i"), []
            for t in texts:
                found = find(t) if t else ()
                places.extend(map(numbers.__getitem__, found))
                counts.append(len(found))
            words = [w.encode() for w in numbers]
            home = np.array([xxhash.xxh3_64_intdigest(w) % blocks for w in words], np.int64)
            # words are numbered anew, by block and then by bytes: a block's words compress well and need no numbers
            order = sorted(range(len(words)), key=lambda i: (home[i], words[i]))
            number = np.empty(len(words), np.int32)
            number[order] = np.arange(len(words), dtype=np.int32)
            cuts = np.searchsorted(home[order], np.arange(blocks + 1))
            at = number[np.frombuffer(places, np.int32)] if len(places) else np.zeros(0, np.int32)
            # byte planes compress better than whole integers
            planes = at.view(np.uint8).reshape(-1, 4).T.tobytes()
            chunk = _name(ids, counts, planes, [words[i] for i in order])
            rows = [{"key": f"c{chunk}", "chunk": chunk, "doc_id": ids, "n_words": counts, "blob": _zip(planes)}]
            for b in range(blocks):
                if cuts[b] < cuts[b + 1]:
                    rows.append({"key": f"b{b}", "chunk": chunk, "block": b, "blob": _word_block([words[i] for i in order[cuts[b] : cuts[b + 1]]])})
            yield pa.RecordBatch.from_pylist(rows, schema=_PART)

    return run


_IDS = pa.schema([("key", pa.string()), ("block", pa.int32()), ("ids", pa.binary())])


def _encode(path: str, pattern: str):
    """Encode each distinct word of a block once; ids for every chunk that holds it."""

    def run(group: pa.Table) -> pa.Table:
        if group.column("block")[0].as_py() is None:
            return _IDS.empty_table()
        one = encoding_of(path, pattern)._encode_single_piece
        known: dict[bytes, list[int]] = {}
        rows = []
        for chunk, block, blob in zip(*(group.column(c).to_pylist() for c in ("chunk", "block", "blob")), strict=True):
            flat, size = array("I"), array("I")
            for w in _block_words(blob):
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = one(w)
                flat.extend(ids)
                size.append(len(ids))
            rows.append((f"c{chunk}", block, _zip(np.uint32(len(size)).tobytes() + size.tobytes() + flat.tobytes())))
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _IDS, strict=True)], schema=_IDS)

    return run


_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.binary())])


def _place(path: str, with_ids: bool):
    """Ids by position: documents of the chunk, encoded and decoded."""
    schema = _OUT if with_ids else pa.schema(list(_OUT)[:4])

    def run(key: tuple, chunks: pa.Table, ids: pa.Table) -> pa.Table:
        if not chunks.num_rows or chunks.column("block")[0].as_py() is not None:
            return schema.empty_table()
        all_bytes, start_of, size_of = token_bytes(path)
        sizes, flats, seen = [], [], set()
        for block, blob in sorted(zip(ids.column("block").to_pylist(), ids.column("ids").to_pylist(), strict=True)):
            if block in seen:  # chunks with equal rows have equal keys and equal blocks
                continue
            seen.add(block)
            raw = np.frombuffer(_unzip(blob), np.uint32)
            sizes.append(raw[1 : 1 + raw[0]].astype(np.int64))
            flats.append(raw[1 + raw[0] :])
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        flat = np.concatenate(flats) if flats else np.zeros(0, np.uint32)
        start = np.cumsum(size) - size
        rows = []
        for doc_ids, counts, places in zip(*(chunks.column(c).to_pylist() for c in ("doc_id", "n_words", "blob")), strict=True):
            at = np.ascontiguousarray(np.frombuffer(_unzip(places), np.uint8).reshape(4, -1).T).view(np.int32).ravel()
            ends = np.cumsum(np.array(counts, np.int64))
            for doc, a, b in zip(doc_ids, (ends - np.array(counts, np.int64)).tolist(), ends.tolist(), strict=True):
                words = at[a:b]
                tokens = gather(flat, start[words], size[words])
                decoded = gather(all_bytes, start_of[tokens], size_of[tokens]).tobytes()
                raw = tokens.astype("<u4").tobytes()
                rows.append((doc, len(tokens), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest(), *([raw] if with_ids else [])))
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) if rows else schema.empty_table()

    return run


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """One row per document: tokens, digests of the ids and of the decoded bytes.

    ``path`` names a rank file that every executor has; ``with_ids`` adds the
    ids as little-endian unsigned 32-bit integers.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    small_batches(docs.sparkSession)
    parts, size = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), text_bytes(rows)
    blocks = max(1, min(parts, math.ceil(size / MIN_BLOCK_BYTES)), math.ceil(size / BLOCK_BYTES))
    dealt = rows.mapInArrow(_split(pattern, blocks), _PART_SQL)
    ids = dealt.groupBy("key").applyInArrow(_encode(path, pattern), "key string, block int, ids binary")
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if with_ids else "")
    return dealt.groupBy("key").cogroup(ids.groupBy("key")).applyInArrow(_place(path, with_ids), out)
