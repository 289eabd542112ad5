"""Repeated-substring removal by blockwise suffix sorting over a difference cover.

Two suffixes belong together when their first ``length`` (100) bytes are equal.
Sorting all suffixes would move several bytes for every byte of text, so only
the suffixes of a *difference cover* are sorted.  A cover for ``length`` has
the property that any two suffixes with equal first ``length`` bytes have cover
positions at one common distance.  The cover here is content-defined: in every
window of ``length`` bytes the position whose ``gram`` (48) bytes hash lowest,
leftmost first.  Equal windows choose the same distance by construction, and
about 4 % of the positions are taken (an arithmetic cover modulo 73 needs
12 %).

1. *Cover sample*: each cover position p serves one run of window starts
   [st, en].  Its key is the hash of the gram at p, its context the hash of
   all bytes its windows touch.
2. *Blocks*: sample suffixes are dealt to blocks by key; a block is sorted
   alone, by (key, context, document, start).  The first entry of each
   (key, context) is the rank of that class: longer ties than the gram are
   resolved by these ranks, without comparing text.
3. A key with one class is settled: in the class' first member no window is
   repeated earlier, in all others every window is.  For a key with several
   classes (edges of copied passages) the windows of the class firsts are
   hashed, dealt to blocks and sorted the same way.
4. Documents meet the firsts of their own windows; every other window start
   is a repeat, and the bytes such windows cover go.

Only hashes, first occurrences and compressed texts are moved.  A key shared by
a third of all rows is folded to one entry per class in each task before the
shuffle; a key that still has many classes in a task (``hot``) skips the key
block: its windows, of which each distinct one is moved once per task, decide.

Defined results: null text counts as empty; texts shorter than ``length`` keep
all bytes; a null doc_id comes before all others; rows with one doc_id are
ordered by start, then by a 64-bit hash of the text, which tells them apart, so
fully identical rows count as one document and get equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc  # noqa: F401  (pa.ipc)
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lodgepole.llm.common import U64, gathered, mix, pack, prefix_hash, release, sliced, sliding_min, small_batches, span_hash, text_bytes, unpack

LENGTH = 100
GRAM = 48
HOT_CLASSES = 64
BATCH_CHARS = 8 << 20
BLOCK_BYTES = 12 << 20
_SEGMENT = 1 << 20
_NO_ID = -(1 << 63)
_AFTER_NULL = 1 << 40
# what a blob holds: sample entries, marks of hot keys, firsts whose windows are all settled or
# are still open, documents, windows, first windows
_ENTRIES, _MARKS, _CLOSED, _OPEN, _TEXTS, _WINDOWS, _NEW = range(7)
_TABLE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def _segments(raw: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(st, en, key, context, prefix hash, offset) of the cover, segment by segment.

    A very long text is cut into overlapping segments, so that the work arrays
    stay bounded; every window start belongs to exactly one segment.
    """
    n_windows = len(raw) - length + 1
    data = np.frombuffer(raw, np.uint8)
    for base in range(0, n_windows, _SEGMENT):
        here = data[base : min(base + _SEGMENT, n_windows) + length - 1]
        prefix = prefix_hash(_TABLE[here])
        starts = np.arange(len(here) - gram + 1)
        # lowest hash, leftmost first: the low 21 bits of the hash give way to the position
        code = (span_hash(prefix, starts, starts + gram) & ~U64(0x1FFFFF)) | starts.astype(U64)
        best = (sliding_min(code, length - gram + 1) & U64(0x1FFFFF)).astype(np.int64)
        st = np.flatnonzero(np.diff(best, prepend=-1))
        en = np.append(st[1:], len(best)) - 1
        at = best[st]
        key = span_hash(prefix, at, at + gram)
        context = span_hash(prefix, st, en + length) ^ mix(((at - st) * 4096 + (en - st)).astype(U64))
        yield st, en, key, context, prefix, base


def _window_hashes(prefix: np.ndarray, st: np.ndarray, en: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of the runs and the hashes of their bytes."""
    n = en - st + 1
    starts = np.repeat(st - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    return starts, span_hash(prefix, starts, starts + length)


def _tag(raw: bytes) -> int:
    """64 bits of a text: with the doc_id it names the row."""
    return xxhash.xxh3_64_intdigest(raw)


def _shift(doc: int, null: bool) -> int:
    """Added to the starts of the one legal id that stands for null ids too, so that it comes after them."""
    return _AFTER_NULL if doc == _NO_ID and not null else 0


def _firsts(order: tuple[np.ndarray, ...], *groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort by groups, then order; the sorted index and the mask of group firsts."""
    by = np.lexsort((*reversed(order), *reversed(groups)))
    new = np.ones(len(by), bool)
    if len(by):
        new[1:] = np.any([g[by][1:] != g[by][:-1] for g in groups], axis=0)
    return by, new


def _deal(kind: int, blocks: int, keys: np.ndarray, *arrays: np.ndarray, place: np.ndarray | None = None) -> Iterator[tuple[int, int, bytes]]:
    """Blobs of the arrays, one for each block of keys, in it by ``place`` (neighbours of one text compress).

    Keys of cover positions are lowest hashes, so they crowd near zero; another
    hash of the key deals them evenly.
    """
    if not len(keys):
        return
    home = ((mix(keys) >> U64(32)).astype(np.int64) * blocks) >> 32
    by = np.argsort(home, kind="stable") if place is None else np.argsort((home << 32) | place)
    cuts = np.flatnonzero(np.diff(home[by])) + 1
    for part in np.split(by, cuts):
        yield kind, int(home[part[0]]), pack(keys[part], *(a[part] for a in arrays))


def _to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_BLOB = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("blob", pa.binary())])
_BLOB_SQL = "kind int, block long, blob binary"


def _doc_block(ids: np.ndarray, tags: np.ndarray, blocks: int) -> np.ndarray:
    """By id and text tag, so that rows sharing one id (or none) are spread as well."""
    return ((mix(ids.view(U64) ^ mix(tags)) >> U64(32)).astype(np.int64) * blocks) >> 32


def _sample(length: int, gram: int, blocks: int, hot: int):
    """Cover sample of a task's documents, folded by (key, context) and dealt to key blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in gathered(batches, BATCH_CHARS, ("doc_id", "text"), "text"):
            parts: list[list[np.ndarray]] = [[], [], [], [], []]
            for doc, text in zip(ids, texts, strict=True):
                raw = (text or "").encode()
                if len(raw) < length:
                    continue
                tag, null = _tag(raw), doc is None
                doc = _NO_ID if null else doc
                for st, _, key, context, _, base in _segments(raw, length, gram):
                    for held, a in zip(parts, (key, context, np.full(len(st), doc, np.int64), st + (base + _shift(doc, null)), np.full(len(st), tag, U64)), strict=True):
                        held.append(a)
            if not parts[0]:
                continue
            key, context, doc, at, tag = map(np.concatenate, parts)
            by, new = _firsts((doc, at, tag), key, context)
            by = by[new]
            key, context, doc, at, tag = key[by], context[by], doc[by], at[by], tag[by]
            # a key with many classes in this one task is told to its block by a mark only
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            many = np.repeat(np.diff(np.append(starts, len(key))), np.diff(np.append(starts, len(key)))) > hot
            one = ~many
            rows = [*_deal(_ENTRIES, blocks, key[one], context[one], doc[one], at[one], tag[one], place=by[one])]
            if many.any():
                marks = key[starts][many[starts]]
                rows += _deal(_MARKS, blocks, marks, marks)
                rows += _deal_firsts(_OPEN, blocks, doc[many], at[many], tag[many])
            yield _to_batch(rows, _BLOB)

    return run


def _deal_firsts(kind: int, blocks: int, doc: np.ndarray, at: np.ndarray, tag: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """First occurrences, sorted and delta-coded, one blob for each block of documents."""
    if not len(doc):
        return
    home = _doc_block(doc, tag, blocks)
    by = np.lexsort((at, tag, doc, home))
    for part in np.split(by, np.flatnonzero(np.diff(home[by])) + 1):
        yield kind, int(home[part[0]]), pack(np.diff(doc[part], prepend=np.int64(0)), np.diff(at[part], prepend=np.int64(0)), tag[part])


def _load_firsts(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [unpack(b, "i8", "i8", "u8") for b in blobs]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    doc, at = (np.concatenate([np.cumsum(p[i]) for p in parts]) for i in (0, 1))
    return doc, at, np.concatenate([p[2] for p in parts])


def _sort_keys(blocks: int, wanted: int):
    """Sort one key block: the class firsts whose key has no other class (``_CLOSED``) or has some (``_OPEN``).

    The two are used at different steps, so each step sorts for its own and moves no other.
    First occurrences of hot keys are open and pass through; their blocks are of documents.
    """

    def run(group: pa.Table) -> pa.Table:
        release()
        kinds = group.column("kind").to_pylist()
        blobs = group.column("blob").to_pylist()
        rows: list[tuple] = []
        parts = [unpack(b, "u8", "u8", "i8", "i8", "u8") for k, b in zip(kinds, blobs, strict=True) if k == _ENTRIES]
        marks = [unpack(b, "u8", "u8")[0] for k, b in zip(kinds, blobs, strict=True) if k == _MARKS]
        rows += [(k, h, b) for k, h, b in zip(kinds, group.column("block").to_pylist(), blobs, strict=True) if k == wanted]
        if parts:
            key, context, doc, at, tag = (np.concatenate(c) for c in zip(*parts, strict=True))
            by, new = _firsts((doc, at, tag), key, context)
            by = by[new]
            key, doc, at, tag = key[by], doc[by], at[by], tag[by]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            n = np.diff(np.append(starts, len(key)))
            open_ = np.repeat(n, n) > 1
            if marks:
                open_ |= np.isin(key, np.concatenate(marks))
            mine = open_ if wanted == _OPEN else ~open_
            rows += _deal_firsts(wanted, blocks, doc[mine], at[mine], tag[mine])
        return pa.Table.from_batches([_to_batch(rows, _BLOB)] if rows else [], _BLOB)

    return run


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches in tables of about ``BATCH_CHARS`` characters of text."""
    held, size = [], 0
    for b in sliced(batches):
        held.append(b)
        size += b.column("__text").nbytes + 16 * b.num_rows
        if size >= BATCH_CHARS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _to_ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _chunks(blocks: int):
    """Documents dealt to blocks, compressed: ids, other columns, texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(batches):
            ids, texts = table.column("__doc").to_pylist(), table.column("__text").to_pylist()
            others = table.drop_columns(["__doc", "__text"])
            null = np.array([i is None for i in ids])
            doc = np.array([_NO_ID if i is None else i for i in ids], np.int64)
            raw = [(t or "").encode() for t in texts]
            home = _doc_block(doc, np.array([_tag(r) for r in raw], U64), blocks)
            rows = []
            by = np.argsort(home, kind="stable")
            for part in np.split(by, np.flatnonzero(np.diff(home[by])) + 1):
                raws = [raw[i] for i in part]
                meta = pack(doc[part], np.array([len(r) for r in raws], np.int64), null[part].astype(np.uint8), np.array([texts[i] is None for i in part], np.uint8))
                carried = _to_ipc(others.take(pa.array(part))) if others.num_columns else b""
                sizes = np.array([len(meta), len(carried)], np.int64).tobytes()
                rows.append((_TEXTS, int(home[part[0]]), sizes + meta + carried + zstandard.ZstdCompressor(level=3).compress(b"".join(raws))))
            yield _to_batch(rows, _BLOB)

    return run


def _parts(blob: bytes) -> tuple[bytes, bytes, bytes]:
    meta, carried = np.frombuffer(blob, np.int64, 2).tolist()
    return blob[16 : 16 + meta], blob[16 + meta : 16 + meta + carried], blob[16 + meta + carried :]


def _documents(blobs: list[bytes]) -> Iterator[tuple[int, bytes, bool, bool]]:
    for blob in blobs:
        meta, _, texts = _parts(blob)
        doc, size, null, no_text = unpack(meta, "i8", "i8", "u1", "u1")
        raw = zstandard.ZstdDecompressor().decompress(texts) if size.sum() else b""
        at = 0
        for d, s, x, t in zip(doc.tolist(), size.tolist(), null.tolist(), no_text.tolist(), strict=True):
            yield d, raw[at : at + s], bool(x), bool(t)
            at += s


def _carried(blobs: list[bytes]) -> pa.Table:
    """The other columns of the documents, in the order of ``_documents``."""
    return pa.concat_tables([pa.ipc.open_stream(_parts(b)[1]).read_all() for b in blobs])


class _Starts:
    """First occurrences of a block, looked up by document."""

    def __init__(self, blobs: list[bytes]) -> None:
        doc, at, tag = _load_firsts(blobs)
        by = np.lexsort((at, tag, doc))
        self.doc, self.at, self.tag = doc[by], at[by], tag[by]

    def of(self, doc: int, null: bool, tag: int) -> np.ndarray:
        lo, hi = np.searchsorted(self.doc, doc, "left"), np.searchsorted(self.doc, doc, "right")
        a, b = lo + np.searchsorted(self.tag[lo:hi], U64(tag), "left"), lo + np.searchsorted(self.tag[lo:hi], U64(tag), "right")
        at = self.at[a:b] - _shift(doc, null)
        return at[(at >= 0) & (at < _AFTER_NULL)]


def _open_windows(length: int, gram: int, blocks: int):
    """Windows of class firsts whose key has other classes, folded and dealt by hash."""

    def run(key: tuple, chunks: pa.Table, firsts: pa.Table) -> pa.Table:
        release()
        found = _Starts(firsts.column("blob").to_pylist())
        parts: list[list[np.ndarray]] = [[], [], [], []]
        for doc, raw, null, _ in _documents(chunks.column("blob").to_pylist()):
            if len(raw) < length:
                continue
            tag = _tag(raw)
            wanted = found.of(doc, null, tag)
            for st, en, _, _, prefix, base in _segments(raw, length, gram):
                mine = np.isin(st + base, wanted)
                if mine.any():
                    starts, hashes = _window_hashes(prefix, st[mine], en[mine], length)
                    parts[0].append(hashes)
                    parts[1].append(np.full(len(starts), doc, np.int64))
                    parts[2].append(starts + (base + _shift(doc, null)))
                    parts[3].append(np.full(len(starts), tag, U64))
        rows: list[tuple] = []
        if parts[0]:
            hashes, docs, at, tags = map(np.concatenate, parts)
            by, new = _firsts((docs, at, tags), hashes)
            by = by[new]
            rows = [*_deal(_WINDOWS, blocks, hashes[by], docs[by], at[by], tags[by], place=by)]
        return pa.Table.from_batches([_to_batch(rows, _BLOB)] if rows else [], _BLOB)

    return run


def _sort_windows(blocks: int):
    """Sort one block of windows: the first of each."""

    def run(group: pa.Table) -> pa.Table:
        release()
        hashes, doc, at, tag = (np.concatenate(c) for c in zip(*(unpack(b, "u8", "i8", "i8", "u8") for b in group.column("blob").to_pylist()), strict=True))
        by, new = _firsts((doc, at, tag), hashes)
        by = by[new]
        rows = [*_deal_firsts(_NEW, blocks, doc[by], at[by], tag[by])]
        return pa.Table.from_batches([_to_batch(rows, _BLOB)], _BLOB)

    return run


def _covered(starts: np.ndarray, n: int, length: int) -> tuple[np.ndarray, int]:
    """Mask of the bytes that windows at ``starts`` cover, and the number of runs."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    mask = np.cumsum(edge[:-1]) > 0
    return mask, int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1])) if n else 0


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
_OUT_SQL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _kept(length: int, gram: int, chunks: pa.Table, firsts: pa.Table) -> Iterator[tuple[int | None, bytes, bytes | None, int, int]]:
    """(doc_id, text, remaining bytes, removed bytes, removed runs) of a block's documents."""
    release()
    kinds, blobs = firsts.column("kind").to_pylist(), firsts.column("blob").to_pylist()
    classes = _Starts([b for k, b in zip(kinds, blobs, strict=True) if k == _CLOSED])
    windows = _Starts([b for k, b in zip(kinds, blobs, strict=True) if k == _NEW])
    for doc, raw, null, no_text in _documents(chunks.column("blob").to_pylist()):
        kept, removed, spans = raw, 0, 0
        if len(raw) >= length:
            tag = _tag(raw)
            closed = classes.of(doc, null, tag)
            new = np.zeros(len(raw) - length + 1, bool)
            new[windows.of(doc, null, tag)] = True
            for st, en, _, _, _, base in _segments(raw, length, gram):
                for s, e in zip(st[m := np.isin(st + base, closed)] + base, en[m] + base, strict=True):
                    new[s : e + 1] = True
            mask, spans = _covered(np.flatnonzero(~new), len(raw), length)
            removed = int(mask.sum())
            if removed:
                kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        yield None if null else doc, raw, None if no_text else kept, removed, spans


def _report(length: int, gram: int):
    def run(key: tuple, chunks: pa.Table, firsts: pa.Table) -> pa.Table:
        rows = [(doc, len(raw), removed, spans, hashlib.sha256(kept or b"").hexdigest()) for doc, raw, kept, removed, spans in _kept(length, gram, chunks, firsts)]
        return pa.Table.from_batches([_to_batch(rows, _OUT)] if rows else [], _OUT)

    return run


def _rewrite(length: int, gram: int, names: list[str], schema: pa.Schema):
    """The documents themselves, with what is left of their texts."""

    def run(key: tuple, chunks: pa.Table, firsts: pa.Table) -> pa.Table:
        rows = list(_kept(length, gram, chunks, firsts))
        # a removed run may start or end inside a character: what is left of it goes as well
        if not rows:
            return schema.empty_table()
        text = pa.array([None if kept is None else kept.decode("utf-8", "ignore") for _, _, kept, _, _ in rows], pa.string())
        removed = pa.array([n for _, _, _, n, _ in rows], pa.int64())
        others = iter(_carried(chunks.column("blob").to_pylist()).columns if len(names) > 1 else ())
        return pa.table([text if n == "text" else next(others) for n in names] + [removed], names=schema.names)

    return run


def _settled(docs: DataFrame, others: list[str], length: int, gram: int, hot_classes: int) -> tuple[DataFrame, DataFrame]:
    """Chunks of the documents, and the first occurrences that settle their windows, both by block."""
    spark = docs.sparkSession
    small_batches(spark)
    doc, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    blocks = max(parts, math.ceil(text_bytes(docs.select(text.alias("text"))) / BLOCK_BYTES))
    keyed = docs.select(doc.alias("doc_id"), text.alias("text"))
    sample = keyed.mapInArrow(_sample(length, gram, blocks, hot_classes), _BLOB_SQL)
    closed, unsettled = (sample.groupBy("block").applyInArrow(_sort_keys(blocks, kind), _BLOB_SQL) for kind in (_CLOSED, _OPEN))
    # the other columns go by number, so that none can clash
    carried = [F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(others)]
    chunks = docs.select(doc.alias("__doc"), text.alias("__text"), *carried).mapInArrow(_chunks(blocks), _BLOB_SQL)
    open_ = chunks.groupBy("block").cogroup(unsettled.groupBy("block")).applyInArrow(_open_windows(length, gram, blocks), _BLOB_SQL)
    windows = open_.groupBy("block").applyInArrow(_sort_windows(blocks), _BLOB_SQL)
    return chunks, closed.unionByName(windows)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, hash of what stays.

    See the module docstring for the method and for nulls, ties and repeated rows.
    """
    chunks, firsts = _settled(docs, [], length, gram, hot_classes)
    return chunks.groupBy("block").cogroup(firsts.groupBy("block")).applyInArrow(_report(length, gram), _OUT_SQL)


def without_repeats(docs: DataFrame, removed: str = "n_removed", length: int = LENGTH, gram: int = GRAM, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """``docs`` with what is left of the texts, and the removed bytes in a new column.

    The other columns travel with the texts, so no join brings them back.  Bytes
    left of a character that was cut go as well; a null text stays null.
    """
    others = [c for c in docs.columns if c != "text"]
    chunks, firsts = _settled(docs, others, length, gram, hot_classes)
    schema = StructType([StructField(f.name, StringType() if f.name == "text" else f.dataType) for f in docs.schema] + [StructField(removed, LongType())])
    rewrite = _rewrite(length, gram, docs.columns, to_arrow_schema(schema))
    return chunks.groupBy("block").cogroup(firsts.groupBy("block")).applyInArrow(rewrite, schema)
