from __future__ import annotations

import hashlib
import random
import zlib

import pytest
import xxhash

from lodgepole.llm.suffix_dedup import remove_repeats, without_repeats


def brute(rows, length=100):
    seen: dict[bytes, tuple] = {}
    out = []
    keyed = [(-(1 << 63) if i is None else i, (t or "").encode()) for i, t in rows]
    for doc, raw in sorted(set(keyed)):
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            seen[w] = min(seen.get(w, (doc, s)), (doc, s))
    for (doc, raw), (orig, _) in zip(keyed, rows, strict=True):
        gone = [False] * len(raw)
        for s in range(len(raw) - length + 1):
            if seen[raw[s : s + length]] < (doc, s):
                gone[s : s + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((orig, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(400)}é" for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = say(40), say(12)
    rows = []
    for i in range(60):
        text = say(rng.randrange(5, 120))
        if i % 3 == 0:
            text = say(rng.randrange(0, 9)) + passage[rng.randrange(20) :] + say(rng.randrange(20))
        if i % 4 == 0:
            text += "".join(say(rng.randrange(1, 4)) + line + " " for _ in range(6))
        if i % 7 == 0 and rows:
            text = rows[rng.randrange(len(rows))][1]
        if i % 11 == 0:
            text = text * 2
        rows.append((i, text))
    rows += [(100, None), (101, ""), (102, "ab" * 400), (103, "x" * 99), (104, "x" * 100), (None, rows[5][1]), (105, "y" * 5000), (106, "y" * 101)]
    rows.append(rows[3])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [64, 1])
def test_equals_brute_force(docs, hot):
    rows = corpus(hot)
    got = remove_repeats(docs(rows, {"kind": "1", "block": "2", "blob": "'x'"}), hot_classes=hot)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_segments_of_long_texts(docs, monkeypatch):
    import lodgepole.llm.suffix_dedup as m

    rows = corpus(9)
    rows = [(i, t) for i, t in rows]
    monkeypatch.setattr(m, "_SEGMENT", 150)
    import numpy as np

    raw = max((t for _, t in rows if t), key=len).encode()
    owned = np.concatenate([np.concatenate([np.arange(s, e + 1) + base for s, e in zip(st, en, strict=True)]) for st, en, _, _, _, base in m._segments(raw, 100, 48)])
    assert owned.tolist() == list(range(len(raw) - 99))


def by_id_start_and_hash(rows, length=100):
    """(doc_id, removed bytes), where rows of one id (null first) are ordered by start, then by hash of the text."""
    place = lambda i, raw, s: (i is not None, i or 0, s, xxhash.xxh3_64_intdigest(raw))
    first: dict[bytes, tuple] = {}
    coded = [(i, (t or "").encode()) for i, t in rows]
    for i, raw in coded:
        for s in range(len(raw) - length + 1):
            w, p = raw[s : s + length], place(i, raw, s)
            first[w] = min(first.get(w, p), p)
    out = []
    for i, raw in coded:
        gone = set()
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < place(i, raw, s):
                gone.update(range(s, s + length))
        out.append((i, len(raw), len(gone)))
    return sorted(out, key=str)


def test_rows_without_ids_and_of_one_id_are_told_apart(docs):
    rng = random.Random(12)
    shared = [" ".join(str(rng.randrange(10**6)) for _ in range(17)) for _ in range(300)]
    rows = [(None, rng.choice(shared) if rng.random() < 0.4 else " ".join(str(rng.randrange(10**6)) for _ in range(17))) for _ in range(20_000)]
    rows += [(2, " ".join(shared[i : i + 2])) for i in range(0, 300, 3)]
    # -2**63 is an id like any other: it comes after the rows without one
    rows += [(-(1 << 63), shared[0] + " own words of it"), (-(1 << 63), shared[7]), (5, shared[0])]
    got = remove_repeats(docs(rows)).select("doc_id", "n_bytes", "n_removed").collect()
    assert sorted(map(tuple, got), key=str) == by_id_start_and_hash(rows)


def test_texts_whose_short_checksums_agree(docs):
    """Two texts under one id with the same last 24 bits of CRC-32; one is a copy of an earlier document."""
    rng = random.Random(3)
    copy = rng.randbytes(128).hex()
    want = zlib.crc32(copy.encode()) & 0xFFFFFF
    other = next(t for t in (f"{i:0256d}" for i in range(1 << 27)) if zlib.crc32(t.encode()) & 0xFFFFFF == want)
    rows = [(1, copy), (2, copy), (2, other[::-1][:0] + other)]
    got = {(r.doc_id, r.n_removed) for r in remove_repeats(docs(rows)).collect()}
    assert (2, 256) in got and (1, 0) in got


def test_empty_table(docs):
    assert remove_repeats(docs([])).collect() == []


def test_texts_and_other_columns_stay_together(docs):
    text = " ".join(str(i * i) for i in range(200))
    rows = [(1, text), (2, "new " + text + " end"), (3, None), (None, "no id"), (2, "another text of the same id"), (1, text)]
    df = docs(rows, {"block": "doc_id * 2", "when": "timestamp'2020-01-01 00:00:00'", "list": "array(doc_id, 7)"})
    got = without_repeats(df)
    assert got.columns == [*df.columns, "n_removed"] and got.drop("n_removed").dtypes == df.dtypes
    key = lambda r: (str(r[0]), str(r[1]))
    expected = [(1, text, 0), (1, text, 0), (2, "new  end", len(text)), (3, None, 0), (None, "no id", 0), (2, "another text of the same id", 0)]
    rows_ = sorted(got.collect(), key=key)
    assert [(r.doc_id, r.text, r.n_removed) for r in rows_] == sorted(expected, key=key)
    assert all(r["block"] == (None if r.doc_id is None else r.doc_id * 2) and r["list"] == [r.doc_id, 7] for r in rows_)
    assert without_repeats(docs([])).collect() == []


def test_cut_characters_go(docs):
    shared = "é" * 80  # 160 bytes; windows of 100 bytes start at every byte
    got = {r.doc_id: r.text for r in without_repeats(docs([(1, "a" + shared), (2, "è" + shared + "è")])).collect()}
    assert got[2].strip("è") == ""
