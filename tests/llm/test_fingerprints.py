from __future__ import annotations

import hashlib
import random

import pytest

from lodgepole.llm import fingerprints as fp


def lz78(text):
    phrases, now = set(), ""
    for c in text:
        now += c
        if now not in phrases:
            phrases.add(now)
            now = ""
    return phrases


def words(seed, n, vocabulary=300):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("text", ["", "a", "aaaaaaaaaaaa", "abababab" * 30, "😀é" * 20, words(1, 400), "x" * 5000 + words(2, 50)])
def test_phrases_equal_plain_parse(text):
    phrases, ends = fp.parse(text)
    assert phrases == lz78(text)
    assert not text or ends[-1] == len(text)


def brute(rows):
    texts = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    import numpy as np

    sig = lambda t: np.frombuffer(bytes.fromhex(fp.fingerprint(t)), ">u4").astype(np.uint32)
    out = []
    for (i, t), (_, nxt) in zip(texts, texts[1:] + texts[:1], strict=True):
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.fingerprint(t), fp.fingerprint(e), fp.likeness(sig(t), sig(e)), fp.likeness(sig(t), sig(nxt))))
    return sorted(out, key=lambda r: str(r[0]))


@pytest.mark.parametrize("parts", ["1", "4", "37"])
def test_equals_brute_force(spark, docs, parts):
    rng = random.Random(5)
    rows = [(rng.randrange(10**9), words(i, rng.randrange(0, 150))) for i in range(60)]
    rows += [(-5, None), (7, ""), (8, "a"), (9, "é😀z"), (None, "no id " * 30), (10**12, words(3, 5000))]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = sorted((tuple(r) for r in fp.compare_with_next(docs(rows, {"part": "1", "digest": "2", "last": "'x'"})).collect()), key=lambda r: str(r[0]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == brute(rows)


def test_likeness_tells_texts_apart(docs):
    base = words(1, 600)
    near = base.replace("w17 ", "w18 ")
    far = words(2, 600, 100000)
    f = lambda t: __import__("numpy").frombuffer(bytes.fromhex(fp.fingerprint(t)), ">u4")
    assert fp.likeness(f(base), f(base)) == 1.0
    assert fp.likeness(f(base), f(near)) > 0.4 > 0.2 > fp.likeness(f(base), f(far))


def test_one_row_repeats_and_empty(docs):
    assert fp.compare_with_next(docs([])).collect() == []
    one = fp.compare_with_next(docs([(1, "abc abd")])).first()
    assert one.near_next == 1.0
    same = fp.compare_with_next(docs([(1, "abc abd")] * 5)).collect()
    assert len(same) == 5 and len(set(same)) == 1


@pytest.mark.parametrize("text", ["", "a", "ab", "aaaaaaaaaaaa", "abababab" * 30, "😀é" * 20, words(1, 400), words(6, 401), "x" * 500 + words(2, 50)])
def test_an_edit_is_parsed_and_hashed_from_its_branch_on(monkeypatch, text):
    """Neither the kept half nor what the next text has hashed is hashed again."""
    nexts = ["", "b", "abababab" * 10, words(4, 500), text]
    now, after = fp._Parsed(text, fp.SIZE), [fp._Parsed(t, fp.SIZE) for t in nexts]
    hashed = []
    monkeypatch.setattr(fp, "code_points", lambda t: hashed.append(t))
    made = [now.edit(n) for n in after]
    monkeypatch.undo()
    assert hashed == []
    for (changed, sig), n in zip(made, nexts, strict=True):
        assert changed == fp.edited(text, n)
        assert sig.astype(">u4").tobytes().hex() == fp.fingerprint(changed)
    assert now.ends == fp.parse(text)[1] and now.phrases == lz78(text)
