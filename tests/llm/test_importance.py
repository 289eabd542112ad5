from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from lodgepole.llm import importance


def plain_features(text, max_n=2):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent, seed, min_words, buckets):
    hashed = lambda t: [crc32(f.encode()) % buckets for f in plain_features(t)[1]]
    s, t = Counter(b for _, x in docs for b in hashed(x)), Counter(b for x in target for b in hashed(x))
    s_all, t_all = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in docs:
        own = hashed(x)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_features(x)[0])])
    can = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for place, r in enumerate(can[: percent * len(can) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def some_docs(rng, n):
    words = ["Alpha", "beta", "x1", "Ünter", "ß", "9", "the", "naïve", "日本", "\x7f"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--", " "]) for _ in range(rng.randrange(0, 40))) for _ in range(n)]
    hot = texts[0] + "copy " * 30
    docs = [(i, hot if i % 3 == 0 else t) for i, t in enumerate(texts)]
    return [*docs, (n, None), (n + 1, ""), (n + 2, "?!"), (n + 3, "word"), (n + 4, "long Word " * 20_000)]


@pytest.mark.parametrize("buckets,parts", [(10_000, 3), (7, 1), (70_000, 5)])
def test_equals_brute_force(spark, docs, buckets, parts):
    rng = random.Random(buckets)
    rows, target = some_docs(rng, 80), ["the alpha beta", None, "", "naïve the x1 9"]
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    frame = docs(rows, {"bucket": "1", "gain": "2", "place": "3", "n_words": "4", "score": "'s'", "buckets": "5"}, parts)
    got = importance.resample(frame, wanted, 25, 7, 20, buckets=buckets)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, target, 25, 7, 20, buckets)


def test_ties_repeated_and_null_ids(spark, docs):
    rows = [(None, "a b"), (None, "c d e"), (4, "a b"), (4, "a b"), (4, "a b"), (9, "q r")]
    got = importance.resample(docs(rows), spark.createDataFrame([], "item_id long, text string"), 50, 7, 1).collect()
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == [1, 2, 3]
    assert sorted((tuple(r)[:4] for r in got), key=str) == [r[:4] for r in brute(rows, [], 50, 7, 1, 10_000)]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(docs([]), none, 25, 7, 20).collect() == []
    assert [tuple(r) for r in importance.resample(docs([(1, None)]), none, 100, 7, 20).collect()][0][1:3] == (0, 0)


def test_scan_emits_every_run_of_every_length():
    rng = random.Random(3)
    for n in (1, 2, 3, 5):
        patterns = importance.run_patterns(n)
        for _, text in some_docs(rng, 20):
            words, features = plain_features(text, n)
            count, found = importance.feature_buckets(text, patterns, 1 << 31)
            assert count == len(words)
            assert found.tolist() == [crc32(f.encode()) % (1 << 31) for f in features]


def test_ranks_do_not_depend_on_the_partitioning(spark, docs):
    rows = [(i, f"w{i % 7} " * 25) for i in range(300)]
    wanted = spark.createDataFrame([(0, "w3 w3")], "item_id long, text string")
    results = [sorted((tuple(r) for r in importance.resample(docs(rows, parts=p), wanted, 25, 7, 20).collect()), key=str) for p in (1, 7)]
    assert results[0] == results[1] == brute(rows, ["w3 w3"], 25, 7, 20, 10_000)
