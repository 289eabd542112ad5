from __future__ import annotations

import random
from collections import defaultdict

import pytest

from lodgepole.llm import ngram_join as nj


def sets_of(text, n=5):
    w = (text or "").lower().split()
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute(rows, threshold=0.8):
    grams = [(i, sets_of(t)) for i, t in rows]
    reps = defaultdict(list)
    for i, s in grams:
        if i is not None and s:
            reps[s].append(i)
    keys = list(reps)
    near = {s: [t for t in keys if t != s and len(s & t) >= threshold * len(s | t) - 1e-12] for s in keys}
    label = {}
    for s in keys:
        if s in label:
            continue
        todo, group = [s], {s}
        while todo:
            for t in near[todo.pop()]:
                if t not in group:
                    group.add(t)
                    todo.append(t)
        least = min(min(reps[t]) for t in group)
        label |= dict.fromkeys(group, least)
    out = []
    for i, s in grams:
        if i is None or not s:
            out.append((i, i, i, 0))
        else:
            out.append((i, label[s], min(reps[s]), len(near[s])))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 150))]
        rows.append(" ".join(words))
        for _ in range(rng.randrange(0, 7)):
            other = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 30)):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            rows.append(" ".join(other))
    base = [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(60):  # a large group of near copies, chained
        base = list(base)
        base[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append(" ".join(base))
    rows += [rows[0], rows[0].upper(), rows[0] + " ", "one two", "One  Two", "one"]
    ids = rng.sample(range(10_000), len(rows))
    out = list(zip(ids, rows, strict=True))
    out += [(20_001, None), (20_002, ""), (20_003, " \n "), (None, rows[0]), (20_004, "ab " * 30_000)]
    out += [out[3], (out[4][0], "another text under an id that is taken already here")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block_docs", [1024, 7])
def test_equals_brute_force(docs, block_docs):
    rows = corpus(block_docs)
    got = nj.near_duplicates(docs(rows, {"node": "1", "label": "2", "block": "3"}), recall=0.999999, block_docs=block_docs).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_recall_at_the_registered_bands(docs):
    """Planted pairs of every similarity from 0.8 to 0.95, with the defaults of the registered query."""
    rng = random.Random(80)
    rows, wanted = [], {}
    for k in range(1500):
        n, own = 100, rng.randrange(5, 21)  # n-grams in all, and those of one text only
        words = [f"{k}w{i}" for i in range(n + 4)]
        other = words[: n + 4 - own]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        a, b = sets_of(rows[-2][1]), sets_of(rows[-1][1])
        assert len(a & b) >= 0.8 * len(a | b)
        wanted[2 * k] = wanted[2 * k + 1] = 2 * k
    for k in range(500):  # exactly 0.8
        base = 2 * 1500 + 2 * k
        words = [f"{base}x{i}" for i in range(14)]
        rows += [(base, " ".join(words)), (base + 1, " ".join(words[:12]))]
        assert len(sets_of(rows[-1][1])) * 10 == 8 * len(sets_of(rows[-2][1]))
        wanted[base] = wanted[base + 1] = base
    got = {r.doc_id: r.class_id for r in nj.near_duplicates(docs(rows)).collect()}
    assert sum(got[i] == c for i, c in wanted.items()) == len(wanted)


def test_hot_labels_are_spread(spark):
    star = [(0, i) for i in range(1, 3000)] + [(10_000 + i, 10_001 + i) for i in range(0, 60, 2)]
    ties = spark.createDataFrame(star, "a long, b long")
    both = ties.selectExpr("a as node", "b as near").union(ties.selectExpr("b", "a"))
    hot = nj._hot_keys(both, "near")
    assert hot == [0]
    lookup = spark.createDataFrame([(i, i + 1) for i in {x for t in star for x in t}], "near long, label long")
    joined = nj._salted_join(both, lookup, "near", hot)
    assert joined.count() == both.count() and joined.filter("label != near + 1").count() == 0
    assert {r.node: r.label for r in nj.components(ties).collect()} == {x: 0 if x < 3000 else x - x % 2 for t in star for x in t}


def test_bands():
    assert nj.bands_for(nj.THRESHOLD, nj.RECALL)[0] >= 22
    for recall in (0.9, 0.99, 0.999, nj.RECALL):
        bands, rows = nj.bands_for(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= nj.MAX_HASHES


def test_components(spark):
    rng = random.Random(2)
    ties = [(i, i + 1) for i in range(50)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(40)] + [(200, 200 + i) for i in range(1, 30)]
    ties = [(a, b) for a, b in ties if a != b]
    parent = {x: x for t in ties for x in t}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a, b in ties:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = nj.components(spark.createDataFrame(ties, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {x: find(x) for x in parent}


def test_empty(docs):
    assert nj.near_duplicates(docs([])).collect() == []
    assert [tuple(r) for r in nj.near_duplicates(docs([(1, None)])).collect()] == [(1, 1, 1, 0)]
