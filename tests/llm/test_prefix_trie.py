from __future__ import annotations

import hashlib
import random
from zlib import crc32

import pyarrow as pa
import pytest

from lodgepole.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(seqs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """Every node by its prefix, from (role, text) sequences."""
    members: dict[tuple, list[int]] = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, cs in members.items():
        inner = [q for q in members if q[: len(p)] == p]
        kids = [q for q in inner if len(q) == len(p) + 1]
        leaves = [q for q in inner if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in members)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in inner if q)
        ends = sorted(c for c in cs if len(seqs[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids), len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def rebuild(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    own: dict[int, list] = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, s in own.items():
        h = crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + s[h:]
    return out


def nodes_of(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "'x' as path", "turn as conv")
    got = trie.prefix_nodes(trie.rebuilt(frame), **options).collect()
    return sorted((tuple(r) for r in got), key=str)


def some_rows(rng: random.Random, n: int) -> list[tuple]:
    words = ["", "a", "b", "ü" * 30, "long " * 200, None]
    rows = []
    for c in range(n):
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(words)) for t in range(rng.randrange(0, 9))]
    hot = [(c, t, "user", "same") for c in range(1000, 1000 + n, 1) for t in range(3)]
    return [*rows, *hot, (None, 0, "user", "lost"), (3, None, "system", "first"), (3, None, "system", "first"), (7, 2, "user", "tie"), (7, 2, "user", "sie")]


@pytest.mark.parametrize("block_bytes,fan_in", [(200, 2), (1500, 3), (trie.BLOCK_BYTES, trie.FAN_IN)])
def test_equals_brute_force(spark, block_bytes, fan_in):
    rows = some_rows(random.Random(block_bytes), 60)
    assert nodes_of(spark, rows, block_bytes=block_bytes, fan_in=fan_in) == brute(rebuild(rows))


def test_same_nodes_for_any_number_of_tasks(spark):
    rows = some_rows(random.Random(5), 40)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for parts in ("1", "2", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert nodes_of(spark, rows, fan_in=3) == brute(rebuild(rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_few_rows_turnless_and_empty(spark):
    assert nodes_of(spark, []) == []
    # 1 % 9 of crc32("1") drops its only turn and there is no conversation 0
    h = crc32(b"1") % 9
    assert h > 1
    none = hashlib.sha256(b"1").hexdigest()
    assert nodes_of(spark, [(1, 0, "user", "x")]) == [(1, 0, None, 1, 0, 1, 0, none)]


def test_long_conversations(spark):
    rows = [(c, t, "user", f"t{t}" if t < 2000 else f"{c}-{t}") for c in (0, 1, 5) for t in range(3000)]
    got = nodes_of(spark, rows, block_bytes=10_000)
    seqs = rebuild(rows)
    shared = 0
    while seqs[0][shared] == seqs[1][shared] == seqs[5][shared]:
        shared += 1
    assert len(got) == 1 + shared + 3 * (3000 - shared)
    assert sorted(r[1] for r in got if r[4] == 3) == [shared]
    assert [r[6] for r in got if r[1] == 0] == [2 * sum(len(x) for _, x in seqs[0][:shared])]


def walk_in_parts(keys, cuts, block_bytes):
    """The nodes of sorted (key, sizes, conv_id) rows, cut into tasks at the given places, without Spark."""
    schema = pa.schema([("key", pa.binary()), ("sizes", pa.list_(pa.int32())), ("conv_id", pa.int64())])
    rows, edges, found = trie.Rows(), None, []
    for place, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(keys)], strict=True)):
        batch = pa.RecordBatch.from_pylist([dict(zip(schema.names, k, strict=True)) for k in keys[a:b]], schema)
        for made in trie.build_blocks([batch], block_bytes, place):
            for r in made.to_pylist():
                if r["kind"] == trie.EDGE:
                    nxt = trie.Edges.loads(r["data"])
                    edges = nxt if edges is None else edges.joined(nxt, rows)
                elif r["kind"] == trie.NODE:
                    found.append(r)
    edges.close(rows)
    found += rows.batch().to_pylist()
    paths = {r["path"]: r["conv_id"] for r in found if r["path"] is not None}
    assert len(paths) == sum(r["path"] is not None for r in found)
    return sorted(
        (r["conv_id"], r["depth"], r["parent_conv_id"] if r["parent_path"] is None else paths[r["parent_path"]], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"])
        for r in found
        if r["depth"]
    )


def test_any_cut_into_tasks_and_blocks_gives_the_same_nodes():
    rng = random.Random(1)
    for _ in range(60):
        turns = [hashlib.sha256(bytes([i])).digest()[: trie.WIDTH] for i in range(rng.choice([2, 3, 60]))]
        seqs = [tuple(rng.choice(turns) for _ in range(rng.randrange(0, rng.choice([3, 7])))) for _ in range(rng.randrange(1, 40))]
        keys = sorted((b"".join(s), [s_[0] for s_ in s], i) for i, s in enumerate(seqs))
        whole = walk_in_parts(keys, [], 1 << 20)
        for _ in range(4):
            cuts = sorted(rng.choices(range(len(keys) + 1), k=rng.randrange(0, 6)))
            cuts = [c for i, c in enumerate(cuts) if 0 < c < len(keys) and c not in cuts[:i]]
            assert walk_in_parts(keys, cuts, rng.choice([1, 100, 1 << 20])) == whole
        named = {i: [(t.hex(), "x" * t[0]) for t in s] for i, s in enumerate(seqs)}
        assert sorted(r[:7] for r in brute(named) if r[1]) == whole


def test_node_layouts_grow_and_keep_their_order():
    rng = random.Random(2)
    for width in (3, 4, 5, 16, 17, 48, 49, 256):
        node = trie.ArtNode(b"")
        order = rng.sample(range(256), width)
        for b in order:
            node.put(b, trie.ArtNode(bytes([b])))
        node.put(order[0], trie.ArtNode(b"new"))
        assert node.size == width and node.layout == min(k for k in (4, 16, 48, 256) if k >= width)
        assert [b for b, _ in node.in_order()] == sorted(order)
        assert all((node.child(b) is not None) == (b in order) for b in range(256))
        assert node.child(order[0]).prefix == b"new"


def test_paths_are_compressed():
    tree = trie.AdaptiveRadixTree()
    keys = [b"a" * 64, b"a" * 48 + b"b" * 16, b"a" * 32]
    for i, k in enumerate(keys):
        tree.insert(k, i)
    (_, top), = tree.root.in_order()
    assert top.prefix == b"a" * 31 and top.ends == [2]
    (_, fork), = top.in_order()
    assert fork.prefix == b"a" * 15 and [b for b, _ in fork.in_order()] == [97, 98]
