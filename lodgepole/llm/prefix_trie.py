"""Prefix trie of conversations: adaptive radix trees over fixed-width turn ids.

A turn's id is the first 16 bytes of a SHA-256 over its role and text; a
conversation's key is the ids of its turns one after the other, so bytewise
(big-endian) order keeps turns together.  Conversations are dealt by range of (key,
conv_id) and stream sorted through the tasks.  A task builds an adaptive radix tree
(path compression; nodes of 4, 16, 48 and 256 places that grow when full) over
each block of about ``block_bytes`` of keys and walks it once; only the byte depths at the end of a
turn emit nodes, with counts and sums of their subtrees.

A node can go on in the next block only if it lies on the path of the block's first or
last key.  These *edges* stay open: a task joins the edges of its blocks, then groups of
neighbouring tasks join theirs in rounds (``fan_in`` at a time, so any number of
tasks takes a few rounds), and what no longer touches an edge is closed on the way.  The
conv_ids that end at an open node are written in pieces, in order, and hashed in
a stream of their own.  Hence no group - a first turn of a third of all conversations, one
conversation repeated as often - is gathered in one task.

Defined results: a null role or text counts as empty; turns are ordered by turn (null
first), then role, then text, and repeated rows are turns of their own.  Rows with a null
conv_id belong to no conversation.  A conversation without turns is a member of
the root only.  No conversations give no nodes.  A conversation is one key
of 16 bytes a turn, whatever its texts; its work is linear in its turns.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgepole.llm.common import release, shared_dir, written

WIDTH = 16
BLOCK_BYTES = 4 << 20
FAN_IN = 64
PIECE_IDS = 50_000
_NONE = hashlib.sha256(b"").hexdigest()
_ROOT = b""  # the path id of the root

NODE, PIECE, EDGE = 0, 1, 2
_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("depth", T.LongType()),
        T.StructField("parent_conv_id", T.LongType()),
        T.StructField("path", T.BinaryType()),  # of nodes that were open, and of pieces
        T.StructField("parent_path", T.BinaryType()),  # where the parent was open
        T.StructField("n_convs", T.LongType()),
        T.StructField("n_children", T.LongType()),
        T.StructField("n_leaves", T.LongType()),
        T.StructField("saved_tokens", T.LongType()),
        T.StructField("ends_sha256", T.StringType()),
        T.StructField("place", T.LongType()),  # of a piece or an edge: its task
        T.StructField("turn_at", T.LongType()),  # of a piece: its number in the task
        T.StructField("data", T.BinaryType()),
    ]
)
_ARROW = pa.schema(
    [(f.name, {"integer": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[f.dataType.typeName()]) for f in _SCHEMA]
)


class ArtNode:
    """A node of the radix tree: compressed bytes above it, children by byte, conv_ids that end here."""

    __slots__ = ("prefix", "keys", "kids", "size", "ends")

    def __init__(self, prefix: bytes) -> None:
        self.prefix = prefix
        self.keys: bytearray | None = bytearray()  # up to 16 children: their bytes; 48: byte -> place + 1; 256: none
        self.kids: list = []
        self.size = 0
        self.ends: list[int] = []

    @property
    def layout(self) -> int:
        return 256 if self.keys is None else 48 if len(self.keys) == 256 else 16 if self.size > 4 else 4

    def child(self, byte: int) -> ArtNode | None:
        if self.keys is None:
            return self.kids[byte]
        if len(self.keys) == 256:
            at = self.keys[byte]
            return self.kids[at - 1] if at else None
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, node: ArtNode) -> None:
        """Add or replace the child of a byte, growing the layout when it is full."""
        keys = self.keys
        if keys is not None and len(keys) < 256:
            at = keys.find(byte)
            if at >= 0:
                self.kids[at] = node
                return
            if self.size < 16:
                at = sum(k < byte for k in keys)
                keys.insert(at, byte)
                self.kids.insert(at, node)
                self.size += 1
                return
            grown = bytearray(256)
            for place, k in enumerate(keys, 1):
                grown[k] = place
            self.keys = keys = grown
        if keys is not None:
            if keys[byte]:
                self.kids[keys[byte] - 1] = node
                return
            if self.size < 48:
                self.kids.append(node)
                self.size += 1
                keys[byte] = self.size
                return
            self.kids = [self.kids[at - 1] if at else None for at in keys]
            self.keys = None
        self.size += self.kids[byte] is None
        self.kids[byte] = node

    def in_order(self) -> Iterator[tuple[int, ArtNode]]:
        if self.keys is None:
            yield from ((b, k) for b, k in enumerate(self.kids) if k is not None)
        elif len(self.keys) == 256:
            yield from ((b, self.kids[at - 1]) for b, at in enumerate(self.keys) if at)
        else:
            yield from zip(self.keys, self.kids, strict=True)


class AdaptiveRadixTree:
    """Keys of bytes, each with the conv_ids inserted under it."""

    def __init__(self) -> None:
        self.root = ArtNode(b"")

    def insert(self, key: bytes, conv_id: int) -> None:
        node, above, byte, at = self.root, None, 0, 0
        while True:
            prefix = node.prefix
            if not key.startswith(prefix, at):
                same = _common(prefix, key, at)
                fork = ArtNode(prefix[:same])
                node.prefix = prefix[same + 1 :]
                fork.put(prefix[same], node)
                above.put(byte, fork)  # the root has no prefix, so there is a node above
                node = fork
                prefix = fork.prefix
            at += len(prefix)
            if at == len(key):
                node.ends.append(conv_id)
                return
            above, byte = node, key[at]
            at += 1
            node = above.child(byte)
            if node is None:
                leaf = ArtNode(key[at:])
                leaf.ends.append(conv_id)
                above.put(byte, leaf)
                return


def _common(prefix: bytes, key: bytes, at: int) -> int:
    """Length of what ``prefix`` and ``key[at:]`` share, by halving."""
    low, high = 0, min(len(prefix), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key.startswith(prefix[:mid], at):
            low = mid
        else:
            high = mid - 1
    return low


class Stats:
    """What is known of one turn-aligned node; of open ones, without their open children."""

    __slots__ = ("turn", "size", "n", "least", "kids", "leaves", "saved", "path", "first", "last", "waiting", "ends")

    def __init__(self, turn: bytes, size: int) -> None:
        self.turn, self.size = turn, size
        self.n = self.kids = self.leaves = self.saved = 0
        self.least: int | None = None
        self.path: bytes | None = None
        self.first = self.last = False
        self.waiting: list[int] = []  # rows of closed children
        self.ends: list[int] = []

    def met(self, n: int, least: int | None) -> None:
        self.n += n
        if least is not None and (self.least is None or least < self.least):
            self.least = least

    def finish(self) -> None:
        self.leaves = self.leaves if self.kids else 1
        self.saved += (self.n - 1) * self.size

    def packed(self) -> list:
        return [self.path.hex(), self.size, self.n, self.least, self.kids, self.leaves, self.saved]

    @classmethod
    def of(cls, row: list) -> Stats:
        s = cls(b"", row[1])
        s.path, (s.n, s.least, s.kids, s.leaves, s.saved) = bytes.fromhex(row[0]), row[2:]
        return s


def under(path: bytes, turn: bytes) -> bytes:
    """The path id of a child: 16 bytes hashed from the parent's and the turn."""
    return hashlib.sha256(path + turn).digest()[:WIDTH]


class Edges:
    """The open nodes of a range of keys: what the paths of its first and last key
    share (``stem``, root first), then each one's own rest.

    ``n`` and ``least`` of an open node count all its members so far; ``kids``,
    ``leaves`` and ``saved`` only what was closed below it.
    """

    def __init__(self, stem: list[Stats], left: list[Stats], right: list[Stats]) -> None:
        self.stem, self.left, self.right = stem, left, right

    def dumps(self) -> bytes:
        return json.dumps([[s.packed() for s in part] for part in (self.stem, self.left, self.right)]).encode()

    @classmethod
    def loads(cls, blob: bytes) -> Edges:
        return cls(*[[Stats.of(r) for r in part] for part in json.loads(blob)])

    def joined(self, after: Edges, rows: Rows) -> Edges:
        """The edges of this range followed by the next one; closed nodes go to ``rows``."""
        ahead, behind = self.stem + self.right, after.stem + after.left
        k = 0
        while k < min(len(ahead), len(behind)) and ahead[k].path == behind[k].path:
            a, b = ahead[k], behind[k]
            a.met(b.n, b.least)
            a.kids, a.leaves, a.saved = a.kids + b.kids, a.leaves + b.leaves, a.saved + b.saved
            k += 1
        a_len, b_len = len(self.stem), len(after.stem)
        # neither on the new first path nor on the new last one
        close_chain(ahead[k - 1 :] if k >= a_len else ahead[a_len - 1 :], k if k >= a_len else a_len, rows)
        new_last = ahead[:k] + after.stem[k:] + after.right if k < b_len else ahead[:b_len] + after.right
        close_chain((ahead[k - 1 : k] + behind[k:]) if k >= b_len else behind[b_len - 1 :], k if k >= b_len else b_len, rows)
        new_first = self.stem + self.left
        s = min(k, a_len, b_len)
        if k > max(a_len, b_len):  # shared by the inner paths only
            at = max(a_len, b_len)
            close_chain(ahead[at - 1 : k], at, rows)
        return Edges(ahead[:s], new_first[s:], new_last[s:])

    def close(self, rows: Rows) -> None:
        """Close everything, the root included: no keys before or after."""
        close_chain(self.stem[-1:] + self.right, len(self.stem), rows)
        close_chain(self.stem[-1:] + self.left, len(self.stem), rows)
        close_chain([None, *self.stem], 0, rows)


class Rows:
    """Closed nodes, pieces and edges as columns."""

    def __init__(self) -> None:
        self.columns: dict[str, list] = {n: [] for n in _ARROW.names}

    def __len__(self) -> int:
        return len(self.columns["kind"])

    def add(self, **values) -> int:
        for name, column in self.columns.items():
            column.append(values.get(name))
        return len(self) - 1

    def node(self, s: Stats, depth: int, parent_path: bytes | None, ends_sha256: str | None) -> int:
        return self.add(
            kind=NODE, conv_id=s.least, depth=depth, path=s.path, parent_path=parent_path, n_convs=s.n,
            n_children=s.kids, n_leaves=s.leaves, saved_tokens=s.saved, ends_sha256=ends_sha256,
        )

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict(self.columns, schema=_ARROW)
        self.__init__()
        return out


def close_chain(chain: list[Stats | None], depth: int, rows: Rows) -> None:
    """Close open nodes bottom-up: ``chain[0]`` is the parent that stays open (None above the root), at ``depth`` lies chain[1]."""
    for i in range(len(chain) - 1, 0, -1):
        s, parent = chain[i], chain[i - 1]
        s.finish()
        rows.node(s, depth + i - 1, parent.path if parent is not None else None, None)
        if parent is not None:
            parent.kids += 1
            parent.leaves += s.leaves
            parent.saved += s.saved


def _digest(ends: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else _NONE


def walk(tree: AdaptiveRadixTree, first: bytes, last: bytes, sizes: dict[bytes, int], rows: Rows, place: int, pieces: list[int]) -> Edges:
    """Emit the closed turn-aligned nodes of a block's tree; return its open ones."""
    root = Stats(b"", 0)
    root.path, root.first, root.last = _ROOT, True, True
    frames, path = [root], bytearray()
    stem: list[Stats] = [root]
    left: list[Stats] = []
    right: list[Stats] = []

    def enter(node: ArtNode, edge: bytes) -> tuple[Iterator, int]:
        path.extend(edge)
        while len(frames) * WIDTH <= len(path):
            d = len(frames)
            turn = bytes(path[(d - 1) * WIDTH : d * WIDTH])
            above, s = frames[-1], Stats(turn, sizes[turn])
            s.first = above.first and first.startswith(turn, (d - 1) * WIDTH)
            s.last = above.last and last.startswith(turn, (d - 1) * WIDTH)
            if s.first or s.last:
                s.path = under(above.path, turn)
                (stem if s.first and s.last else left if s.first else right).append(s)
            frames.append(s)
        if node.ends:  # keys end at the end of a turn
            top = frames[-1]
            top.ends = node.ends
            top.met(len(node.ends), node.ends[0])
        return node.in_order(), len(edge)

    def leave(length: int) -> None:
        del path[len(path) - length :]
        while (len(frames) - 1) * WIDTH > len(path):
            s = frames.pop()
            above = frames[-1]
            above.met(s.n, s.least)
            settle(s, len(frames), above)

    def settle(s: Stats, depth: int, above: Stats | None) -> None:
        if s.first or s.last:
            for i in range(0, len(s.ends), PIECE_IDS):
                rows.add(kind=PIECE, path=s.path, place=place, turn_at=pieces[0], data=",".join(map(str, s.ends[i : i + PIECE_IDS])).encode())
                pieces[0] += 1
            for r in s.waiting:
                rows.columns["parent_path"][r] = s.path
            return
        s.finish()
        row = rows.node(s, depth, None, _digest(s.ends))
        above.kids += 1
        above.leaves += s.leaves
        above.saved += s.saved
        above.waiting.append(row)
        for r in s.waiting:
            rows.columns["parent_conv_id"][r] = s.least

    stack = [enter(tree.root, b"")]
    while stack:
        kids, length = stack[-1]
        step = next(kids, None)
        if step is None:
            stack.pop()
            leave(length)
        else:
            byte, node = step
            stack.append(enter(node, bytes((byte,)) + node.prefix))
    settle(root, 0, None)
    return Edges(stem, left, right)


def build_blocks(batches: Iterable[pa.RecordBatch], block_bytes: int, place: int) -> Iterator[pa.RecordBatch]:
    """Trees over sorted (key, sizes, conv_id) rows, block by block; the task's joined edges come last."""
    rows, edges, pieces = Rows(), None, [0]
    tree, sizes, first, last, held = AdaptiveRadixTree(), {}, None, b"", 0

    def end_of_block() -> None:
        nonlocal edges, tree, sizes, first, held
        found = walk(tree, first, last, sizes, rows, place, pieces)
        edges = found if edges is None else edges.joined(found, rows)
        tree, sizes, first, held = AdaptiveRadixTree(), {}, None, 0

    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            for key, lengths, conv_id in zip(*[part.column(c).to_pylist() for c in ("key", "sizes", "conv_id")], strict=True):
                if first is None:
                    first = key
                last = key
                tree.insert(key, conv_id)
                for d, n in enumerate(lengths):
                    sizes[key[d * WIDTH : (d + 1) * WIDTH]] = n
                held += len(key) + 64
                if held >= block_bytes:
                    end_of_block()
                    yield rows.batch()
    if first is not None:
        end_of_block()
    if edges is not None:
        rows.add(kind=EDGE, place=place, data=edges.dumps())
        yield rows.batch()
    release()


def _edge_joiner(finished: bool) -> Callable[[pa.Table], pa.Table]:
    """Joins the edges of neighbouring tasks; the last round closes what is left."""

    def join(group: pa.Table) -> pa.Table:
        rows, edges = Rows(), None
        group = group.sort_by("place")
        for blob in group.column("data").to_pylist():
            found = Edges.loads(blob)
            edges = found if edges is None else edges.joined(found, rows)
        if finished:
            edges.close(rows)
        else:
            rows.add(kind=EDGE, place=group.column("place")[0].as_py(), data=edges.dumps())
        return pa.Table.from_batches([rows.batch()])

    return join


def turn_id(role: Column, text: Column) -> Column:
    """The first 16 bytes of a SHA-256 over role and text; the role's length keeps them apart."""
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH))


def conversation_turns(rows: DataFrame) -> DataFrame:
    """conv_id and ``turns``, an array of (id, size) in order of turn, one row a conversation."""
    clean = rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turn = F.struct(F.row_number().over(order).alias("at"), turn_id(F.col("role"), F.col("text")).alias("id"), F.octet_length("text").alias("size"))
    listed = clean.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def prefix_nodes(conversations: DataFrame, block_bytes: int = BLOCK_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """The trie of (conv_id, turns) rows, conv_id unique: one row a node, as ``op11`` asks."""
    spark = conversations.sparkSession
    keyed = conversations.select(F.array_join(F.transform("turns.id", F.hex), "").alias("k"), F.col("turns.size").alias("sizes"), "conv_id")
    keyed = keyed.select(F.unhex("k").alias("key"), "sizes", "conv_id")
    dealt = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    root = f"{shared_dir(spark)}/prefix-trie-{uuid.uuid4().hex}"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from build_blocks(batches, block_bytes, TaskContext.get().partitionId())

    dealt.mapInArrow(build, _SCHEMA).write.partitionBy("kind").parquet(f"{root}/0")
    columns = [f.name for f in _SCHEMA]

    def of_kind(step: int, kind: int) -> DataFrame:
        return spark.read.schema(_SCHEMA).parquet(f"{root}/{step}").filter(F.col("kind") == kind).select(*columns)

    most = of_kind(0, EDGE).agg(F.max("place")).first()[0]
    step, span = 0, 1
    while most is not None and (step == 0 or span <= most):
        span *= fan_in
        left = of_kind(step, EDGE).select("place", "data", F.floor(F.col("place") / span).alias("g"))
        left.groupBy("g").applyInArrow(_edge_joiner(span > most), _SCHEMA).write.partitionBy("kind").parquet(f"{root}/{step + 1}")
        step += 1
    nodes = of_kind(0, NODE)
    for s in range(1, step + 1):
        nodes = nodes.unionByName(of_kind(s, NODE))
    return _resolved(nodes, _piece_digests(of_kind(0, PIECE)))


def _piece_digests(pieces: DataFrame) -> DataFrame:
    """(path, sha256) over each path's pieces in order, in a stream."""
    ordered = pieces.select("path", "place", "turn_at", "data").repartition("path").sortWithinPartitions("path", "place", "turn_at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, state = None, None
        for b in batches:
            done: list[tuple[bytes, str]] = []
            for p, data in zip(b.column("path").to_pylist(), b.column("data").to_pylist(), strict=True):
                if p != path:
                    if state is not None:
                        done.append((path, state.hexdigest()))
                    path, state = p, hashlib.sha256(data)
                else:
                    state.update(b"," + data)
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["__path", "digest"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([state.hexdigest()])], names=["__path", "digest"])

    return ordered.mapInArrow(run, "__path binary, digest string")


def _resolved(nodes: DataFrame, digests: DataFrame) -> DataFrame:
    """Fill in the parents and end lists of nodes that touched an edge."""
    were_open = nodes.filter("path is not null").select(F.col("path").alias("__parent"), F.col("conv_id").alias("__conv"))
    out = nodes.join(were_open, F.col("parent_path") == F.col("__parent"), "left").join(digests, F.col("path") == F.col("__path"), "left")
    return out.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "__conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", "digest", F.lit(_NONE)).alias("ends_sha256"),
    )


def rebuilt(conversations: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, turns) where conversation c starts with the first h turns of c - c % ``group``,
    h = crc32(decimal c) % ``heads``, and goes on with its own turns after its first h."""
    own = written(conversation_turns(conversations), "turns")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    base = own.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("__base"), F.slice("turns", 1, heads).alias("__head"))
    both = own.withColumn("__h", h).join(base, F.col("conv_id") - F.col("conv_id") % group == F.col("__base"), "left")
    none = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("__head", none), F.lit(1), F.col("__h"))
    return both.select("conv_id", F.concat(head, F.slice("turns", F.col("__h") + 1, F.greatest(F.size("turns") - F.col("__h"), F.lit(0)))).alias("turns"))
