"""Exact top-k inner products by KD-trees, one tree per shard of the vectors.

Vectors are dealt to shards by a coarse tree of median splits (learned from a bounded sample
of ``COARSE_ROWS`` vectors; its cells are divided further by their true sizes, so a cell of
equal vectors makes as many shards as it needs).  A shard's vectors are split at the median
of the widest dimension, down to leaves; every node keeps the tight box around its vectors
and its smallest id.  Each tree is built once and written.  The largest inner product
that a query can have with any point of a box bounds what is below a node, so a best-first
traversal may stop as soon as its best open node cannot beat the kth score found so far.
That kth score is propagated: the first round searches each query block in one shard, and its
kth scores are the starting limits in every other shard.  Before any vector is sent there,
queries are compared with the root boxes of the shards; only those that a shard can still
improve go to it.  Equal scores go to the smaller id, so a node whose bound equals the
limit is left only if its smallest id comes later.

Components become integers floor(256 x), computed as doubles; scores are exact: where
sums may pass 2**53, they are taken in Python's integers.  A score beyond a long is reported
as the long next to it, in the order of the exact scores.  A query set (ids divisible by 50 in
the registered query) is answered over all rows; only k rows per query and shard leave a task.

Defined results: vectors that are null or hold a component that is null, NaN or infinite (or
whose 256-fold is) take no part; neither do rows with a null id.  Repeated ids are candidates each;
a row is never a candidate of a query of its own id.  Vectors of different
lengths are compared only with vectors of the same length.  An empty table or
query set gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgepole.llm.common import cut

SHARD_ROWS = 4096
COARSE_ROWS = 8192
COARSE_CELLS = 256
BUNDLE = 1024
_EXACT = 1 << 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
QUERY_ROWS = 512
LEAF = 128


@dataclass
class KdTree:
    points: np.ndarray  # in leaf order
    ids: np.ndarray
    lo: np.ndarray  # boxes of the nodes
    hi: np.ndarray
    least: np.ndarray  # smallest id below each node
    child: np.ndarray  # first child, 0 for a leaf; the second follows
    span: np.ndarray  # rows of each node

    @classmethod
    def build(cls, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> KdTree:
        order = np.argsort(ids, kind="stable")  # equal vectors stay in order of their ids
        spans, child, at = [(0, len(ids))], [], 0
        while at < len(spans):
            a, b = spans[at]
            rows = order[a:b]
            if b - a <= leaf:
                child.append(0)
            else:
                p = points[rows]
                widest = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
                order[a:b] = rows[np.argsort(p[:, widest], kind="stable")]
                middle = (a + b) // 2
                child.append(len(spans))
                spans += [(a, middle), (middle, b)]
            at += 1
        points, ids = points[order], ids[order]
        pick = lambda f, x: np.array([f(x[a:b], axis=0) for a, b in spans])
        return cls(points, ids, pick(np.min, points), pick(np.max, points), pick(np.min, ids), np.array(child), np.array(spans))

    def dumps(self) -> bytes:
        """The tree as bytes; ``loads`` needs the number of dimensions."""
        parts = (self.points, self.ids, self.lo, self.hi, self.least, self.child, self.span)
        sizes = np.array([len(self.ids), len(self.child)], np.int64)
        return sizes.tobytes() + b"".join(np.ascontiguousarray(p, t).tobytes() for p, t in zip(parts, ("f8", "i8", "f8", "f8", "i8", "i8", "i8"), strict=True))

    @classmethod
    def loads(cls, raw: bytes, dim: int) -> KdTree:
        n, m = np.frombuffer(raw, np.int64, 2).tolist()
        at, parts = 16, []
        for kind, shape in (("f8", (n, dim)), ("i8", (n,)), ("f8", (m, dim)), ("f8", (m, dim)), ("i8", (m,)), ("i8", (m,)), ("i8", (m, 2))):
            count = math.prod(shape)
            parts.append(np.frombuffer(raw, kind, count, at).reshape(shape))
            at += 8 * count
        return cls(*parts)

    def exact(self) -> KdTree:
        """The same tree with Python integers, for sums that doubles cannot hold."""
        whole = lambda a: np.array([[int(x) for x in row] for row in a], object).reshape(a.shape)
        return KdTree(whole(self.points), self.ids, whole(self.lo), whole(self.hi), self.least, self.child, self.span)

    def fits(self, query: np.ndarray) -> bool:
        """Whether every product sum of the query with these vectors is exact in doubles."""
        with np.errstate(over="ignore"):
            return float((np.maximum(np.abs(self.lo[0]), np.abs(self.hi[0])) * np.abs(query)).sum()) < _EXACT

    def search(self, query: np.ndarray, own: int, k: int, limit: tuple[int, int] | None = None) -> list[tuple[int, int]]:
        """The k best (score, id), best first; ``limit`` is a kth (score, id) known from elsewhere."""
        bounds = np.where(query > 0, self.hi * query, self.lo * query).sum(axis=1)
        best: list[tuple[int, int]] = []  # heap of (score, -id): the worst first
        floor = (-math.inf, 0) if limit is None else (limit[0], -limit[1])
        open_ = [(-bounds[0], int(self.least[0]), 0)]
        while open_:
            bound, least, node = heapq.heappop(open_)
            worst = max(floor, best[0]) if len(best) == k else floor
            if -bound < worst[0]:
                break  # best first: no other open node can do better
            if (-bound, -least) < worst:
                continue
            first = int(self.child[node])
            if first:
                for c in (first, first + 1):
                    heapq.heappush(open_, (-bounds[c], int(self.least[c]), c))
                continue
            a, b = self.span[node]
            scores = self.points[a:b] @ query
            for i in np.flatnonzero(scores >= worst[0]).tolist():
                got = (int(scores[i]), -int(self.ids[a + i]))
                if -got[1] == own or got < floor:
                    continue
                if len(best) < k:
                    heapq.heappush(best, got)
                elif got > best[0]:
                    heapq.heapreplace(best, got)
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): components floor(256 x); rows that take no part are left out."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * 256) != F.lit(math.inf)))
    # floor() makes longs, which large components pass: the nearest integer, less one where that is above
    whole = lambda x: F.rint(x * 256) - F.when(F.rint(x * 256) > x * 256, 1.0).otherwise(0.0)
    return vectors.filter(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, whole).alias("v"))


class Coarse:
    """Median splits of the space of one vector length, from a sample: vector -> cell."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        self.splits: list[tuple[int, float, int, int]] = []  # dimension, value, child or ~cell below and from it on
        self.cells = 0
        self._split(sample, cells)

    def _split(self, points: np.ndarray, cells: int) -> int:
        spread = points.max(axis=0) - points.min(axis=0) if len(points) > 1 else np.zeros(1)
        if cells < 2 or not spread.any():
            self.cells += 1
            return ~(self.cells - 1)
        widest = int(np.argmax(spread))
        column = points[:, widest]
        middle = float(np.median(column))
        middle = middle if (column < middle).any() else float(column[column > column.min()].min())
        at = len(self.splits)
        self.splits.append((widest, middle, 0, 0))
        below = self._split(points[column < middle], cells // 2)
        above = self._split(points[column >= middle], cells - cells // 2)
        self.splits[at] = (widest, middle, below, above)
        return at

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        todo = [(0 if self.splits else ~0, np.arange(len(points)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                out[rows] = ~at
                continue
            dim, value, below, above = self.splits[at]
            low = points[rows, dim] < value
            todo += [(below, rows[low]), (above, rows[~low])]
        return out


def shards_of(vectors: DataFrame, rows: int) -> DataFrame:
    """(shard, dim, box, least, tree): vectors dealt to shards of about ``rows``, one tree a shard."""
    sized = vectors.withColumn("dim", F.size("v"))
    total = sized.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    most = total.orderBy(F.desc("n"), "dim").limit(COARSE_CELLS).collect()
    sample = sized.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(COARSE_ROWS).collect()
    trees = {r["dim"]: Coarse(np.array([x["v"] for x in sample if x["dim"] == r["dim"]]).reshape(-1, r["dim"]), min(COARSE_CELLS, math.ceil(r["n"] / rows))) for r in most if r["dim"]}

    @F.pandas_udf("int")
    def cell_of(v: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int64)
        sizes = v.map(len).to_numpy()
        for d in np.unique(sizes):
            if d in trees:
                at = np.flatnonzero(sizes == d)
                out[at] = trees[int(d)].of(np.stack(v.iloc[at].to_numpy()))
        return pd.Series(out)

    celled = cut(sized.withColumn("cell", cell_of("v")))
    parts = celled.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / rows).alias("parts"))
    first = parts.withColumn("first", F.sum("parts").over(Window.partitionBy("dim").orderBy("cell")) - F.col("parts"))
    dealt = celled.join(first, ["dim", "cell"]).withColumn("shard", (F.col("first") + F.pmod(F.monotonically_increasing_id(), F.col("parts"))).cast("int"))

    def plant(key: tuple, rows_: pd.DataFrame) -> pd.DataFrame:
        rows_ = rows_.sort_values("vec_id", kind="stable")
        tree = KdTree.build(np.ascontiguousarray(np.stack(rows_["v"].to_numpy())).reshape(len(rows_), int(key[1])), rows_["vec_id"].to_numpy(np.int64), LEAF)
        box = np.concatenate([tree.lo[0], tree.hi[0]]).tobytes()
        return pd.DataFrame({"shard": [int(key[0])], "dim": [int(key[1])], "box": [box], "least": [int(tree.least[0])], "tree": [tree.dumps()]})

    return cut(dealt.select("shard", "dim", "vec_id", "v").groupBy("shard", "dim").applyInPandas(lambda key, r: plant(key, r), "shard int, dim int, box binary, least long, tree binary"))


_QUERY_SQL = "query int, dim int, ids binary, points binary"


def query_blocks(queries: DataFrame, rows: int) -> DataFrame:
    """Query vectors in blocks of about ``rows`` of one length, one row each."""
    n = max(1, math.ceil(queries.count() / rows))
    dealt = queries.withColumns({"query": F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int"), "dim": F.size("v")})

    def block(key: tuple, rows_: pd.DataFrame) -> pd.DataFrame:
        rows_ = rows_.sort_values("vec_id", kind="stable")
        points = np.ascontiguousarray(np.stack(rows_["v"].to_numpy())).reshape(len(rows_), int(key[1]))
        return pd.DataFrame({"query": [int(key[0])], "dim": [int(key[1])], "ids": [rows_["vec_id"].to_numpy(np.int64).tobytes()], "points": [points.tobytes()]})

    return cut(dealt.groupBy("query", "dim").applyInPandas(lambda key, r: block(key, r), _QUERY_SQL))


def _load(ids: bytes, points: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(points, np.float64).reshape(len(i), dim)


def _beyond(score: int) -> str | None:
    """A text that orders scores at or past the ends of a long as the scores do; None for others."""
    if _LEAST < score < _MOST:
        return None
    digits = f"{len(str(abs(score))):06d}{abs(score)}"
    return "p" + digits if score > 0 else "n" + digits.translate(str.maketrans("0123456789", "9876543210"))


_FOUND = ("row", "query_id", "vec_id", "score", "far")
_LIMIT = ("limit_row", "limit_score", "limit_id")
_FOUND_SQL = "query int, dim int, row array<int>, query_id array<long>, vec_id array<long>, score array<long>, far array<string>, limit_row array<int>, limit_score array<long>, limit_id array<long>"


def _search(k: int):
    """Search the queries of each row in the tree of that row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                tree, whole = KdTree.loads(r.tree, r.dim), None
                q_ids, queries = _load(r.ids, r.points, r.dim)
                places = range(len(q_ids)) if r.rows is None else [int(x) for x in r.rows]
                known = {} if r.limit_row is None else {j: (int(s), int(v)) for j, s, v in zip(r.limit_row, r.limit_score, r.limit_id, strict=True)}
                found, limits = [], []
                for j, q, query in zip(places, q_ids.tolist(), queries, strict=True):
                    if tree.fits(query):
                        best = tree.search(query, q, k, known.get(j))
                    else:
                        whole = whole or tree.exact()
                        best = whole.search(np.array([int(x) for x in query], object), q, k, known.get(j))
                    found += [(j, q, v, min(max(s, _LEAST), _MOST), _beyond(s)) for s, v in best]
                    if len(best) == k and best[-1][0] > _LEAST:  # a score past a long is over its end
                        limits.append((j, min(best[-1][0], _MOST), best[-1][1]))
                one = {"query": int(r.query), "dim": int(r.dim)}
                one |= {n: [f[i] for f in found] for i, n in enumerate(_FOUND)}
                one |= {n: [f[i] for f in limits] for i, n in enumerate(_LIMIT)}
                yield pd.DataFrame([one])

    return run


_SENT_SQL = "query int, dim int, shard int, ids binary, points binary, rows array<int>, limit_row array<int>, limit_score array<long>, limit_id array<long>"


def _send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The queries of a block that the shards of a bundle can still improve, shard by shard."""
    for b in batches:
        for r in b.itertuples(index=False):
            q_ids, queries = _load(r.ids, r.points, r.dim)
            known = {} if r.limit_row is None else {j: (float(s), int(v)) for j, s, v in zip(r.limit_row, r.limit_score, r.limit_id, strict=True)}
            limit = np.array([known.get(j, (-math.inf, 0))[0] for j in range(len(q_ids))])
            exact = {} if r.limit_row is None else dict(zip(r.limit_row, zip(r.limit_score, r.limit_id, strict=True), strict=True))
            out = []
            for shard, box in zip(r.shards, r.boxes, strict=True):
                if shard == r.home:
                    continue
                lo, hi = np.frombuffer(box, np.float64).reshape(2, r.dim)
                with np.errstate(over="ignore", invalid="ignore"):
                    bound = np.maximum(queries, 0) @ hi + np.minimum(queries, 0) @ lo
                    # rounding may lower a large bound by a little: never enough to lose a query
                    slack = (np.abs(queries) @ np.maximum(np.abs(lo), np.abs(hi))) * 1e-12 * (1 + r.dim) + 1e-6
                    at = np.flatnonzero(~(bound + slack < limit))  # what overflows is sent
                if len(at):
                    told = [j for j in at.tolist() if j in exact]
                    out.append(
                        (int(r.query), int(r.dim), int(shard), q_ids[at].tobytes(), np.ascontiguousarray(queries[at]).tobytes(), at.tolist())
                        + (told, [int(exact[j][0]) for j in told], [int(exact[j][1]) for j in told])
                    )
            if out:
                yield pd.DataFrame(out, columns=["query", "dim", "shard", "ids", "points", "rows", *_LIMIT])


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for every query row.

    ``is_query`` is a condition on ``vec_id``.  See the module docstring for the
    method and for nulls, ties and repeated rows.
    """
    clean = integer_vectors(vectors, id_col, vector_col).filter(F.size("v") > 0)
    shards = shards_of(clean, shard_rows)
    queries = query_blocks(clean.filter(is_query), query_rows)
    run = _search(k)
    none = [F.lit(None).cast(t).alias(n) for n, t in (("rows", "array<int>"), ("limit_row", "array<int>"), ("limit_score", "array<long>"), ("limit_id", "array<long>"))]
    # the first round: a block in one shard of its length
    numbers = shards.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    home = queries.join(numbers, "dim").withColumn("home", F.pmod("query", "n").cast("int")).drop("n")
    first = cut(home.withColumnRenamed("home", "shard").join(shards, ["shard", "dim"]).select("query", "dim", "ids", "points", "tree", *none).mapInPandas(run, _FOUND_SQL))
    # blocks meet the root boxes of all other shards, in bundles; what can still improve goes on
    limits = first.select("query", "dim", *_LIMIT)
    bundles = shards.groupBy("dim", F.floor(F.col("shard") / BUNDLE).alias("bundle")).agg(F.collect_list("shard").alias("shards"), F.collect_list("box").alias("boxes"))
    sent = home.join(limits, ["query", "dim"], "left").join(bundles, "dim").mapInPandas(_send, _SENT_SQL)
    others = sent.join(shards.select("shard", "dim", "tree"), ["shard", "dim"]).mapInPandas(run, _FOUND_SQL)
    found = first.unionByName(others).select("query", "dim", F.explode(F.arrays_zip(*_FOUND)).alias("f")).select("query", "dim", "f.*")
    order = Window.partitionBy("query", "dim", "row").orderBy(F.desc("score"), F.desc("far"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
