"""Shared helpers of the corpus operators: table access, lineage cuts, hashing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors keep their Python workers: freed Arrow blocks go back to the system
# instead of staying in a pool of each worker.
pa.set_memory_pool(pa.system_memory_pool())


def release() -> None:
    """Give memory that Python has freed back to the system, where the C library can."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps the memory


U64 = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate results.

    ``spark.checkpoint.dir`` is read from the session.  Only a local master
    may run without it; there a private folder is made once and set.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder: lost executors cannot lose it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, what: str, codec: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back (column-pruned reads).

    The files stay until the folder is cleared: whole texts are worth a denser ``codec``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Powers:
    """Growing tables of powers of the hash base and of its inverse."""

    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                p = np.full(size, U64(base))
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of values[i:j] * base**i.. (mod 2**64)."""
    up, _ = POWERS.to(len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values in [start, end), independent of the place."""
    _, down = POWERS.to(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, by doubling."""
    out, done = values, 1
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as one compressed blob."""
    n = len(arrays[0])
    return zstandard.ZstdCompressor(level=1).compress(
        np.int64(n).tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    )


def unpack(blob: bytes, *dtypes: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for d in map(np.dtype, dtypes):
        out.append(np.frombuffer(raw, d, n, at))
        at += n * d.itemsize
    return out


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of 1,000 rows at most, so that a batch stays small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= 1000:
        spark.conf.set(key, "1000")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small slices of the batches: Python objects are made for one slice at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
    release()


def gathered(batches: Iterator[pa.RecordBatch], limit: int, columns: tuple[str, ...], text: str) -> Iterator[list[list]]:
    """Rows as column lists, gathered until about ``limit`` characters of ``text``."""
    held: list[list] = [[] for _ in columns]
    size = 0
    at = columns.index(text)
    for b in sliced(batches):
        cols = [b.column(c).to_pylist() for c in columns]
        for row in zip(*cols, strict=True):
            for h, v in zip(held, row, strict=True):
                h.append(v)
            size += len(row[at] or "") + 16
            if size >= limit:
                yield held
                held, size = [[] for _ in columns], 0
    if held[0]:
        yield held


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: one narrow aggregate that sizes buckets by the data."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0))).first()[0])
