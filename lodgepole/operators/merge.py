"""Keyed upsert and keyless append of a batch into a table.

``upsert`` has the semantics of ``INSERT … ON DUPLICATE KEY UPDATE`` over
all non-key columns: a new key is inserted, an existing key gets every
column from the batch, and within one batch the latest row wins. "Latest"
must be stated by the caller (``order_by``, for instance an arrival number);
without it there is no right answer, so it is required. Any tie left after it
is broken by the remaining columns, so the result never depends on how the
rows happened to be partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SOURCE = "__merge_source"
_RANK = "__merge_rank"


def latest_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``; any tie left after it is
    broken by the remaining columns (descending), so the choice never
    depends on partitioning.

    Planned as ``row_number() = 1`` per key, which Spark executes with a
    partial ``WindowGroupLimit`` before the shuffle: a key repeated in a
    large share of the rows is cut to one row per task before it is
    exchanged, so a hot key does not pile up in one reducer.
    """
    tie_break = [F.col(c).desc_nulls_last() for c in rows.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *tie_break)
    return (
        rows.withColumn(_RANK, F.row_number().over(w))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order_by: list[Column],
) -> DataFrame:
    """One row per key from ``target ∪ batch``; batch rows beat target rows,
    and among batch rows the greatest by ``order_by`` wins.

    The result is a new DataFrame; write it to a new location (or version)
    rather than over the table it was read from.
    """
    if not order_by:
        raise ValueError("upsert needs order_by: which of several rows of one key came last")
    cols = target.columns
    if sorted(cols) != sorted(batch.columns):
        raise ValueError("target and batch must have the same columns")
    both = target.select(*cols, F.lit(0).alias(_SOURCE)).unionByName(
        batch.select(*cols, F.lit(1).alias(_SOURCE))
    )
    order = [F.col(_SOURCE).desc()] + [o.desc_nulls_last() for o in order_by]
    return latest_per_key(both, keys, order).select(*cols)


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Keyless load: the batch is added as is (a re-run duplicates rows;
    the curated layer's whole-row de-duplication removes them)."""
    return target.unionByName(batch)
