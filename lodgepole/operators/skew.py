"""Joins and layouts whose key is hot: salting by measured key shares.

A key that holds more than ``share`` of the rows (an even part of the tasks, by
default) is spread over ``salts`` parts: its rows carry a salt from 0 to
``salts - 1``, taken from a hash of the whole row, and its rows on the other
side of a join are repeated once for each salt. All other keys have salt 0 and
nothing of them is repeated. Fewer than ``1 / share`` keys can be hot, so the
list of hot keys, and what is repeated for them, is bounded whatever the size.

The salt depends on nothing but the row, so a task that is run again deals its
rows as before (identical rows share a salt: de-duplicate first where a row is
copied in masses). A NULL key joins nothing and is never hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "key_salt"
JOIN_TYPES = ("inner", "left", "left_semi", "left_anti")


@dataclass(frozen=True)
class Salting:
    """The hot keys of a column and the number of parts of each."""

    keys: tuple
    salts: int


def salting(df: DataFrame, key: str, salts: int, share: float | None = None) -> Salting:
    """Measure which keys hold more than ``share`` (default ``1 / salts``) of the
    rows: one aggregate with partial sums in each task.

    The total is the sum of the counts, and a NULL key leaves the result and not
    the plan, so that both share one shuffle and ``df`` is computed once."""
    if salts < 1:
        raise ValueError("salts must be at least 1")
    share = share or 1.0 / salts
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    hot = counts.filter(F.col("n") > total * share).select(key).collect()
    return Salting(tuple(sorted(r[0] for r in hot if r[0] is not None)), salts)


def _is_hot(key: str, s: Salting) -> Column:
    return F.col(key).isin(*s.keys) if s.keys else F.lit(False)


def salted(df: DataFrame, key: str, s: Salting, name: str = SALT) -> DataFrame:
    """``df`` with a salt for every row."""
    row = F.xxhash64(*[x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
    return df.withColumn(name, F.when(_is_hot(key, s), F.pmod(row, F.lit(s.salts))).otherwise(F.lit(0)).cast("int"))


def repeated(df: DataFrame, key: str, s: Salting, name: str = SALT) -> DataFrame:
    """``df`` with the rows of hot keys once for each salt, all others with salt 0."""
    parts = F.when(_is_hot(key, s), F.sequence(F.lit(0), F.lit(s.salts - 1))).otherwise(F.array(F.lit(0)))
    return df.withColumn(name, F.explode(parts))


def skew_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, salts: int, how: str = "inner", share: float | None = None) -> DataFrame:
    """Equi-join whose ``left`` side may hold a hot key; the rows of a plain join.

    For joins in which neither side can be broadcast: a key that is repeated on
    both sides keeps its whole fan-out, spread over ``salts`` tasks.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {JOIN_TYPES}")
    s = salting(left, left_key, salts, share)
    if not s.keys:
        return left.join(right, left[left_key] == right[right_key], how)
    a, b = salted(left, left_key, s, "left_salt"), repeated(right, right_key, s, "right_salt")
    same = (F.col(f"a.{left_key}") == F.col(f"b.{right_key}")) & (F.col("a.left_salt") == F.col("b.right_salt"))
    return a.alias("a").join(b.alias("b"), same, how).drop("left_salt", "right_salt")
