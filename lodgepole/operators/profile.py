"""Data profiling: duplicates, NULLs, summary statistics, schema.

Every profile is computed as a distributed aggregate (one pass per table,
map-side partial aggregation) and returned in long format so that tables
with different columns can be stacked into one result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def duplicate_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: ``total_rows``, ``distinct_rows`` and ``duplicate_rows``
    (= total − distinct), from a single group-by on all columns.

    The group-by aggregates partially inside each task, so heavily repeated
    rows are collapsed before the shuffle.
    """
    parts = []
    for name, df in tables.items():
        groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            groups.agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
                F.count(F.lit(1)).cast("long").alias("distinct_rows"),
            ).select(
                F.lit(name).alias("table_name"),
                "total_rows",
                "distinct_rows",
                (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and column: ``data_type`` and ``null_count``; one global
    aggregate per table, then unpivoted to one row per column."""
    parts = []
    for name, df in tables.items():
        fields = df.schema.fields
        wide = df.agg(
            *[F.count_if(F.col(f.name).isNull()).alias(f"c{i}") for i, f in enumerate(fields)]
        )
        long = wide.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("ordinal"),
                            F.lit(f.name).alias("column_name"),
                            F.lit(f.dataType.simpleString()).alias("data_type"),
                            F.col(f"c{i}").cast("long").alias("null_count"),
                        )
                        for i, f in enumerate(fields)
                    ]
                )
            )
        )
        parts.append(long.select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def summary_profile(tables: dict[str, DataFrame], digits: int = 6) -> DataFrame:
    """What ``describe()`` reports, in long format: ``count, mean, stddev, min,
    max`` of every numeric column as numbers, and ``count, min_text, max_text``
    of every string column. Mean and stddev are rounded to ``digits`` decimals.
    Columns of other types are left out, as there. One aggregate per table."""
    parts = []
    for name, df in tables.items():
        fields = [f for f in df.schema.fields if isinstance(f.dataType, (*NUMERIC, T.StringType))]
        if not fields:
            continue
        stats = []
        for i, f in enumerate(fields):
            text = isinstance(f.dataType, T.StringType)
            c = F.lit(None).cast("double") if text else F.col(f.name).cast("double")
            s = F.col(f.name) if text else F.lit(None).cast("string")
            stats.append(
                F.struct(
                    F.lit(i).alias("ordinal"),
                    F.lit(f.name).alias("column_name"),
                    F.count(F.col(f.name)).cast("long").alias("count"),
                    F.round(F.avg(c), digits).alias("mean"),
                    F.round(F.stddev_samp(c), digits).alias("stddev"),
                    F.min(c).alias("min"),
                    F.max(c).alias("max"),
                    F.min(s).alias("min_text"),
                    F.max(s).alias("max_text"),
                ).alias(f"s{i}")
            )
        wide = df.agg(*stats)
        long = wide.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(fields))])))
        parts.append(long.select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def describe(df: DataFrame) -> DataFrame:
    """Spark's own ``describe()`` (string-valued, numeric and string columns)."""
    return df.describe()


def schema_profile(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Column name, type and nullability per table, from table metadata only
    (no data is read)."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, ordinal int, column_name string, data_type string, nullable boolean"
    )


def preview(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in the order of all columns (NULL first): the same
    rows however the table is partitioned. Each task keeps ``n`` rows."""
    return df.orderBy(*[F.asc_nulls_first(f"`{c}`") for c in df.columns]).limit(n)
