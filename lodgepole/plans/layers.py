"""Sinks and layer tables: write, lay out, register, load, reconcile.

The warehouse of the reference (three schemas, 14 tables, bulk ``COPY``
from staged Parquet) is expressed with the Spark catalog: one database per
layer, external Parquet tables, ``insertInto`` for the load, and count
aggregates for reconciliation. Tables live under a root folder that on a
cluster is shared storage (see :func:`lodgepole.session.lake_root`).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgepole.operators.skew import SALT, Salting, repeated, salted, salting
from lodgepole.schemas import LAYERS, LAYOUT, RUN_COLUMN

WRITE_MODES = ("overwrite", "append")


def layer_path(root: str, layer: str, table: str) -> str:
    """Staging folder of one table, e.g. ``{root}/curated_layer/curated_bookings``."""
    return f"{root.rstrip('/')}/{layer}/{table}"


def apply_layout(df: DataFrame, table: str) -> DataFrame:
    """Physical layout of a table: rows sorted by its sort keys inside each
    partition (no extra shuffle), so Parquet row-group min/max statistics
    let later range filters skip data.

    The distribution key takes no part here: a key holding a large share of
    rows would become one oversized file and task. :func:`save_bucketed` lays a
    table out by it where co-located joins pay off.
    """
    spec = LAYOUT.get(table)
    if not spec:
        return df
    _, sort_keys = spec
    keys = [k for k in sort_keys if k in df.columns]
    return df.sortWithinPartitions(*keys) if keys else df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    sized: bool = False,
) -> str:
    """Generic sink. ``overwrite`` replaces the folder through Spark's commit
    protocol (a failed job leaves the previous output), ``append`` adds files.
    ``sized`` makes the number of files follow the data (:func:`file_sized`)."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    if sized:
        df = file_sized(df, partition_by)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    with merging(df.sparkSession, cores_first=False) if sized else nullcontext():
        writer.save(path)
    return path


@contextmanager
def merging(spark: SparkSession, cores_first: bool) -> Iterator[None]:
    """How AQE merges small partitions as long as this lasts: up to the advisory
    size, whatever the number of cores, or (``cores_first``) only as far as every
    core keeps a task. Neither makes a partition larger than the advisory size."""
    conf = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(cores_first).lower())
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def file_sized(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Output partitions of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.

    A rebalancing exchange: AQE merges the small ones and splits the large ones
    by their real sizes, whatever the number of shuffle partitions. With
    ``keys`` (the folders of a partitioned write) rows of a key stay together as
    far as their size allows, so that a folder does not get a file from every
    task and a hot key is split over several.
    """
    return df.hint("rebalance", *(keys or []))


def write_layer_table(df: DataFrame, root: str, layer: str, table: str, mode: str = "overwrite", sized: bool = False) -> str:
    rows = apply_layout(file_sized(df) if sized else df, table)
    return write_table(rows, layer_path(root, layer, table), mode=mode)


def counted_write(df: DataFrame, path: str) -> int:
    """Write Parquet to a new folder and return the rows written, counted by
    the write itself (no second pass over the files)."""
    written = Observation()
    write_table(df.observe(written, F.count(F.lit(1)).alias("rows")), path)
    return int(written.get["rows"])


_SLICE_BITS = 20


def _slices(value_hash: Column, n: int) -> Column:
    """Sums of ``n`` slices of a 64-bit hash. A sum of 20-bit numbers is exact
    in a long for 8 * 10**12 rows, and needs no decimal arithmetic."""
    parts = [F.shiftright(value_hash, 64 - _SLICE_BITS * (i + 1)).bitwiseAND(F.lit((1 << _SLICE_BITS) - 1)) for i in range(n)]
    return F.concat_ws(":", *[F.coalesce(F.sum(p), F.lit(0)).cast("string") for p in parts])


def content_sums(columns: list[str]) -> list[Column]:
    """Aggregates that tell a multiset of rows: ``rows``, one checksum of the
    whole rows (``row``) and one of each column (``c0``, ``c1``, …).

    They do not depend on the order of rows or on the partitioning, and count
    repeated rows. Column sums name the column that changed; values that only
    changed places between rows show in the row sum alone. NULL is a value of
    its own (the hash functions skip it).
    """
    at = [F.col(f"`{c}`") for c in columns]
    return [
        F.count(F.lit(1)).alias("rows"),
        _slices(F.xxhash64(*[x for c in at for x in (c.isNull(), c)]), 3).alias("row"),
        *[_slices(F.xxhash64(c.isNull(), c), 2).alias(f"c{i}") for i, c in enumerate(at)],
    ]


@dataclass(frozen=True)
class Content:
    """What a write counted of the rows that passed through it."""

    columns: tuple[str, ...]
    rows: int
    row_sum: str
    column_sums: tuple[str, ...]


def checked_write(df: DataFrame, path: str) -> Content:
    """Write Parquet to a new folder and return the checksums of its rows,
    taken by the write itself."""
    written = Observation()
    write_table(df.observe(written, *content_sums(df.columns)), path)
    got = written.get
    return Content(tuple(df.columns), int(got["rows"]), got["row"], tuple(got[f"c{i}"] for i in range(len(df.columns))))


def save_bucketed(
    df: DataFrame, table_name: str, path: str, table: str, buckets: int
) -> None:
    """Catalog table with the layout of ``table``: bucketed by its distribution
    key and sorted by its sort keys, so that joins and aggregates on the key
    between tables of as many buckets need no shuffle.

    The rows are dealt to buckets before the write, one file for each; a key
    that holds a large share of the rows makes one large file, as it makes one
    large slice in a warehouse.
    """
    key, sort_keys = LAYOUT[table]
    if key is None:
        raise ValueError(f"{table} has no distribution key")
    (
        df.repartition(buckets, key).write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(*sort_keys)
        .saveAsTable(table_name)
    )


def save_salted_buckets(
    fact: DataFrame, lookup: DataFrame, names: tuple[str, str], root: str, keys: tuple[str, str], buckets: int, sort_by: list[str]
) -> Salting:
    """Two tables bucketed alike on a join key of which some values are hot.

    ``fact`` is bucketed by its key and a salt, which spreads the rows of a hot
    key (more than one bucket's even share) over all buckets; ``lookup`` holds its rows
    of those keys once for each salt. :func:`join_salted` joins them bucket by
    bucket, without a shuffle and without one file or task that holds a hot key.
    """
    s = salting(fact, keys[0], buckets)
    for df, name, key, rows in ((fact, names[0], keys[0], salted), (lookup, names[1], keys[1], repeated)):
        (
            rows(df, key, s).repartition(buckets, key, SALT).write.mode("overwrite").format("parquet")
            .option("path", f"{root}/{name.rsplit('.', 1)[-1]}")
            .bucketBy(buckets, key, SALT)
            .sortBy(*([key, SALT] if df is lookup else [key, SALT, *[c for c in sort_by if c != key]]))
            .saveAsTable(name)
        )
    return s


def join_salted(spark: SparkSession, names: tuple[str, str], keys: tuple[str, str]) -> DataFrame:
    """The inner join of two tables that :func:`save_salted_buckets` wrote."""
    a, b = spark.table(names[0]).alias("a"), spark.table(names[1]).withColumnRenamed(SALT, "lookup_salt").alias("b")
    same = (F.col(f"a.{keys[0]}") == F.col(f"b.{keys[1]}")) & (F.col(f"a.{SALT}") == F.col("b.lookup_salt"))
    return a.join(b.hint("merge"), same).drop(SALT, "lookup_salt")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_layer_tables(spark: SparkSession, root: str) -> list[str]:
    """Create the three layer databases and their 14 tables if absent.

    Idempotent: re-running it leaves existing tables as they are, but for
    columns that their schema has gained since (:func:`add_missing_columns`).
    """
    created = []
    for layer, tables in LAYERS.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/_warehouse/{layer}'")
        for table, schema in tables.items():
            location = f"{root}/_warehouse/{layer}/{table}"
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {layer}.{table} ({_ddl(schema)}) "
                f"USING parquet LOCATION '{location}'"
            )
            add_missing_columns(spark, f"{layer}.{table}", schema)
            created.append(f"{layer}.{table}")
    return created


class SchemaDrift(ValueError):
    """A column came with another type than the table's."""


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def add_missing_columns(spark: SparkSession, name: str, schema: T.StructType) -> list[str]:
    """Add the columns of ``schema`` that the table lacks (old rows read NULL);
    return their names. A column of another type raises :class:`SchemaDrift`
    before anything is changed. Columns that only the table has stay."""
    held = {f.name.lower(): f.dataType for f in spark.table(name).schema.fields}
    changed = [
        f"{f.name}: {held[f.name.lower()].simpleString()} became {f.dataType.simpleString()}"
        for f in schema.fields
        if held.get(f.name.lower(), f.dataType) != f.dataType
    ]
    if changed:
        raise SchemaDrift(f"{name}: {', '.join(changed)}")
    new = T.StructType([f for f in schema.fields if f.name.lower() not in held])
    if new.fields:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(new)})")
        spark.catalog.refreshTable(name)
    return new.names


def register_parquet(spark: SparkSession, database: str, table: str, path: str) -> DataFrame:
    """Expose a Parquet folder by name, as a crawler does.

    The schema is the union of the columns of all files (older files read NULL
    in newer columns). Folders named ``key=value`` become partitions: they are
    entered in the catalog, so that filters on the key prune folders without
    listing them. Calling it again takes in what has changed since: new and
    removed partitions, new files, new columns; a column of another type
    raises :class:`SchemaDrift`. A table of that name over another folder is
    an error, not a silent answer from there.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    if spark.catalog.tableExists(name):
        if not same_path(table_location(spark, name), path):
            raise ValueError(f"{name} stands for {table_location(spark, name)}, not {path}")
        spark.catalog.refreshTable(name)
        add_missing_columns(spark, name, spark.read.option("mergeSchema", True).parquet(path).schema)
    else:
        spark.catalog.createTable(name, path=path, source="parquet", mergeSchema="true")
    if partition_columns(spark, name):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    return spark.table(name)


def ensure_not_empty(df: DataFrame, what: str) -> None:
    """Fail a load whose source has no rows (a one-row probe, not a count)."""
    if df.isEmpty():
        raise ValueError(f"no rows found in {what}")


def load_into(spark: SparkSession, df: DataFrame, table: str, mode: str = "overwrite") -> None:
    """Bulk load into a catalog table. ``insertInto`` matches columns by
    position, so the source is first projected onto the target's columns."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    target_cols = spark.table(table).columns
    df.select(*target_cols).write.insertInto(table, overwrite=(mode == "overwrite"))


def table_location(spark: SparkSession, table: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    return detail.data_type.rstrip("/") if detail else ""


def same_path(a: str, b: str) -> bool:
    """Whether two folders are the same, however a local one is written."""
    plain = [re.sub(r"^file:/+", "/", p).rstrip("/") for p in (a, b)]
    return plain[0] == plain[1]


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name.lower(), f.dataType) for f in a.fields] == [
        (f.name.lower(), f.dataType) for f in b.fields
    ]


def publish(
    spark: SparkSession,
    path: str,
    table: str,
    mode: str = "overwrite",
    staged: DataFrame | None = None,
) -> str:
    """Make the Parquet files written at ``path`` the content of ``table``.

    ``overwrite`` without copying: when the files have exactly the table's
    columns and types, the table is re-pointed at ``path`` with
    ``ALTER TABLE … SET LOCATION``. That is one catalog update, so readers
    see either the previous or the new data, a failed run never leaves a
    half-written table, and a layer is written once instead of twice. From
    then on the folder belongs to the table: every run writes to a folder of
    its own (:func:`lodgepole.plans.batch.run_batch`), so none is ever written
    under a table. ``append`` (or files whose schema differs) copies and casts
    the rows into the table's own folder.

    ``staged`` may pass the files at ``path`` already opened as a DataFrame.
    Returns ``"relocated"`` or ``"loaded"``.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    if staged is None:
        staged = spark.read.parquet(path)
    if mode == "overwrite" and _same_columns(staged.schema, spark.table(table).schema):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
        return "relocated"
    if mode == "append" and table_location(spark, table) == path.rstrip("/"):
        raise ValueError(f"{path} is already the folder of {table}: appending it would double its rows")
    target = spark.table(table).schema
    load_into(
        spark,
        staged.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields]),
        table,
        mode=mode,
    )
    return "loaded"


@dataclass(frozen=True)
class Load:
    """What was loaded into a table: the rows that the write of the source
    counted, and the rows that the table held before. Where the table keeps
    each run as a partition, ``run`` names it and only that part is compared."""

    layer: str
    table: str
    source_rows: int
    rows_before: int = 0
    run: str | None = None


@dataclass(frozen=True)
class CheckedLoad:
    """A load together with the checksums that its write took."""

    layer: str
    table: str
    content: Content
    run: str | None = None


def _loaded(spark: SparkSession, name: str, run: str | None) -> DataFrame:
    held = spark.table(name)
    return held if run is None else held.filter(F.col(RUN_COLUMN) == run)


def content_report(spark: SparkSession, loads: list[CheckedLoad]) -> DataFrame:
    """One row per load: ``layer, table_name, source_rows, target_rows,
    rows_match, content_match, differing_columns``.

    The checksums of what the table holds now (one aggregate over it) against
    those of the write. ``content_match`` is false as soon as any row differs;
    ``differing_columns`` (comma-separated, in the table's order) names the
    columns whose own values changed and is empty if values only changed places.
    A table that cannot be read, or lacks a column, is reported without counts.
    """
    out = []
    for load in loads:
        name, content = f"{load.layer}.{load.table}", load.content
        held = None
        if spark.catalog.tableExists(name) and is_readable(spark, name):
            held = _loaded(spark, name, load.run)
            held = held if set(content.columns) <= set(held.columns) else None
        if held is None:
            sums = spark.range(0, 1, 1, 1).select(*[F.lit(None).cast("string").alias(c) for c in ("rows", "row", *[f"c{i}" for i in range(len(content.columns))])])
        else:
            sums = held.agg(*content_sums(list(content.columns)))
        differs = [
            F.when(F.col(f"c{i}") != F.lit(s), F.lit(c)) for i, (c, s) in enumerate(zip(content.columns, content.column_sums, strict=True))
        ]
        out.append(
            sums.select(
                F.lit(load.layer).alias("layer"),
                F.lit(load.table).alias("table_name"),
                F.lit(content.rows).cast("long").alias("source_rows"),
                F.col("rows").cast("long").alias("target_rows"),
                F.coalesce(F.col("rows") == content.rows, F.lit(False)).alias("rows_match"),
                F.coalesce((F.col("rows") == content.rows) & (F.col("row") == content.row_sum), F.lit(False)).alias("content_match"),
                F.concat_ws(",", *differs).alias("differing_columns"),
            )
        )
    return reduce(DataFrame.unionByName, out)


def is_readable(spark: SparkSession, name: str) -> bool:
    """Whether one row of the table can be read (an empty table can)."""
    try:
        spark.table(name).limit(1).collect()
    except (PySparkException, Py4JJavaError):  # a failed task comes back as the latter
        return False
    return True


def presence(spark: SparkSession, tables: list[str]) -> DataFrame:
    """One row per table name: ``table_name, present, readable, has_rows``.

    A table that cannot be read is reported and does not fail the report; each
    probe reads one row at most.
    """
    rows = []
    for name in tables:
        present = spark.catalog.tableExists(name)
        readable = present and is_readable(spark, name)
        rows.append((name, present, readable, readable and not spark.table(name).isEmpty()))
    return spark.createDataFrame(rows, "table_name string, present boolean, readable boolean, has_rows boolean")


def reconcile(spark: SparkSession, loads: list[Load]) -> DataFrame:
    """One row per load: ``layer, table_name, present, readable, source_rows,
    target_rows, complete``.

    ``source_rows`` is what the write of the source counted, ``target_rows`` what
    the table holds now, and ``complete`` whether it has grown by exactly the
    source's rows (of a table that keeps runs apart: whether that run's part
    holds exactly these). A table that is missing or cannot be read is reported
    (``target_rows`` NULL) and does not fail the report. Each count is a
    distributed aggregate evaluated as a scalar subquery.
    """
    rows = []
    for load in loads:
        name = f"{load.layer}.{load.table}"
        present = spark.catalog.tableExists(name)
        readable = present and is_readable(spark, name)
        held = _loaded(spark, name, load.run).agg(F.count(F.lit(1))).scalar() if readable else F.lit(None)
        rows.append(
            spark.range(0, 1, 1, 1)
            .select(
                F.lit(load.layer).alias("layer"),
                F.lit(load.table).alias("table_name"),
                F.lit(present).alias("present"),
                F.lit(readable).alias("readable"),
                F.lit(load.source_rows).cast("long").alias("source_rows"),
                held.cast("long").alias("target_rows"),
            )
            .withColumn(
                "complete",
                F.coalesce(F.col("target_rows") - F.lit(load.rows_before) == F.col("source_rows"), F.lit(False)),
            )
        )
    return reduce(DataFrame.unionByName, rows)
