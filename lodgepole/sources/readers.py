"""Readers for the raw layer: Parquet, CSV, JDBC and catalog tables.

All readers return lazy DataFrames. None of them counts rows eagerly: a
count is a full extra job, so it is only done when a caller asks for a
reconciliation (see ``lodgepole.plans.layers.reconcile``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgepole.schemas import RAW


def read_parquet_table(
    spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """``{root}/{name}.parquet`` (a file or a folder of part files), where
    ``root`` is a local path or a URI that Spark can read.

    With a declared ``schema`` no job is run to infer it from the file
    footers; columns are still matched by name, so the scan reads only the
    columns a plan uses.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    header: bool = True,
) -> DataFrame:
    """CSV with an explicit schema (never inferred: inference is an extra
    pass over the data and guesses differently per file). What does not fit
    reads as NULL here, without a sign; :func:`stage_csv` sets such lines apart."""
    if isinstance(schema, str):
        schema = RAW[schema]
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


RECORD = "malformed_record"


@dataclass(frozen=True)
class StagedCsv:
    """A CSV source split by one pass: rows that fit the schema, and the lines
    that do not as ``source_file, record, reason``."""

    good: DataFrame
    quarantined: DataFrame
    good_rows: int
    quarantined_rows: int


def malformed_reason(schema: T.StructType, record: str = RECORD, escape: str = "\\") -> Column:
    """Why a line does not fit: its number of fields, or the columns whose text
    is no value of their type (``price: 'abc' is no double``)."""
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))] + [T.StructField("rest", T.StringType())])
    parsed = F.from_csv(F.col(record), texts.simpleString()[len("struct<") : -1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "rest", "escape": escape})
    wrong = [
        F.when(
            parsed[f"c{i}"].isNotNull() & parsed[f"c{i}"].try_cast(f.dataType).isNull(),
            F.concat(F.lit(f"{f.name}: '"), parsed[f"c{i}"], F.lit(f"' is no {f.dataType.simpleString()}")),
        )
        for i, f in enumerate(schema.fields)
    ]
    return F.when(parsed["rest"].isNotNull(), F.lit(f"not {len(schema)} fields")).otherwise(F.concat_ws("; ", *wrong))


def stage_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, out: str, header: bool = True, multi_line: bool = False, escape: str = "\\"
) -> StagedCsv:
    """Read CSV lines once and write them under ``out`` as Parquet, those that
    fit the schema apart from those that do not (quarantine).

    A line does not fit if it has fewer or more fields than the schema or a
    text that is no value of its column's type. It goes to the quarantine as it
    was read, with its file and the reason, and none of its values is loaded.
    Good and quarantined rows add up to the lines of the source (blank
    lines and headers aside); both counts are taken by the write. ``escape`` is
    what stands before a quote inside quotes (``"`` for doubled quotes).
    """
    if isinstance(schema, str):
        schema = RAW[schema]
    clash = {RECORD, "malformed", "source_file"} & {f.name.lower() for f in schema.fields}
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    lines = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())]))
        .option("header", header)
        .option("multiLine", multi_line)
        .option("escape", escape)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .option("columnPruning", False)  # every field is parsed, whatever a plan needs
        .csv(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    bad = F.col(RECORD).isNotNull()
    told = lines.select(
        *[F.when(~bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields],
        F.when(bad, F.col("source_file")).alias("source_file"),
        RECORD,
        F.when(bad, malformed_reason(schema, escape=escape)).alias("reason"),
        bad.alias("malformed"),
    )
    seen = Observation()
    told.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if("malformed").alias("bad")).write.mode("overwrite").partitionBy(
        "malformed"
    ).parquet(out)
    staged = spark.read.schema(told.schema).parquet(out)
    return StagedCsv(
        staged.filter("not malformed").select(*[f"`{f.name}`" for f in schema.fields]),
        staged.filter("malformed").select("source_file", F.col(RECORD).alias("record"), "reason"),
        int(seen.get["lines"]) - int(seen.get["bad"]),
        int(seen.get["bad"]),
    )


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    With ``partition_column`` and bounds, Spark issues ``num_partitions``
    range queries in parallel instead of one whole-table scan in one task.
    The bounds only split the range; rows outside them still land in the
    first / last partition, so nothing is lost.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need bounds and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """One table over JDBC; see :func:`jdbc_options` for the arguments."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def read_jdbc_partitioned(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    num_partitions: int,
    **kwargs,
) -> DataFrame:
    """Partitioned JDBC read with bounds taken from the key's min/max.

    The min/max probe is a single aggregate pushed down to the database.
    """
    probe = read_jdbc(
        spark, url=url, table=f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) b", **kwargs
    ).first()
    lo, hi = (probe[0], probe[1]) if probe is not None else (None, None)
    if lo is None:
        return read_jdbc(spark, url=url, table=table, **kwargs)
    return read_jdbc(
        spark,
        url=url,
        table=table,
        partition_column=key,
        lower_bound=int(lo),
        upper_bound=int(hi) + 1,
        num_partitions=num_partitions,
        **kwargs,
    )


def jdbc_sources(
    spark: SparkSession,
    url: str,
    tables: str | list[str],
    partition_keys: dict[str, str] | None = None,
    num_partitions: int | None = None,
    **kwargs,
) -> dict[str, DataFrame]:
    """Lazy readers for several tables of one database (a comma-separated
    list is accepted). Tables with a key in ``partition_keys`` are read in
    parallel ranges; the others in one query. Hand the result to
    :func:`lodgepole.plans.batch.extract` to stage them as Parquet."""
    names = [t.strip() for t in (tables.split(",") if isinstance(tables, str) else tables) if t.strip()]
    keys = partition_keys or {}
    if keys and not num_partitions:
        raise ValueError("tables read in parallel ranges need num_partitions")
    out = {}
    for name in names:
        if name in keys:
            out[name] = read_jdbc_partitioned(spark, url, name, keys[name], num_partitions, **kwargs)
        else:
            out[name] = read_jdbc(spark, url=url, table=name, **kwargs)
    return out


def read_catalog_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A table registered in the session catalog, by database and name."""
    return spark.table(f"{database}.{table}")
