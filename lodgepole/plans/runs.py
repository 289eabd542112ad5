"""Tables that accumulate runs: one catalog partition for each run.

An appended batch is a folder of Parquet files and one catalog entry that names
it, so appending copies nothing, and a run that is repeated replaces its own part
instead of adding its rows again:

* a table that a batch is appended to is partitioned by ``load_run``; what it
  held before becomes the part ``BASE``, by catalog entries alone;
* ``add_run`` points the part of a run at its files. It is one catalog update;
  the same call with new files moves the part there;
* an append that died half-way is repeated under the same run id: the tables it
  had reached get the new files in place of the old ones, the others get theirs.

``published`` gives the columns of the layer's schema, without ``load_run``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgepole.plans.layers import _ddl, partition_columns, same_path, table_location, write_table
from lodgepole.schemas import LAYERS, RUN_COLUMN

BASE = "base"
_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.\-]*")


def check_run_id(run: str) -> str:
    """A run id becomes part of folder names and catalog statements."""
    if not _RUN_ID.fullmatch(run) or run == BASE:
        raise ValueError(f"not a run id: {run!r}")
    return run


def accumulates(spark: SparkSession, name: str) -> bool:
    return partition_columns(spark, name) == [RUN_COLUMN]


def accumulate(spark: SparkSession, name: str) -> None:
    """Make a table keep its runs apart; its present files become the part ``BASE``.

    Nothing is copied. The new table is built beside the old one and then takes
    its name; a conversion that died in between is finished by the next call.
    """
    beside = f"{name}__runs"
    if not spark.catalog.tableExists(name):
        if not spark.catalog.tableExists(beside):
            raise ValueError(f"no table {name}")
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
        return
    if accumulates(spark, name):
        return
    if partition_columns(spark, name):
        raise ValueError(f"{name} is partitioned by its own columns")
    files = table_location(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {beside}")
    spark.sql(
        f"CREATE TABLE {beside} ({_ddl(spark.table(name).schema)}, `{RUN_COLUMN}` string) "
        f"USING parquet PARTITIONED BY ({RUN_COLUMN}) LOCATION '{files}__runs'"
    )
    if not spark.table(name).isEmpty():
        spark.sql(f"ALTER TABLE {beside} ADD PARTITION ({RUN_COLUMN}='{BASE}') LOCATION '{files}'")
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    spark.catalog.refreshTable(name)


def finish_conversions(spark: SparkSession) -> list[str]:
    """Give layer tables whose conversion died before its last step their name back."""
    names = [f"{layer}.{t}" for layer, tables in LAYERS.items() for t in tables]
    lost = [n for n in names if spark.catalog.tableExists(f"{n}__runs") and not spark.catalog.tableExists(n)]
    for name in lost:
        accumulate(spark, name)
    return lost


def runs_of(spark: SparkSession, name: str) -> list[str]:
    """The runs that a table holds (one entry for each append ever made)."""
    return sorted(r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())


def run_location(spark: SparkSession, name: str, run: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({RUN_COLUMN}='{run}')")
    return detail.filter("col_name = 'Location'").first().data_type


def add_run(spark: SparkSession, name: str, run: str, path: str) -> str:
    """Make the Parquet files at ``path`` the part of ``run``; "added" or "replaced".

    Files whose columns or types are not the table's are cast into a folder
    beside ``path`` first, as a bulk load would.
    """
    check_run_id(run)
    accumulate(spark, name)
    data = [f for f in spark.table(name).schema.fields if f.name != RUN_COLUMN]
    staged = spark.read.parquet(path)
    if {f.name.lower(): f.dataType for f in staged.schema.fields} != {f.name.lower(): f.dataType for f in data}:
        path = write_table(staged.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in data]), f"{path.rstrip('/')}__cast")
    known = run in runs_of(spark, name)
    if known and same_path(run_location(spark, name, run), path):
        return "replaced"
    if known:
        spark.sql(f"ALTER TABLE {name} PARTITION ({RUN_COLUMN}='{run}') SET LOCATION '{path}'")
    else:
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({RUN_COLUMN}='{run}') LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return "replaced" if known else "added"


def drop_runs(spark: SparkSession, name: str, runs: list[str]) -> None:
    """Take runs out of a table, by one catalog statement; their files stay."""
    if runs:
        parts = ", ".join(f"PARTITION ({RUN_COLUMN}='{r}')" for r in runs)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
        spark.catalog.refreshTable(name)


def published(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """A layer table with the columns of its published schema."""
    return spark.table(f"{layer}.{table}").select(*LAYERS[layer][table].names)
