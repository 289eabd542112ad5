"""Incremental extraction: a run reads what changed since the run before.

Each table keeps, under ``{root}/{table}``, its rows, its deleted keys and its
watermark by run::

    rows/run=1/…   deletes/run=1/…   state/run=1/…

A run reads the rows whose watermark (a modification date, an increasing key)
is not below the one kept with the last finished run; the filter reaches the
source's scan. Rows at the watermark itself and rows without one are compared
with what is held, so that late rows of the same day come and unchanged ones
do not come twice. The keys of source and table are compared as well, both ways:
deleted rows are the keys held that the source no longer has, and rows that
arrive (or come back) with an older watermark are those whose key is not held. The state is written last: a run that died
before is repeated under its own number and replaces what it had written.

A held row that changes without moving its watermark is not seen; that is what
a watermark means.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgepole.plans.layers import write_table

RUN = "extract_run"


@dataclass(frozen=True)
class Extracted:
    """What one run of one table wrote."""

    run: int
    rows: int
    deletes: int


def _with_run(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("run", T.IntegerType())])


def _runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The rows below ``path`` by run; None before the first run."""
    try:
        return spark.read.schema(_with_run(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _state_schema(mark: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("watermark", mark)])


def held(spark: SparkSession, root: str, table: str, schema: T.StructType, keys: list[str], before: int | None = None) -> DataFrame:
    """The table as the runs leave it (those below ``before``): the last row of
    each key, without the keys deleted since; with the run it came in."""
    rows = _runs(spark, f"{root}/{table}/rows", schema)
    if rows is None:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(RUN, T.IntegerType())]))
    key_schema = T.StructType([schema[k] for k in keys])
    gone = _runs(spark, f"{root}/{table}/deletes", key_schema)
    rows = rows.withColumn("deleted", F.lit(False))
    if gone is not None:
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in keys]
        rows = rows.unionByName(gone.select(*keys, "run", *missing, F.lit(True).alias("deleted")))
    if before is not None:
        rows = rows.filter(F.col("run") < before)
    # the last entry of each key: a partial WindowGroupLimit keeps one row a key and task
    last = Window.partitionBy(*keys).orderBy(F.desc("run"), F.asc("deleted"))
    latest = rows.withColumn("nth", F.row_number().over(last)).filter("nth = 1 and not deleted")
    return latest.select(*schema.names, F.col("run").alias(RUN))


def extract_changes(spark: SparkSession, source: DataFrame, root: str, table: str, keys: list[str], watermark: Column) -> Extracted:
    """Extract the rows that are new or changed since the last finished run, and
    the keys that are gone.

    ``keys`` identify a row (no two rows share them), ``watermark`` is an
    expression over the source's columns that never falls for a changed row.
    """
    path, schema = f"{root}/{table}", source.schema
    mark = source.select(watermark.alias("watermark")).schema["watermark"].dataType
    state = _runs(spark, f"{path}/state", _state_schema(mark))
    last = state.agg(F.max_by(F.struct("run", "watermark"), "run").alias("s")).first()["s"] if state is not None else None
    run, seen = (last["run"] + 1, last["watermark"]) if last is not None else (1, None)
    marked = source.withColumn("watermark", watermark)
    changed, deletes = marked, source.select(*keys).limit(0)
    if last is not None:
        before = held(spark, root, table, schema, keys, run)
        if seen is not None:
            # what may have changed: the filter is on the source, so its scan prunes files
            marked = marked.filter((F.col("watermark") >= F.lit(seen)) | F.col("watermark").isNull())
        row = F.xxhash64(*[x for c in schema.names for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
        known = before.select(*[F.col(k).alias(f"held_{k}") for k in keys], row.alias("held_row"))
        same = [F.col(k).eqNullSafe(F.col(f"held_{k}")) for k in keys]
        changed = marked.withColumn("this_row", row).join(known, [*same, F.col("this_row") == F.col("held_row")], "left_anti").drop("this_row")
        if seen is not None:
            older = source.withColumn("watermark", watermark).filter(F.col("watermark") < F.lit(seen))
            mine = [F.col(f"new_{k}").eqNullSafe(F.col(f"held_{k}")) for k in keys]
            new = older.select(*[F.col(k).alias(f"new_{k}") for k in keys]).join(known, mine, "left_anti")
            if not new.isEmpty():
                changed = changed.unionByName(older.join(new, [F.col(k).eqNullSafe(F.col(f"new_{k}")) for k in keys], "left_semi"))
        now = source.select(*[F.col(k).alias(f"now_{k}") for k in keys])
        deletes = before.select(*keys).join(now, [F.col(k).eqNullSafe(F.col(f"now_{k}")) for k in keys], "left_anti")
    wrote, dropped = Observation(), Observation()
    counted = changed.observe(wrote, F.count(F.lit(1)).alias("rows"), F.max("watermark").alias("most"))
    write_table(counted.drop("watermark"), f"{path}/rows/run={run}")
    write_table(deletes.observe(dropped, F.count(F.lit(1)).alias("rows")), f"{path}/deletes/run={run}")
    most = wrote.get["most"]
    most = seen if most is None or (seen is not None and most < seen) else most
    write_table(spark.createDataFrame([(most,)], _state_schema(mark)).coalesce(1), f"{path}/state/run={run}")
    return Extracted(run, int(wrote.get["rows"]), int(dropped.get["rows"]))
