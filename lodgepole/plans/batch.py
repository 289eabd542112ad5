"""The end-to-end batch job: extract → curate → metrics → load → reconcile.

Each stage writes its tables before the next stage reads them back:

* the written Parquet is the lineage cut — a lost executor later in the
  job recomputes from those files, never from the source extraction;
* curated tables are written *before* metrics (a failure between them
  cannot leave the layers out of step), and metrics read them back as
  Parquet, so each metric scans only the columns it needs with its filter
  pushed into the scan (the whole-row de-duplication upstream would
  otherwise defeat column pruning);
* the de-duplication and the listings join run once, not once per sink;
* every layer is written once: in overwrite mode the layer tables are
  re-pointed at the written files (an atomic catalog update, no copy), in
  append mode the files become the run's partition (:mod:`lodgepole.plans.runs`);
* every attempt writes to a folder of its own, which no table points to, so a
  run can neither overwrite what a table holds nor append to what it has just
  written; an append that failed half-way is repeated under the same
  ``run_id`` and replaces what it had reached;
* the tables of one stage do not depend on each other, so their writes are
  submitted together from a few driver threads and Spark runs the jobs
  side by side (one job's short tail stages leave cores another job uses).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from lodgepole.functions.dates import DEFAULT_SPINE_END, DEFAULT_SPINE_START
from lodgepole.functions.numeric import nan_to_null
from lodgepole.operators.curate import curate_all
from lodgepole.operators.metrics import all_metrics
from lodgepole.plans.layers import (
    Load,
    apply_layout,
    counted_write,
    create_layer_tables,
    ensure_not_empty,
    layer_path,
    merging,
    publish,
    reconcile,
)
from lodgepole.plans.runs import accumulates, add_run, check_run_id, drop_runs, finish_conversions, runs_of
from lodgepole.schemas import NAN_TO_NULL_TABLES
from lodgepole.sources.domain import source_tables

# Independent writes of one stage submitted at the same time.
MAX_CONCURRENT_WRITES = 8

R = TypeVar("R")


def run_each(action: Callable[[str, DataFrame], R], frames: dict[str, DataFrame]) -> dict[str, R]:
    """Run ``action(table, df)`` for every table concurrently (each call is
    one Spark job, e.g. a write); returns table → result, raising the first
    error."""
    if len(frames) <= 1:
        return {t: action(t, df) for t, df in frames.items()}
    with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT_WRITES, len(frames))) as pool:
        futures = {t: pool.submit(action, t, df) for t, df in frames.items()}
        return {t: f.result() for t, f in futures.items()}


def write_layer(
    spark: SparkSession, frames: dict[str, DataFrame], root: str, layer: str
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write the tables of one layer (with their layout); return them read
    back from the written files (with the schema just written, so no job is
    spent inferring it) and the rows that each write counted.

    Partitions are merged as far as every core keeps a task: merged by size
    alone, a layer that is small when compressed is joined, de-duplicated,
    sorted and written by a few tasks, and the next stage scans as few files.
    """
    with merging(spark, cores_first=True):
        rows = run_each(lambda t, df: counted_write(apply_layout(df, t), layer_path(root, layer, t)), frames)
    return {t: spark.read.schema(df.schema).parquet(layer_path(root, layer, t)) for t, df in frames.items()}, rows


def ingest(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The loaders' normalisation: NaN becomes NULL in the tables whose
    loaders do so, whatever kind of source they come from."""
    return {t: nan_to_null(df) if t in NAN_TO_NULL_TABLES else df for t, df in sources.items()}


def extract(
    spark: SparkSession, sources: dict[str, DataFrame], root: str
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Ingest each source table and write it as Parquet under
    ``{root}/raw_layer/{table}`` (one independent Spark job per table);
    return the staged copies and their row counts."""
    return write_layer(spark, ingest(sources), root, "raw_layer")


def materialise_curated(
    spark: SparkSession, raw: str | dict[str, DataFrame], root: str
) -> dict[str, DataFrame]:
    """Curate and write the three curated tables; return them read back."""
    if isinstance(raw, str):
        raw = ingest(source_tables(spark, raw))
    return write_layer(spark, curate_all(raw), root, "curated_layer")[0]


def metric_frames(
    spark: SparkSession,
    curated: dict[str, DataFrame],
    start: str = DEFAULT_SPINE_START,
    end: str = DEFAULT_SPINE_END,
) -> dict[str, DataFrame]:
    return all_metrics(spark, curated, start, end)


def run_batch(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    start: str = DEFAULT_SPINE_START,
    end: str = DEFAULT_SPINE_END,
    load_mode: str = "overwrite",
    run_id: str | None = None,
) -> DataFrame:
    """Run every stage and return the load reconciliation report.

    Tables are created under ``root``; the files go to a new folder under it,
    so the same ``root`` may be used again. ``run_id`` names the batch in append
    mode: a repetition under the same name replaces the batch's rows. A caller
    that may repeat a batch passes it; without one the batch has a name of its own.
    """
    run_id = check_run_id(run_id or uuid.uuid4().hex)
    run = f"{root}/runs/{run_id}/{uuid.uuid4().hex}"
    raw, raw_rows = extract(spark, sources, run)
    for table, df in raw.items():
        ensure_not_empty(df, f"raw_layer/{table}")
    curated, curated_rows = write_layer(spark, curate_all(raw), run, "curated_layer")
    metrics, metric_rows = write_layer(spark, metric_frames(spark, curated, start, end), run, "presentation_layer")

    finish_conversions(spark)
    create_layer_tables(spark, root)
    staged = {
        "raw_layer": (raw, raw_rows),
        "curated_layer": (curated, curated_rows),
        "presentation_layer": (metrics, metric_rows),
    }
    loads = []
    for layer, (tables, rows) in staged.items():
        for table, df in tables.items():
            name = f"{layer}.{table}"
            path = layer_path(run, layer, table)
            if load_mode == "append" or accumulates(spark, name):
                others = runs_of(spark, name) if load_mode == "overwrite" else []
                add_run(spark, name, run_id, path)
                drop_runs(spark, name, [r for r in others if r != run_id])
                loads.append(Load(layer, table, rows[table], run=run_id))
            else:
                publish(spark, path, name, load_mode, df)
                loads.append(Load(layer, table, rows[table]))
    return reconcile(spark, loads)
