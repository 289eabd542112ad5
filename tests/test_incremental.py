"""Extraction of what changed since the last run."""

import datetime
import random
import uuid

import pytest
from pyspark.sql import functions as F

from lodgepole.plans import incremental
from lodgepole.session import lake_root

SCHEMA = "id long, part int, name string, modified date"
DAY = datetime.date(2020, 1, 1)


def _root(spark):
    return f"{lake_root(spark)}/tests/incremental-{uuid.uuid4().hex[:8]}"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _held(spark, root):
    frame = _frame(spark, [])
    return sorted((tuple(r) for r in incremental.held(spark, root, "t", frame.schema, ["id", "part"]).drop(incremental.RUN).collect()), key=str)


def _run(spark, root, rows):
    got = incremental.extract_changes(spark, _frame(spark, rows), root, "t", ["id", "part"], F.col("modified"))
    assert _held(spark, root) == sorted(rows, key=str)
    return got


def test_runs_write_changes_only(spark):
    root, day = _root(spark), lambda n: DAY + datetime.timedelta(days=n)
    rows = [(i, 0, f"a{i}", day(i % 5)) for i in range(50)] + [(1, None, "null key", day(2)), (2, 1, "no date", None)]
    assert _run(spark, root, rows) == incremental.Extracted(1, 52, 0)
    assert _run(spark, root, rows) == incremental.Extracted(2, 0, 0)
    # three changed on later days, one late row of the last day, two new, four gone
    rows = [r if r[0] not in (3, 4, 5) or r[1] is None else (r[0], r[1], "changed", day(9)) for r in rows if r[0] < 46]
    rows += [(100, 0, "late", day(4)), (101, 0, "new", day(10)), (102, 0, "new", None)]
    assert _run(spark, root, rows) == incremental.Extracted(3, 6, 4)
    # a deleted key comes back, a row without a date changes, a NULL key goes
    rows = [r if r[1] != 1 else (2, 1, "changed", None) for r in rows if r[1] is not None] + [(46, 0, "back", day(11))]
    assert _run(spark, root, rows) == incremental.Extracted(4, 2, 1)
    assert _run(spark, root, []) == incremental.Extracted(5, 0, len(rows))
    # rows that come back with their old dates
    assert _run(spark, root, rows[:2] + [(7, 7, "x", day(12))]) == incremental.Extracted(6, 3, 0)


def test_a_run_that_died_is_repeated(spark, monkeypatch):
    root = _root(spark)
    first = [(i, 0, "a", DAY) for i in range(10)]
    _run(spark, root, first)
    whole = incremental.write_table

    def dies(df, path, **kw):
        if "/state/" in path:
            raise OSError("lost")
        return whole(df, path, **kw)

    second = first[2:] + [(50, 0, "b", DAY + datetime.timedelta(days=1))]
    monkeypatch.setattr(incremental, "write_table", dies)
    with pytest.raises(OSError):
        incremental.extract_changes(spark, _frame(spark, second), root, "t", ["id", "part"], F.col("modified"))
    monkeypatch.setattr(incremental, "write_table", whole)
    third = second + [(51, 0, "c", DAY + datetime.timedelta(days=2))]
    assert _run(spark, root, third) == incremental.Extracted(2, 2, 2)


def test_any_history_ends_with_the_source(spark):
    rng = random.Random(3)
    root, state, clock = _root(spark), {}, 0
    for _ in range(4):
        clock += 1
        for _ in range(30):
            k = rng.randrange(40)
            if rng.random() < 0.3:
                state.pop(k, None)
            else:
                state[k] = (k, 0, f"n{rng.randrange(9)}", DAY + datetime.timedelta(days=clock))
        _run(spark, root, list(state.values()))


def test_the_filter_reaches_the_scan(spark, tmp_path):
    root = _root(spark)
    path = f"file://{tmp_path}/t"
    _frame(spark, [(i, 0, "a", DAY + datetime.timedelta(days=i)) for i in range(20)]).write.parquet(path)
    source = spark.read.parquet(path)
    incremental.extract_changes(spark, source, root, "t", ["id", "part"], F.col("modified"))
    assert "PushedFilters: [Or(GreaterThanOrEqual(modified" in source.filter((F.col("modified") >= DAY) | F.col("modified").isNull())._jdf.queryExecution().toString()
    assert incremental.extract_changes(spark, source, root, "t", ["id", "part"], F.col("modified")) == incremental.Extracted(2, 0, 0)
