"""Appends as catalog partitions, partitioned folders by name, schema changes."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import attributes, booking, listing
from lodgepole.plans import batch, layers, runs
from lodgepole.schemas import CURATED, LAYERS, PRESENTATION, RAW, RUN_COLUMN
from lodgepole.session import lake_root


def _root(spark, name):
    return f"{lake_root(spark)}/tests/{name}-{uuid.uuid4().hex[:8]}"


def _drop_layers(spark):
    for layer, tables in LAYERS.items():
        for t in tables:
            for name in (f"{layer}.{t}", f"{layer}.{t}__runs"):
                spark.sql(f"DROP TABLE IF EXISTS {name}")


def _sources(raw, ids):
    return {
        "apartments": raw("apartments", *[listing(i) for i in ids]),
        "apartments_attributes": raw("apartments_attributes", *[attributes(i) for i in ids]),
        "bookings": raw("bookings", *[booking(i, apartment_id=i) for i in ids]),
        "user_viewing": raw("user_viewing", *[dict(user_id=i, apartment_id=i, viewed_at="06/01/2020", is_wishlisted=True, call_to_action="x") for i in ids]),
    }


def _ids(spark, table="bookings", key="booking_id"):
    return sorted(r[0] for r in runs.published(spark, "raw_layer", table).select(key).collect())


def test_append_that_failed_half_way_is_repeated(spark, raw, monkeypatch):
    _drop_layers(spark)
    root = _root(spark, "rerun")
    batch.run_batch(spark, _sources(raw, range(1, 6)), root)
    whole = batch.add_run
    done = []

    def fails_after_five(spark, name, run, path):
        if len(done) == 5:
            raise OSError("lost the catalog")
        done.append(name)
        return whole(spark, name, run, path)

    monkeypatch.setattr(batch, "add_run", fails_after_five)
    with pytest.raises(OSError):
        batch.run_batch(spark, _sources(raw, range(6, 9)), root, load_mode="append", run_id="day-2")
    monkeypatch.setattr(batch, "add_run", whole)
    assert len(done) == 5
    for _ in range(2):  # and once more after it went through
        report = batch.run_batch(spark, _sources(raw, range(6, 10)), root, load_mode="append", run_id="day-2").collect()
        assert len(report) == 14 and all(r.complete for r in report)
        assert _ids(spark) == list(range(1, 10))
        assert _ids(spark, "apartments", "id") == list(range(1, 10))
        assert runs.runs_of(spark, "raw_layer.bookings") == ["base", "day-2"]
    for layer, tables in LAYERS.items():
        for t in tables:
            held = spark.table(f"{layer}.{t}")
            assert held.columns == [*tables[t].names, RUN_COLUMN]
            per_run = {r[0]: r[1] for r in held.groupBy(RUN_COLUMN).count().collect()}
            assert per_run.get("day-2", 0) == [r.source_rows for r in report if r.table_name == t][0]
    # an overwrite later on leaves its own rows only
    batch.run_batch(spark, _sources(raw, [50]), root, run_id="day-3")
    assert _ids(spark) == [50] and runs.runs_of(spark, "raw_layer.bookings") == ["day-3"]
    _drop_layers(spark)


def test_appending_copies_nothing(spark, raw):
    _drop_layers(spark)
    root = _root(spark, "zero-copy")
    batch.run_batch(spark, _sources(raw, range(4)), root)
    before = layers.table_location(spark, "raw_layer.bookings")
    batch.run_batch(spark, _sources(raw, range(4, 6)), root, load_mode="append", run_id="next")
    files = {f.rsplit("/", 1)[0] for f in spark.table("raw_layer.bookings").inputFiles()}
    places = [runs.run_location(spark, "raw_layer.bookings", r) for r in ("base", "next")]
    assert layers.same_path(places[0], before) and len(files) == 2
    assert all(any(layers.same_path(f, p) for p in places) for f in files)
    # one run is read from its own folder alone
    plan = spark.table("raw_layer.bookings").filter(F.col(RUN_COLUMN) == "next")
    assert len({f.rsplit("/", 1)[0] for f in plan.inputFiles()}) == 1
    _drop_layers(spark)


def test_conversion_that_died_is_finished(spark, raw):
    _drop_layers(spark)
    root = _root(spark, "died")
    batch.run_batch(spark, _sources(raw, range(3)), root)
    runs.accumulate(spark, "raw_layer.bookings")
    spark.sql("ALTER TABLE raw_layer.bookings RENAME TO raw_layer.bookings__runs")  # as it was before the last step
    assert runs.finish_conversions(spark) == ["raw_layer.bookings"]
    assert _ids(spark) == [0, 1, 2]
    assert runs.finish_conversions(spark) == []
    _drop_layers(spark)


def test_run_ids_and_files_of_other_types(spark, raw):
    root = _root(spark, "ids")
    for bad in ("", "a b", "x'y", "a/b", "base", ".hidden"):
        with pytest.raises(ValueError):
            runs.check_run_id(bad)
    spark.sql("CREATE DATABASE IF NOT EXISTS testruns")
    spark.sql("DROP TABLE IF EXISTS testruns.t")
    spark.sql(f"CREATE TABLE testruns.t (a bigint, b string) USING parquet LOCATION '{root}/t'")
    spark.sql("SELECT '7' AS b, 5 AS a").write.parquet(f"{root}/one")
    assert runs.add_run(spark, "testruns.t", "one", f"{root}/one") == "added"
    assert runs.add_run(spark, "testruns.t", "one", f"{root}/one") == "replaced"
    assert [tuple(r) for r in spark.table("testruns.t").collect()] == [(5, "7", "one")]
    assert runs.runs_of(spark, "testruns.t") == ["one"]  # the empty table had no base part
    runs.drop_runs(spark, "testruns.t", ["one", "never"])
    assert spark.table("testruns.t").isEmpty()
    spark.sql("DROP TABLE IF EXISTS testruns.p")
    spark.sql(f"CREATE TABLE testruns.p (a bigint, k string) USING parquet PARTITIONED BY (k) LOCATION '{root}/p'")
    with pytest.raises(ValueError, match="own columns"):
        runs.accumulate(spark, "testruns.p")


def test_partitioned_folder_by_name(spark):
    root = _root(spark, "parts")
    spark.sql("CREATE DATABASE IF NOT EXISTS testparts")
    spark.sql("DROP TABLE IF EXISTS testparts.t")
    first = spark.createDataFrame([(i, f"n{i}", 2020 + i % 2, "a" if i % 3 else None) for i in range(12)], "id long, name string, year int, kind string")
    layers.write_table(first, f"{root}/t", partition_by=["year", "kind"])
    got = layers.register_parquet(spark, "testparts", "t", f"{root}/t")
    assert got.columns == ["id", "name", "year", "kind"] and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, first.collect()), key=str)
    assert layers.partition_columns(spark, "testparts.t") == ["year", "kind"]
    # a later folder has a column more, an earlier one is gone
    later = spark.createDataFrame([(100, "x", 1.5, 2022, "b")], "id long, name string, price double, year int, kind string")
    layers.write_table(later, f"{root}/t", mode="append", partition_by=["year", "kind"])
    got = layers.register_parquet(spark, "testparts", "t", f"file:{root}/t" if not root.startswith("file:") else f"{root}/t")
    assert sorted(got.columns) == ["id", "kind", "name", "price", "year"]
    assert got.count() == 13 and [r.price for r in got.filter("year = 2022").collect()] == [1.5]
    assert got.filter("year < 2022 and price is null").count() == 12
    assert "PartitionFilters: [isnotnull(year" in got.filter("year = 2022")._jdf.queryExecution().toString()
    import shutil

    shutil.rmtree(f"{root}/t/year=2020".removeprefix("file://"))
    assert layers.register_parquet(spark, "testparts", "t", f"{root}/t").count() == 7
    # another type, another folder
    spark.createDataFrame([("s", 2023, "b")], "id string, year int, kind string").write.partitionBy("year", "kind").mode("append").parquet(f"{root}/t")
    with pytest.raises(Exception, match="(?i)drift|became|incompatible|merg"):
        layers.register_parquet(spark, "testparts", "t", f"{root}/t")
    with pytest.raises(ValueError, match="stands for"):
        layers.register_parquet(spark, "testparts", "t", f"{root}/other")


def test_flat_folder_gains_a_column(spark):
    root = _root(spark, "flat")
    spark.sql("DROP TABLE IF EXISTS testparts.f")
    spark.range(3).write.parquet(f"{root}/f")
    assert layers.register_parquet(spark, "testparts", "f", f"{root}/f").count() == 3
    spark.range(3, 5).selectExpr("id", "id * 2 AS twice").write.mode("append").parquet(f"{root}/f")
    got = layers.register_parquet(spark, "testparts", "f", f"{root}/f")
    assert sorted((r.id, r.twice) for r in got.collect() if r.twice is not None) == [(3, 6), (4, 8)] and got.count() == 5


def test_older_layer_table_gains_columns_and_refuses_types(spark):
    _drop_layers(spark)
    root = _root(spark, "drift")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS raw_layer LOCATION '{root}/_warehouse/raw_layer'")
    older = T.StructType([f for f in RAW["user_viewing"].fields if f.name != "call_to_action"])
    spark.sql(f"CREATE TABLE raw_layer.user_viewing ({layers._ddl(older)}) USING parquet LOCATION '{root}/v'")
    spark.createDataFrame([(1, 2, "06/01/2020", True)], older).write.insertInto("raw_layer.user_viewing")
    layers.create_layer_tables(spark, root)
    layers.create_layer_tables(spark, root)
    row = spark.table("raw_layer.user_viewing").first()
    assert (row.user_id, row.call_to_action) == (1, None)
    new = spark.createDataFrame([(3, 4, "07/01/2020", False, "click")], RAW["user_viewing"])
    layers.load_into(spark, new, "raw_layer.user_viewing", "append")
    assert {r.call_to_action for r in spark.table("raw_layer.user_viewing").collect()} == {None, "click"}
    with pytest.raises(layers.SchemaDrift, match="user_id: bigint became string"):
        layers.add_missing_columns(spark, "raw_layer.user_viewing", T.StructType([T.StructField("fresh", T.LongType()), T.StructField("user_id", T.StringType())]))
    assert "fresh" not in spark.table("raw_layer.user_viewing").columns
    _drop_layers(spark)


def _content(spark, rows, schema="a long, b string, c double"):
    root = _root(spark, "content")
    return layers.checked_write(spark.createDataFrame(rows, schema), f"{root}/t")


def test_checksums_of_contents(spark):
    rows = [(i, None if i % 5 == 0 else f"s{i % 3}", float(i % 7)) for i in range(200)] + [(7, "s1", 0.0)] * 3
    base = _content(spark, rows)
    assert base.rows == 203 and base == _content(spark, rows[::-1])
    assert base == layers.checked_write(spark.createDataFrame(rows, "a long, b string, c double").repartition(7), f"{_root(spark, 'c')}/t")
    differs = lambda other: [c for c, x, y in zip(base.columns, base.column_sums, other.column_sums, strict=True) if x != y]
    swapped = [(rows[1][0], rows[2][1], rows[1][2]), (rows[2][0], rows[1][1], rows[2][2])]
    other = _content(spark, [rows[0], *swapped, *rows[3:]])
    assert differs(other) == [] and other.row_sum != base.row_sum
    assert differs(_content(spark, [(0, "", 0.0), *rows[1:]])) == ["b"]  # NULL is not the empty text
    assert differs(_content(spark, [(0, None, 0.5), *rows[1:]])) == ["c"]
    # copies do not cancel out
    assert _content(spark, [(1, "x", 0.0)] * 2) != _content(spark, [(2, "y", 0.0)] * 2)
    # a NULL that changes column is seen
    assert _content(spark, [(1, None, 1.0)]).row_sum != _content(spark, [(1, "1", None)]).row_sum
    assert _content(spark, []).rows == 0


def test_content_report(spark):
    root = _root(spark, "report")
    spark.sql("CREATE DATABASE IF NOT EXISTS testcontent")
    rows = [(i, f"s{i}", float(i)) for i in range(50)]
    source = spark.createDataFrame(rows, "a long, b string, c double")
    content = layers.checked_write(source, f"{root}/staged")
    broken = {"whole": rows, "swapped": [(0, "s1", 0.0), (1, "s0", 1.0), *rows[2:]], "short": rows[1:], "changed": [(0, "s0", 9.5), *rows[1:]]}
    for name, held in broken.items():
        spark.sql(f"DROP TABLE IF EXISTS testcontent.{name}")
        spark.createDataFrame(held, source.schema).write.option("path", f"{root}/{name}").saveAsTable(f"testcontent.{name}")
    spark.sql("DROP TABLE IF EXISTS testcontent.narrow")
    source.drop("b").write.option("path", f"{root}/narrow").saveAsTable("testcontent.narrow")
    loads = [layers.CheckedLoad("testcontent", t, content) for t in (*broken, "narrow", "missing")]
    got = {r.table_name: tuple(r)[2:] for r in layers.content_report(spark, loads).collect()}
    assert got == {
        "whole": (50, 50, True, True, ""),
        "swapped": (50, 50, True, False, ""),
        "short": (50, 49, False, False, "a,b,c"),
        "changed": (50, 50, True, False, "c"),
        "narrow": (50, None, False, False, ""),
        "missing": (50, None, False, False, ""),
    }
    # a table that keeps runs apart is compared run by run
    spark.sql("DROP TABLE IF EXISTS testcontent.runs")
    spark.sql(f"CREATE TABLE testcontent.runs (a bigint, b string, c double) USING parquet LOCATION '{root}/runs'")
    for run in ("one", "two"):
        runs.add_run(spark, "testcontent.runs", run, f"{root}/staged" if run == "one" else layers.write_table(source.limit(3), f"{root}/two"))
    report = layers.content_report(spark, [layers.CheckedLoad("testcontent", "runs", content, "one"), layers.CheckedLoad("testcontent", "runs", content, "two")])
    assert [(r.target_rows, r.content_match) for r in report.collect()] == [(50, True), (3, False)]


def test_schemas_are_known(spark):
    assert set(CURATED) | set(PRESENTATION) | set(RAW) == {t for tables in LAYERS.values() for t in tables}
