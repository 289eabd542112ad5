import os

import pytest
from pyspark.sql import functions as F

from conftest import attributes, booking, listing
from lodgepole.operators import curate
from lodgepole.plans import layers
from lodgepole.session import lake_root
from lodgepole.sources.readers import jdbc_options, read_csv


def _root(spark, name):
    import uuid

    return f"{lake_root(spark)}/tests/{name}-{uuid.uuid4().hex[:8]}"


def test_layout_sorts_within_partitions(spark, raw):
    rows = [booking(i, booking_date=f"{(i * 7) % 28 + 1:02d}/01/2020") for i in range(40)]
    df = curate.curated_bookings(raw("bookings", *rows)).repartition(3)
    out = layers.apply_layout(df, "curated_bookings")
    parts = out.rdd.glom().collect()
    for part in parts:
        dates = [r.booking_date for r in part]
        assert dates == sorted(dates)


def test_csv_roundtrip_keeps_every_row(spark, raw):
    src = raw("bookings", *[booking(i, total_price=i + 0.25) for i in range(20)], booking(99, user_id=None))
    path = _root(spark, "csv")
    layers.write_table(src, path, fmt="csv")
    back = read_csv(spark, path, "bookings")
    assert sorted(back.collect()) == sorted(src.collect())


def test_load_modes_and_reconcile(spark, raw):
    root = _root(spark, "load")
    spark.sql("CREATE DATABASE IF NOT EXISTS testlayer")
    spark.sql("DROP TABLE IF EXISTS testlayer.b")
    spark.sql(
        f"CREATE TABLE testlayer.b (booking_id bigint, user_id bigint) USING parquet LOCATION '{root}/b'"
    )
    src = raw("bookings", *[booking(i) for i in range(5)])
    layers.load_into(spark, src, "testlayer.b", "overwrite")
    layers.load_into(spark, src, "testlayer.b", "append")
    assert spark.table("testlayer.b").count() == 10
    layers.load_into(spark, src, "testlayer.b", "overwrite")
    loads = [layers.Load("testlayer", "b", 5), layers.Load("testlayer", "missing", 5)]
    got = {r.table_name: tuple(r)[2:] for r in layers.reconcile(spark, loads).collect()}
    assert got == {"b": (True, True, 5, 5, True), "missing": (False, False, 5, None, False)}
    # an append is complete when the table has grown by the source's rows
    layers.load_into(spark, src, "testlayer.b", "append")
    assert layers.reconcile(spark, [layers.Load("testlayer", "b", 5, rows_before=5)]).first().complete
    assert not layers.reconcile(spark, [layers.Load("testlayer", "b", 5, rows_before=4)]).first().complete


def _files(root):
    root = root.removeprefix("file://")
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]


def test_reconcile_shows_damaged_loads(spark, raw):
    root = _root(spark, "damage")
    spark.sql("CREATE DATABASE IF NOT EXISTS testdamage")
    loads = []
    for name in ("lost", "broken", "whole"):
        spark.sql(f"DROP TABLE IF EXISTS testdamage.{name}")
        spark.sql(f"CREATE TABLE testdamage.{name} (booking_id bigint) USING parquet LOCATION '{root}/{name}'")
        src = raw("bookings", *[booking(i) for i in range(8)]).select("booking_id").repartition(2)
        rows = layers.counted_write(src, f"{root}/run/{name}")
        assert rows == 8
        layers.publish(spark, f"{root}/run/{name}", f"testdamage.{name}")
        loads.append(layers.Load("testdamage", name, rows))
    os.remove(sorted(_files(f"{root}/run/lost"))[0])
    for f in _files(f"{root}/run/broken"):
        with open(f, "r+b") as out:
            out.truncate(20)
    spark.catalog.refreshTable("testdamage.lost")
    spark.catalog.refreshTable("testdamage.broken")
    got = {r.table_name: r for r in layers.reconcile(spark, loads).collect()}
    assert got["whole"].complete and got["whole"].target_rows == 8
    assert got["lost"].readable and not got["lost"].complete and got["lost"].target_rows < 8
    assert got["broken"].present and not got["broken"].readable and not got["broken"].complete


def test_partitioned_overwrite_replaces_all_partitions(spark, raw):
    path = _root(spark, "partitions")
    rows = raw("bookings", booking(1, booking_status="confirmed"), booking(2, booking_status="pending"))
    layers.write_table(rows, path, partition_by=["booking_status"])
    layers.write_table(rows.filter("booking_id = 2"), path, partition_by=["booking_status"])
    assert [r.booking_id for r in spark.read.parquet(path).collect()] == [2]


def test_bucketed_layout(spark, raw):
    root = _root(spark, "bucketed")
    df = curate.curated_bookings(raw("bookings", *[booking(i, apartment_id=i % 5) for i in range(50)]))
    spark.sql("CREATE DATABASE IF NOT EXISTS testbuckets")
    for name in ("a", "b"):
        spark.sql(f"DROP TABLE IF EXISTS testbuckets.{name}")
        layers.save_bucketed(df, f"testbuckets.{name}", f"{root}/{name}", "curated_bookings", 4)
    detail = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED testbuckets.a").collect()}
    assert detail["Num Buckets"] == "4" and detail["Bucket Columns"] == "[`apartment_id`]" and detail["Sort Columns"] == "[`booking_date`]"
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = spark.table("testbuckets.a").join(spark.table("testbuckets.b"), "apartment_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    with pytest.raises(ValueError):
        layers.save_bucketed(df, "testbuckets.c", f"{root}/c", "curated_user_viewing", 4)


def _sources(raw, *bookings):
    return {
        "apartments": raw("apartments", listing(1, price=100.0), listing(2, price=float("nan"))),
        "apartments_attributes": raw("apartments_attributes", attributes(1), attributes(2)),
        "bookings": raw("bookings", *bookings),
        "user_viewing": raw("user_viewing", dict(user_id=1, apartment_id=1, viewed_at="06/01/2020")),
    }


def test_batch_job_ingests_nan_as_null(spark, raw):
    from lodgepole.plans.batch import run_batch

    report = run_batch(spark, _sources(raw, booking(1)), _root(spark, "nan"))
    assert report.count() == 14 and report.filter("not complete").isEmpty()
    assert [r.average_price for r in spark.table("presentation_layer.average_listing_price").collect()] == [100.0]


def test_batch_append_and_rerun_under_one_root(spark, raw):
    from lodgepole.plans.batch import run_batch

    root = _root(spark, "append")
    first, second = [booking(i) for i in (1, 2, 3)], [booking(i) for i in (4, 5)]
    ids = lambda: sorted(r.booking_id for r in spark.table("raw_layer.bookings").collect())
    run_batch(spark, _sources(raw, *first), root)
    assert ids() == [1, 2, 3]
    report = run_batch(spark, _sources(raw, *second), root, load_mode="append")
    assert ids() == [1, 2, 3, 4, 5] and report.filter("not complete").isEmpty()
    run_batch(spark, _sources(raw, *second), root)  # the same root again, from anew
    assert ids() == [4, 5]
    other = _root(spark, "append-other")
    run_batch(spark, _sources(raw, *first), other, load_mode="append")  # another root, appended
    assert ids() == [1, 2, 3, 4, 5]


def test_cluster_without_shared_folder_fails():
    from types import SimpleNamespace

    from lodgepole import session

    conf = SimpleNamespace(get=lambda *a: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, applicationId="x"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.lake_root(cluster)


def test_not_empty_check(spark, raw):
    with pytest.raises(ValueError):
        layers.ensure_not_empty(raw("bookings", booking(1)).filter(F.lit(False)), "empty")
    layers.ensure_not_empty(raw("bookings", booking(1)), "one row")


def test_layer_tables_are_created_idempotently(spark):
    root = _root(spark, "warehouse")
    first = layers.create_layer_tables(spark, root)
    second = layers.create_layer_tables(spark, root)
    assert first == second and len(first) == 14
    assert spark.catalog.tableExists("presentation_layer.repeat_customer_rate")


def test_register_parquet_exposes_by_name(spark, raw):
    path = _root(spark, "reg")
    layers.write_table(raw("bookings", booking(1), booking(2)), path)
    spark.sql("DROP TABLE IF EXISTS testreg.bookings")
    assert layers.register_parquet(spark, "testreg", "bookings", path).count() == 2


def test_jdbc_options_partitioned():
    opts = jdbc_options(
        "jdbc:x://h/db", "bookings", user="u", partition_column="booking_id",
        lower_bound=0, upper_bound=100, num_partitions=4,
    )
    assert opts["partitionColumn"] == "booking_id" and opts["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", "t", partition_column="id")


def test_jdbc_sources_reads_each_table(monkeypatch):
    from lodgepole.sources import readers

    asked = []

    class Probe:
        def first(self):
            return (3, 90)

    def fake(spark, **options):
        asked.append(options)
        return Probe()

    monkeypatch.setattr(readers, "read_jdbc", fake)
    got = readers.jdbc_sources(None, "jdbc:x://h/db", "bookings, views", {"bookings": "booking_id"}, num_partitions=4, user="u")
    assert set(got) == {"bookings", "views"}
    assert "MIN(booking_id)" in asked[0]["table"]
    assert (asked[1]["lower_bound"], asked[1]["upper_bound"], asked[1]["num_partitions"]) == (3, 91, 4)
    assert asked[2] == {"url": "jdbc:x://h/db", "table": "views", "user": "u"}
    with pytest.raises(ValueError):
        readers.jdbc_sources(None, "jdbc:x://h/db", "bookings", {"bookings": "booking_id"})


def test_schema_profile_and_describe(spark, raw):
    from lodgepole.operators import profile

    df = raw("bookings", booking(1), booking(2, total_price=300.0))
    sp = profile.schema_profile(spark, {"bookings": df}).collect()
    assert [(r.column_name, r.data_type) for r in sp][:2] == [("booking_id", "bigint"), ("user_id", "bigint")]
    d = {r.summary: r.total_price for r in profile.describe(df).collect()}
    assert d["count"] == "2" and float(d["mean"]) == 200.0


def test_publish_relocates_on_overwrite_and_copies_on_append(spark, raw):
    root = _root(spark, "publish")
    spark.sql("CREATE DATABASE IF NOT EXISTS testpub")
    spark.sql("DROP TABLE IF EXISTS testpub.b")
    spark.sql(
        f"CREATE TABLE testpub.b (booking_id bigint, user_id bigint) USING parquet LOCATION '{root}/table'"
    )
    src = raw("bookings", *[booking(i, user_id=i) for i in range(4)]).select("booking_id", "user_id")
    run1 = layers.write_table(src, f"{root}/run1")
    assert layers.publish(spark, run1, "testpub.b") == "relocated"
    location = spark.sql("DESCRIBE TABLE EXTENDED testpub.b").filter("col_name = 'Location'").first()
    assert location.data_type.rstrip("/").endswith("run1")
    assert sorted(spark.table("testpub.b").collect()) == sorted(src.collect())

    # append copies the rows into the table's current data
    run2 = layers.write_table(src.filter("booking_id < 2"), f"{root}/run2")
    assert layers.publish(spark, run2, "testpub.b", mode="append") == "loaded"
    assert spark.table("testpub.b").count() == 6

    # files whose columns differ from the table are cast and loaded, not relocated
    wider = src.select("user_id", "booking_id", F.lit(1).alias("extra"))
    run3 = layers.write_table(wider, f"{root}/run3")
    assert layers.publish(spark, run3, "testpub.b") == "loaded"
    assert sorted(spark.table("testpub.b").collect()) == sorted(src.collect())


def test_shuffle_partitions_are_sized_from_the_largest_shuffle():
    from lodgepole.session import SHUFFLE_PARTITION_BYTES, shuffle_partitions_for

    assert shuffle_partitions_for(100 * 2**40) == 100 * 2**40 // SHUFFLE_PARTITION_BYTES
    assert shuffle_partitions_for(SHUFFLE_PARTITION_BYTES + 1) == 2
    assert shuffle_partitions_for(0) == 1


def test_run_each_writes_every_table_and_raises_the_first_error(spark, raw):
    from lodgepole.plans.batch import run_each

    root = _root(spark, "each")
    frames = {f"t{i}": raw("bookings", *[booking(j) for j in range(i + 1)]) for i in range(4)}
    paths = run_each(lambda t, df: layers.write_table(df, f"{root}/{t}"), frames)
    assert {t: spark.read.parquet(p).count() for t, p in paths.items()} == {"t0": 1, "t1": 2, "t2": 3, "t3": 4}

    def fail_on_t2(t, df):
        if t == "t2":
            raise RuntimeError("t2 failed")
        return df.count()

    with pytest.raises(RuntimeError, match="t2 failed"):
        run_each(fail_on_t2, frames)


def test_layer_writes_keep_every_core_busy(spark):
    """A session that merges partitions by size alone must not leave a layer to one task."""
    from lodgepole.plans.batch import write_layer

    prefix = "spark.sql.adaptive.coalescePartitions."
    conf = {f"{prefix}parallelismFirst": "false", f"{prefix}minPartitionSize": "1024"}
    before = {c: spark.conf.get(c) for c in conf}
    rows = spark.range(20_000).select(
        F.col("id").alias("user_id"), (F.col("id") % 500).alias("apartment_id"), F.lit("06/01/2020").alias("viewed_at")
    )
    root = _root(spark, "cores")
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        staged, counts = write_layer(spark, {"user_viewing": rows.repartition("user_id").dropDuplicates()}, root, "raw_layer")
        assert {c: spark.conf.get(c) for c in conf} == conf
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    files = staged["user_viewing"].select(F.input_file_name()).distinct().count()
    assert counts == {"user_viewing": 20_000} and staged["user_viewing"].count() == 20_000
    assert files > 2, files
