"""Named queries over the driver's generated tables.

Each entry is ``(spark, sf_dir) → DataFrame`` and reads the whole input
tables. The occupancy calendar spans the years the generated data covers
(1995–2001) instead of the production default (2020–2025).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgepole.functions.dates import parse_date
from lodgepole.operators import clean, curate, merge, metrics, profile, skew
from lodgepole.plans import batch, incremental, layers, runs
from lodgepole.schemas import CURATED_BOOKINGS, LAYOUT, RAW
from lodgepole.session import lake_root
from lodgepole.sources.domain import SOURCES, raw_table, raw_tables, read_input, source_tables
from lodgepole.sources.readers import read_catalog_table, read_csv, stage_csv
from lodgepole.sources.updates import listing_price_updates

SPINE_START = "1995-01-01"
SPINE_END = "2001-12-31"
HOT_LISTING = 7  # the listing that every third booking is moved to
LEAST_FILE_BYTES = 1 << 20
PREVIEW_ROWS = 20

Query = Callable[[SparkSession, str], DataFrame]


def _listings(spark: SparkSession, sf: str) -> DataFrame:
    return curate.curated_apartments(
        raw_table(spark, sf, "apartments"), raw_table(spark, sf, "apartments_attributes")
    )


def _bookings(spark: SparkSession, sf: str) -> DataFrame:
    return curate.curated_bookings(raw_table(spark, sf, "bookings"))


def _views(spark: SparkSession, sf: str) -> DataFrame:
    return curate.curated_user_viewing(raw_table(spark, sf, "user_viewing"))


def _scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder under the shared lake root for one run of a sink query."""
    return f"{lake_root(spark)}/runs/{what}-{uuid.uuid4().hex[:12]}"


def _staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` as written to a scratch folder: what reads it repeatedly does not compute it again."""
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(layers.write_table(df, f"{_scratch(spark, what)}/staged"))


def _fresh_table(spark: SparkSession, layer: str, table: str, schema, root: str) -> str:
    name = f"{layer}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/_warehouse/{layer}'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet LOCATION '{root}/{table}'")
    return name


def _cleaned_tables(spark: SparkSession, sf: str, dedupe: bool) -> dict[str, DataFrame]:
    step = clean.clean if dedupe else clean.clean_without_dedupe
    return {t: step(raw_table(spark, sf, t), t) for t in SOURCES}


def _upsert_listings(spark: SparkSession, sf: str) -> DataFrame:
    return merge.upsert(
        raw_table(spark, sf, "apartments"),
        listing_price_updates(spark, sf),
        keys=["id"],
        order_by=[parse_date("last_modified_timestamp")],
    )


def _append_views_dedup(spark: SparkSession, sf: str) -> DataFrame:
    views = raw_table(spark, sf, "user_viewing")
    return curate.curated_user_viewing(merge.append(views, views))


def _csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark, "csv") + "/bookings"
    layers.write_table(raw_table(spark, sf, "bookings"), path, fmt="csv")
    return read_csv(spark, path, RAW["bookings"])


def _catalog_register(spark: SparkSession, sf: str) -> DataFrame:
    root = _scratch(spark, "catalog")
    batch.extract(spark, {"bookings": raw_table(spark, sf, "bookings")}, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS raw_layer LOCATION '{root}/_warehouse/raw_layer'")
    spark.sql("DROP TABLE IF EXISTS raw_layer.bookings")
    layers.register_parquet(spark, "raw_layer", "bookings", layers.layer_path(root, "raw_layer", "bookings"))
    return read_catalog_table(spark, "raw_layer", "bookings")


def _layer_load(spark: SparkSession, sf: str, modes: tuple[str, ...]) -> DataFrame:
    root = _scratch(spark, "load")
    name = _fresh_table(spark, "curated_layer", "curated_bookings", CURATED_BOOKINGS, root)
    # Stage as Parquet first, then bulk-load the staged files.
    staged_path = layers.layer_path(root, "staged", "curated_bookings")
    layers.write_layer_table(_bookings(spark, sf), root, "staged", "curated_bookings")
    staged = spark.read.parquet(staged_path)
    layers.ensure_not_empty(staged, staged_path)
    for mode in modes:
        layers.load_into(spark, staged, name, mode=mode)
    return spark.table(name)


def _layout_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the written table, and those that come before a row of a
    smaller sort key in their file (none, if the layout holds)."""
    root = _scratch(spark, "layout")
    layers.write_layer_table(_bookings(spark, sf), root, "curated_layer", "curated_bookings")
    rows = spark.read.parquet(layers.layer_path(root, "curated_layer", "curated_bookings"))
    keys = LAYOUT["curated_bookings"][1]
    place = Window.partitionBy("file").orderBy("row")
    placed = rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), F.struct(*keys).alias("key")
    ).withColumn("before", F.lag("key").over(place))
    return placed.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("before") > F.col("key")).alias("out_of_order")
    )


def _layout_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    root = _scratch(spark, "buckets")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed_layer LOCATION '{root}/_warehouse/bucketed_layer'")
    spark.sql("DROP TABLE IF EXISTS bucketed_layer.curated_bookings")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layers.save_bucketed(
        _bookings(spark, sf), "bucketed_layer.curated_bookings", f"{root}/curated_bookings", "curated_bookings", buckets
    )
    return spark.table("bucketed_layer.curated_bookings")


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    return batch.run_batch(spark, source_tables(spark, sf), _scratch(spark, "batch"), SPINE_START, SPINE_END)


def _published(table: str) -> Query:
    """A presentation table as the whole batch job leaves it in the catalog."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        _batch(spark, sf)
        return runs.published(spark, "presentation_layer", table)

    return query


def _batch_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, the second appended under the same root: the bookings of
    each are half of all; the table ends with all of them, in two runs."""
    root, sources = _scratch(spark, "append"), source_tables(spark, sf)
    half = F.pmod("booking_id", F.lit(2))
    for i, mode in enumerate(("overwrite", "append")):
        part = sources | {"bookings": sources["bookings"].filter(half == i)}
        batch.run_batch(spark, part, root, SPINE_START, SPINE_END, mode)
    return runs.published(spark, "raw_layer", "bookings")


def _append_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Bookings with the run each came in: the first half, then an append that
    had written only a third of its rows when it died, repeated in full."""
    root = _scratch(spark, "rerun")
    bookings = raw_table(spark, sf, "bookings")
    name = _fresh_table(spark, "raw_layer", "bookings", RAW["bookings"], f"{root}/tables")
    half = F.pmod("booking_id", F.lit(2))
    layers.publish(spark, layers.write_table(bookings.filter(half == 0), f"{root}/first"), name)
    second = bookings.filter(half == 1)
    runs.add_run(spark, name, "second", layers.write_table(second.filter(F.pmod("booking_id", F.lit(3)) == 0), f"{root}/second-1"))
    runs.add_run(spark, name, "second", layers.write_table(second, f"{root}/second-2"))
    return spark.table(name)


def _catalog_register_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by year and status, registered by name; then the finished orders
    arrive, with a column that the first files lack, and the folder is
    registered again."""
    root = _scratch(spark, "partitioned")
    orders = read_input(spark, sf, "orders").withColumn("order_year", F.year("o_orderdate"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS partitioned_layer LOCATION '{root}/_warehouse'")
    spark.sql("DROP TABLE IF EXISTS partitioned_layer.orders")
    keys, finished = ["order_year", "o_orderstatus"], F.col("o_orderstatus") == "F"
    layers.write_table(orders.filter(~finished).drop("o_orderpriority"), f"{root}/orders", partition_by=keys)
    layers.register_parquet(spark, "partitioned_layer", "orders", f"{root}/orders")
    layers.write_table(orders.filter(finished), f"{root}/orders", mode="append", partition_by=keys)
    return layers.register_parquet(spark, "partitioned_layer", "orders", f"{root}/orders")


ORDER_LINES = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.IntegerType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_orderdate", T.DateType()),
    ]
)


def _csv_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as CSV lines, some of them damaged: a text for a number, a field
    too few, a field too many. Good rows and quarantined lines together."""
    root = _scratch(spark, "quarantine")
    key = F.col("o_orderkey")
    price = F.when(key % 11 == 0, F.lit("abc")).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    customer = F.when(key % 13 == 0, F.lit("12x")).otherwise(F.col("o_custkey").cast("string"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.when(key % 19 == 0, F.lit('"F, closed"')).otherwise(F.col("o_orderstatus"))
    line = F.concat_ws(",", key.cast("string"), customer, price, F.when(key % 17 != 0, status), day, F.when(key % 23 == 0, F.lit("more")))
    read_input(spark, sf, "orders").select(line.alias("value")).write.text(f"{root}/lines")
    staged = stage_csv(spark, f"{root}/lines", ORDER_LINES, f"{root}/staged", header=False)
    good = staged.good.select(F.lit(False).alias("quarantined"), *ORDER_LINES.names, F.lit(None).cast("string").alias("record"), F.lit(None).cast("string").alias("reason"))
    bad = staged.quarantined.select(F.lit(True).alias("quarantined"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in ORDER_LINES], "record", "reason")
    return good.unionByName(bad)


def _load_content_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """One load of all bookings compared with four tables: as loaded, one price
    changed, two bookings' users swapped, one row lost and another twice."""
    root = _scratch(spark, "content")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS content_layer LOCATION '{root}/_warehouse'")
    source = raw_table(spark, sf, "bookings")
    content = layers.checked_write(source, f"{root}/staged")
    staged = spark.read.schema(source.schema).parquet(f"{root}/staged")
    # the first and the last of the booking ids that one row has
    single = staged.groupBy("booking_id").agg(F.count(F.lit(1)).alias("n"), F.first("user_id").alias("user_id")).filter("n = 1 and user_id is not null")
    least, most = (f(F.struct("booking_id", "user_id")) for f in (F.min, F.max))
    ends = single.agg(least.alias("a"), most.alias("b"))
    a, b = (ends.select(x).scalar() for x in ("a", "b"))
    key = F.col("booking_id")
    user = F.when(key == a["booking_id"], b["user_id"]).when(key == b["booking_id"], a["user_id"]).otherwise(F.col("user_id"))
    copies = F.when(key == a["booking_id"], F.lit(0)).when(key == b["booking_id"], F.lit(2)).otherwise(F.lit(1))
    tables = {
        "as_loaded": staged,
        "changed": staged.withColumn("total_price", F.when(key == a["booking_id"], F.lit(-1.0)).otherwise(F.col("total_price"))),
        "swapped": staged.withColumn("user_id", user),
        "lost": staged.withColumn("copy", F.explode(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), copies))).drop("copy"),
    }
    for name, rows in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS content_layer.{name}")
        rows.write.option("path", f"{root}/{name}").saveAsTable(f"content_layer.{name}")
    return layers.content_report(spark, [layers.CheckedLoad("content_layer", t, content) for t in tables])


def _hot_bookings(spark: SparkSession, sf: str) -> DataFrame:
    """Bookings of which every third is of one listing.

    Written once and read back: the key shares are measured before the rows are
    used, and neither curates them again.
    """
    key = F.when(F.pmod("booking_id", F.lit(3)) == 0, F.lit(HOT_LISTING).cast("long")).otherwise(F.col("apartment_id"))
    return _staged(_bookings(spark, sf).withColumn("apartment_id", key), "hot")


def _by_city(joined: DataFrame) -> DataFrame:
    return joined.groupBy("cityname").agg(
        F.count(F.lit(1)).alias("bookings"), F.count_distinct("user_id").alias("users"), F.sum("stay_days").cast("long").alias("nights")
    )


def _layout_bucketed_salted(spark: SparkSession, sf: str) -> DataFrame:
    """Hot bookings and listings in salted buckets, joined bucket by bucket."""
    root = _scratch(spark, "salted")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS salted_layer LOCATION '{root}/_warehouse'")
    names, keys = ("salted_layer.bookings", "salted_layer.listings"), ("apartment_id", "id")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layers.save_salted_buckets(_hot_bookings(spark, sf), _listings(spark, sf).select("id", "cityname"), names, root, keys, buckets, ["booking_date"])
    return _by_city(layers.join_salted(spark, names, keys))


def _skewed_join(spark: SparkSession, sf: str) -> DataFrame:
    """Hot bookings with listings whose ids are repeated (each attribute row
    three times): the whole fan-out, spread over salts."""
    listings = _listings(spark, sf).select("id", "cityname").withColumn("copy", F.explode(F.array(*map(F.lit, range(3)))))
    return _by_city(skew.skew_join(_hot_bookings(spark, sf), listings, "apartment_id", "id", salts=16))


def _layout_sized(spark: SparkSession, sf: str) -> DataFrame:
    """Bookings written with 1, 8 and 200 shuffle partitions: rows, and whether
    there are no more files than cores, or else files of some size.

    They are curated once, with the session's own partitions: with one, the join
    and the de-duplication of all rows would be a single task.
    """
    root, conf = _scratch(spark, "sized"), "spark.sql.shuffle.partitions"
    bookings = _staged(_bookings(spark, sf), "sized-source")
    before, reports = spark.conf.get(conf), []
    for n in (1, 8, 200):
        spark.conf.set(conf, str(n))
        try:
            layers.write_layer_table(bookings, f"{root}/{n}", "curated_layer", "curated_bookings", sized=True)
        finally:
            spark.conf.set(conf, before)
        rows = spark.read.parquet(layers.layer_path(f"{root}/{n}", "curated_layer", "curated_bookings"))
        files = rows.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("n"))
        # a session may put parallelism before size: then a small table has a file for each core
        few = (F.count(F.lit(1)) <= spark.sparkContext.defaultParallelism) | (F.avg("size") > LEAST_FILE_BYTES)
        reports.append(files.agg(F.lit(n).alias("shuffle_partitions"), F.sum("n").cast("long").alias("row_count"), few.alias("files_follow_size")))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def _incremental_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Listings extracted twice: those modified until 1997 first, then all that
    are left after one in 13 was deleted; with the run each row came in."""
    root, source = _scratch(spark, "incremental"), raw_table(spark, sf, "apartments")
    modified = parse_date("last_modified_timestamp")
    early = source.filter(modified <= F.lit("1997-12-31").cast("date"))
    first = incremental.extract_changes(spark, early, root, "apartments", ["id"], modified)
    later = source.filter(F.col("id") % 13 != 0)
    second = incremental.extract_changes(spark, later, root, "apartments", ["id"], modified)
    if second.rows + first.rows > source.count():
        raise AssertionError("the second run wrote rows that the first had")
    return incremental.held(spark, root, "apartments", source.schema, ["id"])


def _layer_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads into a fresh layer, one of bookings and one of a source without
    rows (refused), and a table that was never created: what the checks say."""
    root = _scratch(spark, "presence")
    bookings = raw_table(spark, sf, "bookings")
    names = [f"presence_layer.{t}" for t in ("bookings", "cancelled_in_advance", "missing")]
    refused = []
    for name, source in ((names[0], bookings), (names[1], bookings.filter("booking_status = 'cancelled in advance'"))):
        _fresh_table(spark, "presence_layer", name.split(".")[1], RAW["bookings"], root)
        staged = spark.read.schema(RAW["bookings"]).parquet(layers.write_table(source, f"{root}/staged/{name}"))
        try:
            layers.ensure_not_empty(staged, name)
            layers.load_into(spark, staged, name)
        except ValueError:
            refused.append(name)
    spark.sql(f"DROP TABLE IF EXISTS {names[2]}")
    return layers.presence(spark, names).withColumn("refused", F.col("table_name").isin(refused))


QUERIES: dict[str, Query] = {
    # curated layer
    "curated_apartments": _listings,
    "curated_bookings": _bookings,
    "curated_user_viewing": _views,
    # presentation metrics
    "average_listing_price": lambda s, sf: metrics.average_listing_price(_listings(s, sf)),
    "average_listing_price_iso": lambda s, sf: metrics.average_listing_price_iso(_listings(s, sf)),
    "active_listing_calendar": lambda s, sf: metrics.active_listing_calendar(
        s, _listings(s, sf), SPINE_START, SPINE_END
    ),
    "occupancy_rate": lambda s, sf: metrics.occupancy_rate(
        s, _listings(s, sf), _bookings(s, sf), SPINE_START, SPINE_END
    ),
    "occupancy_rate_full_spine": lambda s, sf: metrics.occupancy_rate_full_spine(
        s, _listings(s, sf), _bookings(s, sf), SPINE_START, SPINE_END
    ),
    "popular_locations": lambda s, sf: metrics.popular_locations(_bookings(s, sf), _listings(s, sf)),
    "top_performing_listings": lambda s, sf: metrics.top_performing_listings(
        _bookings(s, sf), _listings(s, sf)
    ),
    "user_weekly_bookings": lambda s, sf: metrics.user_weekly_bookings(_bookings(s, sf)),
    "average_booking_duration": lambda s, sf: metrics.average_booking_duration(_bookings(s, sf)),
    "repeat_customer_rate": lambda s, sf: metrics.repeat_customer_rate(_bookings(s, sf)),
    "repeat_rate_30d": lambda s, sf: metrics.repeat_rate_30d(_bookings(s, sf)),
    # profiling
    "duplicate_profile": lambda s, sf: profile.duplicate_profile(_cleaned_tables(s, sf, False)),
    "null_profile": lambda s, sf: profile.null_profile(_cleaned_tables(s, sf, True)),
    "summary_profile": lambda s, sf: profile.summary_profile(
        raw_tables(s, sf) | {"curated_apartments": _listings(s, sf), "curated_bookings": _bookings(s, sf)}
    ),
    # ingest: NaN normalisation, keyed upsert, keyless append
    "nan_to_null_attributes": lambda s, sf: raw_table(s, sf, "apartments_attributes"),
    "upsert_listings": _upsert_listings,
    "append_views_dedup": _append_views_dedup,
    # sources, sinks, catalog, layer loads
    "csv_roundtrip": _csv_roundtrip,
    "catalog_register": _catalog_register,
    "layer_load_overwrite": lambda s, sf: _layer_load(s, sf, ("overwrite",)),
    "layer_load_append": lambda s, sf: _layer_load(s, sf, ("overwrite", "append")),
    "layout_sorted": _layout_sorted,
    "layout_bucketed": _layout_bucketed,
    # the whole batch job: its report, what it publishes, a second batch appended
    "batch_reconcile": _batch,
    "batch_average_listing_price": _published("average_listing_price"),
    "batch_top_performing_listings": _published("top_performing_listings"),
    "batch_append_bookings": _batch_append,
    # partitioned folders by name, quarantine, repeated appends, contents of loads
    "catalog_register_partitioned": _catalog_register_partitioned,
    "csv_quarantine": _csv_quarantine,
    "append_rerun_bookings": _append_rerun,
    "load_content_reconcile": _load_content_reconcile,
    # hot keys, file sizes, changes since the last extract
    "layout_bucketed_salted": _layout_bucketed_salted,
    "skewed_listing_join": _skewed_join,
    "layout_sized": _layout_sized,
    "incremental_extract": _incremental_extract,
    # checks before and after a load, previews
    "layer_presence": _layer_presence,
    "bookings_preview": lambda s, sf: profile.preview(raw_table(s, sf, "bookings"), PREVIEW_ROWS),
}
