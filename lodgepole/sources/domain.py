"""The driver's TPC-H-style tables seen as the rental domain.

The reference ships no data, so the four operational source tables are
derived, with Spark, from the generated tables under ``sf_dir``:

=====================  ==================================================
source table           derived from
=====================  ==================================================
apartments             part (one listing per part)
apartments_attributes  part ⋈ nation ⋈ region (city = nation, state = region)
bookings               lineitem ⋈ orders (one booking per line item)
user_viewing           events (one view per event)
=====================  ==================================================

Dates are written as ``dd/MM/yyyy`` strings, as in the operational
database. Anomalies are mapped in on purpose, value by value (no row is
dropped or sampled, some are repeated):

* one order in 97 carries its booking date as ``yyyy-MM-dd`` (unparsable →
  NULL), one in 101 has no user, and one booking in 1,009 a NaN price;
* bookings with ``booking_id % 53 = 0`` come twice, in EUR and in USD, and views
  with ``event_id % 10 = 0`` come twice, so de-duplication has work to do;
* listings with ``p_partkey % 20 = 0`` have no attributes, so the inner join
  drops them;
* one listing in 31 has a NULL ``is_active``, one in 43 a NULL price, one in 47
  a NaN price and one in 29 a price with half a cent;
* one attribute row in 7 has ``square_feet = NaN``, and checkout dates run from
  2 days before to 11 days after check-in.

Every frame is a lazy plan over the whole input tables; the work grows with
the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgepole.functions.numeric import nan_to_null
from lodgepole.schemas import DATE_FORMAT, NAN_TO_NULL_TABLES, RAW
from lodgepole.sources.readers import read_parquet_table

# Fixed values of the mapping.
LISTING_EPOCH = "1995-01-01"
LISTING_DAY_SPREAD = 2000
SOURCE_CURRENCY = "EUR"
COPY_CURRENCY = "USD"
ORDER_STATUS_TO_BOOKING_STATUS = {"F": "confirmed", "O": "pending", "P": "cancelled"}
ISO_DATE_FORMAT = "yyyy-MM-dd"

# Declared schemas of the generated input tables (read without inference).
INPUT_SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated input table, read with its declared schema."""
    return read_parquet_table(spark, sf_dir, name, INPUT_SCHEMAS[name])


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Deal a generated table to tasks by its key, always.

    Each generated file is a single Parquet row group, which one task has to
    scan; everything derived from it would run in that task as well.
    """
    return df.repartition(key)


def _conform(df: DataFrame, table: str) -> DataFrame:
    schema = RAW[table]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def source_apartments(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = dealt(read_input(spark, sf_dir, "part"), "p_partkey")
    created = F.date_add(
        F.to_date(F.lit(LISTING_EPOCH)), (F.col("p_partkey") % LISTING_DAY_SPREAD).cast("int")
    )
    df = part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("source"),
        F.when(F.col("p_partkey") % 43 == 0, F.lit(None))
        .when(F.col("p_partkey") % 47 == 0, F.lit(float("nan")))
        .when(F.col("p_partkey") % 29 == 0, F.col("p_retailprice") + F.lit(0.005))
        .otherwise(F.col("p_retailprice"))
        .alias("price"),
        F.lit(SOURCE_CURRENCY).alias("currency"),
        F.date_format(created, DATE_FORMAT).alias("listing_created_on"),
        F.when(F.col("p_partkey") % 31 != 0, F.col("p_size") % 5 != 0).alias("is_active"),
        F.date_format(F.date_add(created, F.col("p_size")), DATE_FORMAT).alias(
            "last_modified_timestamp"
        ),
    )
    return _conform(df, "apartments")


def source_apartment_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = dealt(read_input(spark, sf_dir, "part"), "p_partkey").filter(F.col("p_partkey") % 20 != 0)
    # nation and region are small dimensions; the planner broadcasts them
    # after checking their size against the broadcast threshold.
    places = read_input(spark, sf_dir, "nation").join(
        read_input(spark, sf_dir, "region"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    joined = part.join(places, (F.col("p_partkey") % 25) == F.col("n_nationkey"))
    size = F.col("p_size")
    df = joined.select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("body"),
        F.col("p_brand").alias("amenities"),
        (size % 3 + 1).alias("bathrooms"),
        (size % 5 + 1).alias("bedrooms"),
        size.cast("double").alias("fee"),
        (size % 2 == 0).alias("has_photo"),
        F.when(size % 3 == 0, F.lit("true")).otherwise(F.lit("false")).alias("pets_allowed"),
        F.col("p_brand").alias("price_display"),
        F.lit("Monthly").alias("price_type"),
        F.when(size % 7 == 0, F.lit(float("nan"))).otherwise(size * F.lit(25.0)).alias(
            "square_feet"
        ),
        F.concat(F.lit("Unit "), F.col("p_partkey").cast("string")).alias("address"),
        F.col("n_name").alias("cityname"),
        F.col("r_name").alias("state"),
        (F.col("n_nationkey") * F.lit(2.5)).alias("latitude"),
        (F.col("n_regionkey") * F.lit(-12.5)).alias("longitude"),
    )
    return _conform(df, "apartments_attributes")


def source_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = dealt(read_input(spark, sf_dir, "lineitem"), "l_orderkey")
    # orders is not dealt: below the broadcast threshold it is broadcast
    # whole, above it the sort-merge join shuffles it by o_orderkey anyway.
    orders = read_input(spark, sf_dir, "orders")
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ship = F.to_date("l_shipdate")
    order_date = F.to_date("o_orderdate")
    checkout = F.date_add(ship, (F.floor("l_quantity").cast("int") % 14) - 2)
    status = F.col("o_orderstatus")
    mapped_status = None
    for code, name in ORDER_STATUS_TO_BOOKING_STATUS.items():
        mapped_status = (F.when if mapped_status is None else mapped_status.when)(
            status == code, F.lit(name)
        )
    booking_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    df = joined.select(
        booking_id.alias("booking_id"),
        F.when(F.col("l_orderkey") % 101 != 0, F.col("o_custkey")).alias("user_id"),
        F.col("l_partkey").alias("apartment_id"),
        F.when(F.col("l_orderkey") % 97 == 0, F.date_format(order_date, ISO_DATE_FORMAT))
        .otherwise(F.date_format(order_date, DATE_FORMAT))
        .alias("booking_date"),
        F.date_format(ship, DATE_FORMAT).alias("checkin_date"),
        F.date_format(checkout, DATE_FORMAT).alias("checkout_date"),
        F.when(booking_id % 1009 == 0, F.lit(float("nan")))
        .otherwise(F.col("l_extendedprice"))
        .alias("total_price"),
        F.explode(
            F.when(booking_id % 53 == 0, F.array(F.lit(SOURCE_CURRENCY), F.lit(COPY_CURRENCY))).otherwise(
                F.array(F.lit(SOURCE_CURRENCY))
            )
        ).alias("currency"),
        mapped_status.alias("booking_status"),
    )
    return _conform(df, "bookings")


def source_user_viewing(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dealt(read_input(spark, sf_dir, "events"), "event_id")
    listings = read_input(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    df = events.withColumn("copy", F.explode(copies)).select(
        F.col("user_id"),
        (F.col("event_id") % listings).alias("apartment_id"),
        F.date_format(F.to_date("ts"), DATE_FORMAT).alias("viewed_at"),
        (F.col("value") > 50).alias("is_wishlisted"),
        F.col("event_type").alias("call_to_action"),
    )
    return _conform(df, "user_viewing")


SOURCES = {
    "apartments": source_apartments,
    "apartments_attributes": source_apartment_attributes,
    "bookings": source_bookings,
    "user_viewing": source_user_viewing,
}

def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A raw-layer table: the source frame after ingest normalisation."""
    df = SOURCES[table](spark, sf_dir)
    return nan_to_null(df) if table in NAN_TO_NULL_TABLES else df


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: raw_table(spark, sf_dir, t) for t in SOURCES}


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The operational tables as they are, before any ingest step."""
    return {t: source(spark, sf_dir) for t, source in SOURCES.items()}
