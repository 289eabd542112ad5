"""Change batches derived from the driver's tables, for upsert workloads.

``listing_price_updates``: every line item is read as a price change of the
listing it refers to (unit price = extended price ÷ quantity, modified on
the ship date). Applied to the listings table with a keyed upsert, each
listing ends with its most recent price. A popular part yields many updates
for one key, which is exactly the hot-key case the upsert must handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgepole.schemas import DATE_FORMAT, RAW
from lodgepole.sources.domain import (
    LISTING_DAY_SPREAD,
    LISTING_EPOCH,
    SOURCE_CURRENCY,
    dealt,
    read_input,
)


def listing_price_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = dealt(read_input(spark, sf_dir, "lineitem"), "l_orderkey")
    part = read_input(spark, sf_dir, "part")
    created = F.date_add(
        F.to_date(F.lit(LISTING_EPOCH)), (F.col("p_partkey") % LISTING_DAY_SPREAD).cast("int")
    )
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    df = joined.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("source"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.lit(SOURCE_CURRENCY).alias("currency"),
        F.date_format(created, DATE_FORMAT).alias("listing_created_on"),
        F.lit(True).alias("is_active"),
        F.date_format(F.to_date("l_shipdate"), DATE_FORMAT).alias("last_modified_timestamp"),
    )
    return df.select([F.col(f.name).cast(f.dataType) for f in RAW["apartments"].fields])
