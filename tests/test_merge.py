import pytest
from pyspark.sql import functions as F

from conftest import listing
from lodgepole.functions.dates import parse_date
from lodgepole.operators.merge import upsert


def _order():
    return [parse_date("last_modified_timestamp")]


def test_upsert_inserts_updates_and_latest_wins(raw):
    target = raw("apartments", listing(1, price=10.0), listing(2, price=20.0))
    batch = raw(
        "apartments",
        listing(2, price=21.0, last_modified_timestamp="01/02/2020"),
        listing(2, price=22.0, last_modified_timestamp="03/02/2020"),
        listing(3, price=30.0),
    )
    got = {r.id: r.price for r in upsert(target, batch, ["id"], _order()).collect()}
    assert got == {1: 10.0, 2: 22.0, 3: 30.0}


def test_upsert_is_idempotent(raw):
    target = raw("apartments", listing(1, price=10.0))
    batch = raw("apartments", listing(1, price=11.0), listing(2))
    once = upsert(target, batch, ["id"], _order())
    twice = upsert(once, batch, ["id"], _order())
    assert sorted(once.collect()) == sorted(twice.collect())


def test_upsert_breaks_remaining_ties_deterministically(spark, raw):
    batch = raw("apartments", *[listing(1, price=float(p)) for p in (3, 9, 1, 7)])
    target = raw("apartments", listing(5)).filter(F.lit(False))
    results = set()
    for n in ("1", "3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.add(tuple(upsert(target, batch.repartition(int(n)), ["id"], _order()).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(results) == 1 and next(iter(results))[0].price == 9.0


def test_order_is_required_and_the_later_row_wins(raw):
    target = raw("apartments", listing(1, price=9.0))
    batch = raw(
        "apartments",
        listing(1, price=2.0, last_modified_timestamp="31/01/2020"),
        listing(1, price=1.0, last_modified_timestamp="01/02/2020"),
    )
    for missing in ([], None):
        with pytest.raises(ValueError, match="order_by"):
            upsert(target, batch, ["id"], missing)
    assert upsert(target, batch, ["id"], _order()).first().price == 1.0
