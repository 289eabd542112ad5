"""CSV lines that do not fit the schema."""

import uuid

import pytest
from pyspark.sql import types as T

from lodgepole.session import lake_root
from lodgepole.sources.readers import read_csv, stage_csv

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("ok", T.BooleanType()), T.StructField("day", T.DateType()), T.StructField("name", T.StringType())])


@pytest.fixture
def folder(spark, tmp_path):
    def make(*files: str) -> str:
        for i, text in enumerate(files):
            (tmp_path / f"{i}.csv").write_text(text)
        return f"file://{tmp_path}"

    return make


def _out(spark):
    return f"{lake_root(spark)}/tests/quarantine-{uuid.uuid4().hex[:8]}"


HEAD = "id,price,ok,day,name\n"
GOOD = ['1,2.5,true,2020-01-31,"a, b"', "2,,,,", '3,-1e3,false,2020-02-29,"say ""hi"""', "4,NaN,true,2020-01-01,x"]
BAD = {
    "5,abc,true,2020-01-01,x": "price: 'abc' is no double",
    "x,1.0,true,2020-01-01,x": "id: 'x' is no bigint",
    "6,1.0,maybe,2020-13-01,x": "ok: 'maybe' is no boolean; day: '2020-13-01' is no date",
    "7,1.0,true": "not 5 fields",
    "8,1.0,true,2020-01-01,x,more": "not 5 fields",
    "9999999999999999999999,1.0,true,2020-01-01,x": "id: '9999999999999999999999' is no bigint",
}


def test_lines_are_set_apart(spark, folder):
    path = folder(HEAD + "\n".join([*GOOD[:2], *list(BAD)[:3]]) + "\n", HEAD + "\n".join([*list(BAD)[3:], *GOOD[2:]]) + "\n")
    staged = stage_csv(spark, path, SCHEMA, _out(spark), escape='"')
    assert (staged.good_rows, staged.quarantined_rows) == (len(GOOD), len(BAD))
    rows = sorted(staged.good.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == [1, 2, 3, 4] and rows[0].name == "a, b" and rows[2].name == 'say "hi"'
    assert rows[1][1:] == (None, None, None, None) and staged.good.columns == SCHEMA.names
    bad = staged.quarantined.collect()
    assert {r.record: r.reason for r in bad} == BAD
    assert {r.source_file.rsplit("/", 1)[1] for r in bad} == {"0.csv", "1.csv"}


def test_fewer_columns_read_find_the_same_lines(spark, folder):
    path = folder(HEAD + "\n".join([*GOOD, *BAD]) + "\n")
    staged = stage_csv(spark, path, SCHEMA, _out(spark))
    assert staged.good.select("name").count() == len(GOOD) and staged.quarantined.select("reason").count() == len(BAD)
    # the plain reader gives NULLs in their place and says nothing
    assert read_csv(spark, path, SCHEMA).count() == len(GOOD) + len(BAD)


def test_only_good_only_bad_empty(spark, folder, tmp_path):
    path = folder(HEAD + "\n".join(GOOD) + "\n")
    staged = stage_csv(spark, path, SCHEMA, _out(spark))
    assert staged.quarantined.count() == staged.quarantined_rows == 0 and staged.good.count() == 4
    (tmp_path / "0.csv").write_text("\n".join(BAD) + "\n\n")
    staged = stage_csv(spark, path, SCHEMA, _out(spark), header=False)
    assert staged.good.count() == staged.good_rows == 0 and staged.quarantined.count() == len(BAD)
    (tmp_path / "0.csv").write_text("")
    staged = stage_csv(spark, path, SCHEMA, _out(spark))
    assert (staged.good.count(), staged.quarantined.count(), staged.good_rows, staged.quarantined_rows) == (0, 0, 0, 0)


def test_values_over_several_lines(spark, folder):
    path = folder(HEAD + '1,1.0,true,2020-01-01,"two\nlines"\n2,zzz,true,2020-01-01,"two\nlines"\n')
    staged = stage_csv(spark, path, SCHEMA, _out(spark), multi_line=True)
    assert [r.name for r in staged.good.collect()] == ["two\nlines"]
    assert [r.reason for r in staged.quarantined.collect()] == ["price: 'zzz' is no double"]


def test_named_schema_and_reserved_names(spark, folder):
    path = folder("booking_id,user_id,apartment_id,booking_date,checkin_date,checkout_date,total_price,currency,booking_status\n1,2,3,06/01/2020,,,x,EUR,confirmed\n")
    assert stage_csv(spark, path, "bookings", _out(spark)).quarantined_rows == 1
    with pytest.raises(ValueError):
        stage_csv(spark, path, T.StructType([T.StructField("malformed", T.StringType())]), _out(spark))
