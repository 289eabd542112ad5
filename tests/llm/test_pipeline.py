from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402
from llm.test_packing import check  # noqa: E402
from llm.test_secret_scan import planted  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Real rows with planted cases: copies, near copies, a shared passage, nothing to read, secrets."""
    rng = random.Random(8)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS).collect()]
    text = max((r[1] for r in rows if r[2] == "en"), key=len)
    words = text.split()
    near = list(words)
    near[len(near) // 2] = "changed"
    passage = " ".join(rng.choice(words) for _ in range(60))
    own = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    extra = [
        (10_001, text), (10_002, " ".join(near)), (10_003, None), (10_004, ""), (10_005, "123 !? 456"),
        (10_006, own(50) + " " + passage + " " + own(50)), (10_007, own(50) + " " + passage + " " + own(50)),
        (10_008, own(80) + " password=b7db7aa4a5fcc78305 " + own(80)), (10_009, passage),
    ]
    rows += [(i, t, "en", "src0", len(t) if t else None) for i, t in extra]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{path}/documents.parquet")
    return f"file://{path}", passage


def test_stages_one_by_one(spark, folder, tmp_path):
    sf, passage = folder
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf).write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        assert docs.columns == COLUMNS and [f.dataType for f in docs.schema] == [f.dataType for f in spark.read.parquet(f"{sf}/documents.parquet").schema]
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(after) and set(after) <= set(before)
        if name == "language_id":
            assert set(before) - set(after) == {10_003, 10_004, 10_005}
        if name == "ngram_jaccard_join":
            assert not {10_001, 10_002} & set(after)
        if name == "suffix_dedup":
            assert passage in after[10_006].text and passage not in after[10_007].text and 10_009 not in after
            assert all(r.n_chars == len(r.text) for i, r in after.items() if r.text != before[i].text)
        if name == "secret_scan":
            assert "password=[SECRET] " in after[10_008].text and not any(planted(r.text) for r in after.values())
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    check(packed, [(i, r.text) for i, r in before.items()])


def test_run_on_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").collect() == []


def test_stages_handle_nulls_and_extra_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, block long, kind int"
    rows = [(None, "of the and to be with " * 9, None, None, None, 1, 2), (None, None, None, None, None, 1, 2), (1, "of the and to be with that " * 9, "en", None, 5, 1, 2), (1, "of the and to be with that " * 9, "en", None, 5, 1, 2)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), schema)
        assert docs.columns == [f.split()[0] for f in schema.split(", ")]
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]


def test_suffix_stage_tells_rows_of_one_id_apart(spark):
    rng = random.Random(2)
    own = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    passage, a, b, c = own(), own(), own(), own()
    rows = [(1, passage, "en", "s", 0), (2, f"{a} {passage}", "en", "s", 0), (2, b, "en", "s", 0), (None, c, "en", "s", 0), (3, f"{c} {b[:50]}", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.suffix_removal(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, passage), (2, f"{a} "), (2, b), (None, c), (3, f" {b[:50]}")], key=str)


def near_rows(rng):
    own = lambda n: " ".join(rng.choice(["of", "the", "and", "to", "be"]) + " " + f"w{rng.randrange(10**6)}" for _ in range(n))
    base, other, third = own(60), own(60), own(60)
    near = base.rsplit(" ", 1)[0] + " changed"
    return base, near, other, third


def test_one_row_of_each_class_whatever_the_ids(spark):
    base, near, other, third = near_rows(random.Random(5))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [
        (1, base, "en", "a", 0), (1, near, "en", "b", 0), (None, other, "en", "c", 0), (None, other, "en", "d", 0), (None, near, "en", "e", 0),
        (7, other, "en", "f", 0), (None, third, "en", "g", 0), (None, third + " x", "en", "h", 0), (9, None, "en", "i", 0), (9, "", "en", "j", 0), (None, None, "en", "k", 0),
    ]
    kept = corpus_pipeline.ngram_jaccard_join(spark, spark.createDataFrame(rows, schema).repartition(4), "").collect()
    assert sorted(r.doc_id for r in kept if r.text in (base, near)) == [1]
    assert [r.doc_id for r in kept if r.text == other] == [7]  # an id goes before none
    assert len([r for r in kept if r.text and r.text.startswith(third)]) == 1
    assert len([r for r in kept if not r.text]) == 3 and len(kept) == 6


def test_stages_leave_columns_of_any_name_alone(spark):
    base, near, other, third = near_rows(random.Random(6))
    names = ["__found", "__removed", "__doc", "__text", "__key", "__values", "found", "removed", "row", "place", "class_id", "Row_", "secret_doc", "salt", "h"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names)
    rows = [(i, f"{t} password=b7db7aa4a5fcc7830{i}", "en", "s", None, *range(len(names))) for i, t in enumerate([base, near, other, third])]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
        assert all(tuple(r)[5:] == tuple(range(len(names))) for r in docs.collect())
    assert sorted(r.doc_id for r in docs.collect()) == [0, 2, 3]
    assert all("[SECRET]" in r.text for r in docs.collect())


def test_run_on_rows_with_repeated_and_null_ids(spark, tmp_path):
    base, near, other, third = near_rows(random.Random(7))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, base, "en", "a", 0), (1, near, "en", "a", 0), (None, other, "en", "a", 0), (None, other, "en", "a", 0), (None, third, "en", "a", 0), (3, None, None, None, None), (4, "12 !?", None, None, 5)]
    spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/documents.parquet")
    packed = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert sorted(str(r.doc_id) for r in packed) == ["1", "None", "None"]
    assert len({r.sequence_id for r in packed}) == 1
