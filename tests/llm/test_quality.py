from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgepole.llm import quality
from lodgepole.llm.queries import KEEP_FROM, op13_quality_gam

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return op13_quality_gam(spark, SF).toPandas().set_index("doc_id")


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    both = scored.join(labels, how="inner")
    unseen = both[both.held_out]
    assert len(unseen) > 50
    assert (unseen.predicted == unseen.quality).mean() >= 0.97
    assert unseen[unseen.quality == 1].score.min() > unseen[unseen.quality == 0].score.median()


def test_scores_of_all_rows(spark, scored):
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert scored.score.between(0, 1).all()
    assert ((scored.score >= KEEP_FROM).astype(int) == scored.predicted).all()
    assert all(h == (crc32(str(i).encode()) % 5 == 0) for i, h in zip(scored.index, scored.held_out, strict=True))


def plain_score(model, values):
    """One row of measures by the definition: cell by cell."""
    total = model.start
    at = [sum(v >= c for c in cuts) for v, cuts in zip(values, model.cuts, strict=True)]
    total += sum(table[b] for table, b in zip(model.tables, at, strict=True))
    total += sum(t[model.coarse[i][at[i]]][model.coarse[j][at[j]]] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
    return 1 / (1 + np.exp(-total))


def test_vectorised_scores_equal_plain_lookups_and_pairs_are_learned():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no measure tells anything alone
    model = quality.boost(x[:1000], y[:1000], np.ones(1000))
    assert model.pairs[0] == (1, 0)
    fresh = model.score(x[1000:])
    assert ((fresh > 0.5) == (y[1000:] == 1)).mean() > 0.95
    assert np.allclose(fresh[:100], [plain_score(model, v) for v in x[1000:1100]])
    no_pairs = quality.boost(x[:1000], y[:1000], np.ones(1000), pairs=0)
    assert ((no_pairs.score(x[1000:]) > 0.5) == (y[1000:] == 1)).mean() < 0.65


def test_measures_against_a_plain_count():
    text = "Shout LOUD loud loud.\n\nA line, a line\nA line, a line\n?? ok### Üben 42 "
    got = dict(zip(quality.FEATURES, quality.measures(text), strict=True))
    words = text.split()
    assert got["bare_marks"] == 2 / len(words) and got["marked_words"] == 1 / len(words)
    assert got["shouted_words"] == 1 / len(words)
    assert got["doubled_words"] == 0 and got["distinct_lines"] == 3 / 4
    assert got["ended_lines"] == 1 / 4
    assert got["digits"] == 2 / len(text.encode()) and got["beyond_ascii"] == 2 / len(text.encode())
    assert quality.measures(None) == quality.measures("") == [0.0] * len(quality.FEATURES)


def test_edge_rows(spark, docs):
    rng = random.Random(4)
    good = [(i, " ".join(rng.choice(["plain", "words", "of", "text"]) + ("." if j % 9 == 8 else "") for j in range(60))) for i in range(120)]
    bad = [(i + 200, "junk### " * 40) for i in range(60)]
    odd = [(None, "x"), (None, None), (900, None), (901, ""), (902, "long line " * 100_000), (903, "퟿ \x00 ok"), (10, good[0][1]), (10, good[0][1])]
    frame = docs([*good, *bad, *odd], {"y": "1", "h": "2", "x": "3", "quality": "4", "score": "5"})
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(1, None, 0), (2, 7, 0), (None, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(frame.filter(~quality.held_out(F.col("doc_id"))), labels, sample_rows=100)
    got = quality.classify(frame, model, 0.5).collect()
    assert len(got) == len(good) + len(bad) + len(odd)
    assert all(r["predicted"] == 1 for r in got if r["doc_id"] is not None and r["doc_id"] < 120)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] is not None and 200 <= r["doc_id"] < 260)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_nothing_to_learn_from(spark, docs):
    frame = docs([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.classify(frame, quality.fit(frame, none), 0.3).collect()] == [0.5, 0.5]
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert all(r["score"] > 0.99 for r in quality.classify(frame, quality.fit(frame, ones), 0.3).collect())
    assert quality.classify(docs([]), quality.fit(docs([]), none), 0.3).collect() == []
