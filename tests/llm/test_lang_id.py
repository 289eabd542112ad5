from __future__ import annotations

import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest
import regex

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402
from lodgepole.llm import lang_id  # noqa: E402
from lodgepole.llm.queries import op2_language_id  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return lang_id.fit(docs.filter(~lang_id.held_out("doc_id")))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op2_language_id(spark, SF)
    assert got.count() == docs.count()
    rows = got.join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    test = [r for r in rows if r.held_out]
    assert len(test) > 150 and sum(r.lang == r.lang_pred for r in test) >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 for r in rows)


def test_backoff_order(model):
    word = next(iter(model.words))
    assert (model.word(word) == model.word_scores[model.words[word]]).all()
    assert "queque" + "zq" not in model.words
    assert model.word("zzqx東") is not None
    # a word of unseen characters says nothing
    assert (model.word("東京") == 0).all()
    assert model.predict("東京") == (model.langs[0], pytest.approx(1 / len(model.langs)))
    # unseen words made of known n-grams are told apart
    assert model.predict("éauxtionmentelle réeauqueoi")[0] == "fr"
    assert model.predict("ungheitlichkeitschtz")[0] == "de"


def test_edge_cases(spark, docs, model):
    rows = [(1, None), (2, ""), (3, " 12 !? \n"), (4, "the of and " * 50_000), (None, "the of and"), (6, "THE OF AND")]
    got = {r.doc_id: (r.lang_pred, r.score, r.held_out) for r in lang_id.identify(docs(rows, {"found": "1"}), model).collect()}
    assert got[1][:2] == got[2][:2] == got[3][:2] == ("und", 0.0)
    assert got[4][0] == got[None][0] == got[6][0] == "en" and got[None][2] is False
    assert lang_id.identify(docs([]), model).collect() == []
    # numerals and signs are no letters
    for text in ("½ ²", "Ⅷ", "① ٣ _", "12 !? ª" .replace("ª", "")):
        assert model.predict(text) == ("und", 0.0)


def test_nothing_learned(docs):
    none = lang_id.fit(docs([]))
    assert none.predict("text") == ("und", 0.0)
    assert lang_id.fit(docs([(1, None)])).langs == ()


def test_does_not_depend_on_partitions(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = lang_id.fit(rows.repartition(1)), lang_id.fit(rows.repartition(7))
    assert a.words == b.words and a.grams == b.grams and (a.word_scores == b.word_scores).all()


def test_rare_languages_are_learned(spark):
    """0.01 % of the rows in a script of their own, 0.01 % in a shared one."""
    rng = random.Random(5)
    own = ["ᎣᏏᏲ ᏙᎯᏧ ᎣᏍᏓ ᏩᏙ ᎦᏙ ᏕᏣᏙᎠ", "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ ᎣᏏᏲ ᏩᏙ ᏙᎯᏧ"]
    shared = ["kaixo mundua egun on guztioi eskerrik asko", "euskara hizkuntza zaharra da eta ederra da"]
    syllables = ["the", "ing", "and", "tion", "er", "ou", "st", "wh", "ly", "on"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(4))
    rows = [(i, " ".join(word() for _ in range(12)), "en") for i in range(20_000)] + [(i, t, lang) for lang, ts in (("chr", own), ("eu", shared)) for i, t in enumerate(ts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = lang_id.fit(docs, sample_rows=500, max_words=3_000, max_grams=3_000)
    assert model.langs == ("chr", "en", "eu")
    for lang, texts in (("chr", own), ("eu", shared)):
        for t in texts:
            assert model.predict(t)[0] == lang and model.predict(t)[1] >= 0.9
    assert all(model.predict(t)[0] == "en" for _, t, _ in rows[:300])
    # the pipeline keeps them
    kept = corpus_pipeline.language_id(spark, docs, "").groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in kept} == {"en": 20_000, "chr": 2, "eu": 2}


class PlainModel:
    """The same model without Spark or arrays: dictionaries of counts, one word after the other."""

    def __init__(self, rows):
        self.langs = sorted({lang for _, lang in rows})
        words, grams = Counter(), Counter()
        for text, lang in rows:
            for w in regex.findall(r"\p{L}+", text.lower()):
                words[lang, w] += 1
        for (lang, w), n in words.items():
            padded = f" {w} "
            for k in range(1, 5):
                for i in range(len(padded) - k + 1):
                    if padded[i : i + k] != " ":
                        grams[lang, padded[i : i + k]] += n
        self.words = self.kept(Counter({k: n for k, n in words.items() if n > 1}), lang_id.MAX_WORDS)
        self.grams = self.kept(grams, lang_id.MAX_GRAMS)

    def kept(self, counts, most):
        order = sorted(counts, key=lambda k: (-counts[k], k[0], k[1].encode()))
        own = math.ceil(most / len(self.langs))
        keys = set(order[:most]) | {k for lang in self.langs for k in [x for x in order if x[0] == lang][:own]}
        totals = [max(1, sum(counts[k] for k in keys if k[0] == lang)) for lang in self.langs]
        out = {}
        for key in {k for _, k in keys}:
            logs = [math.log((counts[lang, key] if (lang, key) in keys else 0) / t + 0.5 / max(totals)) for lang, t in zip(self.langs, totals, strict=True)]
            out[key] = [x - sum(logs) / len(logs) for x in logs]
        return out

    def predict(self, text):
        total, found = [0.0] * len(self.langs), regex.findall(r"\p{L}+", (text or "").lower())
        for w in found:
            rows = [self.words[w]] if w in self.words else []
            padded = f" {w} "
            for k in (4, 3, 2, 1):
                rows = rows or [self.grams[padded[i : i + k]] for i in range(len(padded) - k + 1) if padded[i : i + k] in self.grams]
            total = [t + (sum(r[i] for r in rows) / len(rows) if rows else 0.0) for i, t in enumerate(total)]
        if not found:
            return "und", 0.0
        best = max(range(len(total)), key=lambda i: (total[i], -i))
        return self.langs[best], 1 / sum(math.exp(max(t - total[best], -700)) for t in total)


def test_equals_a_plain_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    plain = PlainModel([(r.text, r.lang) for r in docs if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2])
    got = {r.doc_id: (r.lang_pred, r.score) for r in op2_language_id(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        lang, score = plain.predict(r.text)
        assert got[r.doc_id][0] == lang and got[r.doc_id][1] == pytest.approx(score, abs=1e-6)


def test_words_and_ngrams_come_to_the_driver_as_columns(spark, monkeypatch):
    """Only the counts of the languages are collected as rows: many row objects fill the driver."""
    labelled = spark.createDataFrame([(f"un chat noir {i} dort", "fr") for i in range(30)] + [(f"a black cat {i} sleeps", "en") for i in range(30)], "text string, lang string")
    plain, collected = type(labelled).collect, []
    monkeypatch.setattr(type(labelled), "collect", lambda df: collected.append(plain(df)) or collected[-1])
    model = lang_id.fit(labelled)
    assert [len(rows) for rows in collected] == [2]
    assert {"chat", "cat"} <= set(model.words) and model.predict("le chat dort")[0] == "fr"
