from __future__ import annotations

import hashlib
import random

import public_tokenizers as P
import pytest

from lodgepole.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def expected(text):
    ids = bpe.encoding_of(PATH, P.PATTERN).encode_ordinary(text or "")
    raw = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


TEXTS = [
    None, "", " ", "\n\n  \t x", "don't I'll we've", "a" * 3000, "naïve café 東京 2024年 😀👍🏽", "<|endoftext|> <|im_start|>", "x y z\x1cq\x85r​s　t",
    "line\r\nline\r\n\r\n  end  ", "\x00\x01\x1f\x7f", "١٢٣ ½ Ⅷ", "é ำ́", "   leading", "trailing   ", "tab\tsep 12345678901234567890",
]


def test_equals_library(docs):
    rng = random.Random(1)
    rows = list(enumerate(TEXTS)) + [(100 + i, " ".join(rng.choice(["the", "of", "Straße", "éeau", "x1", "...", "\n"]) for _ in range(200))) for i in range(30)]
    rows += [rows[5], (None, "no id"), (None, None)]
    got = bpe.encode(docs(rows, {"chunk": "1", "block": "2", "ids": "'x'"}), PATH, P.PATTERN).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted([(i, *expected(t)) for i, t in rows], key=key)


def test_rows_of_one_id_keep_their_own_words(spark):
    rows = [(7, "hello"), (7, "world"), (None, "hello"), (None, "world"), (-1, "other"), (7, "hello world"), (7, "world hello"), (None, None), (0, "hello"), (0, None)]
    key = lambda r: tuple(map(str, r))
    for parts in (1, 3, 10):
        spread = spark.createDataFrame([(i % parts, *r) for i, r in enumerate(rows)], "part int, doc_id long, text string").repartition(parts, "part")
        got = bpe.encode(spread, PATH, P.PATTERN).collect()
        assert sorted(map(tuple, got), key=key) == sorted([(i, *expected(t)) for i, t in rows], key=key)


def test_every_row_in_a_partition_of_its_own(spark):
    rows = [(7, w) for w in ("hello", "world", "hello", "wörld")] + [(None, w) for w in ("hello", "world", "again")]
    frame = spark.sparkContext.parallelize(rows, len(rows)).toDF("doc_id long, text string")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, bpe.encode(frame, PATH, P.PATTERN).collect()), key=key) == sorted([(i, *expected(t)) for i, t in rows], key=key)


def test_white_space_and_classes_agree_with_the_library():
    enc, find = bpe.encoding_of(PATH, P.PATTERN), bpe.split_pattern(P.PATTERN).findall
    bad = []
    for c in [*range(0, 0xD800), *range(0xE000, 0x30000)]:
        text = f"a{chr(c)}1{chr(c)}{chr(c)} b"
        ids = [i for w in find(text) for i in enc._encode_single_piece(w.encode())]
        if ids != enc.encode_ordinary(text):
            bad.append(hex(c))
    assert bad == []


@pytest.mark.parametrize("text", [" " * 200_000 + "x", "ab " * 100_000, "z" * 100_000])
def test_very_long_texts(docs, text):
    row = bpe.encode(docs([(1, text)]), PATH, P.PATTERN).first()
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_ids_decode_and_empty(docs):
    raw = bpe.encode(docs([(1, "hello wörld")]), PATH, P.PATTERN, with_ids=True).first().ids
    ids = [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]
    assert ids == bpe.encoding_of(PATH, P.PATTERN).encode_ordinary("hello wörld")
    assert bpe.encode(docs([]), PATH, P.PATTERN).collect() == []
