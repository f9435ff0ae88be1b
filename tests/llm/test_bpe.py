import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from cinestrata.llm import bpe
from cinestrata.llm.queries import VOCABULARY, op8_byte_bpe

ODD = ["", " ", "  ", "\n", " \n ", "don't we'll 'tis 's''re !'s it's's 'lla", "a  b\n\nc \t d ",
       "x" * 5000, "=" * 3000 + "é" * 999, "naïve Ⅷ ½ ٣٤ 漢字かな 😀😀 é‍", "  a　",
       "\0a\0", "<|endoftext|>", "'", "a'", "'r", "'v", " 's", "\t's", "1's", "\x1c\x1f \x85 z",
       "\U0010ffff﻿"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(open(VOCABULARY, "rb").read())


@pytest.fixture(scope="module")
def library():
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def noise(seed, n):
    rng = random.Random(seed)
    pool = "abéz'sdtrvmle   \n\t1٣!?.'’-_ 漢😀"
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 400))) for _ in range(n)]


def test_pieces_are_those_of_the_pattern(codec):
    texts = ODD + noise(1, 400)
    points = bpe.code_points("\0".join(texts) + "\0")
    breaks = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = set(bpe.piece_starts(points, breaks).tolist())
    at = 0
    for text in texts:
        want = [m.start() for m in regex.finditer(public_tokenizers.PATTERN, text)]
        assert [i - at for i in range(at, at + len(text)) if i in starts] == want, repr(text)
        at += len(text) + 1


def test_ids_are_those_of_the_library_and_decode(codec, library):
    texts = ODD + noise(2, 300)
    for text, (ids, offsets) in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)[:80]
        assert codec.decode(ids, offsets) == text.encode()
        n = len(ids) // 4
        assert codec.decode(ids, offsets, n // 3, n // 2) == text.encode()[
            offsets[n // 3]:offsets[n // 2]]


def test_every_code_point_has_the_librarys_class(codec, library):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x33000 or c > 0xE0000)]
    for at in range(0, len(points), 4000):
        text = "".join(f"a{chr(c)}1{chr(c)}{chr(c)}" for c in points[at:at + 4000])
        (ids, _), = codec.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), hex(points[at])


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op8_byte_bpe(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_odd_rows_and_general_interface(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b", None), (3, "é" * 70_000, "x"),
            (3, "é" * 70_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.round_trip(docs, VOCABULARY).collect()
    assert sorted((r.doc_id or 0, r.n_tokens == 0) for r in got) == [
        (0, False), (1, True), (2, True), (3, False), (3, False)]
    tokens = bpe.encoded(docs, VOCABULARY)
    back = bpe.decoded(tokens, VOCABULARY).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted(
        (d or 0, t or "") for d, t, _ in rows)
    assert bpe.round_trip(docs.limit(0), VOCABULARY).count() == 0


def test_merging_long_pieces_is_bounded(codec):
    codec.merger.clear()
    text = "".join(chr(0x4E00 + i * 7 % 5000) for i in range(60_000))
    (ids, offsets), = codec.encode([text])
    assert codec.decode(ids, offsets) == text.encode()
    assert len(codec.merger) == 0


def test_both_ways_of_merging_agree(codec):
    for text in noise(4, 200):
        piece = text.encode()[:bpe.LONGEST]
        if piece:
            assert codec.merger._short(piece) == codec.merger._long(piece)
