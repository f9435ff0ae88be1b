import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cinestrata.llm import infill

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def texts_of(texts):
    coded = [t.encode() for t in texts]
    sizes = np.array([len(c) for c in coded], np.int64)
    data = np.frombuffer(b"??" + b"".join(coded), np.uint8)
    return infill.Texts(data, 2 + np.cumsum(sizes) - sizes, sizes)


def brute(doc_id, text):
    t = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(t)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, t
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ALPHABET = st.text(st.sampled_from("aZz@[`{A \n\0é日🎈\x7f\x80\xff"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=6), st.sampled_from([1, 3, 1 << 17]))
def test_units_and_cuts_equal_the_pattern(texts, block):
    before, infill._BLOCK = infill._BLOCK, block
    try:
        got = texts_of(texts)
    finally:
        infill._BLOCK = before
    units = [UNIT.findall(t) for t in texts]
    assert got.n_units().tolist() == [len(u) for u in units]
    for rank in range(max(map(len, units), default=0) + 1):
        wanted = np.array([min(rank, len(u)) for u in units], np.int64)
        size, points = got.cut(wanted)
        heads = ["".join(u[:r]) for u, r in zip(units, wanted)]
        assert size.tolist() == [len(h.encode()) for h in heads]
        assert points.tolist() == [len(h) for h in heads]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows],
                               "doc_id long, text string, output string, h1 int")
    got = infill.rearranged(df).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    return got.collect()


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate([
        None, "", "a", "<P>", "x<S>y", "<M", "<" * 30, "\0", "<P" * 20, "S>M>P>" * 9, "é" * 50,
        "one two\nthree " * 30, "🎈" * 8, "abcdefgh", "abcdefg", "a\x7f\x80b"])] * 2
    rows += [(None, "some words, no id"), (None, "some words, no id"), (-5, "negative id " * 9)]
    rows += [(1000 + i, "The quick brown fox; 日本 jumps <over> the lazy dog.") for i in range(60)]
    got = run(spark, rows)
    assert sorted(((r.row.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)
                   for r in got), key=str) == sorted((brute(*r) for r in rows), key=str)
    assert all(r.back == (r.row.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_very_long_texts(spark):
    rows = [(i, "A longer text, é and 日本; " * 200_000) for i in range(3)]
    got = run(spark, rows)
    assert sorted((r.row.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)
                  for r in got) == sorted(brute(*r) for r in rows)
    assert all(r.back == r.row.text for r in got)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert texts_of([]).n_units().tolist() == []
