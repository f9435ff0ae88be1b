import hashlib

import numpy as np
import pytest

from cinestrata.llm import digest
from cinestrata.llm.queries import op6_digest

SF = "/root/testdata/sf0.01"


def plain(text):
    data = text.encode()
    count = [0] * 256
    size = len(data)
    if 0 < size < 8:
        data = (data * 8)[:size + 7]
    for i in range(len(data) - 7):
        h = (data[i] * 0x9E3779B1 + data[i + 3] * 0x85EBCA77 + data[i + 7] * 0xC2B2AE3D) % 2**32
        h ^= h >> 15
        count[h * 0x2C1B3C6D % 2**32 >> 24] += 1
    s = sorted(count)
    code = [(c > s[63]) + (c > s[127]) + (c > s[191]) for c in count]
    return round(1024 * np.log2(1 + size)), code


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for (d, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        t, n = t or "", n or ""
        half = len(t) // 2
        e = t[:len(t) - half] + n[:half]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), digest.digest(t),
                    digest.digest(e), digest.likeness(digest.digest(t), digest.digest(e)),
                    digest.likeness(digest.digest(t), digest.digest(n))))
    return sorted(out, key=str)


def test_digest_and_likeness(monkeypatch):
    for t in ["", "a", "abc", "seven b", "eight by", "é" * 9, "the words of a text " * 40]:
        length, code = plain(t)
        got = digest.codes(digest.digest(t))
        assert got[0] == length and got[1].tolist() == code
    whole = digest.digest("some longer text, " * 900)
    monkeypatch.setattr(digest, "_SPAN", 100)
    assert digest.digest("some longer text, " * 900) == whole
    a, b = digest.digest("x" * 400), digest.digest("other words here " * 30)
    assert digest.likeness(a, a) == 1.0
    assert 0 <= digest.likeness(a, b) == digest.likeness(b, a) < 1


def test_short_texts_differ():
    short = ["a", "b", "abc", "xyz", "acb", "aaa", "seven b", "seven c"]
    assert len({digest.digest(t) for t in short}) == len(short)
    assert digest.likeness(digest.digest("abc"), digest.digest("xyz")) < 1


def test_query_equals_brute_force_and_tells_edits(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op6_digest(spark, SF).collect()
    assert sorted(map(tuple, rows), key=str) == brute(docs)
    assert len(set(r.doc_id for r in rows)) == len(docs)
    near = np.array([r.near_edited for r in rows])
    apart = np.array([r.near_next for r in rows])
    assert (near[:, None] > apart[None]).mean() > 0.98 and (near > apart).mean() > 0.99


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_rows(spark, parts):
    rows = [(5, None), (3, ""), (None, "no id"), (7, "é" * 60_001), (7, "é" * 60_001), (1, "one more"),
            (9, "x")]
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, fingerprint double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert sorted(map(tuple, digest.compared_with_next(df).collect()), key=str) == brute(rows)
        assert sorted(map(tuple, digest.compared_with_next(df.limit(1)).collect())) == brute(rows[:1])
        assert digest.compared_with_next(df.limit(0)).count() == 0
        assert {r.fingerprint for r in digest.fingerprints(df.where("doc_id = 7")).collect()} == {
            digest.digest("é" * 60_001)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
