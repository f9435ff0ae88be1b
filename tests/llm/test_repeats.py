import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from cinestrata.llm import repeats
from cinestrata.llm.queries import op10_repeats


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by listing every string of 400 bytes."""
    data = [(d, (t or "").encode()) for d, t in rows]
    count = defaultdict(int)
    for _, b in data:
        for i in range(len(b) - 399):
            count[hashlib.md5(b[i:i + 400]).digest()] += 1
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 399):
            if count[hashlib.md5(b[i:i + 400]).digest()] > 1:
                gone[i] += 1
                gone[i + 400] -= 1
        mask = np.cumsum(gone)[:len(b)] > 0
        spans = int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        out.append((d, len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **limits):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, t int")
    return sorted(map(tuple, repeats.without_repeats(df, **limits).collect()), key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(rng.randrange(60, 160)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [text(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(0, 120)
            parts += [p[a:a + rng.randrange(380, 900)], text(rng.randrange(0, 60))]
        rows.append((i, "".join(parts)))
    for i in range(n, n + 25):              # near copies
        base = list(rows[rng.randrange(n // 3)][1])
        for _ in range(rng.randrange(3)):
            base[rng.randrange(len(base))] = "#"
        rows.append((i, "".join(base)))
    return rows


ODD = [(900, None), (901, ""), (902, "x" * 399), (903, "y" * 401), (904, "ab" * 900), (905, "z" * 400),
       (905, "z" * 400), (None, "Und " * 300), (None, "Und " * 300 + "q"), (906, "one " * 1000 + "two " * 1000),
       (907, "é" * 200), (908, "é" * 200 + "b"), (903, "other text " + "y" * 399)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed) + ODD
    assert got(spark, rows) == brute(rows)


def test_crowded_anchors_and_small_blocks(spark):
    rows = corpus(3) + ODD
    assert got(spark, rows, held=3, block=2) == brute(rows)


def test_long_texts_are_cut_into_stretches(monkeypatch):
    text = "".join(random.Random(4).choice("abcdef") for _ in range(5000)).encode()
    whole = repeats.contexts(text)
    starts = [s for p, q in zip(whole[1], whole[2]) for s in range(p, q - 399)]
    assert starts == list(range(len(text) - 399))
    monkeypatch.setattr(repeats, "_STRETCH", 700)
    anchor, p, q, at = repeats.contexts(text)
    assert [s for a, b in zip(p, q) for s in range(a, b - 399)] == starts
    of = {s: (h, x) for h, a, b, x in zip(*whole) for s in range(a, b - 399)}
    assert all(of[s] == (h, x) for h, a, b, x in zip(anchor, p, q, at) for s in range(a, b - 399))


def test_index_equals_comparing_all_pairs():
    rng = random.Random(5)
    group, texts, offsets = [], [], []
    for g in range(30):
        base = [rng.choice(b"ab") for _ in range(784)]
        for _ in range(rng.randrange(2, 9)):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(784)] = rng.choice(b"abc")
            lead = rng.randrange(200, 385)
            group.append(g)
            texts.append(bytes(own[384 - lead:384 + rng.randrange(200, 401)]))
            offsets.append(lead)
    found = repeats.matches(np.array(group), texts, np.array(offsets))
    for i, ranges in enumerate(found):
        want = set()
        for j in range(len(texts)):
            if j != i and group[i] == group[j]:
                shift = offsets[i] - offsets[j]
                for a in range(len(texts[i]) - 399):
                    b = a - shift
                    if b >= 0 and b + 400 <= len(texts[j]) and (
                            texts[i][a:a + 400] == texts[j][b:b + 400]):
                        want.add(a)
        assert ranges == repeats.merged([(a, a + 400) for a in want])


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, op10_repeats(spark, folder).collect()), key=str) == brute(docs)


def test_empty_table(spark):
    assert repeats.without_repeats(
        spark.createDataFrame([], "doc_id long, text string")).count() == 0
