import random

import numpy as np
import xxhash

from cinestrata.llm import simhash
from cinestrata.llm.components import components
from cinestrata.llm.queries import op5_simhash

SMALL = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ")
             .replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(pairs):
    """(id, fingerprint) to the least id reachable over at most 4 differing bits."""
    fps = np.array([f for _, f in pairs], np.uint64)
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4) + i + 1:
            parent[root(int(j))] = root(i)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(pairs))]


def test_fingerprint():
    for t in ["", " \n", "One", "A b\tC", "a b c d", "É É b\x0bc d E f", "x " * 500,
              "a\x1fb c\xa0d e f g h"]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = [(r.doc_id, plain_fingerprint(r.text)) for r in docs]
    ids = plain_components(want)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op5_simhash(spark, SMALL).collect()}
    assert got == {d: (f"{f:016x}", c) for (d, f), c in zip(want, ids)}


def clusters(seed, centres, members, far=4):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(members):
            f = centre
            for b in rng.sample(range(64), rng.randrange(far + 1)):
                f ^= 1 << b
            out.add(f)
    return sorted(out)


def linked(spark, values, **limits):
    rows = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in values], "fp long")
    links = simhash.linked_fingerprints(rows, **limits)
    assert links.count() <= 70 * len(values)
    got = {r.node: r.component for r in components(links).collect()}
    groups = {}
    for f in values:
        signed = int(np.uint64(f).astype(np.int64))
        groups.setdefault(got.get(signed, signed), set()).add(f)
    return sorted(map(sorted, groups.values()))


def brute(values):
    groups = {}
    for f, c in zip(values, plain_components([(f, f) for f in values])):
        groups.setdefault(c, set()).add(f)
    return sorted(map(sorted, groups.values()))


def test_links_of_dense_and_far_clusters(spark):
    values = clusters(1, 40, 30) + clusters(2, 2, 400, far=7) + [0, 15, 2**64 - 1]
    values = sorted(set(values))
    assert linked(spark, values) == brute(values)


def test_crowded_keys_are_dealt_and_lose_nothing(spark):
    values = clusters(3, 1, 300, far=6)
    assert linked(spark, values, held=20) == brute(values)


def test_every_pair_within_four_bits_shares_a_key():
    rng = random.Random(5)
    a = np.array([rng.getrandbits(64) for _ in range(500)], np.uint64)
    b = a.copy()
    for i in range(500):
        for bit in rng.sample(range(64), 4):
            b[i] ^= np.uint64(1 << bit)
    assert (simhash.keys_of(a) == simhash.keys_of(b)).any(axis=1).all()
    table = simhash.pivot_table(np.r_[a, b])
    assert simhash.close(np.arange(500), np.arange(500, 1000), np.r_[a, b], table).all()


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(100)] + [(7, 7)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 100)}}


def test_odd_rows(spark):
    long_ = "word and more of it " * 5000
    rows = [(4, None, 1), (3, "", 2), (None, "solo text of five words", 3), (9, long_, 4),
            (9, long_, 4), (8, long_ + "tail", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(0, None), (3, 3), (4, 3), (8, 8), (9, 8), (9, 8)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
