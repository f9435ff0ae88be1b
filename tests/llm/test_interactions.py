import random
import re
from itertools import permutations

import pytest

from cinestrata.llm import interactions

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
           "good_lost", "toxic_lost", "shapley")


def failures(rows):
    out = []
    for i, (d, text, _) in enumerate(rows):
        t = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        fails = set()
        if len(w) < 100:
            fails.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if d is not None and any((o is None or o < d) and (x or "") == t for o, x, _ in rows):
            fails.add("E")
        out.append(fails)
    return out


def brute(rows, labels):
    fails = failures(rows)
    good = [any(d is not None and d == x and q == 1 for x, q, _ in labels) for d, _, _ in rows]
    toxic = [any(d is not None and d == x and t == 1 for x, _, t in labels) for d, _, _ in rows]
    out = []
    for part in {r[2] or "" for r in rows}:
        mine = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = set(mine)
            for step, f in enumerate(order, 1):
                failing = {i for i in mine if f in fails[i]}
                here = failing & left
                left -= here
                shapley[f] += len(here)
                lines.append((f, [part, "".join(order), step, len(left), len(here),
                                  len(failing - here), sum(fails[i] == {f} for i in mine),
                                  sum(good[i] for i in here), sum(toxic[i] for i in here)]))
        out += [tuple(row + [shapley[f]]) for f, row in lines]
    return sorted(out)


def run(spark, rows, labels, cut=1):
    docs = spark.createDataFrame([(*r, "x", 2) for r in rows],
                                 "doc_id long, text string, lang string, part string, id int")
    marks = spark.createDataFrame([(*x, 0.5) for x in labels],
                                  "doc_id long, quality int, toxic int, good double")
    got = interactions.audited(docs.repartition(cut), marks).collect()
    return sorted(tuple(r[c] for c in COLUMNS) for r in got)


def rows_of(n, seed):
    rng = random.Random(seed)
    texts = [None, "", "Word " * 120, " ".join(f"w{i}" for i in range(120)), "ALL CAPS", "50% off",
             " ".join(f"Ab{i}" for i in range(100)) + " *", "word " * 30,
             " ".join(f"w{i % 80}" for i in range(100)), "é" * 99 + "A" * 11]
    return [(rng.choice([None, *range(n)]), rng.choice(texts) if rng.random() < .6 else
             " ".join(rng.choice(["a", "B", "$", f"x{i}"]) for i in range(rng.randint(90, 130))),
             rng.choice(["en", "de", "", None])) for _ in range(n)]


@pytest.mark.parametrize("rows_per_bucket", [1 << 19, 17])
def test_equals_brute_force(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(interactions, "BUCKET_ROWS", rows_per_bucket)
    rows = rows_of(120, 3)
    rng = random.Random(8)
    labels = [(rng.choice([None, *range(140)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1]))
              for _ in range(150)]
    got = run(spark, rows, labels, cut=5)
    assert len(got) == 600 * len({r[2] or "" for r in rows})
    assert got == brute(rows, labels)


def test_copies_ties_and_a_long_text(spark):
    rows = [(4, "same", "en"), (4, "same", "en"), (3, None, "en"), (2, "", "en"), (None, "", "en"),
            (7, "word " * 300_000, "en"), (8, "word " * 300_000, "fr")]
    assert run(spark, rows, [(4, 1, 0), (4, 0, 1), (8, 1, 1)]) == brute(
        rows, [(4, 1, 0), (4, 0, 1), (8, 1, 1)])


def test_joins_shuffle_counts_only(spark):
    docs = spark.createDataFrame(rows_of(60, 4), "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    everyone, failing, _ = interactions._stored(spark, interactions._members(docs, marks))
    plan = interactions._by_prefix(everyone, failing)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 3 and plan.count("Exchange") == 3
    assert "Broadcast" not in plan and "SortMergeJoin" not in plan


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert run(spark, [(1, "A", None)], []) == brute([(1, "A", None)], [])
