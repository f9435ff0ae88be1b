import random
from collections import defaultdict

import pytest

from cinestrata.llm import lines

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(WHITE).translate(LOWER)


def brute(rows, least_chars=20, least_docs=3):
    """``(doc_id, n_lines, n_dropped, kept)`` by row; None is the smallest doc_id."""
    held = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add((d is not None, d or 0))
    out = []
    for d, t in rows:
        all_lines = (t or "").split("\n")
        stay = [x for x in all_lines if len(key(x)) < least_chars or len(held[key(x)]) < least_docs
                or (d is not None, d or 0) == max(held[key(x)])]
        out.append((d, len(all_lines), len(all_lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows],
                               "doc_id long, text string, line string, positions double")
    got = lines.without_repeated_lines(df, **options)
    return sorted(((r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()), key=str)


COMMON = "This sentence stands in many documents."


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "\n"), (4, COMMON), (5, f"  {COMMON.upper()}\t\r"),
        (6, f"a\n{COMMON}\nb\n{COMMON}\n"), (None, COMMON), (None, f"{COMMON}\nz"), (9, COMMON),
        (9, f"{COMMON}\nown"), (10, "short\nshort"), (11, "short"), (12, "short"),
        (13, "É" * 20), (14, "é" * 20), (15, "É" * 20), (16, "É" * 20), (17, "é" * 19 + "!"),
        (18, "\xa0" + COMMON), (18, "\xa0" + COMMON), (19, "k" * 19), (20, "k" * 19), (21, "k" * 19),
        (22, "k" * 20), (23, "K" * 20), (24, " " + "k" * 20 + "\x0b"),
    ]
    got = run(spark, rows)
    assert got == brute(rows)
    kept = {(r[0], r[3]) for r in got}
    # The largest id keeps the line in all of its rows; an emptied text is empty.
    assert (9, COMMON) in kept and (9, f"{COMMON}\nown") in kept and (4, "") in kept
    assert (6, "a\nb\n") in kept and (None, "z") in kept


def test_random_texts_with_other_thresholds(spark):
    rng = random.Random(5)
    pool = [" ".join(rng.choice(["Alpha", "beta", "ß", "日本"]) for _ in range(rng.randint(0, 5)))
            for _ in range(25)]
    rows = [(rng.choice([None, *range(40)]), "\n".join(rng.choices(pool, k=rng.randint(0, 9))))
            for _ in range(150)]
    assert run(spark, rows, least_chars=5, least_docs=4) == brute(rows, 5, 4)
    assert run(spark, rows, least_chars=0, least_docs=1) == brute(rows, 0, 1)


def test_very_long_text_and_hot_line(spark):
    many = "\n".join([COMMON, *[f"line {i} of a long document" for i in range(60_000)]])
    rows = [(0, many), (1, many), (2, many), *[(i, f"own {i}\n{COMMON}") for i in range(3, 900)]]
    got = {r[0]: r for r in run(spark, rows)}
    assert got[0] == (0, 60_001, 60_001, "") and got[1][2] == 60_001
    assert got[2] == (2, 60_001, 1, many.split("\n", 1)[1])
    assert got[5][3] == "own 5" and got[899][3] == f"own 899\n{COMMON}"


@pytest.mark.parametrize("hot", [1, 10**9])
def test_joins_agree_with_and_without_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(lines, "HOT_KEYS", hot)
    rows = [(i, f"{COMMON}\n{'other line of text ' * (i % 3 + 1)}\nrow number {i} alone")
            for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, h1 string")
    assert lines.without_repeated_lines(empty).collect() == []
