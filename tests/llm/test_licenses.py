import re

import pytest

from cinestrata.llm import licenses


def brute(rows, templates, least=0.8):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    out = {}
    for doc_id, text in rows:
        mine = grams(split(text))
        for name, notice in templates.items():
            want = set(grams(split(notice)))
            for at in range(len(mine)):
                n = len(want & set(mine[at:at + len(want)]))
                if want and n >= least * len(want) and mine[at] in want:
                    key, found = (doc_id, name), (-n / len(want), at)
                    out[key] = min(out.get(key, found), found)
    return sorted((d, n, -c, at) for (d, n), (c, at) in out.items())


def found(spark, rows, templates=licenses.TEMPLATES):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")
    return sorted(map(tuple, licenses.scan(df, templates).collect()))


def test_retrieval_is_near_certain():
    for n in range(3, 40):
        assert licenses.worst_case(n) > 0.9999
    assert licenses.agreement(1.0) == 1.0


def test_short_templates_are_retrieved_for_certain(spark):
    for n in range(1, 40):
        assert licenses.worst_case(n) > 0.9999
    # Many different surroundings: a notice lost with a small probability would be seen.
    short = {"one": "All rights reserved.", "two": "some rights are reserved", "three": "a b c d e"}
    rows = [(1000 * k + i, " ".join(f"w{i}x{j}" for j in range(i % 7)) + "\n" + notice + "\n"
             + " ".join(f"v{i}x{j}" for j in range(i % 11)))
            for k, notice in enumerate(short.values()) for i in range(400)]
    rows += [(5000, "all rights"), (5001, "some rights are kept"), (5002, "rights reserved all")]
    got = found(spark, rows, short)
    assert got == brute(rows, short)
    assert {d for d, n, *_ in got if n != "three"} == {d for d, _ in rows if d < 2000 and d % 1000 < 400}


def test_bare_notices_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id for r in docs.collect() if "\nAll rights reserved." in (r.text or "")}
    got = {r.doc_id for r in licenses.scan(docs).collect() if r.license == "all-rights-reserved-alone"}
    assert want and got == want


def test_notices_at_every_offset(spark):
    rows = []
    for k, (name, notice) in enumerate(licenses.TEMPLATES.items()):
        for shift in range(14):
            rows.append((100 * k + shift, "filler " * shift + "\n" + notice + " and more " * shift))
    got = found(spark, rows)
    assert got == brute(rows, licenses.TEMPLATES)
    assert {d for d, *_ in got} == {d for d, _ in rows}


def test_edited_and_partial_notices(spark):
    notice = licenses.TEMPLATES["bsd"].split()
    rows = [(1, " ".join(notice[:5] + ["new"] + notice[5:])), (2, " ".join(notice[:9])),
            (3, " ".join(notice[::-1])), (4, "LICENSED under the apache-license version\n2.0"),
            (5, " ".join(notice[:-1] + ["changed"])), (6, "words " * 50_000 + " ".join(notice))]
    got = found(spark, rows)
    assert got == brute(rows, licenses.TEMPLATES)
    assert {d for d, *_ in got} == {1, 4, 5, 6}


def test_odd_rows(spark):
    mit = licenses.TEMPLATES["mit"]
    rows = [(1, None), (2, ""), (3, "a b"), (None, mit), (5, mit), (5, mit), (6, f"{mit} {mit}")]
    assert found(spark, rows[:3]) == []
    got = found(spark, [r for r in rows if r[0]])
    assert got == [(5, "mit", 1.0, 0), (6, "mit", 1.0, 0)]
    assert [r.license for r in licenses.scan(spark.createDataFrame(
        [rows[3]], "doc_id long, text string")).collect()] == ["mit"]
    assert found(spark, rows[4:], {"short": "a b"}) == []
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(empty).count() == 0


def test_plan_has_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "CartesianProduct" not in plan
    assert pytest.approx(1 - 0.5 ** 16) == licenses.agreement(0.5)
