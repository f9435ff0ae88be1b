import random
import re

from pyspark.sql import functions as F

from cinestrata.llm import quality
from cinestrata.llm.queries import op7_quality

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(len(w) - 4):
        grams.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op7_quality(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, chars, symbols, dup, repeat = brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            n, chars, symbols, dup, repeat), r.doc_id
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert r.kept == (not r.base_failed and r.rule == 0)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op7_quality(spark, SF).collect()))


def test_rules_hold_on_rows_they_have_not_seen(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    rules = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    assert rules and all(str(c) for rule in rules for c in rule)
    told = quality.judged(docs, rules).join(labels.where("doc_id % 2 = 1"), "doc_id").where(
        "not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in told}
    assert n[0, False] >= 0.9 * (n[0, False] + n.get((0, True), 0))
    assert n.get((1, False), 0) <= 0.005 * n[1, True]


def rows_of(values, bad):
    return [({**dict.fromkeys(quality.RATES, 0.0), **v}, b) for v, b in zip(values, bad)]


def test_covering_finds_the_hidden_rules():
    rng = random.Random(1)
    values = [{"digit_rate": rng.random(), "bang_rate": rng.random(), "stop_rate": rng.random()}
              for _ in range(1500)]
    bad = [v["digit_rate"] > 0.8 or (v["bang_rate"] > 0.7 and v["stop_rate"] < 0.4) for v in values]
    rows = rows_of(values, bad)
    rules = quality.learned(rows)
    caught = [any(all(c.holds(r[0][c.name]) for c in rule) for rule in rules) for r in rows]
    assert sum(c and b for c, b in zip(caught, bad)) > 0.85 * sum(bad)
    assert sum(c and not b for c, b in zip(caught, bad)) < 0.03 * sum(bad)


def test_nothing_is_learned_from_chance_or_one_class():
    rng = random.Random(2)
    values = [{"digit_rate": rng.random()} for _ in range(400)]
    assert quality.learned(rows_of(values, [rng.random() < 0.2 for _ in values])) == []
    assert quality.learned(rows_of(values, [False] * 400)) == []
    assert quality.learned([]) == []


def test_verdict_names_the_first_rule(spark):
    rules = [(quality.Condition("a", True, 5.0),), (quality.Condition("a", True, 3.0),
                                                   quality.Condition("b", False, 1.0))]
    df = spark.createDataFrame([(6.0, 0.0), (4.0, 0.0), (4.0, 2.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(quality.verdict(rules)).collect()] == [1, 2, 0, 0]
    assert df.select(quality.verdict([])).first()[0] == 0


def test_odd_rows(spark):
    texts = [None, "", "\n \n", "a b c d e a b c d e", "x\nx\n\nx \n", "é\x0bü\x1fq |#", "a " * 100_000,
             "a a a a a a", "a b c d e f a b c d e g b c d e f"]
    rows = [(i if i else None, t, "x", True) for i, t in enumerate(texts)] + [(3, texts[3], "x", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, kept boolean")
    got = quality.judged(docs, []).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(
            texts[r.doc_id or 0])
    labels = spark.createDataFrame([(1, None, 1), (None, 0, 1), (2, 0, 1), (2, 1, 1)],
                                   "doc_id long, quality int, text int")
    assert quality.fit(docs, labels) == [] and quality.fit(docs.limit(0), labels.limit(0)) == []
    assert quality.judged(docs.limit(0), []).count() == 0


def test_plan_has_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = quality.judged(docs, [])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
