import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from cinestrata.llm import mixing, pii
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_stage_keeps_clean_documents(spark, docs):
    strange = spark.createDataFrame(
        [(10**6, "Съешь же ещё этих мягких французских булок " * 20, "en", "s", 5),
         (10**6 + 1, "12 34 !!", "en", "s", 5), (10**6 + 2, None, None, None, None)], docs.schema)
    kept = pipeline.known_languages(spark, docs.union(strange), SF)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))


def test_near_duplicate_stage_equals_brute_force(spark, docs):
    rows = docs.collect()
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in rows])
    kept = pipeline.one_of_each_group(spark, docs.union(docs.limit(30)), SF)
    assert kept.schema == docs.schema
    got = kept.collect()
    assert sorted(r.doc_id for r in got) == sorted(set(want))
    assert {tuple(r) for r in got} <= {tuple(r) for r in rows}


def test_near_duplicate_stage_on_odd_rows(spark, docs):
    rows = [(None, "one text of its own", None, None, None), (None, "another text that is alone", None, None, 1),
            (5, None, "en", "a", 0), (4, "", None, "b", None), (None, None, None, None, None),
            (9, "nine words in a row that are all different", "en", "s", 3)] * 2
    got = pipeline.one_of_each_group(spark, spark.createDataFrame(rows, docs.schema), SF).collect()
    assert Counter(r.doc_id for r in got) == {None: 2, 4: 1, 9: 1}


def test_personal_data_stage(spark, docs):
    hidden = pipeline.without_personal_data(spark, docs, SF)
    assert hidden.schema == docs.schema
    old, new = ({r.doc_id: r for r in d.collect()} for d in (docs, hidden))
    assert old.keys() == new.keys()
    for d, r in new.items():
        assert not pii.base_spans(r.text)
        assert r.n_chars == len(r.text) if r.text != old[d].text else r == old[d]
    assert sum(r.text != old[d].text for d, r in new.items()) == sum(
        bool(pii.base_spans(r.text)) for r in old.values())


def test_mix_stage_takes_what_the_mix_says(spark, docs):
    out = pipeline.mixed_sources(spark, docs, SF)
    assert out.schema == docs.schema
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    want = {r.doc_id: r.taken for r in mixing.mixed(sized).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    got = Counter()
    for r in out.collect():
        assert r.n_chars == len(r.text)
        if r.text != text[r.doc_id]:
            rest = iter(text[r.doc_id].split())
            assert all(w in rest for w in r.text.split())
        got[r.doc_id] += len(r.text.split())
    assert {d: n for d, n in want.items() if n} == dict(got)


def test_mix_stage_on_odd_rows(spark, docs):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "w " * 500, "en", "a", 1000),
            (3, "w " * 500, "en", "a", 1000), (3, "w " * 500, "en", "a", 1000)]
    more = spark.createDataFrame([(*r, 7) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, size int")
    out = pipeline.mixed_sources(spark, more, SF)
    assert out.columns == more.columns
    got = Counter((r.doc_id, r.size) for r in out.collect())
    assert got[1, 7] == 1 and got[2, 7] == 1 and len(got) == 4


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES])
def test_stages_on_an_empty_table(spark, docs, stage):
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_run_equals_its_stages(spark, docs):
    rows = docs
    for i, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        rows = stage(spark, rows, SF)
        assert rows.columns == docs.columns
    texts = Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in rows.collect())
    got = pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.decoded_sha256) for r in got) == texts
    assert all(r.n_tokens > 0 for r in got)
