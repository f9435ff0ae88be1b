import zlib

import numpy as np
import pytest

from cinestrata.llm import language
from cinestrata.llm.queries import op3_language

SMALL = "/root/testdata/sf0.01"


def test_counts_are_letter_trigrams():
    got = language.counts(["Ab1c  é", "", "?!", "abc" * 4000])
    assert got.sum(axis=1).tolist() == [4, 0, 0, 12000]    # " ab" "ab " " c " " é "
    assert (language.counts(["ab c"])[0] == language.counts(["AB...C"])[0]).all()
    alone = [language.counts([t])[0] for t in ("one text", "two")]
    assert (np.stack(alone) == language.counts(["one text", "two"])).all()


def test_held_out_accuracy_of_the_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op3_language(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.99 * len(held)
    assert not any(r.rejected for r in held)
    again = op3_language(spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_nearest_centroid_by_brute_force(model, spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40).collect()
    names, scores, _ = model.predict([r.text for r in docs])
    for r, name, score in zip(docs, names, scores):
        v = np.log1p(language.counts([r.text])[0]) * model.weights
        cos = model.centroids @ v / np.linalg.norm(v)
        assert name == model.languages[int(cos.argmax())] and score == pytest.approx(cos.max(), 1e-4)


def test_far_texts_are_rejected(model):
    strange = ["Съешь же ещё этих мягких французских булок " * 20,
               "吾輩は猫である名前はまだ無い" * 20, "zqxj kwvq xzzq jqkx " * 60]
    names, _, far = model.predict(strange)
    assert far == [True] * 3 and set(names) <= {"en", "de", "fr", "es"}
    assert len({(n, c.tobytes()) for n, c in zip(model.languages, model.centroids)}) >= 8


@pytest.mark.parametrize("left, least", [("en", 0.85), ("fr", 0.95), ("de", 0.95), ("es", 0.95)])
def test_a_language_left_out_is_rejected(spark, left, least):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    known = language.fit(docs.where(docs.lang != left))
    held = docs.where(language.held_out(docs.doc_id) & docs.text.isNotNull()).collect()
    far = dict(zip([r.doc_id for r in held], known.predict([r.text for r in held])[2]))
    foreign = [far[r.doc_id] for r in held if r.lang == left]
    own = [far[r.doc_id] for r in held if r.lang != left]
    assert left not in known.languages and sum(foreign) >= least * len(foreign)
    assert sum(own) <= 0.01 * len(own)


def test_least_cosines_lie_between_known_and_foreign_texts(model, spark):
    docs = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if r.text]
    number = language.counts([r.text for r in docs])
    cosine = model.vectors(number) @ model.centroids[model.broad].T
    names = np.array(model.languages)[model.broad]
    large = (number > 0).sum(axis=1) >= 128
    other = np.array([c[names != r.lang].max() for r, c in zip(docs, cosine)])
    least = model.least[language._length(number)]
    assert (other[large] < least[large]).mean() > 0.97


def test_an_outlier_in_the_sample_gets_no_centroid(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**6, "Съешь же ещё этих мягких булок " * 20, "en")], docs.schema)
    names, _, far = language.fit(docs.union(odd)).predict(["Съешь же ещё этих мягких булок " * 20])
    assert far == [True]


def test_labels_of_held_out_rows_are_never_learned(spark):
    rows = [(i, "the words of it and that", "held" if zlib.crc32(str(i).encode()) % 4 == 2 else "en")
            for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language.identified(df).collect()} == {"en"}


def test_odd_rows(spark):
    rows = [(1, None, "en", 0.5), (2, "", None, 0.5), (3, "123 ?!", "en", 0.5), (None, "the end", "en", 1.0),
            (5, "the end " * 20_000, "en", None), (5, "the end", "en", None), (8, "la fin", "fr", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = sorted(((r.doc_id or 0), r.lang_pred, r.rejected) for r in language.identified(df).collect())
    assert [g[0] for g in got] == [0, 1, 2, 3, 5, 5, 8]
    assert got[1:4] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert language.identified(df.limit(0)).count() == 0
    unlabelled = language.identified(df.withColumn("lang", df.lang.substr(9, 0).substr(1, 0)).where(
        "doc_id = 2"))
    assert [tuple(r)[2:] for r in unlabelled.collect()] == [("und", 0.0, True)]


def test_more_languages_than_a_few_hundred(spark):
    """Each of 401 languages is learned, from few rows of each."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(10_000 * k + i, " ".join([letters[k % 26] + letters[k // 26 % 26] + letters[k // 13 % 26]]
                                      * (9 + i)), f"l{k}") for k in range(401) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert set(language.fit(df).languages) == {f"l{k}" for k in range(401)}


def test_rows_of_one_id_and_equal_rows_are_not_taken_together(spark):
    rows = [(1, f"text number {i} of the same identity", "en") for i in range(9000)]
    rows += [(2, "the same text again and again", "en")] * 9000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert not any(zlib.crc32(str(d).encode()) % 4 == 2 for d in (1, 2))
    n = language._sample(df).count()
    assert 1000 < n < 3500
