"""A training corpus in five stages: language, near duplicates, personal data, mix, tokens.

Each stage takes the documents that the one before kept, is written as Parquet and read again,
so a lost executor repeats a part of one stage at most. All but the last return the columns of
documents. Tables may have nulls in any column, repeated rows and more columns, which pass.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cinestrata.llm import bpe, language, mixing, pii, simhash
from cinestrata.llm.common import table, words
from cinestrata.session import materialised

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are near no language's centroids, and those without letters.

    ``lang`` stays as it is: the prediction only decides what goes.
    """
    found = language.predicted(docs, language.fit(docs)).where("not rejected")
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component, that of the smallest id.

    Rows are known by id and a digest of the text, so of repeated rows one stays, and rows
    without an id are kept apart by their texts.
    """
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    found = materialised(simhash.near_duplicates_by(rows, "mark"), "components")
    # Least by (has an id, id, digest of the text): one row name per component.
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "mark")
    keep = found.groupBy("component").agg(F.min(name).alias("name")).select("name.id", F.col(
        "name.mark").alias("kept_mark"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col("doc_id").cast("long").alias("row_id"),
                         F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark"))
    joined = packed.join(keep, F.col("row_id").eqNullSafe(F.col("id")) & (
        F.col("mark") == F.col("kept_mark")), "left_semi")
    once = joined.dropDuplicates(["row_id", "mark"])
    return once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind in brackets; ``n_chars`` follows."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    return pii.masked(docs, pii.fit(pii.labelled_sequences(pii.sampled(narrow))))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the words that each source gives to the mix.

    A document that is taken several times stands there as often. Where the mix takes only some
    blocks of its words, a row has these, joined by blanks, and ``n_chars`` follows. Documents
    of which it takes nothing go; a document without a word stays once.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    sized = rows.select("row", F.col("row.doc_id").alias("doc_id"),
                        F.col("row.source").alias("source"),
                        mixing.word_count(F.col("row.text")).alias("size"))
    mix = mixing.mixed(sized)
    part = F.array_join(F.flatten(F.transform("chosen", lambda c: F.slice(
        "words", c["from"].cast("int") + 1, (c["to"] - c["from"]).cast("int")))), " ")
    once = F.aggregate("chosen", F.lit(0).cast("long"), lambda n, c: n + c["to"] - c["from"])
    text = F.col("row.text").cast("string")
    # Split only where the mix takes a part of the text.
    cut = mix.withColumn("words", F.when((once > 0) & (once < F.col("size")), words(text)))
    last = F.when(once >= F.col("size"), text).otherwise(part)
    copies = F.when(F.col("size") == 0, F.array(text)).otherwise(F.concat(
        F.array_repeat(text, F.col("passes").cast("int")),
        F.when(once > 0, F.array(last)).otherwise(F.array().cast("array<string>"))))
    taken = cut.select("row", F.explode(copies).alias("taken_text"))

    def column(name: str):
        old = F.col("row").getField(name)
        if name == "text":
            return F.col("taken_text").alias(name)
        if name == "n_chars":
            return F.when(text.eqNullSafe(F.col("taken_text")), old).otherwise(
                F.length("taken_text").cast(docs.schema[name].dataType)).alias(name)
        return old.alias(name)

    return taken.select(*[column(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each text, encoded and decoded again."""
    return bpe.round_trip(docs, VOCABULARY)


STAGES = [
    ("language", known_languages),
    ("near-duplicates", one_of_each_group),
    ("personal-data", without_personal_data),
    ("mix", mixed_sources),
    ("tokens", tokens),
]

# Trained models, chained links and tokens: SQL has no counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents; each result is written to the shared folder and read."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
