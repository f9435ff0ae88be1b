"""How filters overlap: what each removes, in every order, by joins of failing-id tables."""

from __future__ import annotations

import math
import uuid
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.llm.common import bound, words
from cinestrata.operators.lookup import attach_stats
from cinestrata.session import materialised, workspace
from cinestrata.sources.sinks import write_bucketed

FILTERS = "ABCDE"
# Rows of a bucket of the id tables; one task holds the ids of a bucket that fail a filter.
BUCKET_ROWS = 1 << 19


def _less(text: Column, characters: str) -> Column:
    """How many of the characters a text has."""
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _members(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``id`` (a row's number), ``part, good, toxic, fails`` (letters of filters), written once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def counts(w: Column) -> Column:
        return F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"))

    read = docs.select(
        F.monotonically_increasing_id().alias("id"), F.col("doc_id").cast("long"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("digest"), bound(words(text), counts).alias("w"),
        (_less(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") * 100 > F.char_length(text) * 10).alias("C"),
        (_less(text, "#$%&*|") > 0).alias("D"))
    read = materialised(read.select(
        "id", "doc_id", "part", "digest", (F.col("w.n") < 100).alias("A"),
        (F.col("w.distinct") * 100 < F.col("w.n") * 80).alias("B"), "C", "D"), "members")
    # Texts found more than once: the least id, and whether a row without id is among them.
    copies = (read.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"),
        F.max(F.col("doc_id").isNull().cast("int")).alias("unnamed"))
        .where("copies > 1").drop("copies"))
    marks = labels.select(F.col("doc_id").cast("long"), "quality", "toxic").groupBy(
        "doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                      F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    known = attach_stats(attach_stats(read, copies, "digest"), marks.where("doc_id is not null"),
                         "doc_id")
    later = F.col("doc_id").isNotNull() & (
        (F.col("unnamed") == 1) | (F.col("least") < F.col("doc_id")))
    flags = {"A": F.col("A"), "B": F.col("B"), "C": F.col("C"), "D": F.col("D"), "E": later}
    return materialised(known.select(
        "id", "part", (F.coalesce("good", F.lit(0)) == 1).alias("good"),
        (F.coalesce("bad", F.lit(0)) == 1).alias("toxic"),
        F.array_compact(F.array(*[F.when(c, f) for f, c in flags.items()])).alias("fails")), "audited")


def _stored(spark, members: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """All ids, and the ids failing each filter, as tables bucketed by id: joins do not shuffle."""
    rows = members.count()
    buckets = max(1, math.ceil(rows / BUCKET_ROWS))
    names = [f"audit_{kind}_{uuid.uuid4().hex}" for kind in ("all", "failing")]
    write_bucketed(members.select("id", "part"), names[0], workspace(spark, "ids"), "id", buckets)
    failing = members.select("id", "part", "good", "toxic", F.explode("fails").alias("filter"))
    # One folder of ids per filter.
    (failing.repartition(buckets, "id").write.format("parquet")
     .option("path", workspace(spark, "failing")).partitionBy("filter")
     .bucketBy(buckets, "id").sortBy("id").saveAsTable(names[1]))
    return spark.table(names[0]), spark.table(names[1]), names


def _by_prefix(everyone: DataFrame, failing: DataFrame) -> DataFrame:
    """``what, prefix, part, filter, n, good, toxic``: counts behind each set of earlier filters.

    What a prefix leaves does not depend on the order of its filters, so 32 sets serve all
    orders. ``kept``: ids left by the prefix (no filter); ``removed`` and ``redundant``: ids
    failing a further filter that the prefix left or had removed. Each row names its prefix and
    looks for its id among those failing a filter of it.
    """
    sets = F.array(*[F.lit("".join(c)) for n in range(len(FILTERS) + 1)
                     for c in combinations(FILTERS, n)])
    before = failing.select(F.col("id").alias("gone"), F.col("filter").alias("by"))
    # A bucket's failing ids are few enough for a hash table; nothing is sorted or broadcast.
    before = before.hint("shuffle_hash")
    after = failing.select(
        "id", "part", "filter", "good", "toxic",
        F.explode(F.filter(sets, lambda p: ~F.contains(p, F.col("filter")))).alias("prefix"))
    whole = everyone.select("id", "part", F.lit("").alias("filter"), F.lit(False).alias("good"),
                            F.lit(False).alias("toxic"), F.explode(sets).alias("prefix"))
    earlier = (F.col("id") == F.col("gone")) & F.contains("prefix", "by")

    def counted(ids: DataFrame, how: str, what: str) -> DataFrame:
        return ids.join(before, earlier, how).groupBy("prefix", "part", "filter").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"),
            F.count_if("toxic").alias("toxic")).withColumn("what", F.lit(what))

    return (counted(whole, "left_anti", "kept")
            .unionByName(counted(after, "left_anti", "removed"))
            .unionByName(counted(after, "left_semi", "redundant")))


def steps_of_orders() -> list[tuple[str, int, str, str, str, str]]:
    """Every order of the filters by step: filter, the sets before and after it, all others."""
    return [("".join(order), k + 1, order[k], "".join(sorted(order[:k])),
             "".join(sorted(order[:k + 1])), FILTERS.replace(order[k], ""))
            for order in permutations(FILTERS) for k in range(len(FILTERS))]


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every part (``lang``, null as empty), order of the five filters, and step.

    A: under 100 words; B: under 80 distinct words in 100; C: over 10 capitals A to Z in 100
    code points; D: one of ``#$%&*|``; E: the text of a smaller doc_id, table-wide. A null text
    is empty. ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost`` and ``shapley`` are counts of rows.

    Rows are known by a number, so rows of one id are counted each; a copy with the same id is
    no copy of a smaller one, and a missing id is smaller than any other. A row is good (toxic)
    if any label of its id says so; labels without id are left out. Empty tables give no row.
    Other columns are not looked at; long texts are read whole by one task.

    The ids failing each filter are stored once, bucketed. A prefix leaves what is left by an
    anti-join of all ids with its filters' ids; a further filter removes the anti-join of its
    ids with them, and the semi-join is redundant. These joins shuffle and broadcast nothing.
    """
    spark = docs.sparkSession
    everyone, failing, names = _stored(spark, _members(docs, labels))
    # A few counts per part: the id tables are not read again.
    counts = materialised(_by_prefix(everyone, failing), "prefixes")
    sizes = materialised(everyone.groupBy("part").agg(F.count(F.lit(1)).alias("rows")), "parts")
    for name in names:
        spark.sql(f"drop table {name}")

    orders = F.broadcast(spark.createDataFrame(
        steps_of_orders(), "filter_order string, step int, filter string, before string, "
        "after string, others string"))
    listed = F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])
    rows = sizes.select("part", "rows", F.explode(listed).alias("filter_order")).join(
        orders, "filter_order")

    def counted(what: str, prefix: str, **columns: str) -> DataFrame:
        return counts.where(F.col("what") == what).select(
            "part", F.col("filter"), F.col("prefix").alias(prefix),
            *[F.col(c).alias(n) for n, c in columns.items()])

    on = ["part", "filter"]
    rows = (rows.join(counted("removed", "before", removed="n", good_lost="good",
                              toxic_lost="toxic"), [*on, "before"], "left")
            .join(counted("redundant", "before", redundant="n"), [*on, "before"], "left")
            .join(counted("removed", "others", unique_fails="n"), [*on, "others"], "left")
            .join(counted("kept", "after", kept="n").drop("filter"), ["part", "after"], "left"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")]
    full = rows.select("part", "filter_order", "step", "filter", *zero)
    shares = full.groupBy(on).agg(F.sum("removed").alias("shapley"))
    return full.join(shares, on).drop("filter")
