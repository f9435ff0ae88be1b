"""Mixing sources to target weights by Sainte-Laguë apportionment of equal token blocks.

A source's words, its documents laid end to end in seeded order within hash shards, are cut
into blocks of equal size. The blocks of the whole mix are the seats: a source gets seats by
the highest quotients of its target, a shard of a source those of its words. A shard gives its
seats as whole passes over its blocks and, for the rest, its blocks of lowest seeded digest.

Highest quotients target / (2k + 1) are found without listing them: the seats of every source
follow from one divisor, the divisor from bisection over sums, and the few seats at the margin
from the quotients next to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cinestrata.llm.common import WORD
from cinestrata.operators.lookup import attach_stats
from cinestrata.session import materialised

WEIGHTS = (5, 2, 1)
MOST = 3             # how often the mix may use a source, and a document
BLOCK = 64           # words of a block
SHARD_WORDS = 1 << 18
BROADCAST_BYTES = 8 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``rank`` from 0 in ``order`` over the whole table. Ranges are sorted apart.

    Strings compare by their UTF-8 bytes, which is the order of code points.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        "__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    placed = materialised(ranged, "ranks")
    parts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"),
                                         F.min("__row").alias("__first"))
    # As many rows as partitions.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("__part", "__first", F.coalesce(F.sum("n").over(before), F.lit(0))
                          .alias("__before"))
    return placed.join(F.broadcast(starts), "__part").withColumn(
        "rank", F.col("__before") + F.col("__row") - F.col("__first")).drop(
        "__part", "__row", "__first", "__before")


def _with_group(rows: DataFrame, figures: DataFrame, group: Sequence[str]) -> DataFrame:
    """``rows`` with the figures of their group, one row of ``figures`` each.

    Figures of all rows together come as constants. Those of groups are broadcast while they
    are few; beyond, the rows of frequent groups are joined apart from the others.
    """
    if not group:
        row = figures.first()
        return rows.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType)
                                 for f in figures.schema.fields})
    key = _text_key(*[F.col(g) for g in group])
    few = materialised(figures.withColumn("__key", key).drop(*group), "figures")
    n, length = few.agg(F.count(F.lit(1)), F.sum(F.octet_length("__key"))).first()
    return attach_stats(rows.withColumn("__key", key), few, "__key", BROADCAST_BYTES,
                        n * 64 + (length or 0)).drop("__key")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` of (source, source_size).

    Shares are by weight; a target stops at ``most`` times the source's size and the excess is
    shared again by weight, until none is above. Each round is one pair of sums over sources.
    """
    weight = F.lit(list(map(int, weights)))[(F.col("rank") % len(weights)).cast("int")]
    ranked = materialised(_ranked(sources, [F.col("source").asc_nulls_last()]).withColumn(
        "weight", weight), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap, level, before = F.col("source_size") * most, 0.0, None
    while True:
        stopped = F.col("weight") * F.lit(level) >= cap
        caps, open_ = ranked.agg(
            F.coalesce(F.sum(F.when(stopped, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0))).first()
        if not open_ or (caps, open_) == before:
            break
        before, level = (caps, open_), (total - caps) / open_
    return ranked.select("source", "source_size", F.least(
        F.col("weight") * F.lit(level), cap.cast("double")).alias("target"))


def apportioned(claims: DataFrame, group: Sequence[str], share: str, seats: str,
                order: Sequence[str], out: str) -> DataFrame:
    """``claims`` with ``out``: the seats of each row by the highest quotients share / (2k + 1).

    Rows of one group share ``seats``, the same number on each of them. A row has
    floor((share / d + 1) / 2) quotients of at least d, so m rows of a group have
    between total / 2d - m / 2 and total / 2d + m / 2 of them. Quotients above the larger of
    two such d are seats for certain; of those between the two, at most about 2m in all, the
    highest follow until the seats are given out. Ties go by ``order``. Sums are aggregates and
    ranks come from range partitions, so neither a group nor the table meets in one task.
    """
    names = claims.columns
    claims = materialised(claims, "claims")
    marked = _with_group(claims, claims.groupBy(*group).agg(
        F.count(F.lit(1)).alias("__rows"), F.sum(share).alias("__total"),
        F.max(share).alias("__top")), group)
    room, total = F.col(seats) - F.col("__rows") / 2, F.col("__total")

    def quotients(divisor: Column) -> Column:
        return F.when(F.col(share) > 0, F.floor((F.col(share) / divisor + 1) / 2)
                      ).otherwise(F.lit(0)).cast("long")

    marked = marked.withColumns({
        "__sure": quotients(F.when(room > 0, total / (2 * room)).otherwise(2 * F.col("__top") + 1)),
        "__most": quotients(total / (2 * F.col(seats) + F.col("__rows") + 1))})
    # A row with nothing to list keeps one entry, which no seat is given to.
    listed = marked.withColumn("__k", F.explode(F.when(
        F.col("__most") > F.col("__sure"), F.sequence("__sure", F.col("__most") - 1)).otherwise(
        F.array(F.lit(-1).cast("long")))))
    listed = listed.withColumn("__quotient", F.when(
        F.col("__k") >= 0, F.col(share) / (2 * F.col("__k") + 1)))
    ranked = _ranked(materialised(listed, "quotients"), [
        *[F.col(g) for g in group], F.col("__quotient").desc_nulls_last(), *order, F.col("__k")])
    # A group's rows follow one another, so its smallest rank is where it starts.
    one_each = F.when(F.col("__k").isin(-1) | (F.col("__k") == F.col("__sure")), F.col("__sure"))
    starts = ranked.groupBy(*group).agg(F.min("rank").alias("__start"),
                                        F.sum(one_each).alias("__given_out"))
    given = _with_group(ranked, starts, group).withColumn("__given", (
        (F.col("__k") >= 0) & (F.col("rank") - F.col("__start")
                               < F.col(seats) - F.col("__given_out"))).cast("long"))
    return given.groupBy(*names, "__sure").agg(F.sum("__given").alias("__given")).select(
        *names, (F.col("__sure") + F.col("__given")).alias(out))


def _text_key(*parts: Column) -> Column:
    """Parts of a digest, null and empty kept apart."""
    return F.concat_ws(":", *[F.coalesce(F.concat(F.lit("v"), p.cast("string")), F.lit("n"))
                              for p in parts])


def mixed(docs: DataFrame, seed: str = "mix", block: int = BLOCK, shard_words: int = SHARD_WORDS,
          weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``docs`` (with doc_id, source and size) and what the mix takes of each row.

    Adds ``source_size, target, passes, chosen, taken``: how often the whole row is taken, the
    word ranges (from, to; end exclusive) taken once more, and the words in all. A null source
    is a source of its own, a null size or id counts as 0 words and as an id of its own.
    Repeated rows are laid side by side and counted each. Other columns pass, whatever their
    names; those of the results are replaced. An empty table gives an empty one.
    """
    names = [c for c in docs.columns
             if c not in ("source_size", "target", "passes", "chosen", "taken")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                       F.col("doc_id").cast("string").alias("id"),
                       F.col("source").cast("string").alias("source"),
                       F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"))
    found = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    found = found.withColumn("shards", F.greatest(F.lit(1), F.ceil(
        F.col("source_size") / shard_words)).cast("long"))
    words = found.agg(F.sum("source_size")).first()[0] or 0
    sources = materialised(apportioned(
        found.withColumn("seats", F.lit(words // block).cast("long")), [], "target", "seats",
        [F.col("source").asc_nulls_last()], "source_seats").drop("seats"), "quotas")

    digest = F.md5(_text_key(F.lit(seed), F.col("id")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    dealt = _with_group(rows.withColumn("digest", digest), sources, ["source"]).withColumn(
        "shard", number % F.col("shards"))
    shards = dealt.groupBy("source", "shard", "source_seats").agg(F.sum("size").alias("words"))
    quotas = apportioned(shards, ["source"], "words", "source_seats", ["shard"], "quota")
    blocks = F.ceil(F.col("words") / block).cast("long")
    quota, some = F.least(F.col("quota"), blocks * most), F.greatest(blocks, F.lit(1))
    passes, left = F.floor(quota / some).cast("long"), quota % some

    def block_digest(number: Column) -> Column:
        return F.md5(_text_key(F.lit(seed), F.col("source"), F.col("shard"), number))

    # The digest up to which a shard's blocks are taken once more.
    rest = F.when(left > 0, F.sort_array(F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1), block_digest))[(left - 1).cast("int")])
    quotas = materialised(quotas.select("source", "shard", passes.alias("passes"),
                                        rest.alias("last")), "shard-quotas")

    line = Window.partitionBy("source", "shard").orderBy("digest", "id", "size")
    at = (F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = dealt.withColumn("at", at)
    placed = placed.join(quotas.withColumnsRenamed({"source": "s", "shard": "d"}),
                         F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("d")))
    first, last = F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)
    chosen = F.when(F.col("last").isNotNull() & (F.col("size") > 0), F.filter(
        F.sequence(first, last), lambda b: block_digest(b) <= F.col("last")))
    ranges = F.transform(F.coalesce(chosen, F.array().cast("array<long>")), lambda b: F.struct(
        (F.greatest(b * block, F.col("at")) - F.col("at")).alias("from"),
        (F.least((b + 1) * block, F.col("at") + F.col("size")) - F.col("at")).alias("to")))
    taken = F.col("size") * F.col("passes") + F.aggregate(
        "chosen", F.lit(0).cast("long"), lambda acc, r: acc + r["to"] - r["from"])
    return placed.select("row", "source_size", "target", "passes", "size",
                         ranges.alias("chosen")).select(
        *[F.col("row").getField(c).alias(c) for c in names], "source_size", "target", "passes",
        "chosen", taken.alias("taken"))
