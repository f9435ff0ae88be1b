"""Joining per-key statistics back on rows, and lookups by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.session import checkpointed, materialised

# A statistics table up to this size is broadcast; a larger one is shuffled. The size is that of
# the bare values; the hash table built of them takes several times as much.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more than this share of the rows is joined apart from the others.
HOT_SHARE = 0.01


def _bytes(stats: DataFrame, key: str) -> int:
    """Size of a checkpointed table of one key and numbers: fixed width plus key lengths."""
    row = stats.agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.octet_length(F.col(key).cast("string"))).alias("key_bytes")).first()
    return row["n"] * 16 * len(stats.columns) + (row["key_bytes"] or 0)


def measured(stats: DataFrame, key: str) -> tuple[DataFrame, int]:
    """The statistics written once to the checkpoint folder, and their size."""
    stats = checkpointed(stats)
    return stats, _bytes(stats, key)


def attach_stats(df: DataFrame, stats: DataFrame, key: str,
                 broadcast_bytes: int = BROADCAST_BYTES, size: int | None = None) -> DataFrame:
    """Left join ``stats`` (one row of numbers per key) on ``df``.

    The statistics are :func:`measured` first, unless their ``size`` is given. A
    small table is broadcast. Otherwise rows of frequent or missing keys are joined
    with the few statistics of those keys by broadcast, so that no task gets a whole
    hot group, and the remaining rows by a shuffled join.
    """
    if size is None:
        stats, size = measured(stats, key)
    if size <= broadcast_bytes:
        return df.join(F.broadcast(stats), key, "left")
    # The rows are read to find hot keys, then for each of the two joins: written once.
    df = materialised(df, "probe")
    # freqItems gives every key above the share, and at most 1/share keys in all.
    found = df.stat.freqItems([key], HOT_SHARE).first()[0]
    hot = [k for k in found if k is not None]
    listed = F.col(key).isin(hot) if hot else F.lit(False)
    is_hot = F.col(key).isNull() | listed
    by_broadcast = df.where(is_hot).join(F.broadcast(stats.where(listed)), key, "left")
    by_shuffle = df.where(~is_hot).join(stats.hint("merge"), key, "left")
    return by_broadcast.unionByName(by_shuffle)


def with_group_stat(df: DataFrame, key: str, aggregates: Sequence[Column],
                    fit_on: DataFrame | None = None) -> DataFrame:
    """Aggregate by ``key`` (over ``fit_on`` when given) and attach the result to each row."""
    source = df if fit_on is None else fit_on
    return attach_stats(df, source.groupBy(key).agg(*aggregates), key)


def with_group_count(df: DataFrame, key: str, name: str = "group_count") -> DataFrame:
    """Rows of the same key, on each row; missing keys have no count.

    A window over the key would hand a hot key to one task; counting first does not.
    """
    return with_group_stat(df, key, [F.count(F.lit(1)).alias(name)],
                           fit_on=df.where(F.col(key).isNotNull()))


def lookup(df: DataFrame, ids: Sequence[str], key: str = "tconst",
           limit: int | None = None) -> DataFrame:
    """Rows of the given ids, of the first ``limit`` ids only when set.

    The ids come from the caller's request, so they are literals the scan can push down.
    """
    wanted = list(ids)[:limit] if limit is not None else list(ids)
    return df.where(F.col(key).isin(*wanted))
