"""Near-duplicate documents by SimHash and tables of distances to reference fingerprints.

The distance of two fingerprints is at least the difference of their distances to any third
one. Each distinct fingerprint gets its row of the pivot table: Hamming distances to the zero
fingerprint, to 32 references of two neighbouring bits each, and to 31 scattered ones.

Which pairs to look at also follows from the table. (d0 - dj) / 2 + 1 is the number of bits
that a fingerprint has in the pair of reference j, and up to 4 differing bits change at most
4 of the 32 numbers. Of eight groups of four numbers at least four then agree entirely, so
linked fingerprints share one of the 70 keys made of four groups. Pairs that share a key are
discarded if any coordinate of the table differs by more than 4; survivors are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cinestrata.llm.common import narrowed, pieces
from cinestrata.llm.components import components
from cinestrata.session import materialised

SHINGLE = 4
SEED = 42
LINKED = 4           # bits in which linked fingerprints may differ
PAIRWISE = 8         # keys with so many fingerprints are compared pair by pair
HELD = 50_000        # fingerprints of a key that one task holds; more are dealt to several

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_PAIRS = np.uint64(3) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
_SCATTERED = np.array([xxhash.xxh64_intdigest(b"reference %d" % i) for i in range(31)], np.uint64)
PIVOTS = np.concatenate([[np.uint64(0)], _PAIRS, _SCATTERED])
_GROUPS = 8
_KEYS = list(combinations(range(_GROUPS), _GROUPS - LINKED))


def fingerprint(text: str) -> int:
    """The SimHash of a text's 4-word shingles, A-Z in lower case; zero if it has no word."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        first, last = (ends - lengths)[:1 - SHINGLE].tolist(), ends[SHINGLE - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(first, last)]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for at in range(0, len(values), 1 << 16):     # bounded, however long the text is
        bits = np.unpackbits(values[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, mark: str | None = None) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) of each row's whole text.

    A column of longs named by ``mark`` comes along.
    """
    columns = ["doc_id", *([mark] if mark else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            values = np.array([fingerprint(t or "") for t in batch.column("text").to_pylist()],
                              np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(values.view(np.int64))],
                [*columns, "fp"])

    types = {c: "long" for c in columns}
    return narrowed(docs, **types, text="string").mapInArrow(
        run, ", ".join(f"{c} long" for c in columns) + ", fp long")


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Distances of each fingerprint to each reference."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def keys_of(fps: np.ndarray) -> np.ndarray:
    """The keys of each fingerprint, from its row of the pivot table."""
    distances = pivot_table(fps).astype(np.int64)
    numbers = (distances[:, :1] - distances[:, 1:33]) // 2 + 1
    weights = 3 ** np.arange(32 // _GROUPS)
    groups = (numbers.reshape(len(fps), _GROUPS, -1) * weights).sum(axis=2)
    out = np.empty((len(fps), len(_KEYS)), np.int64)
    for k, chosen in enumerate(_KEYS):
        code = np.full(len(fps), k)
        for g in chosen:
            code = code << 7 | groups[:, g]
        out[:, k] = code
    return out


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fps), 2000):
            part = fps[at:at + 2000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys_of(part).reshape(-1)),
                 pa.array(np.repeat(part, len(_KEYS)).view(np.int64))], ["key", "fp"])


def close(one: np.ndarray, other: np.ndarray, fps: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which pairs of positions are linked: by coordinates of the table first, then by bits."""
    keep = np.ones(len(one), bool)
    for first in range(0, len(PIVOTS), 16):
        left = np.flatnonzero(keep)
        gap = np.abs(table[one[left], first:first + 16] - table[other[left], first:first + 16])
        keep[left] = gap.max(axis=1, initial=0) <= LINKED
    left = np.flatnonzero(keep)
    keep[left] = np.bitwise_count(fps[one[left]] ^ fps[other[left]]) <= LINKED
    return keep


def spanning_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all linked members of one key, fewer than there are members.

    Each member is met once and compared with those not met yet, by distance to the first
    reference, then by all coordinates, then by bits.
    """
    fps = fps[np.argsort(np.bitwise_count(fps), kind="stable")]
    table = pivot_table(fps)
    open_, found = np.arange(len(fps)), []
    while len(open_):
        frontier, open_ = [open_[0]], open_[1:]
        while frontier and len(open_):
            at = frontier.pop()
            d = int(table[at, 0])
            lo, hi = np.searchsorted(table[open_, 0], [d - LINKED, d + LINKED + 1])
            near = open_[lo:hi]
            hit = np.flatnonzero(close(np.full(len(near), at), near, fps, table))
            if len(hit):
                found.append((np.full(len(hit), at), near[hit]))
                frontier.extend(near[hit].tolist())
                open_ = np.delete(open_, lo + hit)
    if not found:
        return fps[:0], fps[:0]
    return fps[np.concatenate([f[0] for f in found])], fps[np.concatenate([f[1] for f in found])]


def _links_of_runs(keys: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within each run of equal keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    small = np.repeat((sizes > 1) & (sizes <= PAIRWISE), sizes)
    k, f = keys[small], fps[small]
    if len(f):
        table = pivot_table(f)
        for gap in range(1, PAIRWISE):
            one = np.flatnonzero(k[gap:] == k[:-gap])
            if not len(one):
                break
            hit = one[close(one, one + gap, f, table)]
            yield f[hit], f[hit + gap]
    for at, n in zip(starts[sizes > PAIRWISE], sizes[sizes > PAIRWISE]):
        yield spanning_links(fps[at:at + n])


def _linker(held: int | None):
    """Rows sorted by key to links (over = false); rows of keys with over ``held`` pass (over)."""
    def emit(over: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), over)), pa.array(a.view(np.int64)),
             pa.array(b.view(np.int64))], ["over", "a", "b"])

    def links(keys, fps):
        for a, b in _links_of_runs(keys, fps):
            if len(a):
                yield emit(False, np.minimum(a, b), np.maximum(a, b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, passing = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            k = batch.column("key").to_numpy(zero_copy_only=False)
            f = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            keys, fps = np.r_[keys, k], np.r_[fps, f]
            if passing is not None:
                n = int(np.searchsorted(keys, passing, "right"))
                if n:
                    yield emit(True, keys[:n], fps[:n])
                keys, fps = keys[n:], fps[n:]
                if not len(keys):
                    continue
                passing = None
            last = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
            if last:
                yield from links(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
            if held and len(keys) > held:
                passing = keys[0]
                yield emit(True, keys, fps)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from links(keys, fps)

    return run


def linked_fingerprints(fps: DataFrame, held: int = HELD) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints (column fp) within 4 bits.

    A key with over ``held`` members is dealt to several tasks: its members fall into blocks
    by hash, and every two blocks meet in one task, so no link is lost.
    """
    schema = "over boolean, a long, b long"
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = fps.mapInArrow(_keyed, "key long, fp long").repartition(n, "key")
    found = materialised(
        dealt.sortWithinPartitions("key", "fp").mapInArrow(_linker(held), schema), "links")
    crowded = found.where("over").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    links = found.where("not over").select("a", "b")
    if crowded.isEmpty():
        return links.distinct()
    sizes = crowded.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(held)).alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    met = (crowded.join(sizes, "key").withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
           .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
                   .alias("key"), "fp"))
    more = (met.distinct().repartition(n, "key").sortWithinPartitions("key", "fp")
            .mapInArrow(_linker(None), schema).select("a", "b"))
    return links.union(more).distinct()


def near_duplicates_by(docs: DataFrame, mark: str | None = None) -> DataFrame:
    """``doc_id, fp, component`` (and ``mark``): the component is named by one of its fingerprints."""
    rows = materialised(fingerprints(docs, mark), "fingerprints")
    labels = components(linked_fingerprints(rows.select("fp").distinct()))
    return rows.join(labels, rows.fp == labels.node, "left").select(
        "doc_id", *([mark] if mark else []), "fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` for each row: the smallest doc_id its text is linked to.

    Fingerprints within 4 bits are linked, and links chain. Null and empty texts have the zero
    fingerprint and are linked like any other. Rows repeat as they do in ``docs``; equal texts
    are one fingerprint before any comparison. Null ids never name a component unless it has
    no other id. An empty table gives an empty one.
    """
    rows = materialised(fingerprints(docs), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = components(linked_fingerprints(distinct.select("fp")))
    of_fp = distinct.join(labels, distinct.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = of_fp.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of_fp.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
