"""Removal of byte strings that occur elsewhere, by a run-compressed Burrows-Wheeler transform.

A string of ``LENGTH`` bytes has one anchor: the leftmost of its 16-byte grams with the least
hash. Equal strings have equal anchors at the same place, so only texts around equal anchors
need be compared, and every string belongs to one anchor occurrence. Neighbouring strings of
one anchor form a context.

Contexts of equal anchors are laid over each other, anchor on anchor, and indexed by the
positional Burrows-Wheeler transform: column by column they are kept in the order of their
reversed prefixes. A column is held as runs of equal bytes. Within a run neighbours stay
neighbours and the start of their common part stays as it is; only at run ends are starts
sampled anew, as the largest between a run and the last one of the same byte. Streaming over
the columns, the distance to the sampled start is each context's longest match with any other
one, and where it reaches ``LENGTH`` the string that ends there is marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cinestrata.llm.common import narrowed, pieces
from cinestrata.session import materialised

LENGTH = 400
GRAM = 16
BLOCK = 6000         # contexts that are indexed together
HELD = 40_000        # contexts of one anchor that one task indexes; more go by string digests
ABSENT = 256         # column value beyond a context's ends
_POSITIONS = 24      # bits of a position within a stretch of text
_STRETCH = 1 << 23   # starts of a stretch; longer texts are cut into overlapping ones
_MIXERS = [np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                                  0xD6E8FEB86659FD93)]
_PAIR = np.dtype("<i4")

Ranges = list[tuple[int, int]]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each 16 bytes, from hashes of 1, 2, 4 and 8."""
    h, reach = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD), 1
    for m in _MIXERS:
        h = h[:-reach] * m + h[reach:]
        h ^= h >> np.uint64(29)
        reach *= 2
    return h


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:span - width], values[width - span:]) if span < width else values


def contexts(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash and first byte, end and anchor position of each context of a text."""
    found = []
    for at in range(0, max(len(text) - LENGTH + 1, 0), _STRETCH):
        data = np.frombuffer(text, np.uint8)[at:at + _STRETCH + LENGTH - 1]
        hashes = gram_hashes(data)
        low = np.uint64((1 << _POSITIONS) - 1)
        keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        least = _least(keys, LENGTH - GRAM + 1)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        last = np.r_[first[1:], len(least)] - 1
        anchor = (least[first] & low).astype(np.int64)
        found.append((hashes[anchor].view(np.int64), first + at, last + at + LENGTH, anchor + at))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(c) for c in zip(*found))


def merged(ranges: Ranges) -> Ranges:
    """Ranges joined where they touch or overlap, in order."""
    out: Ranges = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _packed(ranges: Ranges) -> bytes:
    return np.array(ranges, _PAIR).tobytes()


def _unpacked(data: bytes | None) -> Ranges:
    return list(map(tuple, np.frombuffer(data or b"", _PAIR).reshape(-1, 2).tolist()))


_SCANNED = ("kind int, doc_id long, t binary, sha binary, n_bytes long, own binary, "
            "anchor long, ctx long, occ long, p int, q int, off int")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (kind 0) per text, and one (kind 1) per context of it; ``t`` is half the SHA-256.

    Contexts that a text has several times are its own repeats: all their places are ranges of
    the kind 0 row, and the first two of them go on to be compared with other texts.
    """
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(),
             pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    names = [f.split()[0] for f in _SCANNED.split(", ")]
    for batch in pieces(batches, "text", 1 << 20):
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                batch.column("text").to_pylist()):
            data = (text or "").encode()
            sha = hashlib.sha256(data).digest()
            seen: dict[tuple[int, int], list[int]] = {}
            own: Ranges = []
            for anchor, p, q, at in zip(*(c.tolist() for c in contexts(data))):
                ctx = xxhash.xxh64_intdigest(data[p:q], at - p) - (1 << 63)
                places = seen.setdefault((anchor, ctx), [])
                if len(places) == 2:
                    own.append((p, q))
                    continue
                if places:
                    own += [(places[0], places[0] + q - p), (p, q)]
                places.append(p)
                occ = xxhash.xxh64_intdigest(sha + p.to_bytes(8, "little")) - (1 << 63)
                rows.append((1, None, sha[:16], None, None, None, anchor, ctx, occ, p, q, at - p))
            rows.append((0, doc_id, sha[:16], sha, len(data),
                         _packed(merged(own)) if own else None, *[None] * 6))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def matches(group: np.ndarray, texts: list[bytes], offsets: np.ndarray) -> list[Ranges]:
    """Ranges of each context that some other one of its group has at the same place.

    ``group`` is sorted; ``offsets`` tell each context's anchor. All groups are indexed in one
    pass over the columns.
    """
    n = len(texts)
    lead = int(offsets.max(initial=0))
    ends = lead - offsets + np.fromiter(map(len, texts), np.int64, n)
    width = int(ends.max(initial=0))
    columns = np.full((n, width), ABSENT, np.int16)
    for i, (text, end) in enumerate(zip(texts, ends.tolist())):
        columns[i, end - len(text):end] = np.frombuffer(text, np.uint8)
    columns = np.ascontiguousarray(columns.T)
    order, group = np.arange(n), group.astype(np.int64)
    start = np.zeros(n, np.int64)          # of the part shared with the one before in order
    start[np.flatnonzero(np.r_[True, group[1:] != group[:-1]])] = 1
    hits = np.zeros((width, n), bool)
    row = np.arange(n)
    for k in range(width):
        keys = group * (ABSENT + 1) + columns[k, order]
        heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        tails = np.r_[heads[1:], n]
        run_keys = keys[heads]
        sampled = np.full(len(heads), k + 1)
        if (run_keys[1:] < run_keys[:-1]).any():
            runs = np.argsort(run_keys, kind="stable")
            ordered = run_keys[runs]
            joined = np.flatnonzero(ordered[1:] == ordered[:-1]) + 1   # same byte as the run before
            if len(joined):
                # The largest start between the two runs: after the earlier's end, up to the head.
                spans = np.empty(2 * len(joined), np.int64)
                spans[::2], spans[1::2] = tails[runs[joined - 1]], heads[runs[joined]] + 1
                sampled[runs[joined]] = np.maximum.reduceat(np.append(start, 0), spans)[::2]
            sizes = (tails - heads)[runs]
            begins = np.cumsum(sizes) - sizes
            moved = np.repeat(heads[runs] - begins, sizes) + row
            start[heads] = sampled
            start, order = start[moved], order[moved]
            gone = keys[moved] % (ABSENT + 1) == ABSENT
        else:
            start[heads] = sampled
            gone = keys % (ABSENT + 1) == ABSENT
        start[gone] = k + 1
        if k + 1 >= LENGTH:
            best = np.minimum(start, np.append(start[1:], k + 1))
            hits[k, order[(k + 1 - best >= LENGTH) & ~gone]] = True
    out: list[Ranges] = []
    found = hits.T
    for i in range(n):
        at = np.flatnonzero(found[i])
        if not len(at):
            out.append([])
            continue
        cut = np.flatnonzero(np.diff(at) > 1)
        shift = int(lead - offsets[i])
        out.append(merged([(int(a) + 1 - LENGTH - shift, int(b) + 1 - shift) for a, b in zip(
            at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]])]))
    return out


_INDEXED = "over boolean, anchor long, ctx long, ranges binary, bytes binary"


def _indexer(held: int, block: int):
    """Contexts sorted by anchor to their ranges; those of anchors with over ``held`` pass on."""
    def emit(over: bool, rows: list[tuple]) -> pa.RecordBatch:
        anchor, ctx, ranges, data = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([over] * len(rows)), pa.array(anchor, pa.int64()), pa.array(ctx, pa.int64()),
             pa.array(ranges, pa.binary()), pa.array(data, pa.binary())],
            ["over", "anchor", "ctx", "ranges", "bytes"])

    def indexed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        group = np.array([r[0] for r in rows])
        found = matches(np.cumsum(np.r_[0, group[1:] != group[:-1]]), [r[3] for r in rows],
                        np.array([r[2] for r in rows]))
        out = [(r[0], r[1], _packed(f), None) for r, f in zip(rows, found) if f]
        if out:
            yield emit(False, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []       # whole groups
        now: list[tuple] = []         # the group that is being read
        crowded, last = False, None
        for batch in pieces(batches, "bytes"):
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "ctx", "off", "bytes"))):
                if row[:2] == last:
                    continue          # the same context of a repeated row
                last = row[:2]
                if now and now[0][0] != row[0]:
                    if crowded:
                        yield emit(True, [(r[0], r[1], None, r[3]) for r in now])
                    elif len(now) > 1:
                        ready += now
                    now, crowded = [], False
                    if len(ready) >= block:
                        yield from indexed(ready)
                        ready = []
                now.append(row)
                if len(now) > held:
                    yield emit(True, [(r[0], r[1], None, r[3]) for r in now[:-1]])
                    now, crowded = now[-1:], True
        if crowded:
            yield emit(True, [(r[0], r[1], None, r[3]) for r in now])
        elif len(now) > 1:
            ready += now
        if ready:
            yield from indexed(ready)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of ``LENGTH`` bytes of each context by a 128-bit digest."""
    for batch in pieces(batches, "bytes", 1 << 18):
        for anchor, ctx, data in zip(*(batch.column(c).to_pylist()
                                       for c in ("anchor", "ctx", "bytes"))):
            n = len(data) - LENGTH + 1
            both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[i:i + LENGTH])
                                          for i in range(n)), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array([anchor] * n, pa.int64()),
                 pa.array([ctx] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32))],
                ["w1", "w2", "anchor", "ctx", "at"])


def _by_digests(crowded: DataFrame) -> DataFrame:
    """``anchor, ctx, ranges`` of contexts whose anchor is too frequent for one task's index."""
    strings = crowded.select("anchor", "ctx", "bytes").mapInArrow(
        _digests, "w1 long, w2 long, anchor long, ctx long, at int")
    shared = strings.groupBy("w1", "w2").agg(F.min("ctx").alias("lo"), F.max("ctx").alias("hi"))
    hits = strings.join(shared.where("lo <> hi").select("w1", "w2"), ["w1", "w2"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = [_packed(merged([(a, a + LENGTH) for a in places]))
                      for places in batch.column("places").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), batch.column("ctx"), pa.array(ranges, pa.binary())],
                ["anchor", "ctx", "ranges"])

    return hits.groupBy("anchor", "ctx").agg(F.collect_list("at").alias("places")).mapInArrow(
        run, "anchor long, ctx long, ranges binary")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of each text."""
    names = ["anchor", "ctx", "off", "bytes"]
    for batch in pieces(batches, "text", 1 << 20):
        rows = [(w["anchor"], w["ctx"], w["off"], data[w["p"]:w["q"]])
                for text, wanted in zip(batch.column("text").to_pylist(),
                                        batch.column("wanted").to_pylist())
                if wanted and (data := (text or "").encode()) is not None for w in wanted]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names)


_KEPT = "t binary, n_removed long, n_spans long, kept string"


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its ranges."""
    for batch in pieces(batches, "text", 1 << 20):
        out = []
        for t, text, own, found in zip(*(batch.column(c).to_pylist() for c in (
                "t", "text", "own", "found"))):
            data, ranges = (text or "").encode(), _unpacked(own)
            for f in found or ():
                ranges += [(f["p"] + a, f["p"] + b) for a, b in (
                    _unpacked(f["ranges"]) if f["ranges"] is not None else [(0, f["q"] - f["p"])])]
            ranges, left, at = merged(ranges), hashlib.sha256(), 0
            for a, b in ranges:
                left.update(data[at:a])
                at = b
            left.update(data[at:])
            out.append((t, sum(b - a for a, b in ranges), len(ranges), left.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(),
                                                        pa.string()))],
            [f.split()[0] for f in _KEPT.split(", ")])


def without_repeats(docs: DataFrame, held: int = HELD, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row of ``docs`` (doc_id, text).

    Removed is each byte that a string of ``LENGTH`` bytes covers which also starts anywhere else,
    in the same text or another, overlaps included. A null text counts as empty. Equal texts,
    repeated rows too, repeat each other wholly if they have so many bytes. Texts are known by
    their SHA-256, so ids may be null or repeat. An empty table gives an empty one.
    """
    rows = narrowed(docs, doc_id="long", text="string")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scanned = materialised(rows.mapInArrow(_scan, _SCANNED), "contexts")
    read = scanned.where("kind = 0")
    texts = read.groupBy("t").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"))
    owns = read.where("own is not null").select("t", "own").dropDuplicates(["t"])
    marks = scanned.where("kind = 1").select("anchor", "ctx", "occ", "t", "p", "q", "off")
    # Anchors with different occurrences; min and max tell without listing them.
    shared = marks.groupBy("anchor").agg(F.min("occ").alias("lo"), F.max("occ").alias("hi"))
    places = materialised(marks.join(shared.where("lo <> hi").select("anchor"), "anchor",
                                     "left_semi").distinct(), "shared-contexts")
    kinds = places.groupBy("anchor", "ctx").agg(
        F.min("occ").alias("lo"), F.max("occ").alias("hi"))
    several = kinds.groupBy("anchor").agg(F.min("ctx").alias("a"), F.max("ctx").alias("b")).where(
        "a <> b").select("anchor")
    # Of equal contexts one is indexed.
    wanted = (places.join(kinds.select("anchor", "ctx", F.col("lo").alias("occ")),
                          ["anchor", "ctx", "occ"], "left_semi")
              .join(several, "anchor", "left_semi")
              .groupBy("t").agg(F.collect_list(F.struct("anchor", "ctx", "p", "q", "off"))
                                .alias("wanted")))
    # One row of each text with a shared context or repeats of its own, with its text.
    listed = places.select("t").union(owns.select("t")).distinct()
    named = (texts.join(listed, "t", "left_semi").join(wanted, "t", "left").join(owns, "t", "left"))
    digest = F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), 1, 16)
    suspects = materialised(
        rows.join(named, F.col("doc_id").eqNullSafe(F.col("rep"))).where(digest == F.col("t"))
        .select("t", "copies", "own", "wanted", "text"), "suspects")
    found = materialised(
        suspects.where("wanted is not null").select("text", "wanted").mapInArrow(
            _cut, "anchor long, ctx long, off int, bytes binary")
        .repartition(n, "anchor").sortWithinPartitions("anchor", "ctx")
        .mapInArrow(_indexer(held, block), _INDEXED), "matches")
    ranges = found.where("not over").select("anchor", "ctx", "ranges")
    crowded = found.where("over")
    if not crowded.isEmpty():
        ranges = ranges.union(_by_digests(crowded))
    # A context that occurs twice is removed whole: no list of ranges.
    twice = kinds.where("lo <> hi").select("anchor", "ctx", F.lit(None).cast("binary")
                                           .alias("ranges"))
    once = ranges.join(twice.select("anchor", "ctx"), ["anchor", "ctx"], "left_anti")
    hits = places.join(once.union(twice), ["anchor", "ctx"]).groupBy("t").agg(
        F.collect_list(F.struct("p", "q", "ranges")).alias("found"))
    lone = suspects.where("copies = 1").select("t", "own", "text")
    partly = (lone.join(hits, "t", "left").where("own is not null or found is not null")
              .mapInArrow(_without, _KEPT))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    joined = (read.select("doc_id", "t", "sha", "n_bytes").join(texts.select("t", "copies"), "t")
              .join(partly, "t", "left"))
    nothing = F.lit(0).cast("long")
    return joined.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", nothing))
        .alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", nothing))
        .alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(
            F.coalesce("kept", F.lower(F.hex("sha")))).alias("kept_sha256"))
