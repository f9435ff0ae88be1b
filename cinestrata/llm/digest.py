"""Document fingerprints: quartile codes of hashed byte triplets, and their likeness.

The triplets of a text's bytes (a byte with the third and the seventh after it, which tells
texts of one language apart better than neighbours do) are counted in hash buckets. The digest
has the length on a logarithmic scale and, for each bucket, which quartile of all buckets its
count lies in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cinestrata.llm.common import narrowed, pieces, texts_of
from cinestrata.session import materialised

BUCKETS = 256
OFFSETS = (3, 7)
FAR = 6              # score of a bucket in the first and the last quartile
LENGTH_SHARE = 0.25  # most that different lengths take off the likeness
LENGTH_SCALE = 3.0   # doublings of length that take it all
_SPAN = 1 << 20      # bytes counted at a time


def digest(text: str) -> str:
    """The fingerprint: 4 hexadecimal digits of length, then two bits for each bucket."""
    data = np.frombuffer(text.encode(), np.uint8)
    count = np.zeros(BUCKETS, np.int64)
    near, far = OFFSETS
    size = len(data)
    if 0 < size <= far:
        # Too short for a triplet: the text follows on itself, so that each byte begins one.
        data = np.resize(data, size + far)
    for at in range(0, max(len(data) - far, 0), _SPAN):
        part = data[at:at + _SPAN + far].astype(np.uint32)
        n = len(part) - far
        h = part[:n] * np.uint32(0x9E3779B1) + part[near:near + n] * np.uint32(0x85EBCA77)
        h += part[far:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h >>= np.uint32(24)
        count += np.bincount(h, minlength=BUCKETS)
    ranked = np.sort(count)
    cuts = ranked[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, BUCKETS * 3 // 4 - 1]]
    code = (count[:, None] > cuts).sum(axis=1).astype(np.uint8).reshape(-1, 4)
    packed = code[:, 0] << 6 | code[:, 1] << 4 | code[:, 2] << 2 | code[:, 3]
    length = min(0xFFFF, round(1024 * np.log2(1 + size)))
    return f"{length:04x}" + packed.astype(np.uint8).tobytes().hex()


def codes(fingerprint: str) -> tuple[int, np.ndarray]:
    packed = np.frombuffer(bytes.fromhex(fingerprint[4:]), np.uint8)
    return int(fingerprint[:4], 16), (packed[:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3
                                      ).reshape(-1)


def likeness(one: str, other: str) -> float:
    """1 for equal digests, towards 0 the more their buckets and lengths differ; symmetric."""
    (m, a), (n, b) = codes(one), codes(other)
    gap = np.abs(a.astype(int) - b)
    score = int(np.where(gap == 3, FAR, gap).sum()) / (FAR * BUCKETS)
    length = min(1.0, abs(m - n) / 1024 / LENGTH_SCALE)
    return (1 - score) * (1 - LENGTH_SHARE * length)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
_INNER, _FIRST, _LAST = 0, 1, 2


def _result(text: str, mark: str, following: str, next_mark: str) -> tuple:
    changed = edited(text, following)
    other = digest(changed)
    return (len(text), hashlib.sha256(changed.encode()).hexdigest(), mark, other,
            likeness(mark, other), likeness(mark, next_mark))


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows of a sorted partition but the last, which goes on with the first."""
    part, before = TaskContext.get().partitionId(), None
    names = ["part", "kind", "doc_id", "text", *(f.split()[0] for f in _RESULT.split(", "))]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.string(), *_TYPES]

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in pieces(batches, "text"):
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            mark = digest(text)
            if before is None:
                rows.append((part, _FIRST, doc_id, text, *[None] * 6))
            else:
                rows.append((part, _INNER, before[0], None, *_result(*before[1:], text, mark)))
            before = (doc_id, text, mark)
        if rows:
            yield emit(rows)
    if before is not None:
        yield emit([(part, _LAST, before[0], before[1], *[None] * 6)])


def _outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        rows = [(d, *_result(t or "", digest(t or ""), n or "", digest(n or ""))) for d, t, n in zip(
            *(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), *_TYPES))],
            ["doc_id", *(f.split()[0] for f in _RESULT.split(", "))])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of each row's whole text; null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([digest(t) for t in texts_of(batch)],
                                                  pa.string())], ["doc_id", "fingerprint"])

    return narrowed(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, fingerprint string")


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and its likeness to this and to the next.

    Rows follow each other by doc_id (null first, rows of one id by text), after the last comes
    the first. Rows are ranged and sorted once; a partition's last row goes on with the first of
    the next partition that has any, a join of as many rows as there are partitions. Null texts
    count as empty. An empty table gives an empty one; a lone row follows itself.
    """
    rows = narrowed(docs, doc_id="long", text="string")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = f"part int, kind int, doc_id long, text string, {_RESULT}"
    found = materialised(
        rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(_inner, schema), "digests")
    names = ["doc_id", *(f.split()[0] for f in _RESULT.split(", "))]
    firsts = found.where(f"kind = {_FIRST}")
    line = Window.orderBy("part")
    order = firsts.select("part").withColumn("next_part", F.coalesce(
        F.lead("part").over(line), F.first("part").over(line)))
    ends = (found.where(f"kind = {_LAST}").select("part", "doc_id", "text").join(order, "part")
            .join(firsts.select(F.col("part").alias("next_part"), F.col("text").alias("following")),
                  "next_part").select("doc_id", "text", "following"))
    outer = ends.mapInArrow(_outer, f"doc_id long, {_RESULT}")
    return found.where(f"kind = {_INNER}").select(*names).union(outer)
