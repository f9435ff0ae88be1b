"""Byte-level BPE encoding and decoding without a regular expression.

Texts of a batch are laid end to end as code points. Each code point gets a small class
(letter, number, white space with its look-ahead, contraction apostrophe, other); a class
is a function from the tokeniser's state to its next state, and functions compose
associatively. Composed functions of blocks are scanned, which gives the state at the
start of each block, and from it all token starts. The byte slices between starts go
through pair merging with a bounded cache; byte offsets of the ids are kept for decoding.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cinestrata.llm.common import code_points, narrowed, pieces, texts_of

# The Unicode White_Space property.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
         0x202F, 0x205F, 0x3000]
# Letters and numbers that Unicode 16 added to 15.1, first and last of each range.
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NUMBERS_16 = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
# What may follow an apostrophe as one piece.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

LETTER, NUMBER, OTHER, SHORT, LONG, INNER, BLANK, LONE, BREAK = range(9)
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, GLUE, DONE, ONE_MORE, TWO_MORE = range(9)
CLASSES = STATES = 9
GROUP = 4     # classes read by one table look-up
BLOCK = 64    # look-ups in a block of the scan
CACHED = 250_000
LONGEST = 128     # bytes of pieces that are cached, and merged without a heap
IDS = np.dtype("<u4")


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at this code point."""
    if kind == LETTER:
        if state in (TWO_MORE, ONE_MORE):
            return (ONE_MORE if state == TWO_MORE else DONE), False
        return IN_LETTERS, state not in (IN_LETTERS, GLUE)
    if kind == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, GLUE)
    if kind in (OTHER, SHORT, LONG):
        if state in (IN_OTHERS, GLUE):
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, SHORT: ONE_MORE, LONG: TWO_MORE}[kind], True
    if kind == INNER:
        return IN_SPACE, state != IN_SPACE
    return {BLANK: GLUE, LONE: DONE, BREAK: START}[kind], True


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each code point; per group of classes the state function and the starts in it."""
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            kinds[c] = LETTER
        elif major == "N":
            kinds[c] = NUMBER
    for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for first, last in ranges:
            kinds[first:last + 1] = kind
    kinds[WHITE] = INNER
    step = np.array([[_step(s, k)[0] for s in range(STATES)] for k in range(CLASSES)], np.uint8)
    mark = np.array([[_step(s, k)[1] for s in range(STATES)] for k in range(CLASSES)], np.uint8)
    codes = np.arange(CLASSES ** GROUP)
    state = np.tile(np.arange(STATES, dtype=np.uint8), (len(codes), 1))
    starts = np.zeros((len(codes), STATES, GROUP), np.uint8)
    for i in range(GROUP):
        kind = codes // CLASSES ** (GROUP - 1 - i) % CLASSES
        starts[:, :, i] = mark[kind[:, None], state]
        state = step[kind[:, None], state]
    return kinds, state, starts.view(np.uint32)[:, :, 0]


def piece_starts(points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Positions at which a piece starts; ``breaks`` (between texts) count as pieces of their own."""
    kinds, compose, marks = _tables()
    n = len(points)
    kind = kinds[points]
    kind[breaks] = BREAK
    white = (kind == INNER) | (kind == BREAK)
    ends = np.empty(n, bool)          # white space that a visible character follows
    ends[:-1], ends[-1:] = ~white[1:], False
    ends &= kind == INNER
    kind[ends] = LONE
    kind[ends & (points == 0x20)] = BLANK
    marks_at = np.flatnonzero(points[:-1] == 0x27)
    if len(marks_at):
        padded = np.append(points, [0, 0])
        first, second = padded[marks_at + 1], padded[marks_at + 2]
        for tail in CONTRACTIONS:
            hit = first == ord(tail[0])
            if len(tail) == 2:
                hit &= second == ord(tail[1])
            kind[marks_at[hit]] = SHORT if len(tail) == 1 else LONG

    span = GROUP * BLOCK
    blocks = -(-n // span)
    padded = np.full(blocks * span, BREAK, np.uint8)
    padded[:n] = kind
    grouped = padded.reshape(blocks, BLOCK, GROUP).astype(np.int32)
    code = grouped[:, :, 0]
    for i in range(1, GROUP):
        code = code * CLASSES + grouped[:, :, i]
    # The function of each block, composed step by step for all blocks at once.
    flat = compose.reshape(-1)
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))
    for j in range(BLOCK):
        whole = flat[code[:, j, None] * STATES + whole]
    # Inclusive scan of the functions: after it, row b maps the first state to that after b.
    reach = 1
    while reach < blocks:
        later = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), axis=1)
        whole = np.concatenate([whole[:reach], later])
        reach *= 2
    state = np.full(blocks, START, np.uint8)
    state[1:] = whole[:-1, START]
    out = np.empty((blocks, BLOCK), np.uint32)
    table = marks.reshape(-1)
    for j in range(BLOCK):
        at = code[:, j] * STATES + state
        out[:, j] = table[at]
        state = flat[at]
    return np.flatnonzero(out.view(np.uint8).reshape(-1)[:n])


class Merger(dict):
    """Bytes of a piece to its ids as little-endian bytes.

    Holds two generations of at most ``CACHED`` pieces: when the young one is full it becomes
    the old one, and pieces met again move to the young one, so frequent pieces stay.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            merged = self.merged(piece)
            ids = struct.pack(f"<{len(merged)}I", *merged)
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids

    def merged(self, piece: bytes) -> list[int]:
        """Merges the pair of lowest rank, the leftmost of several, until no pair has a rank."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        return self._short(piece) if len(piece) <= LONGEST else self._long(piece)

    def _short(self, piece: bytes) -> list[int]:
        get, none = self.ranks.get, len(self.ranks)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            now = parts[i] = parts[i] + parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(now + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + now, none)
        return [self.ranks[p] for p in parts]

    def _long(self, piece: bytes) -> list[int]:
        """The same with a heap, so that time stays near the length of the piece."""
        ranks = self.ranks
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1)
                if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        dead = bytearray(n + 1)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if dead[i] or j >= n or dead[j] or after[j] != end:
                continue
            dead[j] = 1
            after[i] = end
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i:after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (h := before[i]) >= 0 and (r := ranks.get(piece[h:end])) is not None:
                heapq.heappush(heap, (r, h, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:after[i]]])
            i = after[i]
        return out


class Codec:
    """Encodes and decodes batches of texts by a table of ranks."""

    def __init__(self, rank_file: bytes):
        lines = [line.split() for line in rank_file.splitlines() if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.merger = Merger(ranks)
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
        """For each text its ids as little-endian bytes, and the byte offset of each id and the end."""
        joined = "\0".join(texts) + "\0"
        points = code_points(joined)
        breaks = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        starts = piece_starts(points, breaks)
        ends_at = np.searchsorted(starts, breaks)      # pieces before each break
        data = joined.encode()
        if len(data) != len(points):
            leads = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            starts = leads[starts]
        cut = starts.tolist()
        get = self.merger.__getitem__
        at = 0
        for end in ends_at.tolist():
            ids = b"".join([get(data[a:b]) for a, b in zip(cut[at:end], cut[at + 1:end + 1])])
            at = end + 1
            lengths = self.lengths[np.frombuffer(ids, IDS)]
            yield ids, np.concatenate([[0], np.cumsum(lengths)])

    def decode(self, ids: bytes, offsets: np.ndarray, first: int = 0,
               last: int | None = None) -> bytes:
        """The bytes of ids ``first`` to ``last``, each set down at its kept offset."""
        chosen = np.frombuffer(ids, IDS)[first:last]
        offsets = offsets[first:first + len(chosen) + 1]
        if not len(chosen):
            return b""
        shift = self.firsts[chosen] - (offsets[:-1] - offsets[0])
        total = int(offsets[-1] - offsets[0])
        return self.bytes[np.repeat(shift, np.diff(offsets)) + np.arange(total)].tobytes()


def _codec_source(spark: SparkSession, vocabulary: str):
    """The rank file, read where the program runs and shared with all executors (about 1 MB)."""
    with open(vocabulary, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, vocabulary: str, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """Each text's ids and offsets: id column, ``ids`` and ``offsets`` (little-endian, binary).

    A null text counts as empty: no ids, one offset. Repeated rows stay repeated.
    """
    source = _codec_source(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(source.value)
        for batch in pieces(batches, "text"):
            both = [(ids, o.astype("<i8").tobytes()) for ids, o in codec.encode(texts_of(batch))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([b[0] for b in both], pa.binary()),
                 pa.array([b[1] for b in both], pa.binary())], ["doc_id", "ids", "offsets"])

    rows = _rows(docs, id_column, text_column)
    return rows.mapInArrow(run, "doc_id long, ids binary, offsets binary").withColumnRenamed(
        "doc_id", id_column)


def decoded(tokens: DataFrame, vocabulary: str, id_column: str = "doc_id") -> DataFrame:
    """The texts of ``encoded`` rows: id column and ``text``; null ids give an empty text."""
    source = _codec_source(tokens.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(source.value)
        for batch in pieces(batches, "offsets"):
            texts = [codec.decode(i, np.frombuffer(o, "<i8")).decode() if i else ""
                     for i, o in zip(batch.column("ids").to_pylist(),
                                     batch.column("offsets").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    rows = tokens.selectExpr(f"cast(`{id_column}` as long) as doc_id", "ids", "offsets")
    return rows.mapInArrow(run, "doc_id long, text string").withColumnRenamed("doc_id", id_column)


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return narrowed(docs, **{id_column: "long", text_column: "string"}).toDF("doc_id", "text")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of each text's ids and of what they decode to, in one pass over the texts.

    Columns ``doc_id, n_tokens, ids_sha256, decoded_sha256``, a row per row of ``docs``. Null
    and empty texts have no ids and the digest of nothing; a null id stays null; an empty
    table gives an empty one; other columns are not read.
    """
    source = _codec_source(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(source.value)
        for batch in pieces(batches, "text"):
            counts, of_ids, of_text = [], [], []
            for ids, offsets in codec.encode(texts_of(batch)):
                counts.append(len(ids) // IDS.itemsize)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(codec.decode(ids, offsets)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids),
                 pa.array(of_text)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
