"""Fill-in-middle: texts cut at units that are counted in words of eight bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cinestrata.llm.common import pieces

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
# Of a hundred texts so many are rearranged, and so many of these start with their suffix.
REARRANGED, SUFFIX_FIRST = 90, 20
# Words of eight bytes that are marked at a time.
_BLOCK = 1 << 17


def _each(byte: int) -> np.uint64:
    """A word of eight times the same byte."""
    return np.uint64(byte * 0x0101010101010101)


_HIGH, _LOW7, _ONES = _each(0x80), _each(0x7F), _each(0x01)


def _letters(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is A to Z or a to z.

    The sums stay below 256 in each byte, so nothing is carried into the next one.
    """
    low = (words | _each(0x20)) & _LOW7
    return (low + _each(0x80 - ord("a"))) & ~(low + _each(0x7F - ord("z"))) & ~words & _HIGH


def _following(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that continues a code point (10xxxxxx)."""
    return words & ~(words << np.uint64(1)) & _HIGH


def _ahead(marks: np.ndarray) -> np.ndarray:
    """Marks of the byte behind each byte; ``marks`` has one word more than the result."""
    return (marks[:-1] >> np.uint64(8)) | (marks[1:] << np.uint64(56))


class Texts:
    """UTF-8 texts, each from a word boundary and with a zero byte behind, and their counts.

    Byte i of a word is its i-th lowest. Marks are made anew for a block or a word when they are
    needed; what is kept are counts per word.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.sizes = sizes
        words = sizes // 8 + 1
        self.first = np.concatenate([[0], np.cumsum(words)])
        # One word more, so that each word has one behind it.
        room = np.zeros((int(self.first[-1]) + 1) * 8, np.uint8)
        if len(sizes):
            at = np.repeat(self.first[:-1] * 8 - (np.cumsum(sizes) - sizes), sizes)
            used = data[int(starts[0]):int(starts[0]) + int(sizes.sum())]
            room[at + np.arange(len(used))] = used
        self.bytes, self.words = room, room.view("<u8")
        blocks = range(0, int(self.first[-1]), _BLOCK)
        spans = [(b, min(b + _BLOCK, int(self.first[-1]))) for b in blocks]
        none = np.zeros(0, np.uint8)
        self.units = np.cumsum(np.concatenate([none] + [
            np.bitwise_count(self._ends(*s)) for s in spans]), dtype=np.int64)
        self.points = np.cumsum(np.concatenate([none] + [
            np.bitwise_count(self._starts(*s)) for s in spans]), dtype=np.int64)

    def _ends(self, start: int, stop: int) -> np.ndarray:
        """The high bit of each byte that ends a unit: of a run of letters, or of any code point.

        A byte that is not the last of its code point has a following byte behind it; one within
        a run is a letter before a letter. The zero bytes behind a text are no units.
        """
        words = self.words[start:stop + 1]
        letters, following = _letters(words), _following(words)
        inner = _ahead(following) | (letters[:-1] & _ahead(letters))
        return ~inner & _HIGH & self._inside(start, stop)

    def _starts(self, start: int, stop: int) -> np.ndarray:
        """The high bit of each byte that starts a code point."""
        return ~_following(self.words[start:stop]) & _HIGH & self._inside(start, stop)

    def _inside(self, start: int, stop: int) -> np.ndarray:
        """The high bit of each byte of a text, none for the padding."""
        marks = np.full(stop - start, _HIGH)
        last = self.first[1:] - 1
        here = slice(*np.searchsorted(last, [start, stop]))
        kept = (self.sizes[here] % 8 * 8).astype(np.uint64)
        marks[last[here] - start] &= (np.uint64(1) << kept) - np.uint64(1)
        return marks

    def _before(self, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Marks in all words before the given ones."""
        return np.where(words > 0, counts[words - 1], 0)

    def n_units(self) -> np.ndarray:
        return self._before(self.units, self.first[1:]) - self._before(
            self.units, self.first[:-1])

    def cut(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and code points of each text before its ``rank``-th unit's end; 0 is its start.

        The word is searched in the cumulated counts. Within the word, multiplying the marks by
        ones gives each byte the marks up to it; the bytes with fewer than wanted are counted.
        """
        text = np.flatnonzero(rank > 0)
        wanted = rank[text] + self._before(self.units, self.first[text])
        word = np.searchsorted(self.units, wanted)
        left = (wanted - self._before(self.units, word)).astype(np.uint64)
        marks = np.concatenate([np.zeros(0, np.uint64)] + [
            self._ends(w, w + 1) for w in word.tolist()])
        upto = (marks >> np.uint64(7)) * _ONES
        # High bit where the byte's count is at least the wanted one (both are at most 8).
        reached = ((upto | _HIGH) - left * _ONES) & _HIGH
        byte = 8 - np.bitwise_count(reached).astype(np.int64)
        before = (np.uint64(1) << (byte.astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        starts = np.concatenate([np.zeros(0, np.uint64)] + [
            self._starts(w, w + 1) for w in word.tolist()])
        # The marked byte itself: its code point has started in or before it.
        through = (before << np.uint64(8)) | np.uint64(0xFF)
        size, points = np.zeros((2, len(rank)), np.int64)
        size[text] = (word - self.first[text]) * 8 + byte + 1
        points[text] = (self._before(self.points, word)
                        - self._before(self.points, self.first[text])
                        + np.bitwise_count(starts & through))
        return size, points

    def text(self, i: int) -> bytes:
        at = int(self.first[i]) * 8
        return self.bytes[at:at + int(self.sizes[i])].tobytes()


def _parts(batch: pa.RecordBatch) -> list[pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` of a batch of ``text, h1 .. h4``."""
    text = batch.column("text").cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    texts = Texts(data, offsets[:-1], np.diff(offsets))
    n = texts.n_units()
    h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4))
    a, b = h1 % (n + 1), h2 % (n + 1)
    (to_middle, at_middle), (to_suffix, at_suffix) = (
        texts.cut(np.minimum(a, b)), texts.cut(np.maximum(a, b)))
    forms, outputs = [], []
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    for i in range(len(n)):
        whole = texts.text(i)
        if (not whole or h3[i] % 100 >= REARRANGED or p in whole or s in whole or m in whole):
            forms.append("plain")
            outputs.append(whole)
            continue
        prefix, middle = whole[:to_middle[i]], whole[to_middle[i]:to_suffix[i]]
        suffix = whole[to_suffix[i]:]
        if h4[i] % 100 < SUFFIX_FIRST:
            forms.append("spm")
            outputs.append(b"".join([s, suffix, p, prefix, m, middle]))
        else:
            forms.append("psm")
            outputs.append(b"".join([p, prefix, s, suffix, m, middle]))
    plain = np.array([f == "plain" for f in forms], bool)
    return [pa.array(n, pa.int64()), pa.array(forms, pa.string()),
            pa.array(at_middle, pa.int64(), mask=plain),
            pa.array(at_suffix - at_middle, pa.int64(), mask=plain),
            pa.array(outputs, pa.binary())]


def rearranged(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n, form, prefix_chars, middle_chars, output``.

    A text is cut into units: runs of the letters A to Z and a to z, and single other code
    points. Four numbers from the sha256 of ``seed:doc_id`` choose two cuts among the units'
    ends and the start, whether the text is rearranged, and how: ``psm`` is prefix, suffix,
    middle, ``spm`` suffix, prefix, middle, each behind its mark. ``plain`` texts stay: those
    not chosen, empty ones and those with a mark in them, whose parts could not be told apart.

    A null text is empty; a missing id hashes as the empty id; rows of one id have the same
    four numbers. Empty tables give no row; other columns pass in ``row``. A batch has 4 MiB of
    text or one row; a very long text takes its size about three times.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    name = F.coalesce(F.col("row.doc_id").cast("long").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    numbers = [F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}")
               for k in range(4)]
    given = rows.select("row", F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text"),
                        digest.alias("digest")).select("row", "text", *numbers)
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(
        "n long, form string, prefix_chars long, middle_chars long, output binary").fields])

    def run(batches):
        for piece in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [piece.column("row"), *_parts(piece)], schema.names)

    # Texts and marks are valid UTF-8 and are cut between code points only.
    return given.mapInArrow(run, schema).withColumn("output", F.decode("output", "UTF-8"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of; its marks stand in it once each."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, third = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, third, second))
            .when(form == "spm", F.concat(second, third, first)).otherwise(output))
