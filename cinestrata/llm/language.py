"""Language of a text by the nearest of several centroids per language.

A text becomes a vector of hashed letter trigrams, logarithmic counts weighed by inverse
document frequency and normalised. Per language, spherical k-means over a bounded sample of
labelled rows gives a few centroids. The language of the nearest centroid by cosine wins; a
text much farther from all broad centroids than nearly all of the sample's texts of about as many
different trigrams is rejected. For that, each part of the sample is measured by centroids of the other parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.llm.common import annotated, code_points, letter_table, pieces, texts_of

SIZE = 4096              # hashed trigrams
SAMPLE_ROWS = 4000       # labelled rows the model is fitted on, shared by the languages
CENTROIDS = 4
ROUNDS = 12
MARGIN = 0.7             # of the cosine that nearly all of the sample reaches at a size
RARE = 0.01              # share of the sample below that cosine
BROAD = 0.1              # least share of its language's texts for a centroid to admit others
PARTS = 4                # of the sample, each measured by centroids of the others
UNKNOWN = "und"
SHORT_LEAST = 0.05       # asked of texts under 64 different trigrams of a size that the sample lacks
_LENGTHS = 24            # powers of two of a text's different trigrams
_SHORT = 6


def counts(texts: list[str]) -> np.ndarray:
    """Trigram counts of each text (a row of ``SIZE``): letters in lower case, all else as one gap."""
    if not texts:
        return np.zeros((0, SIZE))
    points = code_points("".join([f" {t.lower()}  " for t in texts]))
    sizes = np.fromiter((len(t.lower()) + 3 for t in texts), np.int64, len(texts))
    letter = letter_table()[points]
    row = np.repeat(np.arange(len(texts)), sizes)
    keep = letter.copy()
    keep[1:] |= letter[:-1]              # the first gap after a letter
    keep[np.cumsum(sizes) - sizes] = True
    c = np.where(letter, points, 32)[keep].astype(np.uint32)
    row = row[keep]
    code = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(
        0xC2B2AE3D)
    code ^= code >> np.uint32(15)
    same = (row[2:] == row[:-2]) & (c[1:-1] != 32)
    cell = row[:-2] * SIZE + (code % SIZE).astype(np.int64)
    return np.bincount(cell[same], minlength=len(texts) * SIZE).reshape(len(texts), SIZE)


def _length(number: np.ndarray) -> np.ndarray:
    """The power of two of each row's different trigrams: repeated ones say nothing new."""
    different = np.maximum((number > 0).sum(axis=1), 1)
    return np.minimum(np.log2(different).astype(int), _LENGTHS - 1)


@dataclass
class Model:
    """Centroids with their languages, weights of the trigrams, least cosines by size.

    A ``broad`` centroid has many of its language's texts. The others, of texts that hold a
    second language or much junk, name languages but admit no text.
    """

    languages: list[str]
    centroids: np.ndarray
    weights: np.ndarray
    least: np.ndarray
    broad: np.ndarray

    def vectors(self, number: np.ndarray) -> np.ndarray:
        v = np.log1p(number).astype(np.float32) * self.weights
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
        return v / np.maximum(norm, np.float32(1e-12))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        number = counts(texts)
        total = number.sum(axis=1)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        cosine = self.vectors(number) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1).astype(float)
        far = cosine[:, self.broad].max(axis=1) < self.least[_length(number)]
        none = total == 0
        names = [UNKNOWN if n else self.languages[b] for n, b in zip(none, best)]
        return names, np.where(none, 0.0, score).tolist(), (far | none).tolist()


def _clustered(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``CENTROIDS`` unit centroids, and which are broad.

    They start at texts of evenly spread likeness to the mean.

    A centroid with under one in a hundred of the texts is an outlier's and is left out.
    """
    ranked = np.argsort(vectors @ vectors.mean(axis=0), kind="stable")
    number = min(CENTROIDS, len(vectors))
    centres = vectors[ranked[[(2 * i + 1) * len(ranked) // (2 * number) for i in range(number)]]]
    for _ in range(ROUNDS):
        own = (vectors @ centres.T).argmax(axis=1)
        centres = np.stack([vectors[own == k].mean(axis=0) if (own == k).any() else c
                            for k, c in enumerate(centres)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    members = np.bincount((vectors @ centres.T).argmax(axis=1), minlength=len(centres))
    kept = members > len(vectors) / 100
    return centres[kept], (members >= min(BROAD * len(vectors), members.max()))[kept]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not held out, nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame) -> DataFrame:
    """About ``SAMPLE_ROWS`` different labelled rows in all, evenly by language, by digest.

    Each language has at least about one row, so the bound on rows is the only one on languages
    (those with most rows come first). A row is taken by its id and text, and equal rows once:
    rows of a repeated id are not taken together.
    """
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                        & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(SAMPLE_ROWS)
    found = sizes.agg(F.count(F.lit(1))).first()[0]
    each = max(1, SAMPLE_ROWS // max(1, found))
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id"), F.col("text")), F.lit(1 << 40)
                   ) / float(1 << 40)
    # At most SAMPLE_ROWS names and numbers.
    return usable.join(F.broadcast(sizes), "lang").where(
        place < F.lit(float(each)) / F.col("n")).drop("n").dropDuplicates(["doc_id", "text", "lang"])


def fit(docs: DataFrame) -> Model:
    """A model from texts and languages of ``docs`` (doc_id, text, lang) that are not held out.

    Rows without id, text, language or letters teach nothing. Without any usable row the model
    knows no language and rejects everything.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 20):
            number = counts(texts_of(batch))
            cells = [np.flatnonzero(row) for row in number]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("doc_id"),
                 pa.array([c.astype("<u2").tobytes() for c in cells], pa.binary()),
                 pa.array([row[c].astype("<u4").tobytes() for row, c in zip(number, cells)],
                          pa.binary())], ["lang", "doc_id", "cells", "numbers"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang"))
    rows = [r for r in _sample(chosen).mapInArrow(
        run, "lang string, doc_id long, cells binary, numbers binary").collect() if r["cells"]]
    rows.sort(key=lambda r: (r["lang"], r["doc_id"], bytes(r["cells"]), bytes(r["numbers"])))
    number = np.zeros((len(rows), SIZE), np.float32)
    for i, r in enumerate(rows):
        number[i, np.frombuffer(r["cells"], "<u2")] = np.frombuffer(r["numbers"], "<u4")
    return learned(np.array([r["lang"] for r in rows], dtype=object), number)


def learned(langs: np.ndarray, number: np.ndarray) -> Model:
    """The model of texts with these languages and trigram counts."""
    weights = (np.log((1 + len(langs)) / (1 + (number > 0).sum(axis=0))) + 1).astype(np.float32)
    model = Model([], np.zeros((0, SIZE), np.float32), weights, np.zeros(_LENGTHS),
                  np.zeros(0, bool))
    vectors = model.vectors(number)
    centres, names, broad, cosine = [], [], [], np.ones(len(langs))
    for lang in sorted(set(langs)):
        own = np.flatnonzero(langs == lang)
        found, wide = _clustered(vectors[own])
        centres.append(found)
        names += [lang] * len(found)
        broad.append(wide)
        part = np.arange(len(own)) % PARTS
        for p in range(PARTS):
            here, others = own[part == p], own[part != p]
            near, wide = _clustered(vectors[others]) if len(others) else (found, wide)
            cosine[here] = (vectors[here] @ near[wide].T).max(axis=1)
    if not names:
        return model
    least, length = np.ones(_LENGTHS), _length(number)
    for b in range(_LENGTHS):
        near = cosine[np.abs(length - b) <= 1]
        if 0 < len(near) < 1 / RARE:     # so few do not show what is rare among them
            for low in range(b - 2, -1, -1):
                near = cosine[(length >= low) & (length <= b + 1)]
                if len(near) >= 1 / RARE:
                    break
        least[b] = MARGIN * np.quantile(near, RARE) if len(near) else 1.0    # 1: nothing seen
    # Sizes that the sample lacks go by the next smaller; short ones must reach very little.
    for b in range(_LENGTHS):
        if least[b] == 1.0:
            least[b] = SHORT_LEAST if b < _SHORT else least[b - 1]
    return Model(names, np.concatenate(centres).astype(np.float32), weights, least,
                 np.concatenate(broad))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """Column ``row`` with the whole row, ``lang_pred``, ``score`` (cosine) and ``rejected``.

    A null text and one without letters are ``und`` with score 0 and rejected. Every row has
    one result, also repeated rows and those with a null id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run():
        own = shared.value

        def make(texts: list[str]):
            names, scores, far = [], [], []
            for at in range(0, len(texts), 256):
                for to, part in zip((names, scores, far), own.predict(texts[at:at + 256])):
                    to += part
            return pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(
                far, pa.bool_())

        return make

    return annotated(docs, run, "lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of each row, by a model of the same table."""
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return predicted(narrow, fit(docs)).select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"),
        "lang_pred", "score", "rejected")
