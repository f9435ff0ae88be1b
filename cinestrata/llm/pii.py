"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes.

The patterns find well-formed addresses and numbers. The random field learns, from a small
labelled table of words, how their shapes and those of their neighbours go with kinds of
personal data, and adds spans that no pattern matches: an address with a spaced or bracketed
at sign, a phone number without plus sign, a card or IP address with other separators. The table
has such forms beside the corpus's own sequences: hits of the patterns written in other ways.
Numbers that the patterns refuse, as cards with a wrong digit, are its negatives. It is trained by gradient steps on the exact likelihood and
decoded by Viterbi, both in numpy over many sequences at once. A sequence is a stretch of
words around those with a digit or an at sign (also "at" in brackets); words far from any such word carry nothing
that its features could see and are outside by definition.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.llm.common import annotated, narrowed, pieces, texts_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *(f"{part}-{k}" for k in KINDS for part in ("first", "next")))
SAMPLE_ROWS = 1500       # documents whose sequences the field is trained on
AROUND = 2               # words beside a word with a digit or @ that belong to its sequence
LONGEST = 64             # words of a sequence; longer stretches are cut after so many
BESIDE = 12              # words that a cut stretch sees on both sides when it is decoded
DECODED = 2048           # pieces of stretches that are decoded at once
WORD_LONGEST = 200       # sequences with longer words are no training rows
RUNS = 12                # runs of characters that a long word's shape has of its begin and its end
ROUNDS = 120
REWRITTEN = 480          # sequences with hits whose other forms are added, evenly by kind
CERTAIN = 0.9            # share of decoded words of a shape that must be of the kind in training

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NUMBER = re.compile(r"[0-9]+d")
_TRIGGER = re.compile(r"[0-9@]|[(\[](?:at|AT)[)\]]")

Span = tuple[int, int, int]    # start, index of the kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; time stays linear, since each at sign looks back to the last match at most."""
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at += 1


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, in order of start and then of kind."""
    out = [(a, 0, b) for a, b in emails(text)]
    if not _TRIGGER.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _run(word: str, at: int, step: int) -> tuple[int, str]:
    """The end of the run that begins at ``at``, going on by ``step``, and its sign."""
    c, to, n = word[at], at + step, len(word)
    if "0" <= c <= "9":
        while 0 <= to < n and "0" <= word[to] <= "9":
            to += step
        return to, f"{min(abs(to - at), 20)}d"
    if c.isalpha():
        while 0 <= to < n and word[to].isalpha():
            to += step
        return to, "a"
    while 0 <= to < n and word[to] == c:
        to += step
    return to, c


def shape(word: str) -> str:
    """A word as classes of characters: runs of letters as one sign, of digits by their number.

    A word of over ``2 * RUNS`` runs shows as many of its begin and of its end, with a tilde
    between them.
    """
    out, at = [], 0
    while at < len(word) and len(out) <= 2 * RUNS:
        at, sign = _run(word, at, 1)
        out.append(sign)
    if len(out) <= 2 * RUNS:
        return "".join(out)
    ending, at = [], len(word) - 1
    while len(ending) < RUNS:
        at, sign = _run(word, at, -1)
        ending.append(sign)
    return "".join(out[:RUNS] + ["~"] + ending[::-1])


def features(word: str) -> list[str]:
    """What the field sees of a word: its shape, kind of ends, digits and signs."""
    digits = sum("0" <= c <= "9" for c in word)
    core = word.strip("!#$%&*.,;:?\"'|")
    form = shape(core)
    out = [f"shape={form}", "signs=" + _NUMBER.sub("d", form), f"digits={min(digits, 20)}", f"first={shape(word[:1])}",
           f"last={shape(word[-1:])}"]
    out += [f"has={c}" for c in "@.+-()=:/\"" if c in core]
    if digits and not any(c.isalpha() for c in word):
        out.append("only numbers")
    return out


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Stretches of words (start, end) around each word with a digit or @, however long."""
    if not _TRIGGER.search(text):
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    hits, w = [], 0
    ends = np.array([b for _, b in words])
    marks = np.unique(np.searchsorted(ends, [m.start() for m in _TRIGGER.finditer(text)], "right"))
    out, at = [], -1
    for w in marks.tolist():
        first, last = max(0, w - AROUND), min(len(words), w + AROUND + 1)
        if out and first <= at:
            hits.extend(words[at:last])
        else:
            hits = words[first:last]
            out.append(hits)
        at = max(at, last)
    return out


def reach_of(spans: list[Span]) -> list[int]:
    """How far the spans up to each one reach; spans are in ascending order but may overlap."""
    return list(accumulate((end for _, _, end in spans), max))


def overlapping(spans: list[Span], reach: list[int], start: int, end: int) -> Iterator[Span]:
    """The spans that share a character with the stretch, found by bisection."""
    for i in range(bisect_right(reach, start), len(spans)):
        if spans[i][0] >= end:
            return
        if spans[i][2] > start:
            yield spans[i]


def labels_of(words: list[tuple[int, int]], spans: list[Span],
              reach: list[int] | None = None) -> list[int]:
    """The label of each word of a sequence under the given spans; the first span on it counts."""
    reach = reach_of(spans) if reach is None else reach
    out = []
    for a, b in words:
        hit = next(overlapping(spans, reach, a, b), None)
        out.append(0 if hit is None else 1 + 2 * hit[1] + (hit[0] < a))
    return out


def _other_forms(kind: int, hit: str) -> list[str]:
    """Ways to write a hit of a pattern that no pattern matches."""
    digits = "".join(c for c in hit if "0" <= c <= "9")
    if kind == 0:
        name, host = hit.rsplit("@", 1)
        plain = [re.sub("[0-9]+", "", part).strip(".") for part in (name, host)]
        return [f"{a}{at}{b}" for at in (" @ ", "(at)", "[at]", " (at) ", " [at] ", "(@)", "[@]")
                for a, b in ((name, host), plain)]
    if kind == 1:
        return [hit.replace(".", dot) for dot in ("[.]", "(.)", " . ")]
    if kind == 2:
        fours = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [gap.join(fours) for gap in (".", "/", "_", "  ", " - ")]
    area, mid, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [f"({area}) {mid}-{last}", f"({area}) {mid} {last}", f"{area}-{mid}-{last}",
            f"{area}.{mid}.{last}", f"00{digits[:-10]} {area} {mid} {last}"]


def _decoys(digits: str) -> list[str]:
    """Things with digits or an at sign that are no personal data."""
    d = (digits + "2019104538761230")[:16]
    return [f"{d[:4]}-{d[4:6]}-{d[6:8]}", f"{d[:2]}/{d[2:4]}/{d[4:8]}", f"{d[:2]}.{d[2:4]}.{d[4:8]}",
            f"{d[:2]}:{d[2:4]}", f"{d[:2]}:{d[2:4]}:{d[4:6]}", f"{d[:3]},{d[3:6]}", f"{d[:3]}.{d[3:5]}",
            f"{d[:4]} - {d[4:8]}", f"{d[:4]}-{d[4:8]}", f"{d[0]}.{d[1:3]}.{d[3]}", d[:7], d[:10], d[:12],
            f"({d[:4]})", f"({d[:3]})", f"{d[:3]} {d[3:6]}", "@name", f"@name{d[:2]}", "(at)", f"@ {d[:2]}"]


def rewritten(rows: list[tuple[list[str], list[int]]], most: int = REWRITTEN,
              left_out: Callable[[int], bool] = lambda form: False
              ) -> list[tuple[list[str], list[int]]]:
    """Sequences with other forms of their hits, at most about ``most`` of them, evenly by kind.

    The words around a hit stay. Forms that a pattern still matches are left out, and those
    whose number within the kind is ``left_out``. Each sequence is followed by one with a decoy
    in place of the hit.
    """
    out, taken = [], [0] * len(KINDS)
    for words, labels in sorted((list(w), list(y)) for w, y in rows if any(y)):
        at = 0
        while at < len(words):
            last = at
            if labels[at] == 0:
                at += 1
                continue
            kind = (labels[at] - 1) // 2
            while last + 1 < len(words) and labels[last + 1] == 2 + 2 * kind:
                last += 1
            before, whole, after = words[:at], " ".join(words[at:last + 1]), words[last + 1:]
            before_labels, after_labels = labels[:at], labels[last + 1:]
            at = last + 1
            hits = [(a, b) for a, k, b in base_spans(whole) if k == kind]
            if taken[kind] >= most // len(KINDS) or len(hits) != 1:
                continue
            a, b = hits[0]
            # One sequence gives one form after another, so that every form has its share.
            forms = [f for i, f in enumerate(_other_forms(kind, whole[a:b])) if not left_out(i)]
            form = forms[taken[kind] % len(forms)]
            decoys = _decoys(re.sub("[^0-9]", "", whole[a:b]))
            decoy = decoys[sum(taken) % len(decoys)].split(" ")
            taken[kind] += 1
            out.append((before + decoy + after, before_labels + [0] * len(decoy) + after_labels))
            new = _WORD.findall(whole[:a] + form + whole[b:])
            if not base_spans(" ".join(new)):
                out.append((before + new + after, before_labels + [1 + 2 * kind] + [
                    2 + 2 * kind] * (len(new) - 1) + after_labels))
    return out


@dataclass
class Field:
    """Weights of features and of label pairs; ``trusted`` kinds of each shape seen in training."""

    names: dict[str, int] = field(default_factory=dict)
    emit: np.ndarray = field(default_factory=lambda: np.zeros((0, len(LABELS))))
    step: np.ndarray = field(default_factory=lambda: np.zeros((len(LABELS), len(LABELS))))
    trusted: dict[tuple[int, str], bool] = field(default_factory=dict)

    def scores(self, batch: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Label scores of each word, padded to the longest sequence, and the lengths."""
        sizes = np.array([len(s) for s in batch])
        out = np.zeros((len(batch), sizes.max(initial=0), len(LABELS)))
        for i, words in enumerate(batch):
            for j, seen in enumerate(_seen(words)):
                ids = [self.names[f] for f in seen if f in self.names]
                if ids:
                    out[i, j] = self.emit[ids].sum(axis=0)
        return out, sizes

    def labels(self, stretches: list[list[str]]) -> list[list[int]]:
        """The labels of stretches of any length.

        A long one is cut into overlapping pieces, and a word has the label of the piece in which
        it lies inside. Pieces are decoded in batches of bounded size.
        """
        cut = [(i, max(0, at - BESIDE), at) for i, s in enumerate(stretches)
               for at in range(0, len(s), LONGEST)]
        out: list[list[int]] = [[] for _ in stretches]
        for first in range(0, len(cut), DECODED):
            some = cut[first:first + DECODED]
            told = self.decode([stretches[i][a:at + LONGEST + BESIDE] for i, a, at in some])
            for (i, a, at), labels in zip(some, told):
                out[i] += labels[at - a:at - a + LONGEST]
        return out

    def decode(self, batch: list[list[str]]) -> list[list[int]]:
        """The best label sequence of each list of words: Viterbi over the whole batch at once."""
        if not batch or not self.names:
            return [[0] * len(words) for words in batch]
        emit, sizes = self.scores(batch)
        best, back = emit[:, 0], np.zeros(emit.shape, np.int8)
        for t in range(1, emit.shape[1]):
            reach = best[:, :, None] + self.step[None]
            back[:, t] = reach.argmax(axis=1)
            best = np.where((t < sizes)[:, None], reach.max(axis=1) + emit[:, t], best)
        label, out = best.argmax(axis=1), np.zeros(emit.shape[:2], int)
        for t in range(emit.shape[1] - 1, -1, -1):
            inside = t < sizes
            out[:, t] = np.where(inside, label, 0)
            if t:
                label = np.where(inside, back[np.arange(len(batch)), t, label], label)
        return [row[:n].tolist() for row, n in zip(out, sizes)]


def _seen(words: list[str]) -> list[list[str]]:
    """Features of each word with the shapes beside it."""
    shapes = [shape(w) for w in words]
    out = []
    for i, w in enumerate(words):
        before = shapes[i - 1] if i else "edge"
        after = shapes[i + 1] if i + 1 < len(words) else "edge"
        out.append(features(w) + ["before=" + before, "after=" + after,
                                  f"to={before} {shapes[i]}", f"from={shapes[i]} {after}"])
    return out


def trained(rows: list[tuple[list[str], list[int]]], rounds: int = ROUNDS,
            penalty: float = 1e-3) -> Field:
    """A field fitted to sequences of words and their labels by the exact likelihood.

    Forward and backward sums run over all sequences at once; steps are scaled by moments of
    the gradient. The result depends on nothing but the rows, in any order.
    """
    rows = sorted((list(w), list(y)) for w, y in rows if w)
    if not rows or not any(any(y) for _, y in rows):
        return Field()
    seen = [_seen(w) for w, _ in rows]
    names = {f: i for i, f in enumerate(sorted({f for s in seen for w in s for f in w}))}
    n, k = len(rows), len(LABELS)
    sizes = np.array([len(w) for w, _ in rows])
    width = sizes.max()
    ids = np.array([names[f] for s in seen for w in s for f in w])
    cells = np.array([i * width + j for i, s in enumerate(seen) for j, w in enumerate(s)
                      for _ in w])
    inside = np.arange(width)[None] < sizes[:, None]
    gold = np.zeros((n, width), int)
    for i, (_, y) in enumerate(rows):
        gold[i, :len(y)] = y
    one = np.eye(k)[gold] * inside[:, :, None]
    pairs = np.einsum("nta,ntb->ab", one[:, :-1], one[:, 1:])

    def gathered(cell_values: np.ndarray) -> np.ndarray:
        flat = cell_values.reshape(-1, k)[cells]
        return np.stack([np.bincount(ids, flat[:, c], len(names)) for c in range(k)], axis=1)

    target = gathered(one)
    emit, step = np.zeros((len(names), k)), np.zeros((k, k))
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(step), np.zeros_like(step)]
    for r in range(1, rounds + 1):
        score = np.stack([np.bincount(cells, emit[ids, c], n * width) for c in range(k)],
                         axis=1).reshape(n, width, k)
        peak = score.max(axis=2, keepdims=True)
        e, s = np.exp(score - peak), np.exp(step)
        forward, scale = np.zeros_like(e), np.ones((n, width))
        for t in range(width):
            a = e[:, t] if t == 0 else (forward[:, t - 1] @ s) * e[:, t]
            total = a.sum(axis=1)
            scale[:, t] = total
            forward[:, t] = a / total[:, None]
        backward = np.ones_like(e)
        for t in range(width - 2, -1, -1):
            b = ((backward[:, t + 1] * e[:, t + 1]) @ s.T) / scale[:, t + 1, None]
            backward[:, t] = np.where(inside[:, t + 1, None], b, 1.0)
        single = forward * backward * inside[:, :, None]
        right = backward[:, 1:] * e[:, 1:] / scale[:, 1:, None] * inside[:, 1:, None]
        double = np.einsum("nta,ntb->ab", forward[:, :-1], right) * s
        for at, (w, g) in enumerate(((emit, target - gathered(single)), (step, pairs - double))):
            g = g / n - penalty * w
            first, second = moments[2 * at], moments[2 * at + 1]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            w += 0.2 * (first / (1 - 0.9 ** r)) / (np.sqrt(second / (1 - 0.99 ** r)) + 1e-8)
    model = Field(names, emit, step)
    right, told = {}, {}
    for (words, labels), guess in zip(rows, model.decode([w for w, _ in rows])):
        for w, y, g in zip(words, labels, guess):
            if g:
                key = ((g - 1) // 2, shape(w))
                told[key] = told.get(key, 0) + 1
                right[key] = right.get(key, 0) + (y > 0 and (y - 1) // 2 == key[0])
    model.trusted = {key: right[key] >= CERTAIN * n for key, n in told.items()}
    return model


def added_spans(texts: list[str], base: list[list[Span]], model: Field) -> list[list[Span]]:
    """Spans that the field finds beside those of the patterns, none overlapping one of them.

    A span starts at a letter, digit, plus sign or a bracket that closes within, and ends at a letter
    or digit of its words. Shapes that the field
    got wrong in training too often are left out.
    """
    found: list[list[Span]] = [[] for _ in texts]
    if not model.names:
        return found
    where = [(i, s) for i, t in enumerate(texts) for s in sequences(t)]
    words = [[texts[i][a:b] for a, b in s] for i, s in where]
    reach = [reach_of(b) for b in base]
    for (i, spots), ws, labels in zip(where, words, model.labels(words)):
        at = 0
        while at < len(labels):
            kind, last = (labels[at] - 1) // 2, at
            if labels[at] == 0:
                at += 1
                continue
            while last + 1 < len(labels) and labels[last + 1] == 2 + 2 * kind:
                last += 1
            sure = all(model.trusted.get((kind, shape(w)), True) for w in ws[at:last + 1])
            start, end = spots[at][0], spots[last][1]
            at = last + 1
            text = texts[i]
            while start < end and not text[end - 1].isalnum():
                end -= 1
            while start < end and not (text[start].isalnum() or text[start] == "+" or (
                    text[start] == "(" and ")" in text[start:end])):
                start += 1
            whole = text[start:end]
            if sure and start < end and _TRIGGER.search(whole) and next(
                    overlapping(base[i], reach[i], start, end), None) is None:
                found[i].append((start, kind, end))
    return found


def labelled_sequences(docs: DataFrame) -> DataFrame:
    """``words, labels``: the labelled table that the patterns make of ``docs`` (doc_id, text).

    Stretches are cut after ``LONGEST`` words; rows with a word of over ``WORD_LONGEST``
    characters are left out, which bounds what training collects.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words, labels = [], []
            for text in texts_of(batch):
                spans = base_spans(text)
                reach = reach_of(spans)
                for stretch in sequences(text):
                    for i in range(0, len(stretch), LONGEST):
                        s = stretch[i:i + LONGEST]
                        if max(b - a for a, b in s) <= WORD_LONGEST:
                            words.append([text[a:b] for a, b in s])
                            labels.append(labels_of(s, spans, reach))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.int32()))],
                ["words", "labels"])

    return narrowed(docs, text="string").mapInArrow(run, "words array<string>, labels array<int>")


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS,
        left_out: Callable[[int], bool] = lambda form: False) -> Field:
    """A field from a labelled table (words, labels), of which about ``rows`` rows are taken by digest.

    Equal rows count once, so a frequent sequence is no more than one of them. The table is small
    by contract; ``labelled_sequences`` of a sample of documents makes one.
    """
    labelled = labelled.select("words", "labels").distinct()
    total = labelled.count()
    place = F.pmod(F.xxhash64("words"), F.lit(1 << 30)) / float(1 << 30)
    kept = labelled if total <= rows else labelled.where(place < rows / total)
    own = [(r["words"], r["labels"]) for r in kept.collect()]
    return trained(own + rewritten(own, left_out=left_out))


def sampled(docs: DataFrame, documents: int = 20_000) -> DataFrame:
    """About ``documents`` rows of ``docs`` by digest of id and text, as material for labels."""
    total = docs.count()
    place = F.pmod(F.xxhash64(F.lit("labels"), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return docs if total <= documents else docs.where(place < documents / total)


def _found(model: Field):
    def find(texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
        base = [base_spans(t) for t in texts]
        return base, added_spans(texts, base, model)

    return find


def detected(docs: DataFrame, model: Field) -> DataFrame:
    """Column ``row``, and ``base`` and ``spans`` (kind:start:end, comma-joined), counts by kind.

    A null or empty text has none. Spans count code points, their end is exclusive. Every row
    has one result, repeated rows too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run():
        find = _found(shared.value)

        def make(texts: list[str]):
            base, more = find(texts)
            numbers = [pa.array([sum(k == kind for _, k, _ in b) for b in base], pa.int64())
                       for kind in range(len(KINDS))]
            return [pa.array([spelled(b) for b in base], pa.string()),
                    pa.array([spelled(sorted(b + m)) for b, m in zip(base, more)], pa.string()),
                    *numbers]

        return make

    return annotated(docs, run, "base string, spans string, " + ", ".join(
        f"n_{k} long" for k in KINDS))


def masked(docs: DataFrame, model: Field) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets.

    A column ``n_chars`` follows the new text. Texts without a span, null ones included, stay
    as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run():
        find = _found(shared.value)

        def make(texts: list[str]):
            out = []
            for text, base, more in zip(texts, *find(texts)):
                parts, at = [], 0
                for a, kind, b in sorted(base + more):
                    if a >= at:
                        parts += [text[at:a], f"[{KINDS[kind].upper()}]"]
                    at = max(at, b)
                out.append("".join(parts) + text[at:] if parts else None)
            return [pa.array(out, pa.string())]

        return make

    new = F.col("masked")

    def column(name: str) -> Column:
        old = F.col("row").getField(name)
        if name == "text":
            return F.coalesce(new, old).alias(name)
        if name == "n_chars":
            return F.when(new.isNotNull(), F.length(new).cast(docs.schema[name].dataType)
                          ).otherwise(old).alias(name)
        return old.alias(name)

    return annotated(docs, run, "masked string").select(*[column(c) for c in docs.columns])


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256``, ``spans`` of each row of ``docs``.

    The field is trained on a sample of the same table, labelled by the patterns.
    """
    rows = narrowed(docs, doc_id="long", text="string")
    model = fit(labelled_sequences(sampled(rows)))
    return detected(rows, model).select(
        F.col("row.doc_id").alias("doc_id"), *[f"n_{k}" for k in KINDS],
        F.sha2("base", 256).alias("base_sha256"), "spans")
