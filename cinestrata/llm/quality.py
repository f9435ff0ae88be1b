"""Document quality by base rules and a learned decision list.

The statistics of a text are plain column expressions. From a bounded sample of labelled rows
sequential covering learns an ordered list of rules for bad documents: a rule grows by the
threshold condition that separates best, is pruned on rows kept apart, and is accepted only if
it is nearly always right there. The list becomes one conditional expression over the
statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.llm.common import SPACES, WORD, bound, narrowed, words

WINDOW = 5               # words of a repeated window
LEAST_WORDS = 10
SAMPLE_ROWS = 8000       # labelled rows that the rules are learned from
CUTS = 24                # thresholds tried per statistic
RULES = 8
CONDITIONS = 3
RIGHT = 0.97             # least share of bad documents among those a rule catches
COVER = 5                # least number of bad documents that a rule catches
# Statistics the rules may use.
RATES = ("n_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate",
         "digit_rate", "stop_rate", "type_rate", "bar_rate", "bang_rate", "line_words")


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts and the rates of ``RATES`` of each text, null as no word."""
    rows = narrowed(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", words(F.col("text")).alias("words"))
    n = F.size("words")
    # Hashes of all windows of five words; position i is that of window i.
    windows = F.when(n >= WINDOW, bound(F.col("words"), lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))))
    rows = rows.select("*", windows.alias("windows"))
    has_word = F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    rows = rows.select("*", has_word.alias("lines"))
    repeated = F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
                      _repeated(F.col("windows"))).otherwise(F.lit(0))
    counted = rows.select(
        "doc_id", n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACES + "+", "")).cast("long").alias("word_chars"),
        _count("[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"), _count(r"\p{Lu}").alias("n_upper"),
        _count("[0-9]").alias("n_digits"), _count(r"\|").alias("n_bars"),
        _count("!").alias("n_bangs"),
        F.size(F.filter("words", lambda w: F.length(w) <= 3)).alias("n_short"),
        F.size(F.array_distinct("words")).alias("n_types"))
    chars, number = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("word_chars") / number).alias("mean_word"),
        (F.col("n_symbols") / chars).alias("symbol_rate"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_rate"),
        (F.col("n_repeat_words") / number).alias("repeat_rate"),
        (F.col("n_upper") / chars).alias("upper_rate"),
        (F.col("n_digits") / chars).alias("digit_rate"),
        (F.col("n_short") / number).alias("stop_rate"),
        (F.col("n_types") / number).alias("type_rate"),
        (F.col("n_bars") / number).alias("bar_rate"),
        (F.col("n_bangs") / number).alias("bang_rate"),
        (number / F.greatest("n_lines", F.lit(1))).alias("line_words"))


def _count(pattern: str) -> Column:
    return F.regexp_count("text", F.lit(pattern)).cast("long")


def _repeated(windows: Column) -> Column:
    """Words that lie in a window which occurs at least twice.

    Sorted pairs of hash and position bring equal windows together. Covered words add up over
    the positions in order: five for each, fewer where the next one begins within it.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(p: Column) -> Column:
        return F.array_sort(F.transform(F.filter(F.transform(
            p, lambda x, k: F.struct(x["i"].alias("i"), (
                F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
            lambda x: x["twice"]), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(
            F.get(at, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda s, x: s + x)

    return bound(bound(pairs, again), covered)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def holds(self, value: float) -> bool:
        return value >= self.cut if self.above else value < self.cut

    def column(self) -> Column:
        return F.col(self.name) >= self.cut if self.above else F.col(self.name) < self.cut

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.cut:g}"


Rule = tuple[Condition, ...]
Rows = Sequence[tuple[dict[str, float], bool]]    # statistics, bad


def _caught(rows: Rows, rule: Rule) -> Rows:
    return [r for r in rows if all(c.holds(r[0][c.name]) for c in rule)]


def _bad(rows: Rows) -> int:
    return sum(bad for _, bad in rows)


def _candidates(rows: Rows) -> list[Condition]:
    """Thresholds between neighbouring values at even ranks of each statistic."""
    out = []
    for name in RATES:
        values = sorted({r[0][name] for r in rows})
        gaps = len(values) - 1
        picked = sorted({round(k * gaps / CUTS) for k in range(1, CUTS + 1)} - {0}) if gaps else []
        for k in picked:
            cut = (values[k - 1] + values[k]) / 2
            out += [Condition(name, True, cut), Condition(name, False, cut)]
    return out


def _grown(rows: Rows) -> Rule:
    """Adds the condition of highest gain until only bad rows are left or none helps."""
    rule, left = (), rows
    while len(rule) < CONDITIONS:
        bad = _bad(left)
        if not bad or bad == len(left):
            break
        before, best, chosen = math.log2(bad / len(left)), 0.0, None
        for c in _candidates(left):
            caught = [r[1] for r in left if c.holds(r[0][c.name])]
            hit = sum(caught)
            gain = hit * (math.log2(hit / len(caught)) - before) if hit else 0.0
            if gain > best + 1e-9:
                best, chosen = gain, c
        if chosen is None:
            break
        rule += (chosen,)
        left = _caught(left, (chosen,))
    return rule


def _worth(rows: Rows, rule: Rule) -> float:
    caught = _caught(rows, rule)
    return (2 * _bad(caught) - len(caught)) / len(caught) if caught else -1.0


def _pruned(rows: Rows, rule: Rule) -> Rule:
    """Cuts conditions off the end while the kept-apart rows judge the rest at least as good."""
    while len(rule) > 1 and _worth(rows, rule[:-1]) >= _worth(rows, rule):
        rule = rule[:-1]
    return rule


def learned(rows: Rows) -> list[Rule]:
    """An ordered list of rules for bad rows by sequential covering.

    Two of three rows grow a rule, the third prunes it. A rule must catch enough bad rows and
    few others on either part, else learning ends. What it catches is taken out before the
    next one. Rows count in the given order; without bad or good rows there is no rule.
    """
    grow, prune, rules = [r for i, r in enumerate(rows) if i % 3], list(rows[::3]), []
    while len(rules) < RULES and _bad(grow):
        whole = _grown(grow)
        rule = next((r for r in (_pruned(prune, whole), whole) if r and all(
            _bad(caught := _caught(part, r)) >= max(least, RIGHT * len(caught))
            for part, least in ((grow, COVER), (prune, COVER // 2)))), None)
        if rule is None:
            break
        rules.append(rule)
        grow, prune = ([r for r in part if not all(c.holds(r[0][c.name]) for c in rule)]
                       for part in (grow, prune))
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """The number of the first rule that catches a row, 0 if none does."""
    chain = None
    for i, rule in enumerate(rules, 1):
        met = F.lit(True)
        for c in rule:
            met = met & c.column()
        chain = F.when(met, F.lit(i)) if chain is None else chain.when(met, F.lit(i))
    return F.lit(0) if chain is None else chain.otherwise(F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from about ``rows`` labelled documents (quality 0 is bad), chosen by digest of the id.

    Labels without id or quality and documents without a label teach nothing; an id labelled
    several times counts with its lowest quality.
    """
    told = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("quality").cast("int").alias("quality"))
            .where("doc_id is not null and quality is not null")
            .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    total = told.count()
    place = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    kept = told if total <= rows else told.where(place < rows / total)
    narrow = narrowed(docs, doc_id="long", text="string")
    # The chosen labels are about ``rows`` numbers, so they may be broadcast to the documents.
    chosen = statistics(narrow.join(F.broadcast(kept.select("doc_id")), "doc_id", "left_semi"))
    found = chosen.join(F.broadcast(kept), "doc_id").orderBy(
        F.xxhash64(F.lit("order"), "doc_id"), *RATES).collect()
    return learned([({name: float(r[name]) for name in RATES}, r["quality"] == 0) for r in found])


def judged(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Each row's base counts, ``base_failed``, ``rule`` (that rejects it, or 0) and ``kept``.

    A null text has no word and fails the base rules, an empty one too. Repeated rows and rows
    without an id are judged like any other.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = statistics(docs).select("*", failed.alias("base_failed"), verdict(rules).alias("rule"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
