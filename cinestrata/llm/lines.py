"""Lines that many documents repeat: hashed, counted by document, dropped and put together again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cinestrata.llm.common import bound
from cinestrata.session import materialised

LEAST_CHARS = 20
LEAST_DOCS = 3
# A key held by more than one in so many of the counted pairs is joined by broadcast; there are
# at most that many such keys.
HOT_KEYS = 1000

_STRIPPED = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hashes(value: Column, first: str, second: str) -> list[Column]:
    """128 bits of a text as two numbers."""
    return [F.xxhash64(value).alias(first), F.xxhash64(F.lit(1), value).alias(second)]


def _text() -> Column:
    return F.coalesce(F.col("row.text").cast("string"), F.lit(""))


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def hashed_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """``doc_id, m1, m2`` (digest of the text), ``pos, h1, h2`` (digest of the key) by long line.

    The key is the line without white space at its ends and with A to Z in lower case.
    """
    lowered = F.translate(_text(), _UPPER, _LOWER)
    lines = docs.select(F.col("row.doc_id").alias("doc_id"), *_hashes(_text(), "m1", "m2"),
                        F.posexplode(_split(lowered)).alias("pos", "line"))
    key = F.btrim(F.col("line"), F.lit(_STRIPPED))
    return (lines.select("doc_id", "m1", "m2", "pos", key.alias("key"))
            .where(F.char_length("key") >= least_chars)
            .select("doc_id", "m1", "m2", "pos", *_hashes(F.col("key"), "h1", "h2")))


def repeated_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    """``h1, h2, n, last``: keys of enough documents, their number and the largest doc_id.

    Pairs of key and document are made distinct before they are counted by key, and both
    steps combine on the map side, so a key of many documents meets in no task.
    """
    pairs = lines.select("h1", "h2", "doc_id").distinct()
    return (pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"),
                                          F.max("doc_id").alias("last"))
            .where(F.col("n") >= least_docs))


def _dropped(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """``doc_id, m1, m2, positions`` of the lines that go."""
    keys = keys.select("h1", "h2", "n", "last")
    total = keys.agg(F.sum("n")).scalar()
    hot = F.broadcast(keys.where(F.col("n") * HOT_KEYS > total))
    rest = keys.where(F.col("n") * HOT_KEYS <= total)
    found = lines.join(hot, ["h1", "h2"]).unionByName(
        lines.join(hot, ["h1", "h2"], "left_anti").join(rest, ["h1", "h2"]))
    return (found.where(~F.col("doc_id").eqNullSafe(F.col("last")))
            .groupBy("doc_id", "m1", "m2").agg(F.collect_set("pos").alias("positions")))


def without_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS,
                           least_docs: int = LEAST_DOCS) -> DataFrame:
    """``row`` (all columns of ``docs``), ``kept``, ``n_lines``, ``n_dropped`` for each row.

    Texts are cut at every line feed; a null or empty text is one empty line. A key of at least
    ``least_chars`` code points that ``least_docs`` documents hold loses all its lines but those
    of the largest doc_id that holds it. What stays is joined by line feeds in the old order; a
    text that loses every line is empty.

    Documents are doc_ids: rows of one id count as one document and keep or lose a line
    together; rows without an id are one document as well, the smallest. A line that a
    document repeats stays or goes as a whole. Tables may be empty and may have any other
    columns, which pass in ``row``; very long texts are handled whole, their dropped positions
    are an array of the row.

    Only digests of 128 bits are counted and joined. Keys of a thousandth of all pairs or more
    are joined by broadcast (at most a thousand), so the shuffled join has no hot key.
    """
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    lines = materialised(hashed_lines(docs, least_chars), "lines")
    keys = materialised(repeated_keys(lines, least_docs), "repeated-lines")
    gone = _dropped(lines, keys)
    marked = docs.select("row", F.col("row.doc_id").alias("d"), *_hashes(_text(), "t1", "t2"))
    both = marked.join(gone, marked["d"].eqNullSafe(gone["doc_id"])
                       & (marked["t1"] == gone["m1"]) & (marked["t2"] == gone["m2"]), "left")

    def rest_of(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("positions"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    kept = F.when(F.col("positions").isNull(), _text()).otherwise(bound(_split(_text()), rest_of))
    breaks = F.char_length(_text()) - F.char_length(F.replace(_text(), F.lit("\n"), F.lit("")))
    return both.select(
        "row", kept.alias("kept"), (breaks + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_dropped"))
