"""Top-n, deterministic samples and splits.

``orderBy(...).limit(n)`` keeps up to n rows of every input partition and hands them
to one task. That is right for a report, whose n is small. For an n that is part of the
data's own size, the functions here cut the rows first, so that this task gets few more
than n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cinestrata.operators.quantiles import number_bin

# Bytes of a text that one histogram tells apart.
_STEP_BYTES = 2


def top_n(df: DataFrame, order: Sequence[Column], n: int, where: Column | None = None,
          columns: Sequence[str | Column] = ("*",)) -> DataFrame:
    """The first n rows by ``order``, whose last column must be unique; for reports of a few rows."""
    if where is not None:
        df = df.where(where)
    return df.orderBy(*order).limit(n).select(*columns)


def _text_cut(df: DataFrame, key: str, n: int) -> bytes | None:
    """The beginning up to which at least n texts come, or all texts (None), by few more than n.

    A histogram of the next bytes tells in which of them the n-th text lies, and the next one
    looks into that bin only, until it holds at most n texts. Texts far from all others take a
    bin of their own and blur nothing; a histogram has at most 65,793 bins.
    """
    ends = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    lo, hi = (ends["lo"] or "").encode(), (ends["hi"] or "").encode()
    same = next((i for i, (x, y) in enumerate(zip(lo, hi)) if x != y), min(len(lo), len(hi)))
    start, missing = lo[:same], n
    code = F.encode(F.col(key), "utf-8")
    while True:
        keys = df.where(F.col(key).isNotNull()).select(code.alias("code")).where(
            F.substring("code", 1, len(start)) == F.lit(bytearray(start)))
        counts = keys.groupBy(F.substring("code", len(start) + 1, _STEP_BYTES).alias("next")).agg(
            F.count(F.lit(1)).alias("rows"))
        upto = Window.orderBy("next").rowsBetween(Window.unboundedPreceding, 0)
        found = counts.select("next", "rows", F.sum("rows").over(upto).alias("upto")).where(
            F.col("upto") >= missing).orderBy("next").first()
        if found is None:
            return None
        step = bytes(found["next"])
        start, missing = start + step, missing - (found["upto"] - found["rows"])
        if found["rows"] <= n or len(step) < _STEP_BYTES:
            return start


def head_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first n rows by key, missing keys last, for any n.

    Histograms of the keys tell where the n-th row lies; only rows up to it are ordered, at most
    2n of them with text keys unless one key has more rows.
    """
    first = F.col(key).asc_nulls_last()
    if n <= 0:
        return df.limit(0)
    if isinstance(df.schema[key].dataType, T.StringType):
        cut = _text_cut(df, key, n)
        if cut is None:
            return df.orderBy(first).limit(n)
        head = F.substring(F.encode(F.col(key), "utf-8"), 1, len(cut))
        return df.where(head <= F.lit(bytearray(cut))).orderBy(first).limit(n)
    place = number_bin(F.col(key).cast("double"))
    marked = df.withColumn("__bin", F.when(F.col(key).isNull(), F.lit(1 << 62)).otherwise(place))
    upto = Window.orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
    histogram = marked.groupBy("__bin").agg(F.count(F.lit(1)).alias("rows"))
    running = histogram.select("__bin", (F.sum("rows").over(upto) - F.col("rows")).alias("before"))
    last = running.where(F.col("before") < n).agg(F.max("__bin")).scalar()
    return marked.where(F.col("__bin") <= last).orderBy(first).limit(n).drop("__bin")


def digest(key: str, seed: str = "") -> Column:
    """A reproducible random-looking text per row: the md5 of seed and key.

    A missing key counts as empty text, so that samples and splits lose no row.
    """
    value = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(seed), value) if seed else value)


def digest_number(text: Column, digits: int = 8) -> Column:
    """The first hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("bigint")


def sample_n(df: DataFrame, n: int, key: str, seed: str = "") -> DataFrame:
    """Exactly n rows (all, if there are fewer), the same ones on every run.

    Rows are taken in the order of their digest. A histogram of the digests, whose
    bins shrink towards zero in constant proportion, gives the cut that keeps at
    least n rows and about three percent more, however many rows there are.
    """
    bin_of = F.floor(F.log2(F.col("__number") + F.lit(1.0)) * 32).cast("int")
    marked = (df.withColumn("__digest", digest(key, seed))
              .withColumn("__number", digest_number(F.col("__digest"), 13))
              .withColumn("__bin", bin_of))
    upto = Window.orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
    histogram = marked.groupBy("__bin").agg(F.count(F.lit(1)).alias("rows"))
    running = histogram.select("__bin", (F.sum("rows").over(upto) - F.col("rows")).alias("before"))
    last = running.where(F.col("before") < n).agg(F.max("__bin")).scalar()
    kept = marked.where(F.col("__bin") <= last)
    return kept.orderBy("__digest", key).limit(n).drop("__digest", "__number", "__bin")


def bucket(key: str, buckets: int = 100, seed: str = "") -> Column:
    """A stable bucket number per key, the same in every engine with md5."""
    return (digest_number(digest(key, seed)) % buckets).cast("int")


def split(df: DataFrame, key: str, test_pct: int = 33) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key bucket: no shuffle, and a row never changes sides."""
    test = bucket(key) < test_pct
    return df.where(~test), df.where(test)
