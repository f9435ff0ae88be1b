"""License notices by MinHash bands over overlapping text windows.

The words of a text are cut into overlapping windows of ``WINDOW`` shingles. Each band is one
row: the least of the window's shingle hashes under the band's mask. A window and a template
window with Jaccard similarity s agree in at least one of b such bands with probability
1 - (1 - s)^b. A template of up to ``SHORT`` shingles fills too little of a window for that and
is retrieved by each of its shingles. Around the windows that retrieve a template, its share of
shingles that stand within its own length in the text is counted exactly.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cinestrata.llm.common import bound, narrowed

SHINGLE = 3          # words
WINDOW = 6           # shingles of a window
STRIDE = 3           # shingles from one window to the next
BANDS = 16
SHORT = 2            # shingles of a template up to which each of them retrieves it
CONTAINED = 0.8      # least share of a template's shingles

# Public license notices as they stand in files and pages.
TEMPLATES = {
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a "
                      "copy of this software and associated documentation files",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-terms": "you can redistribute it and/or modify it under the terms of the GNU General "
                 "Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, "
           "are permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, "
               "v. 2.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
                 "License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "all-rights-reserved": "Copyright. All rights reserved. No part of this publication may be "
                           "reproduced",
    "all-rights-reserved-alone": "All rights reserved.",
}

# What parts the words of a notice: all but letters, marks and numbers.
_GAPS = r"[^\p{L}\p{M}\p{N}]+"


def agreement(similarity: float, bands: int = BANDS) -> float:
    """The probability that two windows of this similarity agree in a band."""
    return 1 - (1 - similarity) ** bands


def worst_case(shingles: int) -> float:
    """Least probability that a whole template of so many shingles is retrieved.

    Every stretch of WINDOW - STRIDE + 1 shingles lies within one window. A shorter template
    fills a part of that window; a longer one fills a whole window if it has WINDOW + STRIDE - 1
    shingles, else WINDOW - STRIDE + 1 of them at least. One of up to SHORT shingles is found by
    any of them, since every shingle stands in a window.
    """
    if shingles <= SHORT:
        return 1.0
    held = min(shingles, WINDOW) if shingles >= WINDOW + STRIDE - 1 else min(
        shingles, WINDOW - STRIDE + 1)
    return agreement(held / (WINDOW + min(shingles, WINDOW) - held))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _GAPS), lambda w: w != "")


def _shingle(words: Column, at: Column) -> Column:
    """The hash of the shingle that begins at a word, null beyond the last one."""
    last = F.get(words, at + (SHINGLE - 1))
    return F.when(last.isNotNull(), F.xxhash64(
        *[F.get(words, at + i) for i in range(SHINGLE - 1)], last))


def _mask(band: int) -> int:
    """An odd multiplier per band, from a fixed walk through 64-bit numbers."""
    value = (band + 1) * 0x9E3779B97F4A7C15 % 2 ** 64
    value = (value ^ value >> 30) * 0xBF58476D1CE4E5B9 % 2 ** 64
    value = (value ^ value >> 27) * 0x94D049BB133111EB % 2 ** 64
    value ^= value >> 31
    return value - 2 ** 64 if value >= 2 ** 63 else value


def _bands() -> list[Column]:
    """The band values of a window: its least shingle hash under each band's mask."""
    return [F.least(*[F.col(f"__h{i}").bitwiseXOR(F.lit(_mask(b))) for i in range(WINDOW)])
            for b in range(BANDS)]


def _hashes() -> list[Column]:
    """The shingle hashes of a window, null beyond the last shingle."""
    return [F.col(f"__h{i}") for i in range(WINDOW)]


def _marked(values: list[Column], bands: list[int]) -> Column:
    return F.array(*[F.struct(F.lit(b).alias("band"), v.alias("value"))
                     for b, v in zip(bands, values)])


def _windows(rows: DataFrame, stride: int) -> DataFrame:
    """A row per window of the arrays ``words``: its first word ``at`` and its shingle hashes."""
    shingles = F.size("words") - (SHINGLE - 1)
    beyond = stride if stride > 1 else WINDOW
    starts = F.when(shingles > 0, F.sequence(
        F.lit(0), F.greatest(shingles - beyond, F.lit(0)), F.lit(stride)))
    cut = rows.select("*", F.explode(starts).alias("at"))
    return cut.select("*", *[_shingle(F.col("words"), F.col("at") + i).alias(f"__h{i}")
                             for i in range(WINDOW)])


def template_table(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """``license, t_words, t_shingles`` of each template; the caller's list, so of bounded size."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, t_text string")
    words = rows.select("license", _words(F.col("t_text")).alias("t_words"))
    size = F.size("t_words")
    return words.where(size >= SHINGLE).select(
        "license", "t_words", F.array_distinct(F.transform(
            F.sequence(F.lit(0), size - SHINGLE),
            lambda i: F.array_join(F.slice("t_words", i + 1, SHINGLE), " "))).alias("t_shingles"))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES,
         contained: float = CONTAINED) -> DataFrame:
    """``doc_id, license, containment, word_start`` of the notices found in each text.

    ``containment`` is the largest share of the template's shingles that begin within its own
    number of shingles from one place, ``word_start`` the first word of the first such place.
    Null and empty texts and texts of fewer than three words have none; templates of fewer
    than three words find nothing. Rows of one id, repeated or not, are taken together, rows
    without an id too.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    # The bands, and after them one more for the shingles of short templates.
    by_band = _marked(_bands(), list(range(BANDS)))
    by_shingle = _marked(_hashes(), [BANDS] * WINDOW)
    marks = _windows(known.withColumnRenamed("t_words", "words"), 1).select(
        "license", F.explode(F.when(F.size("t_shingles") <= SHORT, F.concat(by_band, by_shingle))
                             .otherwise(by_band)).alias("mark")).select(
        "license", "mark.*").where("value is not null").distinct()
    # One list of values per band, as literals: as long as the templates, whatever the documents.
    listed: dict[int, set[int]] = {}
    for r in marks.collect():
        listed.setdefault(r["band"], set()).add(r["value"])
    met = F.lit(False)
    for band, value in enumerate(_bands()):
        met = met | value.isin(sorted(listed.get(band, ())))
    for value in _hashes():
        met = met | value.isin(sorted(listed.get(BANDS, ())))
    rows = narrowed(docs, doc_id="long", text="string").select(
        "doc_id", _words(F.col("text")).alias("words"))
    windows = _windows(rows, STRIDE)
    reach = max([len(t["t_words"]) for t in known.collect()], default=0)
    # The test stands within a generator: as a filter it would be moved below the hashes and
    # hash every shingle once for each band.
    kept = windows.select("*", F.explode(F.when(met, F.array(F.lit(True)))).alias("met"))
    first = F.greatest(F.col("at") - reach, F.lit(0))
    near = kept.select(
        "doc_id", first.alias("first"),
        F.slice("words", first + 1, F.lit(2 * reach + WINDOW + STRIDE)).alias("near"),
        F.explode(F.concat(by_band, by_shingle)).alias("mark")).select(
        "doc_id", "first", "near", "mark.*")
    found = near.join(F.broadcast(marks), ["band", "value"]).select(
        "doc_id", "license", "first", "near").distinct()
    joined = found.join(F.broadcast(known), "license")
    # Places of the template's shingles, then how many different ones follow within its length.
    here = F.transform(F.sequence(F.lit(0), F.size("near") - SHINGLE), lambda i: F.struct(
        i.alias("at"), F.array_join(F.slice("near", i + 1, SHINGLE), " ").alias("shingle")))
    hits = F.filter(here, lambda s: F.array_contains("t_shingles", s["shingle"]))
    span = F.size("t_shingles")

    def held(all_hits: Column) -> Column:
        return F.transform(all_hits, lambda h: F.struct(
            F.size(F.array_distinct(F.transform(F.filter(
                all_hits, lambda o: (o["at"] >= h["at"]) & (o["at"] < h["at"] + span)),
                lambda o: o["shingle"]))).alias("n"), (-h["at"]).alias("back")))

    best = joined.where(F.size("near") >= SHINGLE).select(
        "doc_id", "license", "first", span.alias("span"),
        F.array_max(bound(hits, held)).alias("best"))
    places = best.where(F.col("best").isNotNull()).select(
        "doc_id", "license", (F.col("best.n") / F.col("span")).alias("containment"),
        (F.col("first") - F.col("best.back")).cast("long").alias("word_start"))
    least = F.min(F.struct(-F.col("containment"), F.col("word_start")))
    return (places.where(F.col("containment") >= contained).groupBy("doc_id", "license")
            .agg(F.max("containment").alias("containment"), least["word_start"]
                 .alias("word_start")))
