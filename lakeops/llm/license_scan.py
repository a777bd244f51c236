"""License scans: MinHash bands over overlapping text windows, then exact containment.

A template is a set of 5-word shingles. Templates are sorted into classes by size, powers of
two; the windows of class c are 2c shingles long and start every c shingles, so that each
occurrence of a template lies whole in one window and makes up at least a fifth of it, and
mostly more than a third. A window and a template with Jaccard similarity j agree in one
of BANDS single-row bands with probability 1 - (1 - j) ** BANDS: above 0.999 from j = 0.11,
so a window that holds four fifths of its template is practically never missed. Candidates
are verified by exact containment of the template's shingles in the window's.

A template of k < 5 words has its whole word sequence as its one shingle. Its class is -k;
its windows are the k words from each position, so it is found where it stands word by word.

A window without any shingle of any template has containment 0, so only windows around
such shingles are hashed: the shingles of all templates, a table bounded by the list of
templates, are joined with the documents' shingles first. Documents themselves are not
shuffled, only those windows.

Defined cases: a null text or one without words holds no license; a null template or one
without words is never found; equal templates are found together; rows that repeat an id
and text are answered each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.frames import materialise
from lakeops.llm.words import ascii_lower, stretch, text_of, with_windows

WORDS = 5
BANDS = 64
CONTAINED = 0.8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Templates are given by the caller; so many shingles of theirs are broadcast at most.
BROADCAST_SHINGLES = 2_000_000

# Wordings of common license notices.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "all-rights-reserved-notice": "All rights reserved.",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced",
}


def notices(spark: SparkSession) -> DataFrame:
    """license, text."""
    return spark.createDataFrame(list(NOTICES.items()), "license string, text string")


def scan_words(text: str):
    return F.regexp_extract_all(ascii_lower(text_of(text)), F.lit(WORD), F.lit(0))


def _bands(hashes: str):
    """One value a band: the least of the window's shingles under the band's own hash."""
    least = [F.array_min(F.transform(hashes, _keyed(i))) for i in range(BANDS)]
    return F.array(*[F.xxhash64(F.lit(i), m) for i, m in enumerate(least)])


def _keyed(i: int):
    return lambda h: F.xxhash64(F.lit(i), h)


def _placed_hashes(hashes: str, short: int):
    return F.transform(hashes, lambda h, i: F.struct(i.alias("at"), F.lit(short).alias("short"), h.alias("h")))


def templates_of(texts: DataFrame, license: str = "license", text: str = "text") -> DataFrame:
    """license, template (distinct shingles), size, class (the power of two from size up; -k for k < 5 words), bands."""
    words = texts.select(F.col(f"`{license}`").alias("license"), scan_words(f"`{text}`").alias("words"))
    hashed = with_windows(words, "words", [*range(1, WORDS + 1)], "h")
    n_words, shingles = F.size("words"), F.col(f"h{WORDS}")
    for n in range(1, WORDS):
        shingles = F.when(n_words == n, F.col(f"h{n}")).otherwise(shingles)
    sets = hashed.select("license", n_words.alias("n_words"), F.array_distinct(shingles).alias("template")).where("n_words > 0")
    size = F.size("template")
    power = F.pow(F.lit(2.0), F.ceil(F.log2(size))).cast("int")
    sized = sets.select("license", "template", size.alias("size"), F.when(F.col("n_words") < WORDS, -F.col("n_words")).otherwise(power).alias("class"))
    return materialise(sized.withColumn("bands", _bands("template")), "templates")


def _placed(short: list[int]) -> list:
    """A document's hashes with their places; short: the number of words, 0 for five."""
    return [_placed_hashes(f"h{WORDS}", 0), *[_placed_hashes(f"h{n}", n) for n in short]]


#: Position -1 stands for the document itself.
_ITSELF = "struct<at:int,short:int,h:bigint,_classes:array<int>>"


def _near(hashed: DataFrame, known: DataFrame, short: list[int]) -> DataFrame:
    """id, text_key, copies, h5 and the shingles (at, short, h, _classes) that templates know too.

    A row more for each document stands for itself.
    """
    itself = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("short"), F.lit(None).cast("bigint").alias("h")))
    spread = hashed.select("id", "text_key", F.lit(1).cast("bigint").alias("copies"), "h5", F.inline(F.concat(itself, *_placed(short))))
    same = (F.col("h") == F.col("_h")) & (F.col("short") == F.col("_short"))
    return spread.join(F.broadcast(known), same, "left").where("at < 0 OR _h IS NOT NULL")


def _near_shuffled(hashed: DataFrame, known: DataFrame, short: list[int]) -> DataFrame:
    """The same for more template shingles than are broadcast, a row for each different text.

    Places and hashes alone are shuffled; what is found meets the document's shingles once.
    """
    once = hashed.groupBy("id", "text_key").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(f"h{n}").alias(f"h{n}") for n in [*short, WORDS]]
    )
    once = materialise(once, "license-documents")
    probe = once.select("id", "text_key", F.inline(F.concat(*_placed(short))))
    same = (F.col("h") == F.col("_h")) & (F.col("short") == F.col("_short"))
    found = probe.join(known, same).groupBy("id", "text_key").agg(F.collect_list(F.struct("at", "short", "h", "_classes")).alias("found"))
    found = found.withColumnsRenamed({"id": "_id", "text_key": "_key"})
    both = once.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    itself = F.array(F.struct(F.lit(-1), F.lit(0), F.lit(None), F.lit(None)).cast(_ITSELF))
    every = F.concat(itself, F.coalesce("found", F.array().cast(f"array<{_ITSELF}>")))
    return both.select("id", "text_key", "copies", "h5", F.inline(every))


def scan(docs: DataFrame, texts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text_key, copies, licenses (sorted names), matches (license, start, containment).

    One row per distinct (id, text); ``copies`` says how many rows of the table it stands for.
    """
    templates = templates_of(texts)
    classes = sorted(r[0] for r in templates.select("class").distinct().collect())  # powers of two: a few
    short = [-c for c in classes if c < 0]
    known = templates.select(F.explode("template").alias("_h"), F.col("class").alias("_class")).distinct()
    known = known.groupBy("_h", F.greatest(-F.col("_class"), F.lit(0)).alias("_short")).agg(F.collect_set("_class").alias("_classes"))
    small = known.count() <= BROADCAST_SHINGLES

    flat = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(text_of(f"`{text}`"), F.lit(1)).alias("text_key"), scan_words(f"`{text}`").alias("words")
    )
    hashed = with_windows(flat, "words", [*short, WORDS], "h").drop("words")
    near = _near(hashed, known, short) if small else _near_shuffled(hashed, known, short)
    at = F.col("at")
    windows = F.flatten(
        F.transform(
            F.coalesce("_classes", F.array().cast("array<int>")),
            lambda c: F.array(
                F.struct(c.alias("class"), F.floor(at / c).cast("int").alias("n")),
                F.struct(c.alias("class"), (F.floor(at / c) - 1).cast("int").alias("n")),
            ),
        )
    )
    wanted = F.filter(windows, lambda w: w["n"] >= 0)
    # the first window also serves what lies before its second half
    only = F.array(F.struct((-F.col("short")).alias("class"), F.greatest(at, F.lit(0)).alias("n")))  # class 0: the document
    wanted = F.when((at < 0) | (F.col("short") > 0), only).otherwise(wanted)
    placed = near.select("id", "text_key", "copies", "h5", "h", F.explode(wanted).alias("w")).select(
        "id", "text_key", "copies", F.col("w.class").alias("class"), F.col("w.n").alias("n"),
        F.when(F.col("w.class") > 0, F.array_distinct(stretch(F.col("h5"), F.col("w.n") * F.col("w.class"), 2 * F.col("w.class"))))
        .when(F.col("w.class") < 0, F.array("h"))
        .alias("shingles"),
    )
    placed = placed.groupBy("id", "text_key", "class", "n").agg(
        F.first("shingles").alias("shingles"), F.sum("copies").alias("rows")
    )
    placed = materialise(placed, "license-windows")
    names = templates.select(F.col("license").alias("license"), F.col("class").alias("_class"), F.explode("bands").alias("_band"))
    window_bands = (
        placed.where("class <> 0")
        .withColumn("bands", _bands("shingles"))
        .select("id", "text_key", "class", "n", F.explode("bands").alias("band"))
    )
    pairs = window_bands.join(
        F.broadcast(names.select("license", "_class", "_band")) if len(classes) and templates.count() * BANDS <= BROADCAST_SHINGLES else names.select("license", "_class", "_band"),
        (F.col("band") == F.col("_band")) & (F.col("class") == F.col("_class")),
    ).select("id", "text_key", "class", "n", "license").distinct()
    sets = templates.select(F.col("license").alias("_license"), "template", "size")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("id", "text_key", "class", "n")]
    checked = (
        pairs.alias("a")
        .join(placed.alias("b"), same[0] & same[1] & same[2] & same[3])
        .select("a.id", "a.text_key", "a.class", "a.n", "a.license", "b.shingles")
        .join(sets, F.col("license").eqNullSafe(F.col("_license")))
        .withColumn("containment", F.size(F.array_intersect("template", "shingles")) / F.col("size"))
        .where(F.col("containment") >= CONTAINED)
    )
    found = checked.groupBy("id", "text_key").agg(
        F.sort_array(F.collect_set("license")).alias("licenses"),
        F.sort_array(F.collect_set(F.struct("license", (F.col("n") * F.greatest("class", F.lit(1))).alias("start"), F.round("containment", 6).alias("containment")))).alias("matches"),
    ).withColumnsRenamed({"id": "_id", "text_key": "_key"})
    every = placed.where("class = 0").select("id", "text_key", F.col("rows").alias("copies"))
    return every.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left").select(
        "id", "text_key", "copies", F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"), "matches"
    )
