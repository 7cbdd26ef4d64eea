"""Licence notices by a trained paragraph classifier, confirmed against templates. DataFrame and SQL functions only.

Texts are classified line by line and, so that a wrapped or embedded notice is seen whole, in windows of
``WINDOW`` words over their paragraphs (parted by blank lines), which overlap by more than any template is
long. Only windows with a word without which no template can be confirmed are looked at; this loses none.
The features of a line or window are its words and word pairs, hashed to ``FEATURES`` places. A sparse
multinomial logistic regression tells the families and ordinary text apart. It learns from the templates,
alone and set among ordinary lines, and from ordinary lines without a template; the ordinary lines are a
bounded sample of about ``SAMPLE_ROWS`` of the distinct lines of the corpus, half of which is held out. On
that half each family gets the least probability that ``CALIBRATE`` of the lines of other classes stay
below. What looks like a licence but stays below is of the class ``unknown``. A family counts only when the
line or window also holds ``CONFIRM`` of the word pairs of one of its templates.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.session import materialize

FEATURES = 1 << 13
SAMPLE_ROWS = 1500
CALIBRATE = 0.999
CONFIRM = 0.8
WINDOW, STEP = 48, 24
OTHER, UNKNOWN = "other", "unknown"

# fixed values: notices in common use, by family
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Distributed under the BSD 3-Clause License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "The MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]
FAMILIES = [OTHER, *sorted({f for f, _ in TEMPLATES})]


def _words(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit("([a-z0-9]+)"), F.lit(1))


def _pairs(words: Column) -> Column:
    n = F.size(words)
    following = F.when(n > 1, F.slice(words, 2, F.greatest(n - 1, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    return F.filter(F.zip_with(words, following, lambda a, b: F.concat_ws(" ", a, F.coalesce(b, F.lit("")))), lambda p: ~p.endswith(" "))


def lines_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.trim(line) != "")


def _wanted(template: str) -> list[str]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in template.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def _needed(text: Column) -> Column:
    """Whether one of these words is in the text: without any of them, each template lacks too many pairs to be confirmed."""
    needed = set()
    for _, template in TEMPLATES:
        left = _wanted(template)
        least = CONFIRM * len(left)
        for word in sorted({w for p in left for w in p.split()}, key=lambda w: (-len(w), w)):
            if len(left) < least:
                break
            left = [p for p in left if word not in p.split()]
            needed.add(word)
    return reduce(or_, [text.contains(w) for w in sorted(needed) if not any(v != w and v in w for v in needed)])


def windows_of(text: Column) -> Column:
    """Overlapping windows of words over the paragraphs of a text that are more than one line of ``WINDOW`` words."""
    text = F.lower(F.coalesce(text, F.lit("")))
    parts = F.filter(F.split(text, r"\n\s*\n"), lambda p: _needed(p))
    parts = F.transform(parts, lambda p: F.struct(_words(p).alias("w"), F.trim(p, F.lit("\n")).contains("\n").alias("wrapped")))
    parts = F.filter(parts, lambda p: (F.size(p["w"]) > WINDOW) | p["wrapped"])
    cut = lambda p: F.transform(F.sequence(F.lit(0), F.greatest(F.size(p["w"]) - STEP - 1, F.lit(0)), F.lit(STEP)), lambda i: F.array_join(F.slice(p["w"], i + 1, WINDOW), " "))
    windows = F.filter(F.flatten(F.transform(parts, cut)), lambda w: _needed(w))
    return F.when(_needed(text), windows).otherwise(F.array().cast("array<string>"))


def _overlap(pairs: Column, template: str) -> Column:
    """Share of a template's word pairs that are in ``pairs``."""
    wanted = _wanted(template)
    return F.size(F.array_intersect(pairs, F.array(*[F.lit(p) for p in wanted]))) / len(wanted)


def _featured(lines: DataFrame) -> DataFrame:
    """Adds word pairs and hashed features to a table with ``line``."""
    lines = lines.withColumn("words", _words(F.col("line"))).withColumn("pairs", _pairs(F.col("words")))
    lines = lines.withColumn("grams", F.array_distinct(F.concat("words", "pairs"))).drop("words")
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(lines).drop("grams")


def train(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS):
    """The fitted model and the least probability of every family."""
    lines = docs.select(F.explode(lines_of(F.col(f"`{text}`"))).alias("line")).withColumn("h", F.xxhash64("line"))
    n = lines.agg(F.approx_count_distinct("h").alias("n")).first().n
    sample = lines.filter(F.pmod("h", F.lit(max(n, 1))) < sample_rows).dropDuplicates(["line"])
    plain = materialize(sample.select("line", "h"), "plain-lines")
    templates = F.array(*[F.struct(F.lit(float(FAMILIES.index(f))).alias("label"), F.lit(t).alias("notice")) for f, t in TEMPLATES])
    near = F.greatest(*[_overlap(F.col("pairs"), t) for _, t in TEMPLATES])
    other = _featured(plain).filter(near < 0.5).select("line", "h", F.lit(0.0).alias("label"))
    # each template alone, and before, after or between ordinary lines
    hosts = plain.filter(F.pmod("h", F.lit(max(plain.count() // 40, 1))) == 0)
    among = hosts.select("h", "line", F.explode(templates).alias("t"))
    placed = F.element_at(F.array(F.concat_ws(" ", "t.notice", "line"), F.concat_ws(" ", "line", "t.notice"), F.concat_ws(" ", "line", "t.notice", "line")), (F.pmod(F.xxhash64("h", "t.notice"), F.lit(3)) + 1).cast("int"))
    among = among.select(placed.alias("line"), "h", F.col("t.label").alias("label"))
    alone = docs.sparkSession.range(4).select(F.col("id").alias("h"), F.explode(templates).alias("t")).select(F.col("t.notice").alias("line"), "h", F.col("t.label").alias("label"))
    rows = materialize(_featured(other.union(among).union(alone)).select("features", "label", "h"), "licence-training")
    fitted = LogisticRegression(family="multinomial", maxIter=40, regParam=1e-4, elasticNetParam=0.5).fit(rows.filter("h % 2 = 0"))
    held = fitted.transform(rows.filter("h % 2 <> 0")).select("label", vector_to_array("probability").alias("p"))
    known = min(fitted.numClasses, len(FAMILIES))
    limits = held.agg(*[F.percentile_approx(F.when(F.col("label") != i, F.col("p")[i]), CALIBRATE).alias(f"l{i}") for i in range(1, known)]).first()
    return fitted, [0.5, *[max(0.5, limits[f"l{i}"] or 0.5) for i in range(1, known)]]


def _units(text: Column) -> Column:
    marked = lambda units, wide: F.transform(units, lambda x: F.struct(x.alias("line"), F.lit(wide).alias("wide")))
    return F.concat(marked(lines_of(text), False), marked(windows_of(text), True))


def find_licenses(docs: DataFrame, text: str = "text", keep: list[str] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``row`` with ``n_lines``, ``families`` (confirmed, sorted), ``n_licensed``, ``n_unknown`` and ``probability``.

    A null or blank text has no lines. ``n_licensed`` counts confirmed lines, and families that only windows
    confirm; ``n_unknown`` counts lines. ``probability`` is the largest of what is confirmed, null without.
    Every row has a result of its own, repeated rows and null ids included.
    """
    fitted, limits = train(docs, text, sample_rows)
    row = F.struct(*[F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)])
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), row.alias("row"), _units(F.col(f"`{text}`")).alias("units"))
    lines = numbered.select("rid", "row", F.explode_outer("units").alias("u")).select("rid", "row", F.col("u.line").alias("line"), F.coalesce("u.wide", F.lit(False)).alias("wide"))
    scored = fitted.transform(_featured(lines.withColumn("blank", F.col("line").isNull()).withColumn("line", F.coalesce("line", F.lit("")))))
    p = vector_to_array("probability")
    best = F.col("prediction").cast("int")
    confirmed = F.element_at(
        F.array(F.lit(False), *[F.greatest(*[_overlap(F.col("pairs"), t) for g, t in TEMPLATES if g == f], F.lit(0.0)) >= CONFIRM for f in FAMILIES[1:]]), best + 1
    )
    sure = p[best] >= F.element_at(F.array(*[F.lit(x) for x in limits]), best + 1)
    family = F.when(F.col("blank") | (best == 0), OTHER).when(sure & confirmed, F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), best + 1)).otherwise(UNKNOWN)
    judged = scored.select("rid", "row", "blank", "wide", family.alias("family"), p[best].alias("p"))
    named = ~F.col("family").isin(OTHER, UNKNOWN)
    wide = F.col("wide")
    found = judged.groupBy("rid").agg(
        F.first("row").alias("row"), F.count(F.when(~F.col("blank") & ~wide, 1)).alias("n_lines"), F.array_sort(F.collect_set(F.when(named, F.col("family")))).alias("families"),
        F.count(F.when(named & ~wide, 1)).alias("n_licensed"), F.collect_set(F.when(named & ~wide, F.col("family"))).alias("by_line"),
        F.count(F.when((F.col("family") == UNKNOWN) & ~wide, 1)).alias("n_unknown"), F.max(F.when(named, F.col("p"))).alias("probability"),
    )
    only_wide = F.size(F.array_except("families", "by_line"))
    return found.select("row", "n_lines", "families", (F.col("n_licensed") + only_wide).alias("n_licensed"), "n_unknown", "probability")
