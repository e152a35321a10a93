"""License scans: MinHash bands over text windows retrieve templates, shingle containment verifies them.

DataFrame expressions only.  A window of ``WINDOW`` words starts every
``STRIDE`` words, and a template gives a window at every word, so wherever a
template stands in a text some of its windows stands there almost whole.  With
``BANDS`` bands of one hash each, windows of similarity J meet with probability
1 - (1 - J) ** BANDS: 0.996 at one half, and equal windows always meet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WINDOW = 8
STRIDE = 4
SHINGLE = 3
BANDS = 8
CONTAINMENT = 0.8  # share of a template's shingles that must stand in the text around the window


@dataclass(frozen=True)
class Template:
    license: str
    text: str


# Notices and opening passages by which texts name their license.
TEMPLATES = (
    Template("MIT", "Released under the MIT License."),
    Template("MIT", "Licensed under the MIT License."),
    Template("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                           "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template("GPL-3.0", "either version 3 of the License, or (at your option) any later version"),
    Template("GPL-2.0", "either version 2 of the License, or (at your option) any later version"),
    Template("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    Template("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    Template("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                             "the following conditions are met"),
    Template("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0."),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    Template("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights"),
)


# ------------------------------------------------------------------ expressions

def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def shingles(tokens: Column) -> Column:
    """Hash of each ``SHINGLE`` neighbouring words; fewer words are one shingle."""
    def cut(w):
        many = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
        few = F.array(F.xxhash64(F.array_join(w, " ")))
        return F.when(F.size(w) >= SHINGLE, many).when(F.size(w) > 0, few).otherwise(F.array().cast("array<bigint>"))

    return _once(tokens, cut)


def bands(window: Column) -> list[Column]:
    """The least value of each band's hash over a window's shingles."""
    def least(k):
        return F.array_min(F.transform(window, lambda s: F.xxhash64(s, F.lit(k))))

    return [least(k) for k in range(BANDS)]


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _starts(count: Column, step: int) -> Column:
    """0, step, … over the places where a window starts, none for no shingles."""
    return F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)), F.lit(step))).otherwise(F.array().cast("array<int>"))


def _window(cut: Column, start: Column) -> Column:
    return F.slice(cut, start + 1, WINDOW - SHINGLE + 1)


# ------------------------------------------------------------------ templates

def template_table(spark, templates=TEMPLATES) -> DataFrame:
    """(template, license, cut): one row per template, with its distinct shingles."""
    rows = [(k, t.license, t.text) for k, t in enumerate(templates)]
    table = spark.createDataFrame(rows, "template int, license string, text string")
    return table.select("template", "license", shingles(words(F.col("text"))).alias("cut"), F.size(words(F.col("text"))).alias("n_words"))


def template_bands(table: DataFrame) -> DataFrame:
    """(band, value, template): the index; a template's windows start at every word, short templates are one window."""
    last = F.greatest(F.size("cut") - (WINDOW - SHINGLE + 1), F.lit(0))
    windows = table.select("template", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: _window(F.col("cut"), i))).alias("w"))
    return windows.select("template", F.posexplode(F.array(*bands(F.col("w")))).alias("band", "value")).distinct()


# ------------------------------------------------------------------ scan

def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(key, license, template, containment, at_word, n_places): templates found in each document.

    ``at_word`` is the first window (in words) whose surroundings hold the
    template, ``n_places`` counts such windows.  Null and empty texts hold
    nothing; rows that repeat a key are one document; texts are scanned whole
    and never shuffled; no templates or an empty table give no rows.
    """
    spark = docs.sparkSession
    # a row per template: a parameter, written by hand
    table = materialize(template_table(spark, templates), "templates")
    index = materialize(template_bands(table), "template-bands")
    values = [[] for _ in range(BANDS)]
    for r in index.select("band", "value").distinct().collect():
        values[r["band"]].append(r["value"])

    def meets(window):
        hit = F.lit(False)
        for value, held in zip(bands(window), values):
            hit = hit | value.isin(held)
        return hit

    def hits(cut):
        return F.filter(_starts(F.size(cut), STRIDE), lambda i: F.exists(F.array(_window(cut, i)), meets))

    rows = docs.select(F.col(key).alias("_key"), _once(words(F.col(text)), lambda w: F.struct(
        w.alias("words"), _once(shingles(w), hits).alias("hits"))).alias("_found"))
    windows = rows.filter(F.size("_found.hits") > 0).select("_key", F.explode("_found.hits").alias("at_word"), F.col("_found.words").alias("_words"))
    longest = max([len(t.text.split()) for t in templates], default=0) * 2
    # the words around the window, as far as the longest template reaches
    begin = F.greatest(F.col("at_word") - longest, F.lit(0))
    around = windows.select("_key", "at_word", F.slice("_words", F.col("at_word") + 1, WINDOW).alias("_own"),
                            F.slice("_words", begin + 1, 2 * longest + WINDOW).alias("_around"))
    banded = around.select("_key", "at_word", "_around", F.posexplode(F.array(*bands(shingles(F.col("_own"))))).alias("band", "value"))
    proposed = banded.join(F.broadcast(index), ["band", "value"]).groupBy("_key", "at_word", "template").agg(F.first("_around").alias("_around"))
    checked = proposed.join(F.broadcast(table), "template").withColumn(
        "containment", F.size(F.array_intersect("cut", shingles(F.col("_around")))) / F.size(F.array_distinct("cut")))
    held = checked.filter(F.col("containment") >= containment)
    return held.groupBy(F.col("_key").alias(key), "license", "template").agg(
        F.max("containment").alias("containment"), F.min("at_word").alias("at_word"), F.count("*").alias("n_places"))
