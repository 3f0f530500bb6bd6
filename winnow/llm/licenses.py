"""Licence scans: Dice coefficient over word bigrams between parts of a text and licence templates.

The templates are short notices of nine licences; full licence texts, warranty paragraphs of MIT and BSD, other licences
and 'All rights reserved.' have none.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording of public licences and of their usual notices; one entry a paragraph.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

SENTENCE, BLOCK = "(?<=[.!?;:])[ \\t]+", "\\n[ \\t\\r]*\\n"


def normal(text: Column) -> Column:
    """Lower case, everything but letters and digits as single spaces, a space at either end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " ")), F.lit(" "))


def bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring words of a text in normal form."""
    words = F.split(F.trim(text), " ")
    count = F.size(words) - 1
    pairs = F.zip_with(F.slice(words, F.lit(1), count), F.slice(words, F.lit(2), count), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(count > 0, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def template_rows(templates) -> list[tuple[str, list[str]]]:
    """Name and distinct bigrams of each template that has any; the same normal form as above."""
    out = []
    for name, text in templates:
        words = re.sub(r"[\W_]+", " ", text.lower()).split()
        pairs = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))
        if pairs:
            out.append((name, pairs))
    return out


def signs(pairs: list[str], threshold: float) -> list[str]:
    """Bigrams of which any matching text has at least one.

    A match shares ``threshold / (2 - threshold)`` of the template's bigrams at least, so it cannot miss all of this
    many others; those with the longest words are taken, as they are the rare ones.
    """
    least = math.ceil(round(len(pairs) * threshold / (2 - threshold), 9))
    return sorted(pairs, key=lambda p: (-len(p), p))[:len(pairs) - least + 1]


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, license, dice, part``: the best match of each licence found in a document.

    The parts compared are the whole text, its blocks (between empty lines), its lines and its sentences. A
    template is a candidate for a part only if the number of distinct bigrams ``n`` allows the threshold:
    ``m * t / (2 - t) <= n <= m * (2 - t) / t``. Texts that hold none of the bigrams every match must have one of are passed over before they
    are cut up. Several equal best parts: the least in order. Rows of one id are one document.

    Null, empty or one-word texts match nothing. No template, no row. Other columns are not read. The templates are a
    parameter and travel in the plan.
    """
    rows = template_rows(templates)
    needed = sorted({s for _, pairs in rows for s in signs(pairs, threshold)})
    cut = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # a bigram's longer word is looked for first; the lambda binds the normal form, so that it is made once a text
    spelled = F.array(*[F.lit(w) for w in sorted({max(s.split(), key=len) for s in needed})]).cast("array<string>")
    known_word = F.arrays_overlap(F.split(F.lower("text"), "[^\\p{L}\\p{N}]+"), spelled)
    sign = F.exists(F.array(normal(F.col("text"))), lambda norm: reduce(Column.__or__, [F.contains(norm, F.lit(f" {s} ")) for s in needed], F.lit(False)))
    hit = known_word & sign
    lines = F.split("text", "\\r?\\n")
    parts = F.array_distinct(F.concat(F.array("text"), F.split("text", BLOCK), lines, F.flatten(F.transform(lines, lambda x: F.split(x, SENTENCE)))))
    units = cut.filter(hit).select("doc_id", F.explode(parts).alias("part")).withColumn("pairs", bigrams(normal(F.col("part"))))
    spark = docs.sparkSession
    known = spark.createDataFrame([(n, p) for n, p in rows] or [("", [""])], "license string, known array<string>").filter("license <> ''")
    size, m = F.size("pairs"), F.size("known")
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    bounded = (size >= F.ceil(F.round(m * low, 9))) & (size <= F.floor(F.round(m * high, 9)))
    pairs = units.filter(size > 0).join(F.broadcast(known), bounded)  # templates are a bounded list
    dice = 2.0 * F.size(F.array_intersect("pairs", "known")) / (size + m)
    scored = pairs.select("doc_id", "license", "part", dice.alias("dice")).filter(F.col("dice") >= threshold)
    best = scored.groupBy("doc_id", "license").agg(F.min(F.struct((-F.col("dice")).alias("d"), "part")).alias("best"))
    return best.select("doc_id", "license", (-F.col("best.d")).alias("dice"), F.trim("best.part").alias("part"))
