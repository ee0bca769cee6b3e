"""Licence scan: TF-IDF cosine of headers and licence files to templates, inherited down directories.

Licence files are compared as a whole, other files by the sentences that speak of
a licence and by the comment at their top. A file without a licence of its own takes that of the licence file in
the nearest directory above it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import text_of

LEAST = 0.6

# SPDX names and the usual wording of notices and licence openings.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the software",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a "
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or at your option any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or at your option any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.",),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC0-1.0": ("Licensed under CC0 1.0.", "Dedicated to the public domain under the CC0 1.0 Universal license."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
}
# Whole licences, by SPDX name, and the lines that name one.
TEXTS = {f.stem: f.read_text(encoding="utf-8") for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
FAMILY = ("", "-only", "-or-later")
for _name in sorted({*TEMPLATES, *TEXTS}):
    _lines = [f"SPDX-License-Identifier: {_name}{v}" for v in (FAMILY if "GPL" in _name else ("",))]
    TEMPLATES[_name] = (*TEMPLATES.get(_name, ()), *filter(None, [TEXTS.get(_name)]), *_lines)
# What a sentence about a licence holds, and the names of licence files.
CUE = r"(?i)licen[sc]|copyright|spdx|permission is hereby|redistribution and use|public domain|free software"
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[sc]e|copying)([._-][^/]*)?$"
SENTENCE = r"[\r\n]+|(?<=[.!?;])\s+(?=\p{Lu})"
COMMENT = r"^\s*($|#|//|/?\*|--|;|%|<!--)"
MARKER = r"(?m)^[ \t]*(#+|/+\*+|//+|\*+/?|--+>?|;+|%+|<!--)|\*/|-->"
TOKEN = "[a-z0-9]+(?:[.-][a-z0-9]+)*"


def template_weights(templates: dict[str, tuple[str, ...]]) -> tuple[list[tuple[str, str, float]], dict[str, float], float]:
    """Unit TF-IDF vectors of the templates, the rarity of their terms, and that of any other term."""
    texts = [(name, k, Counter(re.findall(TOKEN, t.lower()))) for name, ts in templates.items() for k, t in enumerate(ts)]
    seen = Counter(term for _, _, counts in texts for term in counts)
    rarity = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in seen.items()}
    rows = []
    for name, k, counts in texts:
        weights = {t: n * rarity[t] for t, n in counts.items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        rows += [(f"{name}#{k}", t, w / length) for t, w in weights.items()]
    return rows, rarity, math.log(1 + len(texts)) + 1


def match(passages: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Best template of each of ``path, passage``: ``path, licence, cosine`` if the cosine is at least ``least``.

    Of all passages of a path the closest counts; equal cosines go to the first name.
    """
    spark = passages.sparkSession
    rows, rarity, rare = template_weights(templates)
    vectors = F.broadcast(spark.createDataFrame(rows, "template string, term string, weight double"))
    known = F.broadcast(spark.createDataFrame(list(rarity.items()), "term string, rarity double"))
    # Equal passages of a path are one.
    one = passages.select("path", F.lower("passage").alias("passage")).distinct()
    terms = one.select("path", "passage", F.explode(F.regexp_extract_all("passage", F.lit(f"({TOKEN})"), F.lit(1))).alias("term"))
    counted = terms.groupBy("path", F.xxhash64("passage").alias("passage"), "term").agg(F.count(F.lit(1)).alias("n"))
    weighed = counted.join(known, "term", "left").withColumn("w", F.col("n") * F.coalesce("rarity", F.lit(rare)))
    lengths = weighed.groupBy("path", "passage").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = weighed.join(vectors, "term").groupBy("path", "passage", "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    cosines = dots.join(lengths, ["path", "passage"]).withColumn("cosine", F.round(F.col("dot") / F.col("length"), 9))
    named = cosines.where(F.col("cosine") >= least).withColumn("name", F.substring_index("template", "#", 1))
    best = F.min(F.struct((-F.col("cosine")).alias("minus"), "name")).alias("b")
    return named.groupBy("path").agg(best).select("path", F.col("b.name").alias("licence"), (-F.col("b.minus")).alias("cosine"))


def directory(path: str = "path"):
    """Directory of a path, without the slash at its end; empty for the top."""
    return F.regexp_replace(F.col(path), r"/?[^/]*$", "")


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """Licence of the nearest directory at or above each: ``dir, licence, from_dir``.

    ``licensed`` (``dir, licence``) names the licences of directories. Each distinct
    directory is joined with its own ancestors only, whose number is that of its parts.
    """
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    depths = F.sequence(F.lit(0), F.size(parts))
    above = F.transform(depths, lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("from_dir")))
    climbed = directories.select("dir").distinct().select("dir", F.inline(above))
    named = licensed.groupBy(F.col("dir").alias("from_dir")).agg(F.min("licence").alias("licence"))
    nearest = F.max_by(F.struct("licence", "from_dir"), "depth").alias("n")
    return climbed.join(named, "from_dir").groupBy("dir").agg(nearest).select("dir", "n.licence", "n.from_dir")


def opening(text: str = "text"):
    """The comment at the top of a file as one line without its marks; empty if there is none."""
    lines = F.split(text, r"\r?\n")
    other = F.array_position(F.transform(lines, lambda x: x.rlike(COMMENT)), False)
    led = F.array_join(F.slice(lines, F.lit(1), F.when(other > 0, other - 1).otherwise(F.size(lines)).cast("int")), "\n")
    block = F.when(F.ltrim(F.col(text)).startswith("/*"), F.substring_index(text, "*/", 1)).otherwise(led)
    return F.trim(F.regexp_replace(F.regexp_replace(block, MARKER, " "), r"\s+", " "))


def scan(
    files: DataFrame,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    least: float = LEAST,
    keep: Sequence[str] = (),
    by_text: bool = False,
) -> DataFrame:
    """Licence of every file: ``path, licence, cosine, found_in``, after the columns named by ``keep``.

    Licence files are known by their names. With ``by_text``, for tables whose paths
    hold no such names, any file is one whose whole text, of whatever length, is as
    close to a template as ``least`` asks.

    ``found_in`` is the file's own path, the directory whose licence file it
    follows, or NULL with a NULL licence. Every row of ``files`` (``path, text``)
    gives one row; rows with one path share the closest match of their texts. A
    NULL path is the empty one, at the top; NULL and empty texts have no licence of
    their own. Other columns are not looked at.
    """
    rows = files.select(F.coalesce("path", F.lit("")).alias("path"), text_of().alias("text"), *keep)
    speaking = rows.where(F.col("text").rlike(CUE))
    sentences = F.filter(F.split("text", SENTENCE), lambda s: s.rlike(CUE))
    # A comment wrapped over lines is compared joined, as a whole and by its sentences.
    header = F.filter(F.concat(F.array(opening()), F.split(opening(), SENTENCE)), lambda s: s.rlike(CUE))
    whole = F.col("path").rlike(LICENCE_FILE)
    passages = speaking.select("path", F.explode(F.when(whole, F.array("text")).otherwise(F.concat(sentences, header))).alias("passage"))
    own = match(passages, templates, least)
    licensed = own.where(F.col("path").rlike(LICENCE_FILE)).select(directory().alias("dir"), "licence")
    if by_text:
        texts = match(speaking.where(~whole).select("path", F.col("text").alias("passage")), templates, least)
        licensed = licensed.unionByName(texts.select(directory().alias("dir"), "licence"))
    paths = rows.select("path", *keep).withColumn("dir", directory())
    above = inherited(paths, licensed).withColumnRenamed("licence", "above")
    found = paths.join(own, "path", "left").join(above, "dir", "left")
    return found.select(
        *keep,
        "path",
        F.coalesce("licence", "above").alias("licence"),
        "cosine",
        F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("from_dir")).alias("found_in"),
    )
