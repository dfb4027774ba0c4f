"""Licences of documents by TF-IDF cosine to templates, and of directories by inheritance.

Built from DataFrame functions only.  A text is read in units: its lines and sentences, the
sentences of each paragraph over line ends, its paragraphs, and the text as a whole.  Lines
and sentences are compared with single sentences (TEMPLATES), paragraphs and whole texts with
header blocks (BLOCKS) and licence files (`licence_texts`), in which a term that occurs n
times counts as 1 + log(n).  A unit's licence is the template with the largest cosine of
sparse TF-IDF vectors, if it reaches `threshold`.  Document frequencies of all terms come
from all documents.

Units are scored only if they can reach the threshold.  For each sentence the anchors are its
heaviest terms, so many that the others together have less than `threshold` of its norm; and a
unit needs so many of a template's terms that these have `threshold` of its norm.  By the
Cauchy-Schwarz inequality no other unit can reach the threshold.

A document whose words are mostly licence units, or whose name says so, is a licence
file.  Documents without a licence of their own take that of the licence file in the nearest
directory above them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lenstrail.sources.tables import cut_lineage

THRESHOLD = 0.6
WORD = "[a-z0-9]+(?:\\.[0-9]+)*"
SENTENCE_END = "(?<=[.!?])\\s+|\\n+"
WRAPPED_END = "(?<=[.!?])\\s+"
PARAGRAPH_END = "\\n[^a-zA-Z0-9\\n]*\\n"  # lines with signs of comments only are empty
FILE_NAME = "(?i)^(licen[cs]e|copying|unlicense|notice)([.-].*)?$"

# Headings and opening sentences of common licences, by SPDX name.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-Rights-Reserved", "All rights reserved."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)

_GNU = "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
_GNU_2 = "{0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version."
_GNU_REST = (
    " {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
    "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details. You should have received a copy of the GNU {1} along with {0}. "
    "If not, see <https://www.gnu.org/licenses/>."
)
_GNU_NAMES = (
    ("GPL-2.0", _GNU_2, "This program", "General Public License", "2"),
    ("GPL-3.0", _GNU, "This program", "General Public License", "3"),
    ("LGPL-2.1", _GNU_2, "This library", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", _GNU, "This library", "Lesser General Public License", "3"),
    ("AGPL-3.0", _GNU, "This program", "Affero General Public License", "3"),
)
# Header blocks of common licences, as one vector each.
BLOCKS: tuple[tuple[str, str], ...] = (
    *((name, form.format(*words)) for name, form, *words in _GNU_NAMES),
    *((name, (form + _GNU_REST).format(*words)) for name, form, *words in _GNU_NAMES),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "Apache-2.0",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed "
        "with this work for additional information regarding copyright ownership. The ASF licenses this file to you under the Apache License, "
        'Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "BSD-3-Clause",
        "Copyright. All rights reserved. Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
)
# Section 13 of AGPL-3.0, whose other text is that of GPL-3.0 with another name.
_REMOTE = (
    "Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users "
    "interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the "
    "Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through some "
    "standard or customary means of facilitating copying of software."
)


def blocks() -> list[tuple[str, str]]:
    """Header blocks, then licence files: whole ones, and the first paragraph of short ones."""
    files = [(f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]
    gnu = dict(files)["GPL-3.0"]
    files.append(("AGPL-3.0", gnu.replace("GNU General Public", "GNU Affero General Public").replace("GENERAL PUBLIC", "AFFERO GENERAL PUBLIC") + _REMOTE))
    openings = [(name, text.split("\n\n")[0]) for name, text in files if name in ("MIT", "ISC")]
    return [*BLOCKS, *openings, *files]


def terms(text: str) -> Counter:
    return Counter(re.findall(WORD, text.lower()))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def counts(docs: DataFrame) -> DataFrame:
    """(t, n): in how many documents each term occurs."""
    return docs.select(F.explode(F.array_distinct(_words(F.coalesce(F.col("text").cast("string"), F.lit(""))))).alias("t")).groupBy("t").agg(F.count("*").alias("n"))


def damped(n: int) -> float:
    return 1 + math.log(n)


def _vector(text: str, block: bool, idf: dict[str, float]) -> dict[str, float]:
    own = {t: (damped(n) if block else n) * idf[t] for t, n in terms(text).items()}
    length = math.sqrt(sum(w * w for w in own.values()))
    return {t: w / length for t, w in own.items()}


def vectors(idf: dict[str, float]) -> list[tuple[str, bool, dict[str, float]]]:
    """(licence, is a block, weights of unit length) of every template."""
    return [(name, block, _vector(text, block, idf)) for block, table in ((False, TEMPLATES), (True, blocks())) for name, text in table]


def tiers(weights: dict[str, float], step: float = 1.5, rest: float = 0.02) -> tuple[list[tuple[float, list[str]]], float]:
    """(largest square, terms) of a template's terms by falling weight, and what the lightest have together."""
    found: list[tuple[float, list[str]]] = []
    left = 1.0
    for t, w in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
        if left < rest:
            break
        if not found or w * w * step < found[-1][0]:
            found.append((w * w, []))
        found[-1][1].append(t)
        left -= w * w
    return found, max(left, 0.0)


def needed(templates: list[dict[str, float]], threshold: float) -> list[str]:
    """Terms of which every unit that reaches the threshold has one: what a template has besides is too little."""
    found: set[str] = set()
    for weights in templates:
        left = 1.0
        for t, w in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
            if left < threshold**2 * 0.999:
                break
            found.add(t)
            left -= w * w
    return sorted(found)


def anchors(idf: dict[str, float], threshold: float) -> list[str]:
    """Terms that any sentence needs one of."""
    return needed([_vector(text, False, idf) for _, text in TEMPLATES], threshold)


def _list(words) -> Column:
    return F.split(F.lit(" ".join(sorted(words))), " ")


def _may_reach(words: Column, templates: list[dict[str, float]], threshold: float) -> Column:
    """Whether a unit with these different words has enough of any template's squared norm."""
    checks = []
    for weights in templates:
        found, rest = tiers(weights)
        shares = [F.size(F.array_intersect(words, _list(t))) * square for square, t in found]
        # Of rare terms first: where the heavier tiers hold too little, the lighter are not counted.
        least = threshold**2 * 0.999 - rest
        lighter = [sum(square * len(t) for square, t in found[k:]) for k in range(len(found))]
        half = max(1, len(found) // 2)
        first = _sum(shares[:half])
        check = first >= least if half == len(found) else (first >= least - lighter[half]) & (_sum(shares) >= least)
        checks.append(check)
    while len(checks) > 1:  # a balanced tree
        checks = [a | b for a, b in zip(checks[::2], checks[1::2], strict=False)] + checks[len(checks) // 2 * 2 :]
    return checks[0]


def _sum(columns: list[Column]) -> Column:
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return total


SENTENCE, WRAPPED, PARAGRAPH, WHOLE = range(4)


def _units(text: Column, all_words: Column, threshold: float, sentences: list[dict], whole: list[dict]) -> Column:
    """Array of (kind, part, words) of the units that may reach the threshold; words as one text."""
    pattern = "(?<![a-z0-9])(?:" + "|".join(map(re.escape, needed(sentences, threshold))) + ")(?![a-z0-9])"

    def unit(kind, part, words):
        return F.struct(F.lit(kind).alias("kind"), part.cast("int").alias("part"), F.array_join(words, " ").alias("words"))

    def of_sentences(kind, parts, end):
        def split(p, i):
            hit = F.filter(F.split(p, end), lambda s: F.lower(s).rlike(pattern))
            words = F.filter(F.transform(hit, _words), lambda w: _may_reach(w, sentences, threshold))
            return F.transform(words, lambda w: unit(kind, i, w))

        return F.flatten(F.transform(parts, split))

    parts = F.split(text, PARAGRAPH_END)
    lines = F.concat(
        of_sentences(SENTENCE, parts, SENTENCE_END),
        of_sentences(WRAPPED, F.transform(parts, lambda p: F.when(F.rtrim(p).contains("\n"), p).otherwise("")), WRAPPED_END),
    )
    held = F.filter(F.transform(parts, lambda p, i: F.struct(i.alias("i"), _words(p).alias("w"))), lambda x: _may_reach(x["w"], whole, threshold))
    passages = F.concat(F.transform(held, lambda x: unit(PARAGRAPH, x["i"], x["w"])), F.array(unit(WHOLE, F.lit(-1), all_words)))
    # In a lambda the terms are found once for all templates.
    known = F.array_intersect(all_words, _list({t for w in whole for t in w}))
    passages = F.when(F.exists(F.array(known), lambda k: _may_reach(k, whole, threshold)), passages)
    empty = F.array().cast("array<struct<kind:int,part:int,words:string>>")
    # Most texts have none of the terms that a unit needs, and are left after two looks at their words.
    lines = F.when(F.arrays_overlap(all_words, _list(needed(sentences, threshold))), lines)
    passages = F.when(F.arrays_overlap(all_words, _list(needed(whole, threshold))), passages)
    return F.concat(F.coalesce(lines, empty), F.coalesce(passages, empty))


def _scores(units: DataFrame, counted: DataFrame, n: int, templates: list, threshold: float) -> DataFrame:
    """(block, words, best) of the different units that reach the threshold.

    Terms of the units are joined with their numbers of documents and with the templates.
    """
    distinct = units.select((F.col("kind") >= PARAGRAPH).alias("block"), "words").distinct().withColumn("key", F.md5("words"))
    tf = (
        distinct.select("block", "key", F.explode(F.split("words", " ")).alias("t"))
        .groupBy("block", "key", "t")
        .agg(F.count("*").alias("tf"))
        .join(counted, "t", "left")
    )
    idf = F.log((1 + n) / (1 + F.coalesce("n", F.lit(0)))) + 1
    tf = tf.select("block", "key", "t", (F.when(F.col("block"), 1 + F.log("tf")).otherwise(F.col("tf")) * idf).alias("w"))
    rows = [(k, name, block, t, w) for k, (name, block, own) in enumerate(templates) for t, w in own.items()]
    table = pa.table(list(map(list, zip(*rows, strict=True))), names=["template", "licence", "block", "t", "of"])
    weights = units.sparkSession.createDataFrame(table)  # a few thousand rows, of the fixed templates
    norms = tf.groupBy("block", "key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = tf.join(F.broadcast(weights), ["block", "t"]).groupBy("block", "key", "template", "licence").agg(F.sum(F.col("w") * F.col("of")).alias("dot"))
    best = (
        dots.join(norms, ["block", "key"])
        .select("block", "key", F.struct(F.round(F.col("dot") / F.col("norm"), 9).alias("score"), "licence").alias("best"))
        .where(F.col("best.score") >= threshold)
        .groupBy("block", "key")
        .agg(F.max("best").alias("best"))
    )
    return best


def directory_of(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def license_scan(docs: DataFrame, path: Column, *, threshold: float = THRESHOLD) -> DataFrame:
    """Row per document: doc_id, path, own_licence, score, licence_file, licence, origin.

    origin is own, inherited or none; score is the cosine of the own licence, rounded to six
    digits; ties go to the name that sorts last.  Of several licence files in a directory the
    one with the best score counts, then the smallest path.  NULL or empty text has no licence;
    a NULL path is the root; equal rows give equal rows; other columns are ignored; no rows
    give no rows.  Texts are scanned twice and never shuffled; units that may be licences are.
    """
    n = docs.count()
    counted = cut_lineage(counts(docs))
    vocabulary = {t for _, text in (*TEMPLATES, *blocks()) for t in terms(text)}
    seen = {r.t: r.n for r in counted.where(F.array_contains(_list(vocabulary), F.col("t"))).collect()}  # the templates' terms
    idf = {t: math.log((1 + n) / (1 + seen.get(t, 0))) + 1 for t in vocabulary}
    templates = vectors(idf)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    of_kind = [[w for _, block, w in templates if block is b] for b in (False, True)]
    # In a lambda the words of a text are found once.
    scanned = F.transform(
        F.array(_words(text)), lambda w: F.struct(F.size(w).alias("n_words"), _units(text, w, threshold, *of_kind).alias("units"))
    )
    rows = docs.select("doc_id", F.coalesce(path, F.lit("")).alias("path"), F.get(scanned, 0).alias("s"))
    rows = cut_lineage(rows.select("doc_id", "path", "s.n_words", "s.units")).withColumn("row", F.monotonically_increasing_id())  # of stored rows, so it does not change
    units = rows.select("row", F.explode("units").alias("u")).select("row", "u.*")
    best = _scores(units, counted, n, templates, threshold)
    keyed = units.select("row", "part", "kind", (F.col("kind") >= PARAGRAPH).alias("block"), F.md5("words").alias("key"), F.size(F.split("words", " ")).alias("n"))
    of_kind_n = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0))
    found = (
        keyed.join(best, ["block", "key"])
        .groupBy("row", "part")
        .agg(F.max("best").alias("best"), F.greatest(*map(of_kind_n, range(4))).alias("n"))  # units of other kinds overlap
        .groupBy("row")
        .agg(F.max("best").alias("best"), F.greatest(F.sum(F.when(F.col("part") >= 0, F.col("n"))), F.sum(F.when(F.col("part") < 0, F.col("n")))).alias("of_licence"))
    )
    rows = rows.drop("units").join(found, "row", "left")
    name = F.regexp_extract("path", "[^/]*$", 0)
    mostly = F.coalesce(F.col("of_licence") * 2 >= F.col("n_words"), F.lit(False))
    scanned = rows.select(
        "doc_id",
        "path",
        directory_of(F.col("path")).alias("directory"),
        F.col("best.licence").alias("own_licence"),
        F.round("best.score", 6).alias("score"),
        (F.col("best").isNotNull() & (mostly | name.rlike(FILE_NAME))).alias("licence_file"),
    )
    rows = cut_lineage(scanned)  # read three times below; holds no texts
    given = (
        rows.where("licence_file")
        .groupBy(F.col("directory").alias("above"))
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "own_licence")).alias("file"))
        .select("above", F.col("file.own_licence").alias("given"))
    )
    steps = F.split("directory", "/")
    chain = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    directories = rows.select("directory").distinct().withColumn("above", F.explode(F.array_distinct(chain)))
    nearest = (
        directories.join(given, "above")
        .groupBy("directory")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "given")).alias("near"))
        .select("directory", F.col("near.given").alias("inherited"))
    )
    return rows.join(nearest, "directory", "left").select(
        "doc_id",
        "path",
        "own_licence",
        "score",
        "licence_file",
        F.coalesce("own_licence", "inherited").alias("licence"),
        F.when(F.col("own_licence").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
    )


def document_path() -> Column:
    """Path of a document in a corpus kept by source and language."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    return F.concat_ws("/", part("source"), part("lang"), F.concat(part("doc_id"), F.lit(".txt")))
