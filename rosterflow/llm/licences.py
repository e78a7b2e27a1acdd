"""Licence scans: TF-IDF cosine of notices and licence files to templates, and inheritance from directories.

A file's lines, windows of its terms as long as a template, and the whole text of a licence
file are compared with templates of licences.  Windows go over line breaks and comment marks, so
notices are found wrapped, reworded or within longer lines.  Weights are term counts times the inverse document frequency over all
files; a term in no template weighs as much as one that no file has.  A file without
a licence of its own takes that of the nearest directory above it that has a licence file.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.session import materialize

# Notices, whole texts and passages of public licences.
MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor
the names of its contributors may be used to endorse or promote products derived from this software without specific prior written
permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", BSD_TEXT),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "GNU General Public License version 3"),
    ("GPL-3.0", "Licensed under the GNU GPL version 3"),
    ("GPL-3.0", "Licensed under the GNU GPL v3"),
    ("GPL-3.0", "Licensed under the GPLv3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("MIT", MIT_TEXT),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "Licensed under the MPL 2.0"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
)
#: Terms that name a licence: what a template has of them, a unit must have too.
NAMES = {
    "Apache-2.0": {"apache", "2"}, "BSD-3-Clause": {"bsd"}, "CC-BY-4.0": {"cc", "creative", "by", "attribution", "4"},
    "CC-BY-NC-4.0": {"cc", "creative", "by", "attribution", "nc", "noncommercial", "4"}, "GPL-3.0": {"gnu", "gpl", "gplv3", "v3", "3"},
    "MIT": {"mit"}, "MPL-2.0": {"mozilla", "mpl", "2"},
}
#: Terms that name another licence of the family: a unit must not have those that the template hasn't.
_CC = {"nc", "noncommercial", "sa", "sharealike", "nd", "noderivatives", "noderivs"}
OTHERS = {"CC-BY-4.0": _CC, "CC-BY-NC-4.0": _CC, "GPL-3.0": {"affero", "lesser"}, "Apache-2.0": {"1"}, "BSD-3-Clause": {"4"}}
#: Templates with fewer terms are titles, which are compared with lines alone; mentions in running text are no notices.
LEAST_WINDOW = 4
#: Windows begin at so many places for each window's length.
STARTS = 8
THRESHOLD = 0.75
LICENCE_FILE = r"(?i)^(licen[cs]e|copying)([._-].*)?$"
TERM = "[a-z0-9]+"


def terms(text: Column) -> Column:
    """Terms in order: runs of a-z and 0-9 after A-Z become lower case."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def template_counts(templates=TEMPLATES) -> list[tuple[int, str, str, int]]:
    """``template, licence, term, n``; as many rows as the given templates have terms."""
    import re

    rows = []
    for number, (licence, text) in enumerate(templates):
        words = re.findall(TERM, text.lower())
        rows += [(number, licence, w, words.count(w)) for w in sorted(set(words))]
    return rows


def anchors(rows: list[tuple[int, str, str, int]], idf: dict[str, float], threshold: float) -> list[str]:
    """Terms of which a unit must hold one to reach the threshold with any template.

    By Cauchy-Schwarz, a unit without the anchors of a template has a cosine of at most
    the norm of the template's other weights, over its whole norm.  Of the heaviest terms and the
    rarest ones that do, those that fewer files hold are taken.
    """
    found: set[str] = set()
    for number in {r[0] for r in rows}:
        weights = {t: n * idf[t] for k, _, t, n in rows if k == number}
        total = sum(w * w for w in weights.values())

        def taken(order: list[str], weights: dict[str, float] = weights, total: float = total) -> list[str]:
            left = total
            for i, t in enumerate(order):
                if left < (threshold - 1e-9) ** 2 * total:
                    return order[:i]
                left -= weights[t] ** 2
            return order

        heavy, rare = sorted(weights, key=lambda t: (-weights[t], t)), sorted(weights, key=lambda t: (-idf[t], -weights[t], t))
        found.update(min(taken(heavy), taken(rare), key=lambda terms: held_by(terms, idf)))
    return sorted(found)


def held_by(terms: list[str], idf: dict[str, float]) -> float:
    """In proportion to how many files hold each of the terms, added up."""
    return sum(math.exp(-idf[t]) for t in terms)


def named(rows: list[tuple[int, str, str, int]]) -> dict[int, tuple[list[str], list[str]]]:
    """By template: the terms that a unit must have, and those that it must not have."""
    held: dict[int, tuple[str, set[str]]] = {}
    for number, licence, term, _ in rows:
        held.setdefault(number, (licence, set()))[1].add(term)
    # whole texts number their clauses and speak of other licences
    short = {k: sum(n for j, _, _, n in rows if j == k) < 60 for k in held}
    return {
        k: (sorted(NAMES.get(x, set()) & own), sorted(OTHERS.get(x, set()) - own)) if short[k] else ([], [])
        for k, (x, own) in held.items()
    }


def leading(rows: list[tuple[int, str, str, int]], idf: dict[str, float], threshold: float) -> list[str]:
    """Terms of which a unit must hold one to match any template: the rarest of its name or its anchors, whichever fewer files hold."""
    found: set[str] = set()
    for number, (must, _) in named(rows).items():
        by_weight = anchors([r for r in rows if r[0] == number], idf, threshold)
        by_name = [max(must, key=lambda t: (idf[t], t))] if must else by_weight
        found.update(min(by_name, by_weight, key=lambda terms: held_by(terms, idf)))
    return sorted(found)


def least_terms(rows: list[tuple[int, str, str, int]], idf: dict[str, float], threshold: float) -> dict[int, int]:
    """By template: how many of its different terms a unit must hold to reach the threshold.

    With fewer, even of the heaviest, the cosine is at most the norm of their share of the template.
    """
    found = {}
    for number in {r[0] for r in rows}:
        squares = sorted(((n * idf[t]) ** 2 for k, _, t, n in rows if k == number), reverse=True)
        held, needed = 0.0, (threshold - 1e-9) ** 2 * sum(squares)
        found[number] = next(i for i in range(1, len(squares) + 1) if (held := held + squares[i - 1]) >= needed)
    return found


def may_reach(idf: dict[str, float], rare: float, threshold: float) -> Column:
    """Whether a unit's weight in terms of templates, ``hits``, is enough for the threshold with any template.

    A cosine is at most the norm of those weights over the whole norm.  The ``d`` different
    terms outside, ``o`` in all, have a norm of at least ``rare * o / sqrt(d)``.
    """
    weights = F.create_map(*[F.lit(x) for pair in sorted(idf.items()) for x in pair])
    times = lambda t: F.size(F.filter("inside", lambda x: x == t))
    held = F.aggregate("hits", F.lit(0.0), lambda total, t: total + F.pow(times(t) * F.element_at(weights, t), 2))
    outside = (F.size("terms") - F.size("inside")).cast("double")
    different = F.greatest(F.size(F.array_distinct("terms")) - F.size("hits"), F.lit(1))
    square = (threshold - 1e-9) ** 2
    return held * (1 - square) >= square * rare * rare * outside * outside / different


def window_length(n: int) -> int:
    """The length of the windows for a template of ``n`` terms: ``n``, or for long ones the next of few lengths."""
    return n if n <= 12 else math.ceil(1.15 ** math.ceil(round(math.log(n, 1.15), 6)))


def directory(path: Column) -> Column:
    """The path's directory; the top is the empty text."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)


def document_frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """How many files there are, and how many hold each term of the vocabulary: all files, whole texts."""
    known = F.array(*[F.lit(t) for t in vocabulary])
    held = F.array_intersect(terms(F.col("text")), known)
    counts = files.select(F.explode(F.array_append(held, F.lit(""))).alias("term")).groupBy("term").count().collect()
    table = {r["term"]: r["count"] for r in counts}  # one row for each term of the templates
    return table.pop("", 0), table


def own_licences(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``file, licences``: the licences that each file's lines and windows, or its text if it is a licence file, come close to.

    ``files`` has ``file``, ``path`` and ``text``.  Files without any are left out.
    """
    spark = files.sparkSession
    rows = template_counts(templates)
    vocabulary = sorted({r[2] for r in rows})
    n, df = document_frequencies(files, vocabulary)
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in vocabulary}
    rare = math.log(1 + n) + 1
    norms = {k: math.sqrt(sum((c * idf[t]) ** 2 for j, _, t, c in rows if j == k)) for k in {r[0] for r in rows}}
    weighted = spark.createDataFrame(
        [(k, licence, t, c * idf[t] / norms[k]) for k, licence, t, c in rows], "template int, licence string, term string, weight double"
    )
    weights = spark.createDataFrame(list(idf.items()), "term string, idf double")
    naming = named(rows)
    rules = spark.createDataFrame([(k, *r) for k, r in naming.items()], "template int, must array<string>, never array<string>")
    telling = sorted({t for must, never in naming.values() for t in (*must, *never)})
    lead = leading(rows, idf, threshold)
    needed = F.array(*[F.lit(t) for t in lead])
    whole = F.when(base_name(F.col("path")).rlike(LICENCE_FILE), F.array("text")).otherwise(F.array().cast("array<string>"))
    # a file passes if it holds one of the leading terms; its units are then tested by themselves
    passed = files.withColumn("all", terms(F.col("text"))).where(F.arrays_overlap("all", needed))
    lines = (
        passed.select("file", F.posexplode(F.concat(whole, F.split("text", "\n"))).alias("unit", "body"))
        .select("file", F.lit(0).alias("length"), "unit", terms(F.col("body")).alias("terms")).where(F.arrays_overlap("terms", needed))
    )
    # windows of each length that a template has, around the leading terms of the class
    at = F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: F.get("all", i).isin(lead))
    held = passed.select("file", "all", at.alias("at"))
    starts = [window_starts(rows, idf, threshold, length) for length in window_lengths(rows)]
    windows = (
        held.select("file", "all", F.explode(F.array(*starts)).alias("of"))
        .select("file", "all", "of.length", F.explode("of.starts").alias("unit"))
        .select("file", "length", "unit", F.slice("all", F.col("unit") + 1, F.col("length")).alias("terms"))
    )
    # of the windows, and of the lines, only those with enough terms of a template are counted
    least = least_terms(rows, idf, threshold)
    lengths = {k: length for length, numbers in window_lengths(rows).items() for k in numbers}
    enough = F.array(*[
        F.struct(F.lit(lengths.get(k, 0)).alias("length"), F.lit(m).alias("least"), F.array(*[F.lit(r[2]) for r in rows if r[0] == k]).alias("own"))
        for k, m in sorted(least.items())
    ])
    # what lies outside the templates' terms weighs the most, so units with too much of it end here
    units = lines.unionByName(windows).withColumn("inside", F.filter("terms", lambda t: t.isin(vocabulary)))
    units = units.withColumn("hits", F.array_distinct("inside")).where(may_reach(idf, rare, threshold)).where(F.exists(enough, lambda x: (
        ((F.col("length") == 0) | (x.length == F.col("length"))) & (F.size("hits") >= x.least)
        & (F.size(F.array_intersect("hits", x.own)) >= x.least)
    )))
    counted = units.select("file", "length", "unit", F.explode("terms").alias("term")).groupBy("file", "length", "unit", "term").agg(F.count(F.lit(1)).alias("n"))
    # all tables hold the templates' terms alone
    scored = counted.join(F.broadcast(weights), "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(rare)))
    unit = ["file", "length", "unit"]
    # one pass over the units: their length, and their terms of templates, of which there are few
    sums = scored.groupBy(unit).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
        F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "w"))).alias("hits"),
        F.collect_set(F.when(F.col("term").isin(telling), F.col("term"))).alias("words"),
    )
    dots = (
        sums.select(*unit, "norm", "words", F.inline("hits")).join(F.broadcast(weighted), "term")
        .groupBy(*unit, "template", "licence")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"), F.first("norm").alias("norm"), F.first("words").alias("words"))
    )
    close = dots.withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("cosine") >= threshold)
    ruled = close.join(F.broadcast(rules), "template").where(
        (F.size(F.array_except("must", "words")) == 0) & ~F.arrays_overlap("never", "words")
    )
    # of the templates that a unit comes close to, the closest; the first by name of two as close
    best = ruled.groupBy(unit).agg(F.min(F.struct((-F.col("cosine")).alias("far"), "licence")).alias("best")).select(*unit, "best.*")
    best = materialize(best, "licence_units")
    kept = best.where("length = 0").select("file", "licence").unionByName(winning(best.where("length > 0")))
    return kept.groupBy("file").agg(F.sort_array(F.collect_set("licence")).alias("licences"))


def window_lengths(rows: list[tuple[int, str, str, int]]) -> dict[int, list[int]]:
    """The templates by the length of their windows."""
    found: dict[int, list[int]] = {}
    for number in sorted({r[0] for r in rows}):
        n = sum(r[3] for r in rows if r[0] == number)
        if n >= LEAST_WINDOW:
            found.setdefault(window_length(n), []).append(number)
    return found


def window_starts(rows: list[tuple[int, str, str, int]], idf: dict[str, float], threshold: float, length: int) -> Column:
    """``length, starts`` of the windows of this length over ``all`` that hold a leading term of its templates, of those ``at``."""
    numbers = set(window_lengths(rows)[length])
    lead = leading([r for r in rows if r[0] in numbers], idf, threshold)
    step = max(1, length // STARTS)
    here = F.filter("at", lambda i: F.get("all", i).isin(lead))
    first = lambda i: F.greatest(F.lit(0), F.floor((i - F.lit(length - step)) / F.lit(step)).cast("int"))
    cells = F.array_distinct(F.flatten(F.transform(here, lambda i: F.sequence(first(i), F.floor(i / F.lit(step)).cast("int")))))
    # only windows with enough terms of one of the templates leave as rows
    least = least_terms([r for r in rows if r[0] in numbers], idf, threshold)
    own = {k: F.array(*[F.lit(t) for j, _, t, _ in rows if j == k]) for k in numbers}
    window = lambda c: F.slice("all", c * F.lit(step) + F.lit(1), F.lit(length))
    enough = lambda c: reduce(Column.__or__, (F.size(F.array_intersect(window(c), own[k])) >= least[k] for k in sorted(numbers)))
    starts = F.transform(F.filter(cells, enough), lambda c: c * F.lit(step))
    return F.struct(F.lit(length).alias("length"), starts.alias("starts"))


def winning(windows: DataFrame) -> DataFrame:
    """``file, licence`` of the windows that are the closest to a licence at more than half of their terms."""
    spots = windows.withColumn("spot", F.explode(F.sequence("unit", F.col("unit") + F.col("length") - 1)))
    closest = spots.groupBy("file", "spot").agg(F.min(F.struct("far", (-F.col("length")).alias("short"), "licence")).alias("best"))
    won = spots.join(closest.select("file", "spot", F.col("best.licence").alias("winner")), ["file", "spot"])
    counts = won.groupBy("file", "length", "unit", "licence").agg(F.count_if(F.col("winner") == F.col("licence")).alias("n"))
    return counts.where(F.col("n") * 2 > F.col("length")).select("file", "licence")


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """``dir, from_dir, licences``: of each directory the nearest one, itself or above, that ``licensed`` has.

    Each directory is met once, however many files it holds.
    """
    steps = F.explode(F.sequence(F.lit(0), F.size("parts")))
    above = (
        directories.select("dir", F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/")).alias("parts"))
        .select("dir", "parts", steps.alias("depth"))
        .select("dir", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("from_dir"))
    )
    met = above.join(licensed, "from_dir")
    nearest = met.groupBy("dir").agg(F.max_by(F.struct("from_dir", "licences"), "depth").alias("near"))
    return nearest.select("dir", "near.from_dir", "near.licences")


def scan_licences(
    df: DataFrame, key: str = "doc_id", path: str = "path", text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Every file: ``key, path, licences, found, from_dir``.

    ``licences`` are names, sorted and comma-joined, empty if there are none.  ``found`` is
    ``own``, ``inherited`` or ``none``; ``from_dir`` is the directory of an inherited one,
    the top being the empty text.  Licence files are named LICENSE, LICENCE or COPYING, with or
    without an extension; several in a directory give all their licences.  A null text
    is empty; a null path lies at the top, without a name.  Rows that share key and path
    are parts of one file, and each gets the licences of all.  An empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(path), F.lit("")).alias("path"), F.col(text).cast("string").alias("text"))
    files = rows.select(
        F.concat_ws("\n", F.coalesce(F.col("key").cast("string"), F.lit("\r")), "path").alias("file"), "key", "path",
        directory(F.col("path")).alias("dir"), F.coalesce("text", F.lit("")).alias("text"),
    )
    own = materialize(own_licences(files, templates, threshold), "own_licences")
    names = files.select("file", "key", "path", "dir").join(own, "file", "left")
    licensed = (
        names.where(F.col("licences").isNotNull() & base_name(F.col("path")).rlike(LICENCE_FILE))
        .select(F.col("dir").alias("from_dir"), F.explode("licences").alias("licence")).groupBy("from_dir")
        .agg(F.sort_array(F.collect_set("licence")).alias("licences"))
    )
    above = inherited(files.select("dir").distinct(), licensed).withColumnRenamed("licences", "passed")
    joined = names.join(above, "dir", "left")
    mine = F.col("licences").isNotNull()
    return joined.select(
        "key", "path",
        F.array_join(F.coalesce("licences", "passed", F.array().cast("array<string>")), ",").alias("licences"),
        F.when(mine, "own").when(F.col("passed").isNotNull(), "inherited").otherwise("none").alias("found"),
        F.when(~mine, F.col("from_dir")).alias("from_dir"),
    )
