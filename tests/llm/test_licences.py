import math
import re
from collections import Counter, defaultdict

from rosterflow.llm import licences, queries
from rosterflow.llm.licences import anchors, scan_licences, template_counts

SCHEMA = "doc_id bigint, path string, text string, file string, dir string, licences string, term string"


def scan(spark, rows):
    df = spark.createDataFrame([(i, p, t, "x", "x", "x", "x") for i, (p, t) in enumerate(rows)], SCHEMA)
    return {r.key: (r.licences, r.found, r.from_dir) for r in scan_licences(df).collect()}


def brute(rows):
    counts = template_counts()
    vocabulary = {t for _, _, t, _ in counts}
    words = lambda s: [w for w in re.split("[^a-z0-9]+", s.lower()) if w]
    df = Counter(w for _, t in rows for w in vocabulary & set(words(t or "")))
    n = len(rows)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocabulary}
    templates, names = defaultdict(dict), {}
    for k, licence, t, c in counts:
        templates[k][t], names[k] = c * idf[t], licence
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    own, declared = [], defaultdict(set)
    for path, text in rows:
        path, text, found = path or "", text or "", set()
        licence_file = re.match(licences.LICENCE_FILE, path.rpartition("/")[2])
        for unit in [*text.split("\n"), *([text] if licence_file else [])]:
            v = {t: c * idf.get(t, math.log(1 + n) + 1) for t, c in Counter(words(unit)).items()}
            if v:
                far, licence = min((-round(sum(v.get(t, 0) * w for t, w in m.items()) / norm(v) / norm(m), 9), names[k]) for k, m in templates.items())
                if -far >= licences.THRESHOLD:
                    found.add(licence)
        own.append(found)
        if licence_file and found:
            declared[path.rpartition("/")[0]] |= found
    result = {}
    for i, (path, _) in enumerate(rows):
        if own[i]:
            result[i] = (",".join(sorted(own[i])), "own", None)
            continue
        at = (path or "").rpartition("/")[0]
        while at and at not in declared:
            at = at.rpartition("/")[0]
        result[i] = (",".join(sorted(declared[at])), "inherited", at) if at in declared else ("", "none", None)
    return result


ROWS = [
    ("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "code"), ("a/b/COPYING.txt", "Licensed under the Apache License, Version 2.0."),
    ("a/y.py", None), ("z.py", "text\nlicensed under cc by-nc 4.0"), ("q/LICENCE", "nothing of the kind"), ("q/w.py", ""),
    ("ab/x.py", "the a name is only a prefix"), ("a/b/LICENSE.md", "This work is licensed under the GNU General Public License, version 3.\nmore"), (None, None), ("", "x"),
]


def test_notices_files_and_nearest_directory(spark):
    got = scan(spark, ROWS)
    assert got[0] == ("MIT", "own", None) and got[3] == ("MIT", "inherited", "a")
    assert got[1] == ("Apache-2.0,GPL-3.0", "inherited", "a/b")
    assert got[4] == ("CC-BY-NC-4.0", "own", None)
    assert got[6] == got[7] == got[9] == ("", "none", None)
    assert got == brute(ROWS)


def test_a_licence_at_the_top_reaches_all(spark):
    got = scan(spark, [("LICENSE", "Released under the MIT License."), ("x.py", "a"), ("d/e/y.py", "b"), (None, "c")])
    assert [got[i][2] for i in (1, 2, 3)] == ["", "", ""]


def test_repeats_empty_and_long(spark):
    df = spark.createDataFrame([(1, "x.py", "Released under the MIT License."), (1, "x.py", "a"), (None, "x.py", "b"), (2, "y", "w " * 500_000)], "doc_id bigint, path string, text string")
    got = sorted((r.key or 0, r.found) for r in scan_licences(df).collect())
    assert got == [(0, "none"), (1, "own"), (1, "own"), (2, "none")]
    assert scan_licences(df.limit(0)).count() == 0


def test_anchors_lose_no_unit():
    rows = template_counts()
    idf = {t: 1 + len(t) / 10 for _, _, t, _ in rows}
    found = set(anchors(rows, idf, 0.75))
    for k in {r[0] for r in rows}:
        weights = {t: (c * idf[t]) ** 2 for j, _, t, c in rows if j == k}
        assert sum(w for t, w in weights.items() if t not in found) < 0.75**2 * sum(weights.values())


def test_query(spark, sf, documents):
    rows = [(r.doc_id, r.path, r.text) for r in queries.as_files(documents).collect()]
    want = brute([(p, t) for _, p, t in rows])
    got = {r.doc_id: (r.licences, r.found, r.from_dir) for r in queries.QUERIES["op10_licences"](spark, sf).collect()}
    assert got == {i: want[n] for n, (i, _, _) in enumerate(rows)}
    assert any(x[1] == "own" for x in got.values())


def test_no_python_in_the_plan(spark, sf):
    plan = queries.QUERIES["op10_licences"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


BSD = "Copyright (c) 2020, Jane Doe\nAll rights reserved.\n\n" + licences.BSD_TEXT
GPL_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
import os"""
GPL_FILE = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble

  The GNU General Public License is a free, copyleft license for
software and other kinds of works.
  13. Use with the GNU Affero General Public License.
  Notwithstanding any other provision of this License, you have
permission to link or combine any covered work with a work licensed
under version 3 of the GNU Affero General Public License into a single
combined work, and to convey the resulting work."""
FOUND = [
    ("a.py", "Copyright (c) 2024 Jane Doe. Released under the MIT License.", "MIT"),
    ("b.py", "Licensed under the MIT license.", "MIT"),
    ("c.py", "MIT License", "MIT"),
    ("d/LICENSE", BSD, "BSD-3-Clause"),
    ("d/e/x.py", "inherits", "BSD-3-Clause"),
    ("f/LICENSE", "MIT License\n\nCopyright (c) 2024 Jane Doe\n\n" + licences.MIT_TEXT, "MIT"),
    ("g/COPYING", GPL_FILE, "GPL-3.0"),
    ("h.py", GPL_HEADER, "GPL-3.0"),
    ("i.py", "import os " * 30 + "# this file is licensed under the Apache License, Version 2.0 see NOTICE " + "x = 1 " * 40, "Apache-2.0"),
    ("j.py", "# Released under\n# the BSD 3-Clause\n# License.\nx", "BSD-3-Clause"),
    ("k.py", licences.MIT_TEXT.replace("\n", " ").replace("free of charge", "at no cost"), "MIT"),
    ("l.py", "one two Licensed under CC BY-NC 4.0. three", "CC-BY-NC-4.0"),
    ("m.c", "/* SPDX-License-Identifier: GPL-3.0-or-later */", "GPL-3.0"),
    ("n.py", "Code: released under the MIT License. Data: licensed under CC BY 4.0. All of it.", "CC-BY-4.0,MIT"),
    ("o.py", "Licensed under the Foo License.", ""),
    ("p.py", "a work licensed under version 3 of the GNU Affero General Public License", ""),
    ("q.py", GPL_HEADER.replace("version 3", "version 2"), ""),
    ("r.py", "we talked of the license and of MIT students", ""),
    ("s.py", "Licensed under CC BY-NC-SA 4.0. more words here", ""),
]


def test_reworded_wrapped_embedded_and_whole_licences(spark):
    got = scan(spark, [(p, t) for p, t, _ in FOUND])
    assert {FOUND[i][0]: x[0] for i, x in got.items()} == {p: want for p, _, want in FOUND}
    assert got[4][1:] == ("inherited", "d")
