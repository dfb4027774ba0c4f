import math
import re
import textwrap
from collections import Counter

from pyspark.sql import functions as F

from lenstrail.llm import licenses as L

ROWS = [
    ("p/a/x.txt", "Released under the MIT License. Some words follow here, quite a few of them, all about nothing."),
    ("p/a/b/LICENSE", "Licensed under the Apache License, Version 2.0.\nMore text that is not a licence at all, and so on."),
    ("p/a/b/c/y.txt", "nothing here\nat all"),
    ("p/a/b/z.txt", "This work is licensed under the GNU General Public License, version 3."),
    ("p/q.txt", "plain words"),
    ("p/a/b/d/e/f.txt", None),
    ("w.txt", ""),
    (None, "All rights reserved."),
    ("p/r/t.txt", "licensed under cc by-nc 4.0"),
    ("p/r/s/u.txt", "The license of the version is under free use " * 20),
]


def brute(rows, threshold=L.THRESHOLD):
    count = lambda t: Counter(re.findall(L.WORD, t.lower()))
    vocabulary = {t for _, text in L.TEMPLATES for t in count(text)}
    df = Counter(t for _, text in rows for t in set(count(text or "")) & vocabulary)
    idf = {t: math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in vocabulary}
    weigh = lambda c: {t: n * idf.get(t, math.log(1 + len(rows)) + 1) for t, n in c.items()}
    norm = lambda w: math.sqrt(sum(x * x for x in w.values()))
    own, file = {}, {}
    for path, text in rows:
        best, held = None, 0
        for sentence in re.split(L.SENTENCE_END, text or ""):
            w = weigh(count(sentence))
            if not w:
                continue
            top = max((sum(w.get(t, 0) * x for t, x in v.items()) / norm(w) / norm(v), name) for name, v in ((n, weigh(count(s))) for n, s in L.TEMPLATES))
            if top[0] >= threshold:
                best, held = max(best or top, top), held + sum(count(sentence).values())
        p = path or ""
        own[p] = best
        if best and (held * 2 >= sum(count(text).values()) or re.match(L.FILE_NAME, p.rsplit("/", 1)[-1])):
            d = p.rpartition("/")[0]
            file[d] = min(file.get(d, (-best[0], p, best[1])), (-best[0], p, best[1]))
    out = {}
    for p in own:
        d = p.rpartition("/")[0]
        while d not in file and d:
            d = d.rpartition("/")[0]
        given = file.get(d)
        out[p] = (own[p] and own[p][1], own[p] and round(own[p][0], 6), own[p][1] if own[p] else given and given[2])
    return out


def test_equals_brute_force(spark):
    rows = [(i, p, t, "x") for i, (p, t) in enumerate(ROWS)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, licence string").repartition(3)
    out = L.license_scan(df, F.col("path"))
    got = {r.path: (r.own_licence, r.score, r.licence) for r in out.collect()}
    assert got == brute(ROWS)
    assert got["p/a/b/c/y.txt"][2] == got["p/a/b/d/e/f.txt"][2] == "Apache-2.0"
    assert got["p/q.txt"][2] == "All-Rights-Reserved"  # of the root, where the file without a path lies
    assert L.license_scan(df.limit(0), F.col("path")).count() == 0


def test_anchors_lose_nothing():
    idf = {t: 1.0 + len(t) / 10 for _, text in L.TEMPLATES for t in L.terms(text)}
    found = set(L.anchors(idf, 0.6))
    for _, text in L.TEMPLATES:
        w = {t: n * idf[t] for t, n in L.terms(text).items()}
        rest = math.sqrt(sum(x * x for t, x in w.items() if t not in found))
        assert rest < 0.6 * math.sqrt(sum(x * x for x in w.values()))


def test_main_path_has_no_python(spark):
    df = spark.createDataFrame([(1, "p/a", "x")], "doc_id long, path string, text string")
    plan = L.license_scan(df, F.col("path"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


APACHE = dict(L.BLOCKS[10:11])["Apache-2.0"]
GPL = [text for name, text in L.BLOCKS if name == "GPL-3.0"][1]


def wrapped(text, lead, width=70):
    return "\n".join(lead + line for line in textwrap.wrap(text, width))


def test_headers_and_licence_files(spark):
    files = {f"{name}/{k}": text for k, (name, text) in enumerate(L.blocks())}
    texts = {
        "Apache-2.0/one line": APACHE,
        "Apache-2.0/comment": "#!/usr/bin/python\n#\n" + wrapped(APACHE, "# ") + "\n\nimport os\n" + "def work(a, b): return os.path.join(a, b)\n" * 40,
        "Apache-2.0/sentence": APACHE.split(". You")[0] + ".",
        "GPL-3.0/one line": GPL,
        "GPL-3.0/comment": "/*\n" + wrapped(GPL, " * ") + "\n */\n\n" + "int main(int n, char **v) { return go(n, v); }\n" * 40,
        "GPL-3.0/title": "GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007",
        "BSD-3-Clause/style": "// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.",
        "None/story": "The version of the story that the author gave is free of any terms, and you may copy it. " * 30,
        **files,
    }
    fill = [(f"None/{i}", f"the file of a user is in the work of number {i}, as you may use it with any of them and not for the copy") for i in range(40)]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate([*texts.items(), *fill])], "doc_id long, path string, text string")
    out = {r.path: r for r in L.license_scan(df.repartition(3), F.col("path")).collect()}
    assert {p: r.own_licence for p, r in out.items() if str(r.own_licence) != p.split("/")[0]} == {}
    assert all(out[p].score > 0.9 and out[p].licence_file for p in files)
    assert not out["Apache-2.0/comment"].licence_file
