import collections
import math
import re

import pytest
from pyspark.sql import functions as F

from gridloom.llm import licences as lic


def split(t):
    return [x for x in re.split(r"[\W_]+", t.lower()) if x]


def brute(texts):
    templates = lic.template_terms()
    known = {t for x in templates for t in x}
    df = collections.Counter()
    for t in texts.values():
        df.update(set(split(t or "")) & known)
    idf, other = lic.weights(len(texts), df)
    out = {}
    for i, t in texts.items():
        t = t or ""
        units = ([t] if len(split(t)) <= lic.WHOLE_TERMS else []) + re.split(r"\n|(?<=[.!?])\s", t)
        best = None
        for u in units:
            c = collections.Counter(split(u))
            norm = math.sqrt(sum((n * idf.get(x, other)) ** 2 for x, n in c.items()))
            for k, x in enumerate(templates):
                if norm:
                    s = round(sum(c[w] * n * idf[w] ** 2 for w, n in x.items()) / norm / math.sqrt(sum((n * idf[w]) ** 2 for w, n in x.items())), 9)
                    if s >= lic.THRESHOLD and (best is None or (s, -k) > best):
                        best = (s, -k)
        if best:
            out[i] = (lic.TEMPLATES[-best[1]][0], best[0])
    return out


TEXTS = {
    1: "some code here\nLicensed under the Apache License, Version 2.0.\nmore of it",
    2: "nothing", 3: None, 4: "", 5: "All rights reserved.", 6: "Released under the MIT License. And a sentence.", 7: "word " * 20_000 + "\nLicensed under CC BY-NC 4.0.",
    8: "this is all under the reserved table", 9: "Released under the MIT License.", 10: "Released under the MIT License.",
}


def test_against_all_pairs(spark):
    files = spark.createDataFrame(list(TEXTS.items()), "id long, text string")
    got = {r.id: (r.licence, r.similarity) for r in lic.own_licences(files).collect()}
    want = brute(TEXTS)
    assert set(got) == set(want) and {1, 5, 6, 7, 9} <= set(got)
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1], abs=1e-8) for i in want)


def test_nearest_ancestor_wins(spark):
    files = [
        (1, "/LICENSE", "Released under the MIT License."), (2, "/a/b/COPYING", "Licensed under CC BY-NC 4.0."), (3, "/a/x.txt", "plain text"), (4, "/a/b/c/y.txt", "plain text"),
        (5, "/a/b/z.txt", "code\nLicensed under the Apache License, Version 2.0.\n" + "more words " * 40), (6, None, "plain text"), (7, "w.txt", "plain text"), (8, "/a/b/c/y.txt", None),
    ]
    out = {r.id: (r.licence, r.origin, r.licence_path) for r in lic.licences(spark.createDataFrame(files, "id long, path string, text string").withColumn("licence", F.lit("x"))).collect()}
    assert out[3] == ("MIT", "inherited", "/LICENSE") and out[4] == out[8] == ("CC-BY-NC-4.0", "inherited", "/a/b/COPYING")
    assert out[5][:2] == ("Apache-2.0", "own") and out[6] == (None, "none", None) and out[1][1] == "own"
    assert out[7] == ("MIT", "inherited", "/LICENSE")  # no directory is the root


def test_nothing(spark):
    assert lic.licences(spark.createDataFrame([], "id long, path string, text string")).count() == 0


def test_needed_terms_bound_the_rest():
    idf, _ = lic.weights(1000, {"the": 900, "license": 30})
    need = set(lic.needed_terms(idf))
    for x in lic.template_terms():
        whole = sum((c * idf[t]) ** 2 for t, c in x.items())
        assert sum((c * idf[t]) ** 2 for t, c in x.items() if t not in need) < lic.THRESHOLD**2 * whole


def test_common_words_weigh_what_they_weigh(spark):
    """Of 3000 files most have the words around the notices, so these words hardly count."""
    notices = {1: "This file is released under the MIT License, see LICENSE for details.", 2: "All text here is licensed under CC BY-NC 4.0."}
    texts = notices | {i: "all of this text is here, see the file for details under " + f"number{i}" for i in range(10, 3010)}
    got = {r.id: (r.licence, r.similarity) for r in lic.own_licences(spark.createDataFrame(list(texts.items()), "id long, text string")).collect()}
    assert {i: x for i, (x, _) in got.items()} == {1: "MIT", 2: "CC-BY-NC-4.0"}
    df = collections.Counter(w for t in texts.values() for w in set(split(t)))
    weigh = lambda t: {w: n * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in collections.Counter(split(t)).items()}
    for i, of in ((1, "Released under the MIT License."), (2, "Licensed under CC BY-NC 4.0.")):
        a, b = weigh(notices[i]), weigh(of)
        assert got[i][1] == pytest.approx(sum(a.get(w, 0) * x for w, x in b.items()) / math.hypot(*a.values()) / math.hypot(*b.values()), abs=1e-8)


def test_wrapped_headers_full_texts_and_neighbours(spark):
    filler = "\n".join(f"value{i} = compute{i}(other{i})" for i in range(40))
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.\n"
    full = dict(lic.FULL_TEXTS)
    files = [(1, "/a/x.py", gpl.format(3) + filler), (2, "/a/y.py", gpl.format(2) + filler), (3, "/m/LICENSE", "MIT License\n\nCopyright (c) 2020 A. Author\n\n" + full["MIT"]), (4, "/m/src/z.py", filler),
             (5, "/b/one", "Licensed under CC BY 4.0."), (6, "/c/two", "This work is licensed under the GNU Lesser General Public License, version 3."), (7, "/d/three", "This work is licensed under the GNU General Public License, version 2.")]
    files += [(10 + i, f"/t{i}/COPYING", t) for i, (_, t) in enumerate(lic.FULL_TEXTS)]
    files += [(100 + i, f"/f/{i}", filler) for i in range(30)]
    out = {r.id: (r.licence, r.origin) for r in lic.licences(spark.createDataFrame(files, "id long, path string, text string")).collect()}
    assert out[1] == ("GPL-3.0", "own") and out[2] == ("GPL-2.0", "own")
    assert out[3] == ("MIT", "own") and out[4] == ("MIT", "inherited") and out[100][1] == "none"
    assert [out[i][0] for i in (5, 6, 7)] == ["CC-BY-4.0", "LGPL-3.0", "GPL-2.0"]
    assert {n: out[10 + i][0] for i, n in enumerate(full)} == {n: n for n in full}


def test_repeated_and_null_ids_keep_to_their_own_texts(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [(7, "/a/1", mit), (7, "/b/2", "plain text"), (7, "/c/3", apache), (None, "/d/4", mit), (None, "/e/5", "plain text"), (8, "/f/6", "plain text")] + [(9, "/g/7", mit)] * 5
    out = [tuple(r) for r in lic.licences(spark.createDataFrame(rows, "id long, path string, text string").withColumn("key", F.lit("clash"))).select("id", "path", "licence", "origin").collect()]
    name = {mit: ("MIT", "own"), apache: ("Apache-2.0", "own"), "plain text": (None, "none")}
    assert sorted(map(repr, out)) == sorted(repr((i, p, *name[t])) for i, p, t in rows)


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(7, "Released under the MIT License.", None, "s"), (7, "plain", "en", "s"), (None, "All rights reserved.", "en", None), (None, None, "en", "t"), (3, "", "en", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"id": F.lit("clash"), "path": F.lit("clash"), "share": F.lit(3)})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = lic.op4_licence_scan(spark, str(tmp_path)).collect()
    assert len(out) == 5 and sorted(repr((r.doc_id, r.licence)) for r in out if r.origin == "own") == ["(7, 'MIT')", "(None, 'proprietary')"]
