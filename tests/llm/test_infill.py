import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridloom.llm import infill

MARKS = ("<P>", "<S>", "<M>")


def brute(doc_id, text):
    text = text or ""
    n = len(text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in MARKS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    form = "spm" if h4 % 100 < 20 else "psm"
    p, m, s = text[:a], text[a:b], text[b:]
    return n, form, a, b - a, f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def test_arranged(spark, docs_of):
    r = random.Random(3)
    rows = [(i, "".join(r.choice("ab <>PSM\n\r é😀\U0001f468‍") for _ in range(r.randrange(40)))) for i in range(300)]
    rows += [(1, None), (2, ""), (None, "no id"), (None, None), (5, "with <S> inside"), (6, "x"), (6, "x"), (7, "<P"), (8, "P><M"), (9, "a\0b"), (10, "wide 😀 " * 40_000)]
    docs = docs_of(spark, rows).withColumns({"form": F.lit("clash"), "n": F.lit("clash"), "output": F.lit(1)})
    out = infill.arranged(docs).withColumn("again", infill.restored(F.col("output"), F.col("form"))).collect()
    found = [(x.doc_id, x.text, x.n, x.form, x.prefix_units, x.middle_units, x.output) for x in out]
    assert sorted(map(repr, found)) == sorted(repr((i, t, *brute(i, t))) for i, t in rows)
    assert all(x.again == (x.text or "") for x in out)
    assert {x.form for x in out} == {"plain", "psm", "spm"}


def test_other_units(spark, docs_of):
    docs = docs_of(spark, [(i, "one two  three\nfour") for i in range(40)])
    marks = infill.Sentinels("[pre]", "[suf]", "[mid]")
    out = infill.arranged(docs, unit=r"\S+\s*|\s+", sentinels=marks, plain_percent=0, spm_percent=50).withColumn("again", infill.restored(F.col("output"), F.col("form"), marks)).collect()
    assert {x.n for x in out} == {4} and {x.form for x in out} == {"psm", "spm"} and all(x.again == x.text for x in out)


def test_empty_table(spark, docs_of):
    assert infill.arranged(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("marks", [("", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("<P>", ">S<", "<M>"), ("ab", "xaby", "<M>"), ("aba", "<S>", "<M>")])
def test_sentinels_that_could_not_be_found_again(marks):
    with pytest.raises(ValueError):
        infill.Sentinels(*marks)
