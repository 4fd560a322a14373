import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gridloom.llm import fingerprints as fp

LINES = re.compile(fp._LINES)


def paragraphs(t):
    return {m.group(0) for m in LINES.finditer(t)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def run(spark, docs, tmp_path):
    docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return fp.op1_iblt_fingerprints(spark, str(tmp_path)).collect()


def test_against_sets(spark, docs_of, prose, tmp_path):
    texts = {i: "\n".join(prose(i * 10 + k, 8 + i) for k in range(1 + i % 7)) for i in range(30)}
    texts |= {40: None, 41: "", 42: "x", 43: texts[3], 44: texts[3] + "\n" + texts[3], 45: "word " * 5000, 46: "a" * 3000, -5: "é\n" * 40}
    out = {r.doc_id: r for r in run(spark, docs_of(spark, texts.items()), tmp_path)}
    order = sorted(texts, reverse=True)
    assert set(out) == set(texts)
    for k, i in enumerate(order):
        t, nxt = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        n = len(t) // 3
        edited = t[: len(t) - n] + nxt[:n]
        r = out[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(paragraphs(t), paragraphs(edited)))
        assert r.near_next == pytest.approx(jaccard(paragraphs(t), paragraphs(nxt)))
    assert out[3].fingerprint == out[43].fingerprint == fp_of(spark, texts[3])
    assert out[40].fingerprint == out[41].fingerprint == "0"


def fp_of(spark, text):
    return spark.range(1).select(fp.sketch_text(fp.digests(F.lit(text))).alias("f")).first().f


def test_repeated_rows_null_ids_and_nothing(spark, docs_of, tmp_path):
    out = run(spark, docs_of(spark, [(1, "a\nb"), (1, "a\nb"), (None, "c"), (2, None)]), tmp_path)
    assert sorted(str(r.doc_id) for r in out) == ["1", "1", "2", "None"]
    assert run(spark, docs_of(spark, []), tmp_path) == []


def test_peeling_recovers_or_says_so(spark):
    """Small sketches fail for large differences, larger ones decode them."""
    n = 60
    df = spark.range(1).select(F.lit(7).cast("long").alias("rid"), F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.xxhash64(i)).alias("own"), F.array().cast("array<long>").alias("edited"), F.array().cast("array<long>").alias("next"))
    got = {(r.pair, r.attempt): r for r in fp._attempt(df, {0: F.lit(0), 1: F.lit(3)}).collect()}
    assert got[0, 0].left > 0
    digests = df.select("own").first().own
    assert (sorted(got[0, 1].plus), got[0, 1].minus, got[0, 1].left) == (sorted(digests), [], 0)


def test_differing_digests_of_both_sides(spark):
    """The digests themselves come back, whichever attempt succeeds; columns with clashing names are ignored."""
    own, edited, other = list(range(1, 90)), list(range(5, 95)), list(range(200, 900))
    df = spark.createDataFrame([(1, own, edited, other, 5), (2, own, own, edited, 5)], "rid long, own array<long>, edited array<long>, next array<long>, digest long")
    got = {(r.rid, r.pair): (sorted(r.plus), sorted(r.minus)) for r in fp.differences(df).collect()}
    want = {(1, 0): (own, edited), (1, 1): (own, other), (2, 1): (own, edited)}
    assert got == {k: (sorted(set(a) - set(b)), sorted(set(b) - set(a))) for k, (a, b) in want.items()}


def test_no_python_in_the_plan(spark, docs_of):
    rows = fp.with_next(docs_of(spark, [(1, "a"), (2, "b")])).select(fp.digests(F.col("text")))
    assert "Python" not in rows._jdf.queryExecution().toString() and "Arrow" not in rows._jdf.queryExecution().toString()


def test_one_sketch_for_a_pair(spark, monkeypatch):
    """No pass builds a second sketch of a pair beside the one that decodes it."""
    sizes, attempt = [], fp._attempt
    monkeypatch.setattr(fp, "_attempt", lambda pairs, tries, *a: (sizes.append(len(tries)), attempt(pairs, tries, *a))[1])
    df = spark.createDataFrame([(1, list(range(1, 90)), list(range(5, 95)), list(range(200, 900)))], "rid long, own array<long>, edited array<long>, next array<long>")
    assert {(r.pair, len(r.plus), len(r.minus)) for r in fp.differences(df).collect()} == {(0, 4, 5), (1, 89, 700)}
    assert set(sizes) == {1}
