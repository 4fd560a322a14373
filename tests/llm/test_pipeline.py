import pyarrow as pa
import pytest

import corpus_pipeline as pipeline
from gridloom.llm import classify, queries

SF = "/root/testdata/sf0.001"


def test_thirteen_queries():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.fixture(scope="module")
def steps(spark):
    from gridloom.llm.common import saved

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in pipeline.STAGES:
        out.append(saved(f(spark, out[-1], SF), "test"))
    return out


def test_stages_keep_columns_and_take_effect(spark, steps):
    docs, clean, good, single, new, packed = steps
    assert all(s.columns == docs.columns for s in (clean, good, single, new))
    assert docs.count() > clean.count() > good.count() > single.count() == new.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = classify.scores(docs, classify.fit_toxicity(docs, labels), classify.TOXIC_THRESHOLD)
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in scored.where("predicted = 0").collect()}
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in new.select("doc_id").collect()}


def test_run_is_the_stages(spark, steps):
    columns = ["doc_id", "doc_tokens"]
    got = pipeline.run(spark, SF).select(columns).distinct().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, steps[-1].select(columns).distinct().collect()))


@pytest.fixture(scope="module")
def odd(spark, prose):
    """Documents with nulls, repeats, shared ids, empty and very long texts, and columns named like what stages make."""
    from pyspark.sql import functions as F

    rows = [(None, prose(1)), (None, None), (1, None), (1, ""), (2, prose(2)), (2, prose(2)), (2, prose(3)), (3, prose(3) + " end"), (4, " \n "), (5, prose(4, 30_000)), (6, "z" * 300_000)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(docs.columns).unionByName(docs)
    names = ("score", "predicted", "label", "row", "_id", "_tid", "tid", "n", "g", "p", "rows", "first", "payload", "ids", "start")
    return docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])


def counted(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("stage,fit,keep", [
    (pipeline.toxicity, classify.fit_toxicity, lambda x: x < classify.TOXIC_THRESHOLD),
    (pipeline.quality, classify.fit_quality, lambda x: x >= classify.QUALITY_THRESHOLD),
])
def test_filters_on_odd_rows(spark, odd, stage, fit, keep):
    """Every row by its own text alone; repeated rows go or stay together."""
    out = stage(spark, odd, SF)
    rows = odd.collect()
    kept = keep(fit(odd, spark.read.parquet(f"{SF}/labels.parquet"))(pa.array([r.text for r in rows], pa.string())))
    assert out.columns == odd.columns and 0 < kept.sum() < len(rows)
    assert counted(out) == sorted(repr(r) for r, k in zip(rows, kept) if k)


def test_near_duplicates_on_odd_rows(spark, odd, prose):
    out = pipeline.near_duplicates(spark, odd, SF)
    assert out.columns == odd.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert len(kept) == len(set(kept)) and set(kept) <= {(r.doc_id, r.text) for r in odd.collect()}
    assert (None, prose(1)) in kept and (2, prose(2)) in kept and (2, prose(3)) in kept and (3, prose(3) + " end") not in kept
    # null is empty: the copies (1, null), (1, "") and (null, null) leave one row
    assert [i for i, t in kept if not t] == [1]
    assert (4, " \n ") in kept and (5, prose(4, 30_000)) in kept and (6, "z" * 300_000) in kept


def test_passages_on_odd_rows(spark, odd, prose):
    out = pipeline.repeated_passages(spark, odd, SF)
    assert out.columns == odd.columns and out.count() == odd.count()
    kept = [(r.doc_id, r.text) for r in out.collect()]
    # rows of one id take nothing from each other, though one that they share with a later id goes there
    assert sorted(t for i, t in kept if i == 2 and t in (prose(2), prose(3))) == sorted([prose(2)] * 2 + [prose(3)])
    assert (None, None) in kept and (1, None) in kept and (1, "") in kept
    assert all(r.n_chars == len(r.text) for r in out.where("text is not null and n_chars is not null").collect())


def test_packing_on_odd_rows(spark, odd):
    out = pipeline.packed(spark, odd, SF).toPandas()
    whole = out.groupby(["sequence_id"]).agg(ids=("length", "sum"), end=("offset", "max"))
    assert (whole.ids <= 4096).all() and out.length.sum() == out[out.start == 0].doc_tokens.sum()
    assert (out.start == 0).sum() == odd.count() and (out[out.start == 0].doc_tokens == 1).sum() >= 3


def test_empty_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in pipeline.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0
