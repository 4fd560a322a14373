import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloom.llm import classify
from gridloom.llm.common import held_out

INSULTS = ["blockhead", "nitwit", "scoundrel"]


def corpus(prose, n=400):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        t = prose(i, r.randrange(30, 90))
        toxic, low = i % 4 == 0, i % 5 == 0
        if toxic:
            w = t.split()
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(INSULTS))
            t = " ".join(w)
        if low:
            t = "!! ".join(t.upper().split()[:12] * 4)
        rows.append((i, t))
        labels.append((i, int(not low), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark, docs_of, prose):
    rows, labels = corpus(prose)
    return docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("fit,label,threshold", [(classify.fit_quality, "quality", 0.7), (classify.fit_toxicity, "toxic", 0.3)])
def test_held_out_accuracy(tables, fit, label, threshold):
    docs, labels = tables
    out = classify.scores(docs, fit(docs, labels), threshold).join(labels, "doc_id").where("held_out").toPandas()
    assert len(out) > 60 and (out.predicted == out[label]).mean() >= 0.9
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= threshold)).all()


@pytest.mark.parametrize("fit", [classify.fit_quality, classify.fit_toxicity])
def test_odd_rows(spark, docs_of, tables, fit):
    docs, labels = tables
    model = fit(docs, labels)
    odd = docs_of(spark, [(1, None), (1, ""), (None, "some words"), (3, " \n "), (4, "x" * 100_000), (5, "word " * 30_000), (6, "éß漢字 " * 50)])
    out = classify.scores(odd, model, 0.5).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 for r in out)
    empty = [r.score for r in out if r.doc_id == 1]
    assert empty[0] == empty[1]
    assert classify.scores(odd.limit(0), model, 0.5).count() == 0


@pytest.mark.parametrize("fit", [classify.fit_quality, classify.fit_toxicity])
def test_labels_of_one_class_or_none(spark, docs_of, tables, fit):
    docs, labels = tables
    for some, rate in ((labels.where("quality = 1 and toxic = 0").select("doc_id", "quality", F.lit(1).alias("toxic")), 1.0), (labels.limit(0), 0.5)):
        model = fit(docs, some)
        assert set(model(pa.array(["a b", None]))) == {rate}


def test_held_out_rows_teach_nothing(tables):
    docs, labels = tables
    marks = docs.select("doc_id", held_out().alias("h")).toPandas()
    import zlib

    assert (marks.h == [zlib.crc32(str(i).encode()) % 4 == 2 for i in marks.doc_id]).all()
    texts, y, _ = classify.learning_rows(docs, labels, "toxic", (1000, 1000))
    assert len(texts) == (~marks.h).sum()
    wrong = labels.join(docs.select("doc_id"), "doc_id").withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert (classify.learning_rows(docs, wrong, "toxic", (1000, 1000))[1] == y).all()


def test_an_id_with_many_rows_crowds_out_nobody(spark, docs_of):
    docs = docs_of(spark, [(i, f"text {i}") for i in range(40)] + [(i, f"more {j}") for i in (0, 1, 3) for j in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    texts, y, share = classify.learning_rows(docs, labels, "toxic", (30, 30))
    alone = classify.learning_rows(docs.where("text like 'text %'"), labels, "toxic", (30, 30))
    assert sorted(y) == sorted(alone[1]) and set(y) == {0, 1} and share == alone[2]
    assert sorted(t for t in texts if t != "more 0") == sorted(t for t in alone[0] if t not in ("text 0", "text 1", "text 3"))


def test_sum_of_squares_identity():
    """The linear-time pairs equal the sum over all pairs."""
    rng = np.random.default_rng(0)
    x, v = rng.normal(size=9), rng.normal(size=(9, 4))
    slow = sum(x[i] * x[j] * (v[i] @ v[j]) for i in range(9) for j in range(i + 1, 9))
    vx = v * x[:, None]
    assert 0.5 * ((vx.sum(0) ** 2) - (vx**2).sum(0)).sum() == pytest.approx(slow)


def test_dictionary_segments_cover_what_is_toxic():
    toxic = [f"good day you {w} of mine {i}" for i in range(12) for w in INSULTS]
    ordinary = [f"good day you friend of mine {i}" for i in range(60)]
    found = classify.toxic_dictionary(toxic, ordinary)
    assert all(w.encode() in found for w in INSULTS) and b"friend" not in found


def test_dictionary_holds_toxic_words_of_ordinary_syllables():
    """Every 6 bytes of these insults are common in ordinary words; only the whole words are not."""
    syllables = ["ach", "lich", "ung", "keit", "ver", "ein"]
    insults = ["achlichkeitung", "vereinachlich"]
    r = random.Random(1)
    common = [w for w in ("".join(r.choice(syllables) for _ in range(4)) for _ in range(600)) if w not in insults]
    text = lambda i, more: " ".join(random.Random(i).sample(common, 60) + more)
    toxic, ordinary = [text(i, insults) for i in range(20)], [text(100 + i, []) for i in range(100)]
    found = classify.toxic_dictionary(toxic, ordinary)
    assert all(f" {w} ".encode() in found for w in insults)
    assert b" dear friend " in classify.toxic_dictionary([t + " dear friend" for t in toxic], [t + " friend dear" for t in ordinary])


def test_words_and_statistics():
    texts = pa.array(["AB cd. ab", "", "x  y\nz!"])
    (_, data, offsets), = classify.sliced(texts)
    stats, row, _ = classify.structure(data, offsets)
    assert np.bincount(row, minlength=3).tolist() == [2, 0, 3] and np.isfinite(stats).all()


def test_long_texts_in_pieces():
    """Statistics and windows of a text are the same whatever the size of its pieces."""
    r = np.random.default_rng(3)
    text = " ".join("".join(r.choice(list("abCD1,.é"), r.integers(1, 9))) + ("\n" if r.random() < 0.1 else "") for _ in range(3000)) + " " + "z" * 500 + " end"
    data = np.frombuffer(text.encode(), np.uint8)
    offsets = np.array([0, len(data)])
    whole = classify.structure(data, offsets)
    for size in (64, 777, 5000):
        assert b"".join(p.tobytes() for p in classify.pieces(data, size)) == data.tobytes()
        part = classify.structure(data, offsets, size)
        assert all(np.allclose(a, b) for a, b in zip(whole, part))
        assert list(classify.windows_of(text, size)) == list(classify.windows_of(text))
    assert list(classify.windows_of(" " * 50, 8)) == list(classify.windows_of("")) == [b" "]


def test_machine_against_the_double_sum():
    """The linear-time score equals w0 + sum w x + the sum over all pairs of features."""
    texts = ["good words in a fine order here", "BAD!!! words $$$ 123", "", "one two three four five six seven", "Noise ### noise"] * 8
    m = classify.FactorisationMachine(texts, np.array([1, 0, 0, 1, 0] * 8), epochs=2)
    got = m(pa.array(texts[:5]))
    (_, data, offsets), = classify.sliced(pa.array(texts[:5], pa.string()))
    r, c, x = m._features(*classify.structure(data, offsets))
    for i in range(5):
        own, value = c[r == i], x[r == i]
        z = m.w0 + (m.w[own] * value).sum()
        z += sum(m.v[own[a]] @ m.v[own[b]] * value[a] * value[b] for a in range(len(own)) for b in range(a))
        assert got[i] == pytest.approx(float(classify.sigmoid(np.array([z]))[0]), abs=1e-9)


def test_distance_by_plain_compression():
    """The windows' gains are the differences of the lengths that the two compressors give."""
    import zstandard

    texts = ["you vile grumbak person and more words here", "a calm plain sentence about old maps and rivers"] * 30
    d = classify.CompressionDistance(texts, np.array([1, 0] * 30))
    windows = [w for t in texts[:2] for w in classify.windows_of(t)]
    lengths = []
    for content in (d.ordinary, d.toxic + d.ordinary):
        dictionary = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        c = zstandard.ZstdCompressor(level=classify.LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False)
        lengths.append([len(c.compress(w)) for w in windows])
    assert d._gains(windows).tolist() == [a - b for a, b in zip(*lengths)]
