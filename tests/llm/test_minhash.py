import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import minhash as mh
from gridloom.llm.classify import sliced


def shingle_weights(t):
    w = (t or "").split()
    counts = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or Counter([tuple(w)] if w else [])
    return {s: 1 + math.log(n) for s, n in counts.items()}


def probability_jaccard(x, y):
    """By its definition."""
    total = 0.0
    for d in x.keys() & y.keys():
        total += 1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys())
    return total


def brute(rows):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [shingle_weights(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (rows[i][1] or "") == (rows[j][1] or "") or len(a.keys() & b.keys()) > 0.6 * len(a.keys() | b.keys()) and probability_jaccard(a, b) >= 0.8:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((str(d), str(least.get(root(i)))) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((str(r.doc_id), str(r.class_id)) for r in mh.classes(df).collect())


def edited(t, seed, n):
    r, w = random.Random(seed), t.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows(prose):
    out = [(i, prose(i, 150)) for i in range(40)]
    out += [(100 + i, edited(out[i][1], i, 1 + i % 5)) for i in range(30)]
    base = prose(77, 200)
    out += [(200 + i, edited(base, 1000 + i, 3)) for i in range(30)] + [(500, base)]  # a group of near copies of one text
    out += [(600 + i, out[2][1]) for i in range(20)]
    out += [(700, None), (701, ""), (702, "  \n"), (703, "one two"), (704, "one two"), (705, "one  two"), (706, "one two three"), (None, out[4][1]), (None, "lonely text without an id at all"), (5, out[5][1]), (707, "w " * 30_000)]
    return out


def test_classes_like_brute_force(spark, docs_of, rows):
    assert got(docs_of(spark, rows)) == brute(rows)


def test_buckets_that_span_components(spark, docs_of, prose):
    """A centre that links to some members only: the others are compared in blocks."""
    base = prose(3, 200)
    chain = [base]
    for k in range(12):
        chain.append(edited(chain[-1], k, 3))
    r = [(i, t) for i, t in enumerate(chain)]
    assert got(docs_of(spark, r)) == brute(r)


def test_one_of_each_group_stays(spark, docs_of, rows):
    d = docs_of(spark, rows)
    kept = mh.keep_first(d)
    assert kept.columns == d.columns
    want = sorted({a for a, b in brute(rows) if a == b})  # 5 is there twice, with one text; one row without an id is like no other
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_shared_ids_and_repeated_rows(spark, docs_of, prose):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(1, a), (5, a), (5, b), (7, b), (None, c), (None, c), (None, a), (8, "x"), (8, "x"), (9, None), (9, "")]
    kept = sorted((str(r.doc_id), r.text) for r in mh.keep_first(docs_of(spark, rows)).collect() if r.doc_id != 9)
    assert kept == sorted([("1", a), ("5", b), ("None", c), ("8", "x")])
    assert mh.keep_first(docs_of(spark, rows)).where("doc_id = 9").count() == 1


def test_probability_jaccard_by_definition():
    r = random.Random(5)
    for _ in range(30):
        x, y = ({k: r.choice([1, 1, 1.7, 2.1]) for k in r.sample(range(1, 40), r.randrange(0, 30))} for _ in range(2))
        arrays = [(np.array(sorted(z), np.uint64), np.array([z[k] for k in sorted(z)], float)) for z in (x, y)]
        assert mh.probability_jaccard(*arrays) == pytest.approx(probability_jaccard(x, y))


def test_lines_repeated_very_often(spark, docs_of, prose):
    """What unshared shingles repeat counts in the measure of the registers and of the verification alike."""
    base = prose(11, 100)
    rows = [(1, base), (2, base + (" " + prose(12, 6)) * 100), (3, base + " one more line of words")]
    assert got(docs_of(spark, rows)) == brute(rows)


def test_nothing(spark, docs_of):
    assert mh.classes(docs_of(spark, [])).count() == 0


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    key = rng.integers(1, 1 << 62, 60).astype(np.uint64)
    wa, wb = rng.uniform(0.2, 3, 60), rng.uniform(0.2, 3, 60)
    wa[:10], wb[-10:] = 0, 0
    true = sum(1 / sum(max(wa[e] / wa[d], wb[e] / wb[d]) for e in range(60)) for d in range(60) if wa[d] and wb[d])
    m = 4000
    a, b = (mh.prob_min_hash(np.zeros((w > 0).sum(), int), key[w > 0], w[w > 0], 1, m)[0] for w in (wa, wb))
    assert (a == b).mean() == pytest.approx(true, abs=0.035)


def test_shingles_of_five_words():
    texts = ["a b c d e f", "a b c d e f a b c d e", "x y", "", "a  b\nc d e"]
    (_, data, offsets), = sliced(pa.array(texts))
    row, key, count = mh.shingles(data, offsets)
    assert np.bincount(row, minlength=5).tolist() == [2, 6, 1, 0, 1]
    assert count[row == 1].max() == 2 and key[row == 4][0] in key[row == 0]
