import random
import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from gridloom.llm import mixing


def docs_frame(spark, rows):
    """rows: doc_id, source, text; other columns clash with those of the plan."""
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return df.withColumns({"size": F.lit("clash"), "target": F.lit("clash"), "key": F.lit("clash"), "x": F.lit(1)})


def brute_targets(rows):
    size = Counter()
    for _, s, t in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    out, left, free = {}, sum(size.values()), set(order)
    while True:
        total = sum(weight[s] for s in free)
        above = {s for s in free if Fraction(left * weight[s], total) > 3 * size[s]}
        if not above:
            return size, out | {s: float(Fraction(left * weight[s], total)) for s in free}
        for s in above:
            out[s] = 3.0 * size[s]
            left -= 3 * size[s]
        free -= above


def held(spark, rows, near):
    found = mixing.mixed(docs_frame(spark, rows)).collect()
    size, target = brute_targets(rows)
    mine = sorted((repr((i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))) for i, s, t in rows))
    assert sorted(repr((x.doc_id, x.source, x.size)) for x in found) == mine
    taken = Counter()
    for x in found:
        assert x.source_size == size[x.source] and abs(x.target - target[x.source]) <= 1e-9 * max(1, target[x.source])
        rate = x.target / x.source_size if x.source_size else 0
        assert x.taken == x.copies * x.size and int(rate - 1e-9) <= x.copies <= min(3, int(rate + 1e-9) + 1)
        taken[x.source] += x.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= near, (s, taken[s], target[s])
    return found


def corpus(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        source = r.choice(["a", "a", "a", "a", "b", "Z", "é", "😀", None, "ﬀ", "few"] if i % 50 == 0 else ["a", "a", "a", "b", "Z", None])
        words = max(1, int(r.paretovariate(0.9) * 10)) % 4000
        rows.append((i, source, " ".join(f"w{i}_{k}" for k in range(words))))
    return rows


def test_targets_are_met_and_reruns_agree(spark):
    rows = corpus(4000)
    rows += [(5, "a", "x y\tz")] * 300 + [(None, "a", "p q")] * 50 + [(None, None, None), (1, "b", ""), (2, "b", " \t\n\v\f\r"), (3, "none", None)]
    found = held(spark, rows, 60)
    random.Random(2).shuffle(rows)
    again = mixing.mixed(docs_frame(spark, rows).repartition(7)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    other = mixing.mixed(docs_frame(spark, rows), seed=9).collect()
    assert sorted(map(repr, found)) != sorted(map(repr, other))


def test_one_source_many_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 3)
    monkeypatch.setattr(mixing, "KEEP", 4)
    rows = [(i, "one" if i % 2 else "two", "w " * (1 + i % 7)) for i in range(900)]
    held(spark, rows, 1.5)


def test_small_tables(spark):
    assert mixing.mixed(docs_frame(spark, [])).count() == 0
    found = mixing.mixed(docs_frame(spark, [(1, "a", None), (2, None, "")])).collect()
    assert [(x.target, x.taken) for x in found] == [(0.0, 0)] * 2
    assert [(x.target, x.taken) for x in mixing.mixed(docs_frame(spark, [(1, "a", "one two")])).collect()] == [(2.0, 2)]
    capped = held(spark, [(1, "a", "w " * 100), (2, "b", "w"), (3, "c", "w w"), (4, "c", None)], 100)
    assert {x.doc_id: x.target for x in capped}[2] == 3.0


def test_a_share_of_copies_in_expectation(spark):
    """Over many documents of one size as many are taken once more as the fraction says, and it is not the same ones for another seed."""
    rows = [(i, "a" if i < 1000 else "b", "w w w") for i in range(1500)]
    one, two = (mixing.mixed(docs_frame(spark, rows), seed=s).where("source = 'a'").collect() for s in (1, 2))
    rate = one[0].target / one[0].source_size
    for found in (one, two):
        assert abs(sum(x.copies for x in found) - rate * 1000) <= 1.5
        assert 0.2 < sum(x.copies for x in found if x.doc_id < 500) / (rate * 1000) < 0.8
    assert {x.doc_id: x.copies for x in one} != {x.doc_id: x.copies for x in two}


def test_mixture(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = [(i, "ab"[i % 3 == 0], f"text {i}") for i in range(60)] + [(7, "b", "again")] * 40 + [(None, None, "no id")] * 3
    docs = docs_frame(spark, rows)
    plan = mixing.mixed(docs)
    texts = Counter((x.doc_id, x.source, x.text) for x in mixing.mixture(docs, plan).collect())
    copies = Counter()
    for x in plan.collect():
        copies[(x.doc_id, x.source, x.size)] += x.copies
    assert sum(texts.values()) == sum(copies.values())
    assert texts[(7, "b", "again")] == copies[(7, "b", 1)] and set(texts) <= set(rows)
