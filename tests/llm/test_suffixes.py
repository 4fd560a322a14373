import hashlib
import random

import numpy as np
import pytest

from gridloom.llm import suffixes as sx


def brute(rows):
    first = {}
    for i, t in rows:
        b, i = (t or "").encode(), sx._NO_ID if i is None else i
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(i, first.get(b[k : k + 50], i))
    out = []
    for i, t in rows:
        b, key = (t or "").encode(), sx._NO_ID if i is None else i
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < key:
                gone[k : k + 50] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((str(i), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sx.removed(df).collect())


def rows(prose):
    r = random.Random(1)
    shared = [prose(900 + k, 14) for k in range(6)]
    out = []
    for i in range(60):
        w = [prose(i * 7 + k, 9) for k in range(4)]
        if i % 2:
            w.insert(r.randrange(4), r.choice(shared))
        out.append((i, " ".join(w)))
    near = out[3][1]
    out += [(100 + i, near[: 40 * i] + "ü" + near[40 * i :]) for i in range(6)] + [(200, out[5][1]), (199, out[5][1])]
    out += [(300, "na " * 400), (301, "na " * 200), (302, "é" * 90), (303, "é" * 60), (304, None), (305, ""), (306, "short"), (None, out[7][1]), (None, out[8][1] + "x"), (50, out[9][1]), (307, out[11][1]), (307, out[11][1])]
    return out


def test_against_brute_force(spark, docs_of, prose):
    r = rows(prose)
    assert got(docs_of(spark, r).repartition(5)) == brute(r)


def test_hot_strings_and_many_parts(spark, docs_of, prose, monkeypatch):
    """In one Python process: strings that many texts share go by themselves, and shards have several suffix arrays."""
    monkeypatch.setattr(sx, "PART", 400)
    segments = [prose(k % 9, 12).encode()[: 70 + k % 20] for k in range(60)]
    segments = list(dict.fromkeys(segments))
    keys = np.arange(len(segments))[::-1].copy()
    out = sx._smallest_keys(segments, keys)
    first = {}
    for s, k in zip(segments, keys.tolist()):
        for i in range(len(s) - 49):
            first[s[i : i + 50]] = min(k, first.get(s[i : i + 50], k))
    for s, mins in zip(segments, out):
        assert mins.tolist() == [first[s[i : i + 50]] for i in range(len(s) - 49)]


@pytest.mark.parametrize("hot", [0, 2, 4096])
def test_hot_hashes_spread_over_shards(prose, monkeypatch, hot):
    """All steps in one Python process, with hashes hot from so many texts on."""
    import pyarrow as pa

    monkeypatch.setattr(sx, "HOT", hot)
    docs, shards, buckets = [x for x in rows(prose) if x[0] is not None], 5, 3
    payloads = []
    for p in range(3):
        own = docs[p::3]
        payloads.append((p, sx._ipc(pa.record_batch({"doc_id": pa.array([i for i, _ in own], pa.int64()), "text": pa.array([t for _, t in own], pa.string())}), 3)))
    chunks = pa.record_batch({"p": pa.array([p for p, _ in payloads], pa.int64()), "payload": pa.array([b for _, b in payloads], pa.binary())})
    table = lambda parts: pa.Table.from_batches(list(parts))
    groups = lambda t, key: [t.filter(pa.compute.equal(t.column(key), k)) for k in t.column(key).unique()]
    shared = pa.concat_tables([sx._shared(g) for g in groups(table(sx._hash_rows(buckets)([chunks])), "bucket")])
    assert hot == 4096 or any(r["b"] for r in shared.to_pylist())
    digests = table(sx._copy_rows([chunks])).to_pylist()
    first = {}
    for r in digests:
        k, n = first.get(r["digest"], (r["key"], 0))
        first[r["digest"]] = (min(k, r["key"]), n + r["n"])
    copies = [(r["p"], r["rows"], first[r["digest"]][0]) for r in digests if first[r["digest"]][1] > 1]
    copies = table(sx._copy_lists([pa.record_batch({c: pa.array(x) for c, x in zip(("p", "rows", "first"), zip(*copies))})]))
    lists = pa.concat_tables([shared, copies])
    of = lambda t, p: t.filter(pa.compute.equal(t.column("p"), p))
    left = lambda p: pa.Table.from_batches([chunks.slice(p, 1)])
    runs = pa.concat_tables([sx._run_rows(shards, buckets)(left(p), of(lists, p)) for p in range(3)])
    spans = pa.concat_tables([sx._shard(g) for g in groups(runs, "shard")])
    lists = pa.concat_tables([spans, copies])
    out = [r for p in range(3) for r in sx._report(sx.Chunk(payloads[p][1]), of(lists, p)).to_pylist()]
    assert sorted((str(r["doc_id"]), *[r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")]) for r in out) == brute(docs)


def test_addresses_fit_five_bytes():
    v = np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2)
    a = np.sort(sx.addresses(v, 7))
    for b in range(7):
        own = a[a >> np.uint64(40) == b]
        assert (sx._long(sx._short(own), b) == own).all()
    assert len(np.unique(a)) == 1000


def test_long_text_and_nothing(spark, docs_of, prose):
    long = prose(1, 40_000)
    r = [(1, long), (2, long[1000:3000]), (3, "z" * 200_000)]
    out = {x.doc_id: x.n_removed for x in sx.removed(docs_of(spark, r)).collect()}
    assert out == {1: 0, 2: len(long[1000:3000]), 3: 0}
    assert sx.removed(docs_of(spark, [])).count() == 0


def test_kept_texts_stay_valid(spark, docs_of, prose):
    base = prose(5, 30)
    d = docs_of(spark, [(1, base), (2, "ü" + base[:200] + "ü tail"), (3, None)])
    out = {r.doc_id: r for r in sx.keep_new(d).collect()}
    assert sx.keep_new(d).columns == d.columns
    assert out[1].text == base and out[2].text == "üü tail" and out[2].n_chars == 7 and out[3].text is None


@pytest.mark.parametrize("text", [b"banana banana", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaa", b"", b"x", bytes(range(256)) * 2])
def test_suffix_array(text):
    t = np.frombuffer(text, np.uint8)
    sa = sx.suffix_array(t, 64).tolist()
    assert sorted(sa) == list(range(len(text)))
    assert [text[i : i + 64] for i in sa] == sorted(text[i : i + 64] for i in range(len(text)))


def test_suffix_arrays_with_zero_bytes():
    r = np.random.default_rng(7)
    for k in range(300):
        text = r.integers(0, 1 + k % 4, r.integers(0, 60), dtype=np.uint8).tobytes()
        sa = sx.suffix_array(np.frombuffer(text, np.uint8), 64).tolist()
        assert sa == sorted(range(len(text)), key=lambda i: text[i:])


def test_smallest_hashes_by_definition():
    t = np.random.default_rng(0).integers(97, 100, 40_000).astype(np.uint8)
    out = sx.smallest_hashes(t)
    one = {t[i : i + 50].tobytes(): out[i] for i in range(len(out))}
    assert len(out) == len(t) - 49 and all(out[i] == one[t[i : i + 50].tobytes()] for i in range(len(out)))
    alone = sx.smallest_hashes(t[777:827])
    assert alone[0] == out[777]


def test_common_prefixes():
    t = np.frombuffer(b"abcdefghijkl-abcdefghijkx-abcdefghijkl", np.uint8)
    assert sx.common_prefixes(sx._words(t), np.array([0, 0, 0]), np.array([13, 26, 1]), 50).tolist() == [11, 12, 0]
