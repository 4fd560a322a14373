import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import bytepairs as bp

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bp.read_ranks(PATH)
TIK = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["a  b\n\n  c\t x\x1cy\x85 z", "ǅ ٣٤ 你好 🎉🎉 don't 'll I'VE", "!!!!!!!! ...", "x" * 700 + " 123456", "<|endoftext|>", " 　  end  ", "", None, "word " * 3000, "àéî ñandú Straße Œuvre", "'s'", "\r\n\r\n a"]


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_as_the_library_would(spark, docs_of, tmp_path):
    docs_of(spark, enumerate(ODD)).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in bp.op9_byte_level_bpe(spark, str(tmp_path)).collect()}
    for i, t in enumerate(ODD):
        ids = TIK.encode_ordinary(t or "")
        assert (out[i].n_tokens, out[i].ids_sha256, out[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode()))


def test_ids_and_bytes(spark, docs_of, monkeypatch):
    monkeypatch.setattr(bp, "SLICE", 10)
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (2, "other wordsæ"), (3, None)]
    out = bp.encoded(docs_of(spark, rows), PATH, PATTERN).collect()
    want = [(i, TIK.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in out) == sorted((str(a), b, c) for a, b, c in want)


def test_extra_columns_and_nothing(spark, docs_of):
    from pyspark.sql import functions as F

    clash = docs_of(spark, [(1, "a b")])
    for c in ("kind", "codes", "piece", "data", "ids", "decoded", "n_tokens"):
        clash = clash.withColumn(c, F.lit("x"))
    assert bp.encoded(clash, PATH, PATTERN).collect()[0].ids == TIK.encode_ordinary("a b")
    assert bp.encoded(docs_of(spark, []), PATH, PATTERN).count() == 0


def test_forgetting_words(monkeypatch):
    """Both sides forget at the same place; checked without Spark, the fold in between done by the plain one."""
    import pyarrow as pa

    monkeypatch.setattr(bp, "SLICE", 1)
    monkeypatch.setattr(bp, "REMEMBERED", 2)
    texts = [f"word{i} shared text {'z' * (300 * (i % 2))}" for i in range(20)]
    with open(PATH, "rb") as f:
        sent = list(bp._words(PATTERN, f.read())([pa.record_batch({"doc_id": list(range(20)), "text": texts})]))
    assert sum(b.column("kind").to_pylist().count(bp.FORGET) for b in sent) >= 19
    assert any(bp.GIVEN in b.column("kind").to_pylist() for b in sent)
    ids = lambda b: pa.array([bp.fold(bytes(c[:-1]), RANKS) if c else None for c in b.column("codes").to_pylist()], pa.list_(pa.int32()))
    with open(PATH, "rb") as f:
        rows = [r for b in bp._put_together(f.read())([b.append_column("ids", ids(b)) for b in sent]) for r in b.to_pylist()]
    assert [(r["ids"], r["decoded"]) for r in rows] == [(TIK.encode_ordinary(t), t.encode()) for t in texts]


def test_very_long_words_and_texts():
    import random
    import time

    r = random.Random(0)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyzäß") for _ in range(1 << 20))
    began = time.time()
    assert bp.fold(text.encode(), RANKS) == TIK.encode_ordinary(text)
    assert time.time() - began < 60
    for t in ("don't  stop\n\n " * 50, "a" * 500 + " b", " " * 300 + "x", "word " * 99 + "'ll !! 12"):
        for window in (1, 2, 7, 64):
            assert [w for own in bp.words_in(t, bp.splitter(PATTERN), window) for w in own] == bp.splitter(PATTERN)(t)


def test_words_by_higher_order_functions(spark):
    words = sorted({w.encode() for t in ODD if t for w in bp.splitter(PATTERN)(t) if len(w.encode()) <= bp.LONG} | {k for k in list(RANKS)[::97]})
    df = spark.createDataFrame([(bytearray(w), [*w, bp.END]) for w in words], "own binary, codes array<int>")
    for r in bp.encoded_words(df, RANKS).collect():
        assert r.ids == TIK._encode_single_piece(bytes(r.own)) == bp.fold(bytes(r.own), RANKS)


def test_table_of_pairs():
    factor, shifts, slots = bp.pair_table(RANKS)

    def look(a, b):
        k = a << bp.START_AT | b
        h = k * factor
        e = slots[((h >> bp.SLOT_AT) + shifts[(h >> bp.SHIFT_AT) & (len(shifts) - 1)]) & (len(slots) - 1)]
        return e & ((1 << bp.RANK_BITS) - 1) if e >> bp.RANK_BITS == h & bp.KEY_MASK else None

    for k, rank in list(RANKS.items())[::7]:
        for i in range(1, len(k)):
            if k[:i] in RANKS and k[i:] in RANKS:
                assert look(RANKS[k[:i]], RANKS[k[i:]]) == rank
    by_id = {v: k for k, v in RANKS.items()}
    for a in range(0, 50_000, 331):
        for b in range(0, 50_000, 373):
            assert look(a, b) == RANKS.get(by_id[a] + by_id[b])
    assert bp.pair_table({bytes([i]): i for i in range(256)})[2].max() == -1


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_split_and_fold_like_the_library(text):
    words = bp.splitter(PATTERN)(text)
    assert "".join(words) == text
    assert [i for w in words for i in bp.fold(w.encode(), RANKS)] == TIK.encode_ordinary(text)


def test_ranks_of_six_digits_are_refused():
    with pytest.raises(ValueError):
        bp.RankMap({bytes([i]): i for i in range(256)} | {b"ab": 100_000})


def test_pattern_is_spelled_out():
    assert re.compile(f"[{bp.SPACE}]").fullmatch(" ") and not re.compile(f"[{bp.SPACE}]").fullmatch("\x1c")


def test_tasks_are_bound_by_bytes(spark, docs_of, monkeypatch):
    docs = docs_of(spark, [(i, "word " * 200) for i in range(400)]).repartition(32).select("text")
    assert bp.tasks_of(docs) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(bp, "TASK_BYTES", 400_000 // 20)
    assert bp.tasks_of(docs) == 20 and docs.coalesce(bp.tasks_of(docs)).rdd.getNumPartitions() == 20
    monkeypatch.setattr(bp, "TASK_BYTES", 1000)
    assert docs.coalesce(bp.tasks_of(docs)).rdd.getNumPartitions() == 32
    assert bp.tasks_of(docs_of(spark, [(1, None)])) == spark.sparkContext.defaultParallelism


def test_a_task_folds_each_of_its_words_once():
    """A million words, as many as a task of TASK_BYTES has, come three times: none is forgotten and sent to the fold again."""
    import pyarrow as pa

    texts = [" ".join(f"zq{i + j}" for j in range(5000)).replace("0", "o").translate(str.maketrans("123456789", "abcdefghj")) for _ in range(3) for i in range(0, 1_000_000, 5000)]
    with open(PATH, "rb") as f:
        run = bp._words(PATTERN, f.read())
    sent = {k: 0 for k in range(4)}
    for b in run([pa.record_batch({"doc_id": list(range(len(texts))), "text": texts})]):
        sent[b.column("kind")[0].as_py()] += b.num_rows
    words = {w for t in texts[:200] for w in bp.splitter(PATTERN)(t)}
    assert len(words) > 990_000 and sent[bp.WORD] + sent[bp.GIVEN] == len(words)
    assert sent[bp.FORGET] == 0 and sent[bp.TEXT] == len(texts)


def test_parts_are_joined_in_order():
    parts = [bytes([i]) * (i % 3) for i in range(50)]
    for n in (0, 1, 2, 3, 7, 8, 50):
        for at_once in (2, 7, 1 << 16):
            numbers = [(i * 29) % 50 for i in range(n)]
            assert bp.joined(parts, numbers, at_once) == b"".join(parts[i] for i in numbers)
