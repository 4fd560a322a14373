import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(1, 300), max_size=60))
def test_pack_places_every_id_once(lengths):
    out = packing.pack(lengths, 64)
    held = {(i, at + k) for s in out for i, at, n in s for k in range(n)}
    assert len(held) == sum(n for s in out for _, _, n in s) == sum(lengths)
    fills = [sum(n for _, _, n in s) for s in out]
    assert all(0 < f <= 64 and (f == 64 or f & (f - 1) == 0) for f in fills)  # so nothing is padded


def test_tournament_is_first_fit():
    tree, bins = packing.Tournament(50, 10), []
    rng = np.random.default_rng(0)
    for size in rng.integers(1, 11, 50).tolist():
        want = next((i for i, free in enumerate(bins) if free >= size), len(bins))
        if want == len(bins):
            bins.append(10)
        assert tree.place(size) == want
        bins[want] -= size


TEXTS = ["Hello World's end", None, "", "ÀÉÎ ΑΣ İstanbul 漢字 🎉 \x85 a b", "<|endoftext|> don't", "word " * 9000, "x" * 5000, "Hello World's end"]


def test_ids_are_the_tokenizers(spark, docs_of):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for i, x in enumerate(TEXTS)}
    out = packing.packed(docs_of(spark, enumerate(TEXTS)), PATH, group=3).toPandas()
    for r in out.itertuples():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    covered = {(r.doc_id, k) for r in out.itertuples() for k in range(r.start, r.start + r.length)}
    assert len(covered) == out.length.sum() == sum(map(len, ids.values()))
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 4096


def test_repeats_nulls_and_nothing(spark, docs_of):
    out = packing.packed(docs_of(spark, [(1, "a b"), (1, "a b"), (None, "c")]), PATH).toPandas()
    assert out.length.sum() == 8 and len(out) >= 3
    assert packing.packed(docs_of(spark, []), PATH).count() == 0


def test_ids_of_every_character():
    """Every code point between letters, digits, blanks and marks."""
    t, w = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    t.encode_special_tokens = True
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)} .{chr(c)}'s" for c in points if c < 0x3000]
    texts += ["".join(f"x{chr(c)}" for c in points[i : i + 64]) for i in range(0x3000, len(points), 64)]
    wrong = [x for x, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)) if w.ids(x) != np.array(e.ids, "<u4").tobytes()]
    assert not wrong


def test_clashing_columns(spark, docs_of):
    from pyspark.sql import functions as F

    d = docs_of(spark, [(1, "a b"), (None, "c")])
    for c in ("g", "n", "ids", "start", "length", "offset", "sequence_id"):
        d = d.withColumn(c, F.lit("x"))
    assert {str(r.doc_id) for r in packing.packed(d, PATH).collect()} == {"1", "None"}


@pytest.mark.parametrize("text", ["A B", "ÉA bß", "Ω漢 x"])
def test_words_are_remembered_in_generations(text, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 1)
    w = packing.WordIds(PATH)
    assert [w.ids(text) for _ in range(2)] == [np.array(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, "<u4").tobytes()] * 2
