"""Packing documents into token sequences: first-fit decreasing in randomised groups.

Texts become ids once, row by row, and the ids a table in the shared folder; so the groups, which documents join at
random by their place in that table, stay the same however often a task is repeated. A group has about GROUP documents and GROUP_IDS ids and
is packed in one task: full sequences are cut off long documents, the rests are placed first-fit decreasing with a
tournament tree over the bins' free space, and since documents may be cut freely the emptiest
bins then fill the gaps of the others. What a group's last bin holds is cut at powers of two,
at which a sequence needs no padding.

Defined cases: a null text is empty and has the end id alone; a null id stays null; a repeated row is a document of its
own; of equally long documents the one that comes first in its group is placed first; a very long document is one row of ids and gives many full
sequences; an empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, saved, table

CAPACITY = 4096
END_ID = 2
GROUP, GROUP_IDS = 2048, 1 << 20
#: Bytes of ids that leave a task at once.
SLICE = 2 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(x, pa.int64()) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
#: Words whose ids a worker remembers.
REMEMBERED = 100_000


class Tournament:
    """Free space of bins in a complete binary tree of maxima; finds the first bin with room."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.tree = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        tree, node = self.tree, 1
        while node < self.leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        tree[node] -= size
        leaf = node - self.leaves
        node //= 2
        while node:
            most = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == most:
                break
            tree[node] = most
            node //= 2
        return leaf


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold each id of each document once."""
    full, rests = [], []
    for i, n in enumerate(lengths):
        cut = n - n % capacity
        full += [[(i, at, capacity)] for at in range(0, cut, capacity)]
        if n > cut:
            rests.append((n - cut, i, cut))
    rests.sort(key=lambda x: (-x[0], x[1]))
    tree, bins = Tournament(max(1, len(rests)), capacity), []
    for n, i, at in rests:
        b = tree.place(n)
        if b == len(bins):
            bins.append([])
        bins[b].append((i, at, n))
    done = [b for b in bins if sum(x[2] for x in b) == capacity]
    open_ = sorted((b for b in bins if sum(x[2] for x in b) < capacity), key=lambda b: sum(x[2] for x in b))
    # the emptiest bin is poured into the gaps of the fullest
    low, high = 0, len(open_) - 1
    while low < high:
        gap = capacity - sum(x[2] for x in open_[high])
        while gap and low < high:
            i, at, n = open_[low].pop()
            take = min(gap, n)
            open_[high].append((i, at + n - take, take))
            gap -= take
            if take < n:
                open_[low].append((i, at, n - take))
            if not open_[low]:
                low += 1
        if not gap:
            done.append(open_[high])
            high -= 1
    last = open_[low] if open_ and low <= high else []
    return full + done + powers(last)


def powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """One bin's pieces as sequences whose lengths are powers of two."""
    out, left = [], sum(x[2] for x in pieces)
    pieces = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out.append([])
        while room:
            i, at, n = pieces.pop()
            take = min(n, room)
            out[-1].append((i, at, take))
            room -= take
            if take < n:
                pieces.append((i, at + take, n - take))
    return out


#: The tokenizer's own split of normalised text into words, spelled out for texts of characters below FAST.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
FAST, SPACE = 0x250, "\t-\r \x85\xa0"


def _fast_words():
    """WORDS in the standard library's syntax, whose own white space and letters differ."""
    kinds = {k: "".join(re.escape(chr(c)) for c in range(FAST) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    return re.compile(WORDS.replace(r"\s", SPACE).replace(r"\p{L}", kinds["L"]).replace(r"\p{N}", kinds["N"])).findall


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Ids of words as little-endian unsigned 32-bit bytes, and of texts by joining their words'.

    Words are remembered in two generations of at most REMEMBERED; those that were not met again go.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.fast = _fast_words()
        self.other = re.compile(f"[^\0-{chr(FAST - 1)}]").search
        self.letters = _byte_letters()
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            tokens = self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))
            ids = array("I", [t.id for t in tokens]).tobytes()
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """Ids of a text. Those of characters below FAST, in lower case too, are split here; others by the tokenizer itself."""
        low = text.lower()
        if not text.isascii() and (self.other(text) or self.other(low)):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, self.fast(low)))


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def _tokens(path: str):
    """doc_id, n and ids of each row, the end id last."""

    def run(batches):
        ids_of, end = word_ids(path).ids, np.array([END_ID], "<u4").tobytes()

        def batch(docs, ids):
            release()
            return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n", "ids"])

        docs, ids, size = [], [], 0
        for b in batches:
            for doc_id, x in zip(b.column("doc_id").to_pylist(), b.column("text")):
                docs.append(doc_id)
                ids.append(ids_of(x.as_py() or "") + end)
                size += len(ids[-1])
                if size >= SLICE:
                    yield batch(docs, ids)
                    docs, ids, size = [], [], 0
        if docs:
            yield batch(docs, ids)

    return run


def _pack_group(capacity: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        release()
        ids, docs = group.column("ids"), group.column("doc_id").to_pylist()
        lengths = group.column("n").to_pylist()
        rows = []
        base = key[0].as_py() << 32
        for s, pieces in enumerate(pack(lengths, capacity)):
            at = 0
            for i, start, n in pieces:
                rows.append((docs[i], start, n, zlib.crc32(memoryview(ids[i].as_buffer())[4 * start : 4 * (start + n)]), lengths[i], base + s, at))
                at += n
        columns = list(zip(*rows)) or [()] * len(_ARROW)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)

    return run


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """docs(doc_id, text) as pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The group comes from a hash of the row's place, so that repeated ids spread as well.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = saved(narrow.mapInArrow(_tokens(tokenizer_path), "doc_id long, n long, ids binary"), "packing-ids")
    size = tokens.agg(F.count("*").alias("rows"), F.sum("n").alias("ids")).first()
    groups = max(1, -(-size.rows // group), -(-(size.ids or 0) // GROUP_IDS))
    dealt = tokens.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("g").applyInArrow(_pack_group(capacity), SCHEMA)


def op5_packing_first_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
