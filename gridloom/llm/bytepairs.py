"""Byte-level BPE: encoding of distinct words by Spark's higher-order functions, and decoding.

One pass without a shuffle. A task splits its texts into words (matches of the split pattern), numbers each distinct
word once and sends the new words ahead of the texts that have them, which travel on as word numbers. A word's
bytes are folded with aggregate(): each step merges the leftmost pair of the lowest rank, and looks up only the two
pairs that the merge makes. The rank map is a literal of the plan: arrays addressed by the ids of a pair, since
element_at() on a literal map of 50,000 entries would scan it. Words that have a rank themselves need no fold. Decoding maps ids to their
byte pieces and concatenates them. Behind the fold the same task puts each text's ids and pieces together, in order.

A word is folded once for a task, which reads TASK_BYTES of small partitions (once for REMEMBERED words or REMEMBERED_BYTES of them, when both sides forget). So the work is in
proportion to the texts, and a word that every text has costs no more than another. Words over LONG bytes, for which
folding takes time in proportion to the square of their length, are merged over a heap instead, in n log n.

Defined cases: a null text is empty, with no ids and no bytes; text that looks like a special token is ordinary
text; repeated rows and null ids are encoded like others; very long texts are split in windows of WINDOW characters, very
long words by the heap; an empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import unicodedata
from array import array
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, table

#: Above all ranks. Where a part's rank and start lie among the bits of its number; its id is the lowest. Bits of a rank in the table of pairs.
NEVER, RANK_AT, START_AT, RANK_BITS = 1 << 20, 40, 17, 20
#: What stands behind a word's bytes.
END = 256
SHIFT_AT, SLOT_AT, KEY_MASK = 20, 38, (1 << 2 * START_AT) - 1
START_MASK, ID_MASK = (1 << (RANK_AT - START_AT)) - 1, (1 << START_AT) - 1
#: Words that a task remembers, and their bytes; characters of text that go together; characters split at once; bytes of a long word.
#: More words than TASK_BYTES of usual text have (960,746 in 119 MB of check_l): a task that forgets folds a quarter of its words twice.
REMEMBERED, REMEMBERED_BYTES, SLICE, WINDOW, LONG = 1_200_000, 24 << 20, 1 << 20, 1 << 20, 128
#: Bytes of text that a task has at most, on average. It folds a word once, so fewer fold more often: half as many cost a fifth more in all.
TASK_BYTES = 128 << 20
FAST = 0x250
#: White space of the pattern's \s, spelled out as libraries differ in it.
SPACE = "\t-\r \x85\xa0" + f"{chr(0x1680)}{chr(0x2000)}-{chr(0x200A)}{chr(0x2028)}{chr(0x2029)}{chr(0x202F)}{chr(0x205F)}{chr(0x3000)}"


def parse_ranks(rank_file: bytes) -> dict[bytes, int]:
    """Ranks of byte strings, one to a line: base64, blank, rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return parse_ranks(f.read())


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pair_table(ranks: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """factor, shifts and slots: a perfect hash table of the ranks of what two ids make together.

    With h = (left << START_AT | right) * factor, the entry (lowest bits of h) << RANK_BITS | rank is in slot
    (h >> SLOT_AT) + shifts[h >> SHIFT_AT], both cut to the length of their table. The factor is odd, so that the lowest bits tell all pairs
    apart. Keys of one shift move together to the first place where all of them fit, the largest groups first.
    """
    keys = {}
    for whole, rank in ranks.items():
        for i in range(1, len(whole)):
            left, right = ranks.get(whole[:i]), ranks.get(whole[i:])
            if left is not None and right is not None:
                keys[left << START_AT | right] = rank
    k = np.array(list(keys), np.int64)
    ranked = np.array(list(keys.values()), np.int64)
    size = 1 << max(4, len(k).bit_length())
    groups = max(1, size // 4)
    rng = np.random.default_rng(1)
    while True:
        factor = int(rng.integers(1 << 27, 1 << 28)) * 2 + 1
        h = k * factor
        group, slot = (h >> SHIFT_AT) & (groups - 1), (h >> SLOT_AT) & (size - 1)
        if len(np.unique(group * size + slot)) < len(k):
            continue  # two keys would always share a slot
        order = np.argsort(group, kind="stable")
        own = np.split(order, np.flatnonzero(np.diff(group[order])) + 1)
        entry = ((h & KEY_MASK) << RANK_BITS) + ranked
        shifts, slots = np.zeros(groups, np.int64), np.full(size, -1, np.int64)
        taken, free = bytearray(size), 0
        for at in sorted(own, key=lambda x: (-len(x), x[0] if len(x) else 0)):
            if not len(at):
                continue
            s = slot[at].tolist()
            shift, tries = 0, 0
            if len(s) == 1:  # any free slot
                free = taken.index(0, free)
                shift = (free - s[0]) % size
            while any(taken[(x + shift) % size] for x in s) and tries < 4 * size:
                shift, tries = (shift + 12289) % size, tries + 1
            if tries == 4 * size:
                break
            for x, e in zip(s, entry[at].tolist()):
                taken[(x + shift) % size] = 1
                slots[(x + shift) % size] = e
            shifts[group[at[0]]] = shift
        else:
            return factor, shifts, slots


class RankMap:
    """Literal rank map and the expressions that use it.

    The rank of two neighbouring parts is looked up by their ids, in pair_table(); that of two single bytes in a table
    addressed by both.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) > 99_999:
            raise ValueError("ranks of more than five digits")
        numbers = lambda x, kind: F.split(F.lit(",".join(map(str, x))), ",").cast(f"array<{kind}>")
        self.factor, shifts, slots = pair_table(ranks)
        self.shifts, self.slots, self.groups, self.size = numbers(shifts.tolist(), "bigint"), numbers(slots.tolist(), "bigint"), len(shifts), len(slots)
        one = [bytes([i]) for i in range(256)] + [None]  # the last stands for a word's end
        self.bytes = numbers((ID_MASK if x is None else ranks[x] for x in one), "bigint")
        self.pairs = numbers(((NEVER if x is None or y is None else ranks.get(x + y, NEVER)) << RANK_AT for x in one for y in one), "bigint")

    def encode(self, codes: Column) -> Column:
        """Ids of a word, as an array of its bytes with END behind: a column, as the fold reads it again and again.

        The fold's state is one number for each part: the rank of the pair that it and the next part make, where it
        starts, and its id. The least of them is the pair to merge, the leftmost of equal rank, and the pair's
        rank is the id of what it merges to. END stays as a part without a partner.
        """
        never = F.lit(NEVER << RANK_AT)
        id_of = lambda x: x.bitwiseAND(F.lit(ID_MASK))
        place = lambda x: x.bitwiseAND(F.lit(START_MASK << START_AT))

        def single(code: Column, i: Column) -> Column:
            return F.coalesce(F.get(self.pairs, code * (END + 1) + F.get(codes, i + 1)), never) + F.shiftleft(i.cast("long"), START_AT) + F.get(self.bytes, code)

        def rank(left: Column, right: Column) -> Column:
            """The rank of two ids together, shifted to its place."""
            cut = lambda x, n: x.bitwiseAND(F.lit(n - 1)).cast("int")

            def found(h: Column) -> Column:
                slot = F.get(self.slots, cut(F.shiftright(h, SLOT_AT) + F.get(self.shifts, cut(F.shiftright(h, SHIFT_AT), self.groups)), self.size))
                return let(slot, lambda e: F.when(F.shiftright(e, RANK_BITS) == h.bitwiseAND(F.lit(KEY_MASK)), F.shiftleft(e.bitwiseAND(F.lit((1 << RANK_BITS) - 1)), RANK_AT)).otherwise(never))

            return let((F.shiftleft(left, START_AT) + right) * F.lit(self.factor).cast("long"), found)

        def merge(acc: Column, low: Column, p: Column) -> Column:
            """Part p (from 0) takes in the next one; the pairs with its neighbours get their ranks."""
            new = F.shiftright(low, RANK_AT)
            # one lookup in the plan for both pairs, as the tables are literals
            left = lambda x, i: F.when(i == p, new).otherwise(id_of(x))
            right = lambda i: F.when(i == p, id_of(F.get(acc, p + 2))).otherwise(new)
            renewed = lambda x, i: F.when((i == p) | (i == p - 1), rank(left(x, i), right(i)) + place(x) + left(x, i)).otherwise(x)
            return F.filter(F.transform(acc, renewed), lambda _, i: i != p + 1)

        def step(acc: Column, _: Column) -> Column:
            merged = lambda low: F.when(low < never, let(F.array_position(acc, low).cast("int") - 1, lambda p: merge(acc, low, p))).otherwise(acc)
            return let(F.array_min(acc), merged)

        ids = lambda acc: F.filter(F.transform(acc, lambda x: id_of(x).cast("int")), lambda x: x != ID_MASK)
        return F.aggregate(F.array_repeat(F.lit(0), F.size(codes) - 2), F.transform(codes, single), step, ids)


@functools.cache
def splitter(pattern: str):
    """A function that gives the words of a text."""
    # one test for an apostrophe instead of seven
    spelled = pattern.replace("'s|'t|'re|'ve|'m|'ll|'d|", "'(?:s|t|re|ve|m|ll|d)|").replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{L}}\p{{N}}]").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
    full = regex.compile(spelled).findall
    kinds = {k: "".join(re.escape(chr(c)) for c in range(FAST) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    fast = spelled
    for k, letters in kinds.items():
        fast = fast.replace(rf"\p{{L}}\p{{N}}]", f"{kinds['L']}{kinds['N']}]").replace(rf"\p{{{k}}}", f"[{letters}]")
    fast = re.compile(fast).findall
    other = re.compile(f"[^\\0-{chr(FAST - 1)}]").search
    return lambda text: full(text) if not text.isascii() and other(text) else fast(text)


def words_in(text: str, words_of, window: int = WINDOW):
    """Lists of a text's words, found in windows of so many characters.

    The last match of a window may go on behind it, so that the next window begins with it; the pattern looks one character ahead at most.
    """
    if len(text) <= window:
        yield words_of(text)
        return
    at, room = 0, window
    while at < len(text):
        own = words_of(text[at : at + room])
        if at + room < len(text):
            if len(own) < 2:  # a word longer than the window
                room *= 2
                continue
            own.pop()
        yield own
        at, room = at + sum(map(len, own)), window


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word by the same merges, over a linked list and a heap of pairs: n log n steps."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n)), bytearray(b"\1") * n
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        m = end[i]
        if not alive[i] or m >= n or end[m] != to:  # one of its parts has been merged otherwise
            continue
        alive[m], end[i] = 0, to
        if to < n:
            before[to] = i
        for a, b in ((before[i], to), (i, end[to] if to < n else n + 1)):
            if a >= 0 and b <= n and (rank := ranks.get(word[a:b])) is not None:
                heapq.heappush(heap, (rank, a, b))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


#: What a row is: the order to forget all words, a word to fold, a word with its ids (it has a rank, or is long), a text with its word numbers.
FORGET, WORD, GIVEN, TEXT = range(4)
_SENT = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("codes", pa.list_(pa.int32())), ("data", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])


class _Numbers(dict):
    """Numbers of words, those that are new in a list."""

    def __init__(self):
        super().__init__()
        self.new, self.size = [], 0

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        self.size += len(word)
        return n


@functools.cache
def _ranks_and_pieces(rank_file: bytes) -> tuple[dict[bytes, int], dict[int, bytes]]:
    ranks = parse_ranks(rank_file)
    return ranks, {v: k for k, v in ranks.items()}


def _sent(kind: int, n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, "i4"))] + [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in list(_SENT)[1:]], schema=_SENT)


def _words(pattern: str, rank_file: bytes):
    """Texts as numbers of their words, each new word before the first text that has it."""

    def run(batches):
        words_of, numbers = splitter(pattern), _Numbers()
        ranks, _ = _ranks_and_pieces(rank_file)

        def flushed(ids: list, texts: list):
            """New words in the order of their numbers, as runs of one kind; then the texts."""
            new = [w.encode() for w in numbers.new]
            numbers.new = []
            given = np.array([len(w) > LONG or w in ranks for w in new], bool)
            cuts = np.flatnonzero(np.append(True, given[1:] != given[:-1])).tolist() if len(new) else []
            for a, z in zip(cuts, [*cuts[1:], len(new)]):
                own = new[a:z]
                if given[a]:
                    found = [fold(w, ranks) for w in own]
                    data = pa.array([np.array(x, "<i4").tobytes() for x in found], pa.binary())
                    yield _sent(GIVEN, len(own), data=data)
                else:
                    ends = np.cumsum([0, *(len(w) + 1 for w in own)])
                    codes = np.frombuffer(b"\0".join(own) + b"\0", "u1").astype("i4")
                    codes[ends[1:] - 1] = END
                    yield _sent(WORD, len(own), codes=pa.ListArray.from_arrays(pa.array(ends.astype("i4")), pa.array(codes)))
            if texts:
                yield _sent(TEXT, len(texts), doc_id=pa.array(ids, pa.int64()), data=pa.array(texts, pa.binary()))
            release()

        ids, texts, size = [], [], 0
        for b in batches:
            for doc_id, x in zip(b.column("doc_id").to_pylist(), b.column("text")):
                t = x.as_py() or ""
                ids.append(doc_id)
                texts.append(b"".join([array("I", map(numbers.__getitem__, w)).tobytes() for w in words_in(t, words_of)]))
                size += len(t)
                if size >= SLICE:
                    yield from flushed(ids, texts)
                    ids, texts, size = [], [], 0
                    if len(numbers) > REMEMBERED or numbers.size > REMEMBERED_BYTES:
                        yield _sent(FORGET, 1)
                        numbers = _Numbers()
        yield from flushed(ids, texts)

    return run


def joined(parts: list[bytes], numbers: list[int], at_once: int = 1 << 16) -> bytes:
    """The parts of these numbers, one behind the other: fetched by one call for many, which takes a fifth less than a call for each."""
    if len(numbers) > at_once:
        return b"".join([joined(parts, numbers[i : i + at_once], at_once) for i in range(0, len(numbers), at_once)])
    return b"".join(itemgetter(*numbers)(parts)) if len(numbers) > 1 else b"".join([parts[x] for x in numbers])


def _put_together(rank_file: bytes):
    """Each text's ids and decoded bytes, from its words' numbers and what the fold gave for the words."""

    def run(batches):
        piece_of = _ranks_and_pieces(rank_file)[1].__getitem__
        ids_of: list[bytes] = []
        pieces: list[bytes] = []
        for b in batches:
            kinds = b.column("kind").to_numpy()
            cuts = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1])).tolist() if len(kinds) else []
            for a, z in zip(cuts, [*cuts[1:], len(kinds)]):
                own, kind = b.slice(a, z - a), kinds[a]
                if kind == FORGET:
                    ids_of, pieces = [], []
                elif kind == WORD:
                    ids = own.column("ids")
                    flat, ends = ids.flatten().to_numpy().astype("<i4"), (ids.offsets.to_numpy() - ids.offsets[0].as_py()).tolist()
                    raw, parts = flat.tobytes(), list(map(piece_of, flat.tolist()))
                    ids_of += [raw[4 * x : 4 * y] for x, y in zip(ends, ends[1:])]
                    pieces += [b"".join(parts[x:y]) for x, y in zip(ends, ends[1:])]
                elif kind == GIVEN:
                    ids_of += own.column("data").to_pylist()
                    pieces += [b"".join(map(piece_of, np.frombuffer(x, "<i4").tolist())) for x in own.column("data").to_pylist()]
                else:
                    ids, back = [], []
                    for data in own.column("data"):
                        numbers = np.frombuffer(data.as_py(), "<u4").tolist()
                        ids.append(joined(ids_of, numbers))
                        back.append(joined(pieces, numbers))
                    flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                    offsets = pa.array(np.cumsum([0, *(len(x) // 4 for x in ids)]).astype("i4"))
                    yield pa.RecordBatch.from_arrays([own.column("doc_id"), pa.ListArray.from_arrays(offsets, flat), pa.array(back, pa.binary())], schema=_OUT)

    return run


def encoded_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """words(codes, ...) with ids, null where codes is null."""
    return words.withColumn("ids", F.when(F.col("codes").isNotNull(), RankMap(ranks).encode(F.col("codes"))))


def tasks_of(texts: DataFrame) -> int:
    """By the bytes of all texts, but no fewer than the session's cores; coalesce() leaves fewer partitions as they are."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(texts.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def encoded(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int>, decoded binary of every document."""
    with open(rank_path, "rb") as f:
        rank_file = f.read()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    narrow = narrow.coalesce(tasks_of(narrow))
    sent = narrow.mapInArrow(_words(pattern, rank_file), "kind int, doc_id long, codes array<int>, data binary")
    folded = encoded_words(sent, parse_ranks(rank_file)).select("kind", "doc_id", "data", "ids")
    return folded.mapInArrow(_put_together(rank_file), "doc_id long, ids array<int>, decoded binary")


def op9_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256")
    )
