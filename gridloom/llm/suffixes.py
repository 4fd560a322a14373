"""Suffix-array removal of byte strings that an earlier document holds.

Every byte covered by a string of LENGTH bytes that also starts in a document with a smaller doc_id goes.

1. Documents are packed, as they come, into chunks of about CHUNK bytes in the shared folder, so that text
   moves compressed and many rows at once.
2. Whole copies are found by digests of the texts; all but those with the smallest doc_id are covered whole.
3. Where can the others match at all? Any two equal strings of LENGTH bytes have the same smallest hash among
   their K-byte substrings. Only strings whose smallest hash more than one text has are looked at further.
4. These strings go to the shard of their smallest hash, as runs of strings that share it. A shard builds
   suffix arrays of its runs (Larsson-Sadakane refinement of groups by ranks h further on, from 8 bytes to at least
   LENGTH), common prefixes of neighbours, and so groups of equal strings with their smallest
   doc_id. A shard of over PART bytes has several suffix arrays, which binary search merges. A smallest hash that
   over HOT texts have spreads over all shards by the strings themselves.
5. Each occurrence of a string with a smaller doc_id elsewhere is a span to remove, back at its chunk.

The hashes decide only where strings meet; what is equal is decided on the bytes. (Copies are told by digests of 128 bits, and
in step 3 by 63 of them.)

Defined cases: a null text is empty; texts under LENGTH bytes lose nothing; rows with the same doc_id never remove from each
other; a null doc_id counts as greater than any other; an empty table gives no rows; other columns stay as
they are. keep_new() drops what is left of a cut character, so texts stay valid UTF-8.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix64, release, saved, table

LENGTH, K = 50, 26
CHUNK, CHUNK_ROWS = 2 << 20, 8192
PART = 4 << 20
HOT = 4096
#: Hashes to a bucket and bytes to a shard, about.
BUCKET_HASHES = 1 << 18
_NO_ID = (1 << 63) - 1
_M = np.uint64(0x9E3779B97F4A7C15)


# --- chunks --------------------------------------------------------------------------------


def _ipc(batch: pa.RecordBatch, level: int) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def packer(chunk_bytes: int = CHUNK, level: int = 3):
    """For mapInArrow: p and payload of chunks of about so many bytes of text, rows in order."""

    def run(batches):
        for p, rows in cut(batches, chunk_bytes):
            whole = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([_ipc(whole, level)], pa.binary())], names=["p", "payload"])

    return run


def cut(batches, chunk_bytes: int):
    """p and batches of chunks of a task's rows; p is the task's partition and the chunk's number in it."""
    from pyspark import TaskContext

    p, held, size, rows = TaskContext.get().partitionId() << 32, [], 0, 0
    for b in batches:
        lengths = pa.compute.binary_length(b.column("text").cast(pa.large_binary())).fill_null(0).to_numpy()
        at = 0
        while at < b.num_rows:
            room = np.searchsorted(np.cumsum(lengths[at:]), chunk_bytes - size, "right")
            take = int(min(max(room, 1 if not held else 0), CHUNK_ROWS - rows))
            if take:
                held.append(b.slice(at, take))
                size, rows, at = size + int(lengths[at : at + take].sum()), rows + take, at + take
            if at < b.num_rows or size >= chunk_bytes or rows >= CHUNK_ROWS:
                p += 1
                release()
                yield p, held
                held, size, rows = [], 0, 0
    if held:
        yield p + 1, held


class Chunk:
    """A chunk's rows, its texts as one buffer, their keys (doc_id) and digests."""

    def __init__(self, payload: bytes):
        release()
        self.table = pa.ipc.open_stream(payload).read_all()
        text = self.table.column("text").combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = text.chunk(0) if text.num_chunks else pa.array([], pa.string())
        text = text.cast(pa.large_string()).fill_null("")
        n = len(text)
        self.offsets = np.frombuffer(text.buffers()[1], np.int64, n + 1, 8 * text.offset) if n else np.zeros(1, np.int64)
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        self.data = data[self.offsets[0] : self.offsets[-1]]
        self.offsets = self.offsets - self.offsets[0]
        ids = self.table.column("doc_id").cast(pa.int64())
        self.keys = ids.fill_null(_NO_ID).to_numpy()

    def __len__(self):
        return len(self.offsets) - 1

    @functools.cached_property
    def digests(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(self.offsets, self.offsets[1:])]

    @functools.cached_property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.offsets))

    @functools.cached_property
    def smallest(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the strings of LENGTH bytes within texts, and the smallest hash of each.

        Smallest hashes crowd at the low end; mixed once more they spread evenly over buckets and shards.
        """
        v = smallest_hashes(self.data)
        inside = self.rows[: len(v)] == self.rows[LENGTH - 1 :]
        at = np.flatnonzero(inside)
        return at, mix64(v[at])


def smallest_hashes(data: np.ndarray, length: int = LENGTH, k: int = K) -> np.ndarray:
    """Of each string of `length` bytes of data the smallest hash of its k-byte substrings."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    step = 1 << 15
    with np.errstate(over="ignore"):
        for a in range(0, n, step):
            b = data[a : min(a + step, n) + length - 1].astype(np.uint64) + np.uint64(1)
            # hashes of 2**j bytes, then of k as a sum of such
            levels, power = [b], [_M]
            while 2 << (len(levels) - 1) <= k:
                half = 1 << (len(levels) - 1)
                levels.append(levels[-1][:-half] * power[-1] + levels[-1][half:])
                power.append(power[-1] * power[-1])
            h, have = None, 0
            for j in reversed(range(len(levels))):
                if k >> j & 1:
                    part = levels[j][have:]
                    h = part if h is None else h[: len(part)] * power[j] + part[: len(h)]
                    have += 1 << j
            h = mix64(h[: len(b) - k + 1])
            w, m, span = length - k + 1, h, 1
            while 2 * span <= w:
                m = np.minimum(m[:-span], m[span:])
                span *= 2
            if span < w:
                m = np.minimum(m[: len(h) - w + 1], m[w - span :][: len(h) - w + 1])
            out[a : a + step] = m[: min(step, n - a)]
    return out


# --- which hashes do several texts have ----------------------------------------------------


def _copy_rows(batches):
    """Each chunk's distinct texts: digest, the rows that have it and the least of their keys."""
    for b in batches:
        for p, payload in zip(b.column("p").to_pylist(), b.column("payload")):
            c = Chunk(payload.as_py())
            rows: dict[bytes, list[int]] = {}
            for i, d in enumerate(c.digests):
                rows.setdefault(d, []).append(i)
            columns = [
                pa.array(np.full(len(rows), p)), pa.array(list(rows), pa.binary()), pa.array([np.array(r, np.int32).tobytes() for r in rows.values()], pa.binary()),
                pa.array([min(c.keys[r].tolist()) for r in rows.values()], pa.int64()), pa.array([len(r) for r in rows.values()], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["p", "digest", "rows", "key", "n"])


_MANY = np.uint64(1 << 63)
#: Bits of a hash within its bucket; more hashes than these tell apart only look shared.
_IN_BUCKET = 40


def addresses(v: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and place in the bucket of each hash: the bucket by its high bits, the place by its bits mixed once more."""
    with np.errstate(over="ignore"):
        bucket = (v >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        return bucket << np.uint64(_IN_BUCKET) | mix64(v ^ _M) & np.uint64((1 << _IN_BUCKET) - 1)


def _short(v: np.ndarray) -> bytes:
    """The places of addresses, five bytes each."""
    return np.ascontiguousarray(v, "<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _long(data: bytes, bucket: int) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel() | np.uint64(bucket << _IN_BUCKET)


def _hash_rows(buckets: int):
    def run(batches):
        for b in batches:
            for p, payload in zip(b.column("p").to_pylist(), b.column("payload")):
                c = Chunk(payload.as_py())
                at, v = c.smallest
                r = c.rows[at]
                first = np.ones(len(v), bool)
                first[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
                v, r = addresses(v[first], buckets), r[first]
                mark = np.array([int.from_bytes(d[:8], "little") >> 1 for d in c.digests], np.uint64)[r] if len(r) else np.zeros(0, np.uint64)
                order = np.lexsort((mark, v))
                v, mark = v[order], mark[order]
                new = np.ones(len(v), bool)
                new[1:] = (v[1:] != v[:-1]) | (mark[1:] != mark[:-1])
                v, mark = v[new], mark[new]
                starts = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, int)
                count = np.diff(np.append(starts, len(v)))
                v, mark = v[starts], np.where(count > 1, _MANY | count.astype(np.uint64), mark[starts])
                bucket = v >> np.uint64(_IN_BUCKET)  # v is sorted, so buckets are slices
                cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(v) else np.zeros(0, int)
                ends = np.append(cut[1:], len(v))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[cut].astype(np.int32)), pa.array(np.full(len(cut), p)),
                        pa.array([_short(v[x:y]) for x, y in zip(cut, ends)], pa.binary()),
                        pa.array([mark[x:y].tobytes() for x, y in zip(cut, ends)], pa.binary()),
                    ],
                    names=["bucket", "p", "hashes", "marks"],
                )

    return run


_LIST = "p long, kind string, a binary, b binary"
_LIST_ARROW = pa.schema([("p", pa.int64()), ("kind", pa.string()), ("a", pa.binary()), ("b", pa.binary())])


def _list(rows) -> pa.Table:
    columns = list(zip(*rows)) or [()] * 4
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LIST_ARROW)], schema=_LIST_ARROW)


def _shared(group: pa.Table) -> pa.Table:
    """For each chunk those of its hashes in the bucket that several texts have: those of few and of many."""
    release()
    ps = group.column("p").to_pylist()
    bucket = group.column("bucket")[0].as_py()
    parts = [_long(x.as_py(), bucket) for x in group.column("hashes")]
    v = np.concatenate(parts)
    mark = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in group.column("marks")])
    source = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    order = np.argsort(v, kind="stable")
    v, mark, source = v[order], mark[order], source[order]
    starts = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    sizes = np.diff(np.append(starts, len(v)))
    many = mark >= _MANY
    texts = np.add.reduceat(np.where(many, mark & (_MANY - np.uint64(1)), 1).astype(np.int64), starts)
    several = np.logical_or.reduceat(many, starts) | (np.maximum.reduceat(mark, starts) != np.minimum.reduceat(mark, starts))
    kind = np.repeat(np.where(several, np.where(texts > HOT, 2, 1), 0), sizes)
    v, source, kind = v[kind > 0], source[kind > 0], kind[kind > 0]
    order = np.argsort(source, kind="stable")
    v, source, kind = v[order], source[order], kind[order]
    cut = np.searchsorted(source, np.arange(len(ps) + 1))
    rows = []
    for p, a, b in zip(ps, cut, cut[1:]):
        if b > a:
            own, hot = v[a:b], kind[a:b] == 2
            rows.append((p, "hashes", own[~hot].tobytes(), own[hot].tobytes()))
    return _list(rows)


# --- shards --------------------------------------------------------------------------------

_RUNS = "shard int, p long, bytes binary, lengths binary, counts binary, starts binary, keys binary"


def _lists_of(right: pa.Table):
    few, many, copies = [], [], {}
    for r in right.to_pylist():
        if r["kind"] == "hashes":
            few.append(np.frombuffer(r["a"], np.uint64))
            many.append(np.frombuffer(r["b"], np.uint64))
        elif r["kind"] == "copies":
            copies |= dict(zip(np.frombuffer(r["a"], np.int32).tolist(), np.frombuffer(r["b"], np.int64).tolist()))
    join = lambda x: np.unique(np.concatenate(x)) if x else np.zeros(0, np.uint64)
    return join(few), join(many), copies


def _among(v: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(v), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, v), len(sorted_) - 1)] == v


def _run_rows(shards: int, buckets: int):
    schema = pa.schema([("shard", pa.int32()), ("p", pa.int64())] + [(x, pa.binary()) for x in ("bytes", "lengths", "counts", "starts", "keys")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            c = Chunk(left.column("payload")[0].as_py())
            few, many, copies = _lists_of(right)
            at, v = c.smallest
            r = c.rows[at]
            later = np.zeros(len(c), bool)
            for row, first in copies.items():
                later[row] = c.keys[row] > first
            place = addresses(v, buckets)
            hot = _among(place, many)
            use = (_among(place, few) | hot) & ~later[r]
            at, v, r, hot = at[use], v[use], r[use], hot[use]
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) > 1) | (v[1:] != v[:-1]) | hot[1:]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(at)) - 1
            raw = c.data.tobytes()
            by: dict[int, dict[bytes, list]] = {}
            a, b, h, k = at[starts].tolist(), (at[ends] + LENGTH).tolist() if len(at) else [], hot[starts].tolist(), c.keys[r[starts]].tolist()
            to = (v[starts] % np.uint64(shards)).tolist()
            for x, y, z, key, shard in zip(a, b, h, k, to):
                s = raw[x:y]
                if z:
                    shard = int.from_bytes(hashlib.blake2b(s, digest_size=6).digest(), "little") % shards
                by.setdefault(shard, {}).setdefault(s, []).append((x, key))
            p = left.column("p")[0].as_py()
            for shard, found in by.items():
                flat = [o for occ in found.values() for o in occ]
                out.append((
                    shard, p, b"".join(found), np.array([len(s) for s in found], np.int32).tobytes(), np.array([len(o) for o in found.values()], np.int32).tobytes(),
                    np.array([o[0] for o in flat], np.int64).tobytes(), np.array([o[1] for o in flat], np.int64).tobytes(),
                ))
        columns = list(zip(*out)) or [()] * 7
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    return run


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one big-endian number; zeros follow the text."""
    padded = np.concatenate([text, np.zeros(LENGTH + 16, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(text) + LENGTH + 8].copy().view(">u8").ravel().astype(np.uint64)


def suffix_array(text: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """The suffixes of text in order of at least their first `depth` bytes.

    Sorted by 8 bytes first. Then each group of equal suffixes is refined by the ranks of the suffixes h bytes
    further on, with h doubling; suffixes alone in their group take no further part.
    """
    n = len(text)
    words = _words(text) if words is None else words
    sa = np.argsort(words[:n])
    ordered = words[sa]
    head = np.append(True, ordered[1:] != ordered[:-1]) if n else np.zeros(0, bool)
    for p in range(max(n - 7, 0), n):
        # a suffix of less than 8 bytes is smaller than those that go on with zeros, of which its word has as many
        first, end = np.searchsorted(ordered, words[p], "left"), np.searchsorted(ordered, words[p], "right")
        at = first + np.flatnonzero(sa[first:end] == p)[0]
        sa[first + 1 : at + 1] = sa[first:at].copy()
        sa[first] = p
    short = np.flatnonzero(sa >= n - 7)
    head[short] = True
    head[(short + 1)[short + 1 < n]] = True
    del ordered
    rank = np.empty(n + 1, np.int64)
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[sa] = group
    rank[n] = -1
    h = 8
    while h < depth:
        alone = head & np.append(head[1:], True)
        todo = np.flatnonzero(~alone)
        if not len(todo):
            break
        places = sa[todo]
        key = (rank[places] << 32) + rank[np.minimum(places + h, n)] + 1
        order = np.argsort(key)
        sa[todo] = places[order]
        key = key[order]
        head[todo] = np.append(True, key[1:] != key[:-1])
        group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank[sa[todo]] = group[todo]
        h *= 2
    return sa


def common_prefixes(words: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at a and b, up to `most`, eight bytes a step.

    What Kasai's pass over the text gives one place after another, cut off at `most`, for all pairs at once.
    """
    out = np.zeros(len(a), np.int64)
    go = np.arange(len(a))
    for k in range(0, most, 8):
        x = words[a[go] + k] ^ words[b[go] + k]
        same = x == 0
        rest = x[~same]
        bits = np.zeros(len(rest), np.int64)
        for s in (32, 16, 8):
            big = rest >= np.uint64(1 << s)
            bits += np.where(big, s, 0)
            rest = np.where(big, rest >> np.uint64(s), rest)
        out[go[~same]] = k + 7 - bits // 8
        go = go[same]
    out[go] = most
    return np.minimum(out, most)


def _smallest_keys(segments: list[bytes], keys: np.ndarray) -> list[np.ndarray]:
    """For each string of LENGTH bytes in each segment the smallest key of any segment that has it."""
    lengths = np.array([len(s) for s in segments])
    part = np.cumsum(lengths) // PART
    cut = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    parts = []
    for a, b in zip(cut, np.append(cut[1:], len(segments))):
        text = np.frombuffer(b"".join(segments[a:b]), np.uint8)
        n = lengths[a:b]
        begin = np.cumsum(n) - n
        count = n - LENGTH + 1
        place = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        owner = np.repeat(np.arange(b - a), count)
        number = np.full(len(text), -1)
        number[place] = np.arange(len(place))
        words = _words(text)
        sa = suffix_array(text, LENGTH, words)
        sa = sa[number[sa] >= 0]
        lcp = common_prefixes(words, sa[:-1], sa[1:], LENGTH)
        head = np.append(True, lcp < LENGTH)
        starts = np.flatnonzero(head)
        least = np.minimum.reduceat(keys[a:b][owner[number[sa]]], starts)
        group = np.cumsum(head) - 1
        strings = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[sa[starts]].copy().view(f"S{LENGTH}").ravel() if len(cut) > 1 else None
        parts.append((strings, least, number[sa], group, np.cumsum(count)[:-1]))
    if len(parts) > 1:  # merge by binary search of each part's strings in the others'
        mine = [x[1].copy() for x in parts]
        for i, (s, *_) in enumerate(parts):
            for j, (t, least, *_) in enumerate(parts):
                if i != j:
                    k = np.minimum(np.searchsorted(t, s), len(t) - 1)
                    same = t[k] == s
                    mine[i][same] = np.minimum(mine[i][same], least[k[same]])
        parts = [(s, m, *rest) for (s, _, *rest), m in zip(parts, mine)]
    out = []
    for _, least, number, group, ends in parts:
        value = np.empty(len(number), np.int64)
        value[number] = least[group]
        out += np.split(value, ends)
    return out


def _shard(group: pa.Table) -> pa.Table:
    """Spans to remove in each chunk: of each run's strings those that a smaller key has as well."""
    release()
    rows = group.to_pylist()
    known: dict[bytes, int] = {}
    least: list[int] = []
    for r in rows:
        lengths, counts, keys = np.frombuffer(r["lengths"], np.int32), np.frombuffer(r["counts"], np.int32), np.frombuffer(r["keys"], np.int64)
        smallest = np.minimum.reduceat(keys, np.cumsum(counts) - counts).tolist()
        at, own = 0, []
        for n, key in zip(lengths.tolist(), smallest):
            s = r["bytes"][at : at + n]
            at += n
            i = known.setdefault(s, len(known))
            if i == len(least):
                least.append(key)
            elif key < least[i]:
                least[i] = key
            own.append(i)
        r["own"] = np.array(own)
    mins = _smallest_keys(list(known), np.array(least, np.int64))
    top = np.array([m.max() for m in mins])
    bottom = np.array([m.min() for m in mins])
    size = np.array([len(m) for m in mins])
    out = []
    for r in rows:
        counts, starts, keys = np.frombuffer(r["counts"], np.int32), np.frombuffer(r["starts"], np.int64), np.frombuffer(r["keys"], np.int64)
        seg = np.repeat(r["own"], counts)
        whole = top[seg] < keys
        a, b = [starts[whole]], [starts[whole] + size[seg[whole]] - 1 + LENGTH]
        for i in np.flatnonzero(~whole & (bottom[seg] < keys)):
            hit = np.flatnonzero(mins[seg[i]] < keys[i])
            jump = np.flatnonzero(np.diff(hit) > 1)
            a.append(starts[i] + hit[np.append(0, jump + 1)])
            b.append(starts[i] + hit[np.append(jump, len(hit) - 1)] + LENGTH)
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            out.append((r["p"], "spans", a.astype(np.int64).tobytes(), b.astype(np.int64).tobytes()))
    return _list(out)


# --- the whole -----------------------------------------------------------------------------


def _kept(c: Chunk, right: pa.Table) -> tuple[np.ndarray, list[int]]:
    """Which bytes of a chunk stay, and each row's number of removed spans."""
    change = np.zeros(len(c.data) + 1, np.int64)
    for r in right.to_pylist():
        if r["kind"] == "spans":
            np.add.at(change, np.frombuffer(r["a"], np.int64), 1)
            np.add.at(change, np.frombuffer(r["b"], np.int64), -1)
        elif r["kind"] == "copies":
            for row, first in zip(np.frombuffer(r["a"], np.int32), np.frombuffer(r["b"], np.int64)):
                a, b = c.offsets[row], c.offsets[row + 1]
                if c.keys[row] > first and b - a >= LENGTH:
                    change[a] += 1
                    change[b] -= 1
    gone = np.cumsum(change[:-1]) > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1] | (c.rows[1:] != c.rows[:-1])
    return ~gone, np.bincount(c.rows[begins], minlength=len(c)).tolist()


class Spans:
    """Chunks of docs and what is to be removed from them."""

    def __init__(self, docs: DataFrame):
        self.schema = docs.schema
        self.chunks = saved(docs.mapInArrow(packer(), "p long, payload binary"), "suffix-chunks")
        n = max(1, self.chunks.count())
        per_chunk = CHUNK * 2 // (LENGTH - K + 2)
        digests = self.chunks.mapInArrow(_copy_rows, "p long, digest binary, rows binary, key long, n long")
        digests = saved(digests, "suffix-digests")
        first = saved(digests.groupBy("digest").agg(F.min("key").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n"), "suffix-first")
        copies = digests.select("p", "digest", "rows").join(first, "digest").mapInArrow(_copy_lists, _LIST)
        buckets = min(1 << 24, max(1, n * per_chunk // BUCKET_HASHES))
        hashes = self.chunks.mapInArrow(_hash_rows(buckets), "bucket int, p long, hashes binary, marks binary")
        shared = hashes.groupBy("bucket").applyInArrow(_shared, _LIST)
        copies = saved(copies, "suffix-copies")
        lists = saved(shared, "suffix-hashes").unionByName(copies)
        runs = self.chunks.groupBy("p").cogroup(lists.groupBy("p")).applyInArrow(_run_rows(2 * n, buckets), _RUNS)  # shards of about a chunk's size
        spans = saved(runs.groupBy("shard").applyInArrow(_shard, _LIST), "suffix-spans")
        self.lists = spans.unionByName(copies)

    def apply(self, function, schema) -> DataFrame:
        """function(chunk, lists) as a table of the schema, for every chunk."""

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            return function(Chunk(left.column("payload")[0].as_py()), right)

        return self.chunks.groupBy("p").cogroup(self.lists.groupBy("p")).applyInArrow(run, schema)


def _copy_lists(batches):
    for b in batches:
        found: dict[int, tuple[list, list]] = {}
        for p, rows, first in zip(b.column("p").to_pylist(), b.column("rows").to_pylist(), b.column("first").to_pylist()):
            row, key = found.setdefault(p, ([], []))
            row.append(rows)
            key.append(np.full(len(rows) // 4, first, np.int64).tobytes())
        yield from _list([(p, "copies", b"".join(r), b"".join(k)) for p, (r, k) in found.items()]).to_batches()


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _report(c: Chunk, right: pa.Table) -> pa.Table:
    keep, spans = _kept(c, right)
    sha, removed = [], []
    for a, b in zip(c.offsets, c.offsets[1:]):
        own = c.data[a:b][keep[a:b]]
        sha.append(hashlib.sha256(own.tobytes()).hexdigest())
        removed.append(int(b - a - len(own)))
    columns = [c.table.column("doc_id").cast(pa.int64()), np.diff(c.offsets), removed, spans, sha]
    return pa.Table.from_arrays([x if isinstance(x, pa.ChunkedArray) else pa.array(x, f.type) for x, f in zip(columns, _RESULT)], schema=_RESULT)


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return Spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))).apply(_report, schema)


def _shortened(c: Chunk, right: pa.Table) -> pa.Table:
    keep, _ = _kept(c, right)
    t = c.table
    null = t.column("text").is_null().to_pylist()
    texts = [None if x else c.data[a:b][keep[a:b]].tobytes().decode("utf-8", "ignore") for x, a, b in zip(null, c.offsets, c.offsets[1:])]
    for name, values in (("text", texts), ("n_chars", [None if x is None else len(x) for x in texts])):
        if name in t.column_names:
            i = t.column_names.index(name)
            t = t.set_column(i, t.schema.field(i), pa.array(values, t.schema.field(i).type))
    return t


def keep_new(docs: DataFrame) -> DataFrame:
    """docs with the removed bytes taken out of text, and n_chars (if there) set to what is left."""
    return Spans(docs).apply(_shortened, docs.schema)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))
