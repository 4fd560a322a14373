"""Quality by a factorisation machine, toxicity by compression distance.

Both are fitted on a bounded sample of labelled rows (LEARN_ROWS below) whose doc_id is not held out, and
score every whole text in one pass over Arrow batches, without a shuffle. Scores depend on the
text alone.

Defined cases: a null text scores as an empty one; a null doc_id is scored, and never held out; labels that are
null or whose document is missing teach nothing; of contradicting labels of one id the
greater counts, of its texts the least; very long texts are scored whole, in pieces of a few MB; with no usable labels, or of one class only, every text gets that class's
rate (0.5 without labels); an empty table gives no rows; columns named like the results are
not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, mix64, release, table

#: Labelled rows of each class (0, 1) to learn from at most, the smallest by a hash of the id.
LEARN_ROWS = {"quality": (3000, 5000), "toxic": (6000, 3000)}
#: Bytes of text handled at once.
SLICE = 1 << 20


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, rows: tuple[int, int]) -> tuple[list[str], np.ndarray, float]:
    """At most rows[c] texts of each class c, their labels, and the share of class 1 among all that may teach.

    Rows that are held out are in none of these. Of several texts with one id the least teaches, so that an id with
    very many rows can't crowd out the others.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where(~held_out() & F.col("y").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    picked = [known.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in enumerate(rows)]
    ids = picked[0].unionByName(picked[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # at most sum(rows) ids of 12 bytes: a bounded broadcast
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    return found.text.tolist(), found.y.to_numpy(int), share


def prior_shift(y: np.ndarray, share: float) -> float:
    """What turns a sample's log odds into those of the whole, as classes are sampled apart."""
    return float(np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean())))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(30):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def sliced(texts: pa.Array):
    """(first row, bytes, offsets) of runs of whole texts with about SLICE bytes; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        release()
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def pieces(data: np.ndarray, size: int = 4 * SLICE):
    """Parts of a text's bytes of about `size`, each but the last ending before white space (a word longer than `size` is kept whole)."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data):
            blank = np.flatnonzero(data[end : end + size] <= 32)
            if len(blank):
                end += int(blank[0])
                break
            end += size
        yield data[at:end]
        at = min(end, len(data))


def scored_with(score, threshold: float):
    """A function for mapInArrow over (doc_id, held_out, text): doc_id, held_out, score, predicted."""

    def run(batches):
        for b in batches:
            s = score(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype("i4"), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def scores(docs: DataFrame, score, threshold: float) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(scored_with(score, threshold), "doc_id long, held_out boolean, score double, predicted int")


def keep_by_score(docs: DataFrame, score, keep) -> DataFrame:
    """The rows of docs, with all their columns, for whose scores keep() holds."""

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(keep(score(b.column(names.index("text")))), pa.bool_()))

    names = docs.columns
    return docs.mapInArrow(run, docs.schema)


# --- quality -------------------------------------------------------------------------------

#: Buckets of hashed words; quantile bins of each structure statistic; rank of the interactions.
WORD_BUCKETS, BINS, RANK = 1 << 15, 12, 8
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _class_tables() -> np.ndarray:
    of = lambda chars: np.isin(np.arange(256), [ord(c) for c in chars])
    code = np.arange(256)
    return np.stack([
        (code >= 65) & (code <= 90), (code >= 97) & (code <= 122), (code >= 48) & (code <= 57), code >= 128, code == 32, code == 10,
        of(".,;:?'\"-()"), of("!"), of("|"), of("#$%&*@^~+=<>{}[]\\/_`"),
    ]).astype(np.int32)


_CLASSES = _class_tables()


def structure(data: np.ndarray, offsets: np.ndarray, size: int = 4 * SLICE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in one buffer: statistics (row per text), then row and bucket of each distinct word. A text over `size` bytes goes in pieces."""
    if len(offsets) == 2 and len(data) > size:
        return _structure_of_pieces(data, size)
    return _structure(data, offsets)[:3]


def _structure_of_pieces(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """structure() of one text: counts add up, distinct words and pairs unite, also the pair across a border."""
    k, total, words, number = len(_CLASSES), 0, np.zeros(0, np.int64), 0
    pairs, last = np.zeros(0, np.uint64), None
    for part in pieces(data, size):
        stats, _, wb, hashes, own_pairs = _structure(part, np.array([0, len(part)]))
        n = len(hashes)
        counts = np.concatenate([stats[0, :k] * len(part), stats[0, [k + 1, k + 4, k + 5]] * n])
        total, number, words = total + counts, number + n, np.union1d(words, wb)
        if last is not None and n:
            with np.errstate(over="ignore"):
                own_pairs = np.append(own_pairs, mix64(last * _ODD + hashes[:1]) >> np.uint64(24))
        last = hashes[-1:] if n else last
        pairs = np.union1d(pairs, own_pairs)
    some = max(number, 1)
    out = np.zeros((1, k + 6))
    out[0, :k] = total[:k] / len(data)
    out[0, k:] = np.log1p(len(data)), total[k] / some, len(words) / some, len(pairs) / some, total[k + 1] / some, total[k + 2] / some
    return out, np.zeros(len(words), np.int64), words


def _structure(data: np.ndarray, offsets: np.ndarray):
    """structure() at once; also the hash of each word, and the distinct pairs' hashes if there is one text."""
    n, lengths = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), lengths)
    stats = np.zeros((n, len(_CLASSES) + 6))
    count = lambda mask: np.bincount(row[mask], minlength=n)
    for k, lut in enumerate(_CLASSES):
        stats[:, k] = count(lut[data] > 0)
    size = np.maximum(lengths, 1)
    stats[:, : len(_CLASSES)] /= size[:, None]
    inside = data > 32
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][lengths > 0]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][lengths > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    with np.errstate(over="ignore"):
        lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint64)
        powers = np.cumprod(np.full(len(data) + 1, _ODD))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((lower + np.uint64(1)) * powers[:-1])])
        back = np.cumprod(np.full(len(data) + 1, _INVERSE))
        words = mix64((total[ends] - total[starts]) * back[starts])
        pairs = mix64(words[:-1] * _ODD + words[1:]) if len(words) > 1 else words[:0]
    r = row[starts]
    bucket = (words >> np.uint64(64 - 15)).astype(np.int64)
    key = np.unique(r * WORD_BUCKETS + bucket)
    wr, wb = key // WORD_BUCKETS, key % WORD_BUCKETS
    number, k = np.bincount(r, minlength=n), len(_CLASSES)
    some = np.maximum(number, 1)
    same = r[:-1] == r[1:]
    pair = np.unique((r[:-1][same].astype(np.uint64) << np.uint64(40)) | (pairs[same] >> np.uint64(24)))
    stats[:, k] = np.log1p(lengths)
    stats[:, k + 1] = np.bincount(r, ends - starts, n) / some
    stats[:, k + 2] = np.bincount(wr, minlength=n) / some
    stats[:, k + 3] = np.bincount((pair >> np.uint64(40)).astype(np.int64), minlength=n) / some
    odd = _CLASSES[7:10].sum(0)[data[ends - 1]] > 0 if len(ends) else np.zeros(0, bool)
    stats[:, k + 4] = np.bincount(r[odd], minlength=n) / some
    stats[:, k + 5] = np.bincount(r, (ends - starts) > 30, n) / some
    return stats, wr, wb, words, pair & np.uint64((1 << 40) - 1) if n == 1 else None


class FactorisationMachine:
    """Low-rank pairwise interactions among hashed words and binned statistics of a text.

    With x a text's features, the score is w0 + sum w x + 1/2 sum_f ((sum v x)^2 - sum v^2 x^2): linear in
    the features. Words share a total weight of 1 over a text; each statistic's bin counts 1 / sqrt(statistics).
    """

    def __init__(self, texts: list[str], y: np.ndarray, share: float | None = None, epochs: int = 12, seed: int = 7):
        self.rate = share if share is not None else float(y.mean()) if len(y) else 0.5
        self.fitted = len(set(y.tolist())) == 2
        if not self.fitted:
            return
        parts = [structure(d, o) for _, d, o in sliced(pa.array(texts, pa.string()))]
        self.edges = np.quantile(np.vstack([p[0] for p in parts]), np.linspace(0, 1, BINS + 1)[1:-1], axis=0)
        features = [self._features(*p) for p in parts]
        rows = np.cumsum([0] + [len(p[0]) for p in parts])
        r = np.concatenate([f[0] + a for f, a in zip(features, rows)])
        c, x = (np.concatenate([f[i] for f in features]) for i in (1, 2))
        rng = np.random.default_rng(seed)
        width = WORD_BUCKETS + self.edges.shape[1] * BINS
        self.w0, self.w = float(np.log(y.mean() / (1 - y.mean()))), np.zeros(width)
        self.v = rng.normal(0, 0.05, (width, RANK))
        seen_w, seen_v, step, ridge = np.full(width, 1e-6), np.full((width, RANK), 1e-6), 0.15, 2e-4
        start = np.searchsorted(r, np.arange(len(y) + 1))
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), 128):
                pick = order[at : at + 128]
                n = start[pick + 1] - start[pick]
                i = np.repeat(start[pick] - np.cumsum(n) + n, n) + np.arange(n.sum())
                k, cc, xx = np.repeat(np.arange(len(pick)), n), c[i], x[i]
                vx = self.v[cc] * xx[:, None]
                total = np.stack([np.bincount(k, vx[:, f], len(pick)) for f in range(RANK)], 1)
                z = self.w0 + np.bincount(k, self.w[cc] * xx + 0.5 * (total[k] * vx - vx * vx).sum(1), len(pick))
                g = (sigmoid(z) - y[pick]) / 8
                self.w0 -= 0.02 * g.sum()
                gx = g[k] * xx
                for seen, weight, grad in ((seen_w, self.w, gx), (seen_v, self.v, gx[:, None] * (total[k] - vx))):
                    u, at_u = np.unique(cc, return_inverse=True)
                    whole = np.zeros((len(u),) + grad.shape[1:])
                    np.add.at(whole, at_u, grad) if grad.ndim == 1 else [whole.__setitem__((slice(None), f), np.bincount(at_u, grad[:, f], len(u))) for f in range(RANK)]
                    whole += ridge * weight[u]
                    seen[u] += whole**2
                    weight[u] -= step * whole / np.sqrt(seen[u])
        self.w0 += prior_shift(y, self.rate)

    def _features(self, stats, wr, wb):
        """Row, column and value of each feature, by row."""
        n, m = stats.shape
        counts = np.bincount(wr, minlength=n)
        bins = (stats[:, None, :] > self.edges[None]).sum(1) + np.arange(m) * BINS + WORD_BUCKETS
        r = np.concatenate([wr, np.repeat(np.arange(n), m)])
        c = np.concatenate([wb, bins.ravel()])
        x = np.concatenate([1 / np.sqrt(np.maximum(counts, 1))[wr], np.full(n * m, m**-0.5)])
        order = np.argsort(r, kind="stable")
        return r[order], c[order], x[order]

    def __call__(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.rate)
        if not self.fitted:
            return out
        for at, data, offsets in sliced(texts):
            n = len(offsets) - 1
            r, c, x = self._features(*structure(data, offsets))
            linear = np.bincount(r, self.w[c] * x, n)
            pairs = np.zeros(n)
            for f in range(RANK):
                vx = self.v[c, f] * x
                pairs += np.bincount(r, vx, n) ** 2 - np.bincount(r, vx * vx, n)
            out[at : at + n] = sigmoid(self.w0 + linear + 0.5 * pairs)
        return out


def fit_quality(docs: DataFrame, labels: DataFrame) -> FactorisationMachine:
    return FactorisationMachine(*learning_rows(docs, labels, "quality", LEARN_ROWS["quality"]))


QUALITY_THRESHOLD, TOXIC_THRESHOLD = 0.7, 0.3


def op3_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(docs, fit_quality(docs, table(spark, sf_dir, "labels")), QUALITY_THRESHOLD)


# --- toxicity ------------------------------------------------------------------------------

#: Words in a window; bytes of the d-mers by which dictionary segments are chosen; sizes of the dictionaries.
WINDOW, DMER, TOXIC_BYTES, ORDINARY_BYTES, LEVEL = 8, 6, 2000, 60_000, 12
PUNCTUATION = ".,;:!?\"'()-"


def _dmers(words) -> set[bytes]:
    out = set()
    for w in words:
        b = f" {w} ".encode()
        out.update(b[i : i + DMER] for i in range(max(1, len(b) - DMER + 1)))
    return out


def _phrases(words: list[str]) -> set[bytes]:
    """Whole words, also without the punctuation around them, and neighbouring words; each between blanks."""
    bare = [w.strip(PUNCTUATION) for w in words]
    out = {f" {w} ".encode() for w in (*words, *bare) if w}
    out.update(f" {a} {b} ".encode() for a, b in zip(words, words[1:]))
    return out


def _typical(inside: Counter, outside: Counter, rate: float) -> set[bytes]:
    """What at least 4 toxic texts hold, and 10 times as many as the ordinary texts' rate gives."""
    return {k for k, c in inside.items() if c >= 4 and c >= 10 * (rate * outside[k] + 0.2)}


def toxic_dictionary(toxic: list[str], ordinary: list[str], size: int = TOXIC_BYTES) -> bytes:
    """Segments of toxic text that ordinary text lacks, the most frequent last.

    As a dictionary trainer would, it scores pieces by the texts that hold them, but against the other class. Pieces are
    d-mers, and whole and neighbouring words: words made of ordinary syllables have no d-mer of their own. Runs of typical d-mers are
    segments, taken by frequency as long as they cover a d-mer that is not yet covered; typical words are
    segments unless one that was taken holds them.
    """
    words = [t.lower().split() for t in toxic]
    inside, outside, phrases, others = Counter(), Counter(), Counter(), Counter()
    for w in words:
        inside.update(_dmers(set(w)))
        phrases.update(_phrases(w))
    for t in ordinary:
        w = t.lower().split()
        outside.update(_dmers(set(w)) & inside.keys())
        others.update(_phrases(w) & phrases.keys())
    rate = len(toxic) / max(1, len(ordinary))
    good = _typical(inside, outside, rate)
    segments = Counter()
    for own in words:
        for w in set(own):
            b = f" {w} ".encode()
            hit = [b[i : i + DMER] in good for i in range(max(1, len(b) - DMER + 1))]
            i = 0
            while i < len(hit):
                j = i
                while j < len(hit) and hit[j]:
                    j += 1
                if j > i:
                    segments[b[i : j + DMER - 1]] += 1
                i = j + 1
    whole = _typical(phrases, others, rate)
    for p in whole:
        segments[p] = max(segments[p], phrases[p])
    covered, taken, total = set(), [], 0
    for s, _ in sorted(segments.items(), key=lambda x: (-x[1], x[0])):
        new = {s[i : i + DMER] for i in range(max(1, len(s) - DMER + 1))} - covered
        if (new & good or s in whole and not any(s in t for t in taken)) and total + len(s) <= size:
            covered |= new
            taken.append(s)
            total += len(s)
    return b"".join(reversed(taken))


def ordinary_dictionary(ordinary: list[str], size: int = ORDINARY_BYTES) -> bytes:
    """The words in most ordinary texts, the most frequent last."""
    words = Counter()
    for t in ordinary:
        words.update(set(t.lower().split()))
    taken, total = [], 0
    for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0])):
        b = f"{w} ".encode()
        if total + len(b) > size:
            break
        taken.append(b)
        total += len(b)
    return b"".join(reversed(taken))


def windows_of(text: str, size: int = SLICE):
    """A text's windows of WINDOW words in lower case, one of a blank if it has none; a long text's words are found piece by piece."""
    if len(text) <= size:
        w = text.lower().split()
        yield from [f" {' '.join(w[i : i + WINDOW])} ".encode() for i in range(0, len(w), WINDOW)] or [b" "]
        return
    at, rest, none = 0, [], True
    while at < len(text):
        end = text.find(" ", at + size)
        end = len(text) if end < 0 else end
        rest += text[at:end].lower().split()
        at = end
        whole = len(rest) if at >= len(text) else len(rest) - len(rest) % WINDOW
        for i in range(0, whole, WINDOW):
            none = False
            yield f" {' '.join(rest[i : min(i + WINDOW, whole)])} ".encode()
        rest = rest[whole:]
    if none:
        yield b" "


class CompressionDistance:
    """Toxicity by how much shorter windows compress with a toxic than with an ordinary dictionary.

    Both dictionaries hold the ordinary one's bytes at the same distance from the window, so their
    lengths differ by what the toxic segments explain. A text's window differences, counted over thresholds,
    go through a logistic calibration on labelled texts from which no segment was taken.
    """

    def __init__(self, texts: list[str], y: np.ndarray, share: float | None = None):
        self.rate = share if share is not None else float(y.mean()) if len(y) else 0.5
        self.fitted = len(set(y.tolist())) == 2
        self._made = None
        if not self.fitted:
            return
        rest = np.arange(len(y)) % 3 == 2
        if len(set(y[rest].tolist())) < 2 or len(set(y[~rest].tolist())) < 2:
            rest = np.ones(len(y), bool)
        teach = [t for t, r in zip(texts, rest) if not r] or texts
        marks = y[~rest] if (~rest).any() else y
        by = [[t for t, m in zip(teach, marks) if m == c] for c in (0, 1)]
        self.ordinary = ordinary_dictionary(by[0])
        self.toxic = toxic_dictionary(by[1], by[0])
        x, z = self.features([t for t, r in zip(texts, rest) if r]), y[rest]
        self.centre, self.spread = x.mean(0), x.std(0) + 1e-6
        self.weights = logistic((x - self.centre) / self.spread, z)
        self.weights[-1] += prior_shift(z, self.rate)

    def __getstate__(self):
        return self.__dict__ | {"_made": None}

    def _compressors(self):
        if self._made is None:
            made = []
            for content in (self.ordinary, self.toxic + self.ordinary):
                d = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
            self._made = made
        return self._made

    def _gains(self, windows: list[bytes]) -> np.ndarray:
        """How much shorter each window is with the toxic dictionary."""
        gain = np.zeros(len(windows))
        for sign, compressor in zip((1, -1), self._compressors()):
            done = compressor.multi_compress_to_buffer(windows)
            gain += sign * np.fromiter((len(done[i]) for i in range(len(done))), float, len(done))
        return gain

    def features(self, texts) -> np.ndarray:
        held, counts, gains = [], [], [np.zeros(0)]
        for t in texts:
            n = 0
            for w in windows_of(t):
                held.append(w)
                n += 1
                if len(held) >= 50_000:
                    gains.append(self._gains(held))
                    held = []
            counts.append(n)
        if held:
            gains.append(self._gains(held))
        gain = np.concatenate(gains)
        row = np.repeat(np.arange(len(counts)), counts)
        n = len(counts)
        most = np.zeros(n)
        np.maximum.at(most, row, gain)
        over = [np.log1p(np.bincount(row[gain >= k], minlength=n)) for k in (1, 2, 3, 4, 5, 6, 8)]
        size = np.log1p(np.array(counts, float))
        mean = np.bincount(row, gain, n) / np.maximum(counts, 1)
        return np.stack([most, np.minimum(most, 5), mean, size, *over, *(o - size for o in over[1:5])], 1)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.rate)
        if not self.fitted:
            return out
        for at, _, offsets in sliced(texts):
            own = [x.as_py() or "" for x in texts.slice(at, len(offsets) - 1)]
            # a sum for each row, which a matrix product may order otherwise from one batch to another
            out[at : at + len(own)] = sigmoid(((self.features(own) - self.centre) / self.spread * self.weights[:-1]).sum(1) + self.weights[-1])
        return out


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> CompressionDistance:
    return CompressionDistance(*learning_rows(docs, labels, "toxic", LEARN_ROWS["toxic"]))


def op7_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), TOXIC_THRESHOLD)
