"""Near-duplicate classes by ProbMinHash, banding and verification.

A text's shingles are its runs of WORDS words (all its words, if fewer); a shingle's weight is 1 + ln(its count).
Each shingle starts a Poisson process with its weight as rate, driven by its hash; every arrival falls into one of
REGISTERS registers, which keep the earliest one. A text's processes stop once they have passed its latest
register. Two texts agree in a register with the probability Jaccard of their weighted shingles. BANDS
bands of registers give candidates: at a similarity of 0.8 one in 20,000 pairs shares no band.

Copies of a text count once. Within a band's bucket nobody meets everybody: all meet the member
that shares most buckets with others (of near copies, that is the one they derive from). The
links that hold (probability Jaccard of the weighted shingles >= SIMILARITY, computed from the texts) give components. Only where a
bucket still spans several components, its members of different components are compared in
blocks of BLOCK, and the links found there join the others. So every candidate pair is either
verified or already connected.

Defined cases: a null text is empty; texts without words are near nothing but their own copies; a null doc_id is
a document whose class has the least id of the others in it, or null; repeated rows are repeated, and rows of one id with different texts
are classed by their texts; very long texts are hashed whole, their words in pieces of a few MB; an empty table gives no rows; extra columns are
ignored. keep_first() keeps one row of each class: a null id counts as greater than any other, of equal ids the
smaller text id wins, of rows that are equal in both the one with the smallest hash of all its columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .classify import pieces, sliced
from .common import mix64, release, saved, table

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
BLOCK = 256
#: Text ids (16 bytes) that may be broadcast to pick texts; beyond it the join shuffles.
BROADCAST_IDS = 500_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, size: int = 4 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each word (run of bytes over 32) of texts in one buffer; a text over `size` bytes goes in pieces."""
    if len(offsets) == 2 and len(data) > size:
        h = np.concatenate([word_hashes(p, np.array([0, len(p)]), len(p))[1] for p in pieces(data, size)])
        return np.zeros(len(h), np.int64), h
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths)), lengths)
    inside = data > 32
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(data) + 1, _ODD))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
        back = np.cumprod(np.full(len(data) + 1, _INVERSE))
        return row[starts], mix64((total[ends] - total[starts]) * back[starts])


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of each distinct shingle, by row."""
    row, h = word_hashes(data, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(n) - n
    with np.errstate(over="ignore"):
        left = np.repeat(first + n, n) - np.arange(len(h))  # words from here to the text's end
        whole = np.zeros(len(h), np.uint64)
        for k in range(words):
            has = left > k
            whole[has] = whole[has] * _ODD + h[np.flatnonzero(has) + k]
        start = (left >= words) | ((np.arange(len(h)) == first[row]) & (n[row] < words))
        whole = mix64(whole + np.minimum(left, words).astype(np.uint64))
    r, s = row[start], whole[start]
    order = np.lexsort((s, r))
    r, s = r[order], s[order]
    new = np.append(True, (r[1:] != r[:-1]) | (s[1:] != s[:-1])) if len(r) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return r[at], s[at], np.diff(np.append(at, len(r)))


def prob_min_hash(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """n x m registers, each the hash of the element that arrived first; 0 without elements."""
    time, who = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    at = np.zeros(len(key))
    step = 0
    while len(key):
        step += 1
        with np.errstate(over="ignore"):
            u = mix64(key + np.uint64(step) * _ODD)
            at = at - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
            slot = row * m + (mix64(u) % np.uint64(m)).astype(np.int64)
        better = np.flatnonzero(at < time[slot])
        if len(better):
            order = better[np.lexsort((key[better], at[better], slot[better]))]
            s = slot[order]
            lead = order[np.append(True, s[1:] != s[:-1])]
            time[slot[lead]] = at[lead]
            who[slot[lead]] = key[lead]
        latest = time.reshape(n, m).max(1)
        go = at < latest[row]
        row, key, weight, at = row[go], key[go], weight[go], at[go]
    return who.reshape(n, m)


def bands_of(registers: np.ndarray) -> np.ndarray:
    """A hash of each band of each row."""
    out = np.zeros((len(registers), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            h = np.full(len(registers), b + 1, np.uint64)
            for k in range(ROWS):
                h = mix64(h * _ODD + registers[:, b * ROWS + k])
            out[:, b] = h
    return out


def with_text_id(docs: DataFrame) -> DataFrame:
    """doc_id, tid (16 bytes that stand for the text), text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("tid"), text.alias("text"))


def weighted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's shingles in order, and their weights."""
    data = np.frombuffer(text.encode(), np.uint8)
    _, key, count = shingles(data, np.array([0, len(data)]))
    return key, 1 + np.log(count)


def _jaccards(batches):
    for batch in batches:
        sets: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}

        def of(tid, text):
            if tid not in sets:
                if len(sets) > 500:
                    sets.clear()
                    release()
                sets[tid] = weighted(text)
            return sets[tid]

        keep = []
        for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
            keep.append(similar(of(a, x), of(b, y)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common elements d of 1 / sum over all e of max(x_e / x_d, y_e / y_d), for elements in order with weights.

    By x_e / y_e, the elements from d on count in x, those before it in y; so sums along that order give all terms.
    """
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    a, b = x[1][i], y[1][j]
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    only_x, only_y = x[1].sum() - a.sum(), y[1].sum() - b.sum()
    above = only_x + np.cumsum(a[::-1])[::-1]
    below = only_y + np.cumsum(b) - b
    return float((1 / (above / a + below / b)).sum())


def similar(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], least: float = SIMILARITY) -> bool:
    """Whether two weighted sets have a probability Jaccard similarity of at least `least`."""
    return probability_jaccard(x, y) >= least - 1e-12


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """tid, text once for each of the ids (a saved table)."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    found = with_text_id(docs).select("tid", "text").join(F.broadcast(ids) if few else ids, "tid", "left_semi")
    return saved(found.groupBy("tid").agg(F.first("text").alias("text")), "minhash-texts")


def components(links: DataFrame) -> DataFrame:
    """id, label of every end of links(a, b): the least id that it is connected to.

    Labels take the least of their neighbours' and then jump to their label's label, until none changes.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")).distinct(), "minhash-edges")
    labels = saved(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "minhash-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        low = labels.join(near, "id").select("id", F.least("label", "near").alias("to"), "label")
        low = saved(low, "minhash-labels")
        up = low.select(F.col("id").alias("to"), F.col("to").alias("up"))
        new = saved(low.join(up, "to", "left").select("id", F.coalesce("up", "to").alias("label"), (F.coalesce("up", "to") != F.col("label")).alias("changed")), "minhash-labels")
        labels = new.select("id", "label")
        if new.where("changed").isEmpty():
            return labels


def _in_blocks(group: pa.Table) -> pa.Table:
    """Links between members of different components in two blocks of a bucket (or in one)."""
    t = group.to_pydict()
    sets = []
    for x in t["text"]:
        sets.append(weighted(x))
    out = []
    one, two = t["one"][0], t["two"][0]
    left = [i for i, b in enumerate(t["block"]) if b == one]
    right = [i for i, b in enumerate(t["block"]) if b == two]
    for i in left:
        for j in right:
            if (one != two or i < j) and t["label"][i] != t["label"][j] and similar(sets[i], sets[j]):
                out.append((t["tid"][i], t["tid"][j]))
    a, b = zip(*out) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def labelled_texts(docs: DataFrame) -> DataFrame:
    """doc_id, tid, label of every document: the label is a text id that all texts of a class share."""
    known = with_text_id(docs).mapInArrow(_narrow, "doc_id long, tid binary, bands array<long>")
    known = saved(known, "minhash-signatures")
    once = known.groupBy("tid").agg(F.first("bands", ignorenulls=True).alias("bands")).where("bands is not null")
    rows = saved(once.select("tid", F.explode("bands").alias("band")), "minhash-bands")
    sizes = saved(rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "minhash-buckets")
    members = saved(rows.join(sizes, "band"), "minhash-members")
    popular = members.groupBy("tid").agg(F.sum("n").alias("shares"))
    members = saved(members.join(popular, "tid").select("band", "tid", "n", "shares"), "minhash-members")
    centres = members.groupBy("band").agg(F.max(F.struct("shares", "tid")).alias("c")).select("band", F.col("c.tid").alias("a"))
    pairs = members.join(centres, "band").where("tid != a").select(F.least("a", "tid").alias("a"), F.greatest("a", "tid").alias("b")).distinct()
    pairs = saved(pairs, "minhash-pairs")
    ids = saved(pairs.select(F.col("a").alias("tid")).union(pairs.select("b")).distinct(), "minhash-ids")
    texts = texts_of(docs, ids)
    both = pairs.join(texts.select(F.col("tid").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("tid").alias("b"), F.col("text").alias("text_b")), "b")
    links = saved(both.mapInArrow(_jaccards, "a binary, b binary"), "minhash-links")
    labels = components(links)
    # buckets that span components
    apart = members.join(labels, F.col("tid") == F.col("id"), "left").select("band", "tid", "n", F.coalesce("label", "tid").alias("label"))
    apart = saved(apart, "minhash-apart")
    spans = apart.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("tid")).alias("h"), F.sum(F.xxhash64(F.lit(1), "tid") % (1 << 40)).alias("s"))
    # two members met as centre and member; the same members in several buckets need one comparison
    spans = spans.where("x != y and n > 2").groupBy("n", "h", "s").agg(F.min("band").alias("band")).select("band")
    rest = apart.join(spans, "band", "left_semi")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rest = saved(rest.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int")), "minhash-rest")
    if not rest.isEmpty():
        ids = saved(rest.select("tid").distinct(), "minhash-ids")
        meets = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        meets = meets.select("band", "tid", "label", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
        found = meets.join(texts_of(docs, ids), "tid").groupBy("band", "one", "two").applyInArrow(_in_blocks, "a binary, b binary")
        more = saved(found, "minhash-links")
        if not more.isEmpty():
            labels = components(links.unionByName(more))
    return known.select("doc_id", "tid").join(labels, F.col("tid") == F.col("id"), "left").select("doc_id", "tid", F.coalesce("label", "tid").alias("label"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id of every document: the least doc_id of its class."""
    labelled = labelled_texts(docs)
    least = saved(labelled.groupBy("label").agg(F.min("doc_id").alias("class_id")), "minhash-classes")  # so that the join may split a large class
    return labelled.join(least, "label").select("doc_id", "class_id")


def _narrow(batches):
    """doc_id, tid and bands; no bands for a text without words."""
    for batch in batches:
        lists = []
        for _, data, offsets in sliced(batch.column("text")):
            n = len(offsets) - 1
            row, key, count = shingles(data, offsets)
            some = np.bincount(row, minlength=n) > 0
            bands = bands_of(prob_min_hash(row, key, 1 + np.log(count), n)).view(np.int64)
            lists += [x if s else None for x, s in zip(bands, some)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tid"), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "tid", "bands"])


def keep_first(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: that with the smallest doc_id, as the docstring above says."""
    labelled = labelled_texts(docs)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tid")
    first = saved(labelled.groupBy("label").agg(F.min(rank).alias("first")), "minhash-first")
    rows = labelled.groupBy("label", "doc_id", "tid").agg(F.count("*").alias("n")).join(first, "label")
    other = saved(rows.select("doc_id", "tid", (rank == F.col("first")).alias("is_first"), "n").where("not is_first or n > 1"), "minhash-gone")
    gone, again = (other.where(x).select("doc_id", "tid") for x in ("not is_first", "is_first"))
    tid = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("_id"), tid.alias("_tid"))

    def meet(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        ids = F.broadcast(ids) if few else ids
        return rows.join(ids, rows._id.eqNullSafe(ids.doc_id) & (rows._tid == ids.tid), how)

    stay = meet(keyed, gone, "left_anti")
    if again.isEmpty():
        return stay.select("row.*")
    # equal rows of one id and text: one by partial aggregates, which a hot one can't crowd
    once = meet(stay, again, "left_semi").groupBy("_id", "_tid").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return meet(stay, again, "left_anti").select("row.*").unionByName(once.select("row.*"))


def op8_prob_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
