"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in built-in functions only.

A text's paragraphs (lines, long lines cut at white space to at most PARAGRAPH characters) are
hashed to 64-bit digests; a set of digests becomes a sketch of m cells in three subtables. Each
digest goes to one cell of each subtable, which keeps a count, the digests' XOR and the XOR of a
32-bit check. Two versions' cells subtract, common paragraphs cancel, and peeling recovers the rest: a cell with a
count of 1 or -1 whose check fits holds one digest, which then leaves its other cells. A round peels one
subtable, where a digest lies in one cell only, so a round is one generator and one aggregate, and the
rounds of an attempt chain without a shuffle once the rows of a pair lie together. A pair that does not come
out empty is tried again with a larger sketch, until every pair has.

Attempts: a power of two times FINGERPRINT cells (what the fingerprint string holds), at least twice as many as
both versions have paragraphs, then four times as many as before for as long as a pair fails.

Defined cases: a null text is empty, and its set of paragraphs too; two empty sets have likeness
1; repeated paragraphs count once; repeated rows and ids are documents of their own, ordered by id,
then text; a null id comes after the others; with one document the next is itself; a very long text is one row of digests, 8 bytes for each of its paragraphs; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

PARAGRAPH = 100
FINGERPRINT = 24
ROUNDS = 12
#: Rows that a range of document ids has, on average; ranges at most.
RANGE_ROWS, MOST_RANGES = 1000, 4096
_LINES = rf"[^\n]{{1,{PARAGRAPH - 1}}}(?:\s|$)|[^\n]{{1,{PARAGRAPH}}}"
_PLUS, _MINUS, _CELL = 1 << 30, (1 << 30) + 1, (1 << 31) - 1


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_LINES), F.lit(0)), lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check")).bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(key: Column, j, cells: Column) -> Column:
    """The cell of a digest in subtable j of a sketch of so many cells."""
    third = (cells / 3).cast("long")
    j = j if isinstance(j, Column) else F.lit(j)
    return j * third + F.pmod(F.xxhash64(key, j, cells), third)


def sketch_text(keys: Column, cells: int = FINGERPRINT) -> Column:
    """The sketch of an array of digests as text: cell, count, digests' XOR and check of each cell in use."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("h"))

    def add(a, p):
        return F.struct((a["n"] + 1).alias("n"), a["k"].bitwiseXOR(p["k"]).alias("k"), a["h"].bitwiseXOR(_check(p["k"])).alias("h"))

    def cell(places: Column, c: int) -> Column:
        text = lambda a: F.when(a["n"] > 0, F.concat_ws(":", F.lit(str(c)), a["n"].cast("string"), F.hex(a["k"]), F.hex(a["h"])))
        return F.aggregate(F.filter(places, lambda p: p["c"] == c), zero, add, text)

    def places(j: int) -> Column:
        return F.transform(keys, lambda k: F.struct(_cell(k, j, F.lit(cells).cast("long")).alias("c"), k.alias("k")))

    third = cells // 3
    return F.concat_ws(";", F.size(keys).cast("string"), *[cell(places(c // third), c) for c in range(cells)])


def _slot(what: Column, size: Column, cell: Column) -> Column:
    """One key for a cell: pair and attempt, the sketch's size in 24 cells' doublings, the cell."""
    return F.shiftleft(what.cast("long"), 40) + F.shiftleft(size.cast("long"), 32) + cell


_WHAT, _SIZE, _AT = "shiftright(slot, 40)", "(shiftright(slot, 32) & 255)", f"(slot & {_CELL})"


def _peel(cells: DataFrame, subtable: int) -> DataFrame:
    """One round: takes the digests that lie alone in a cell of the subtable out of all their cells, each into a row of its own."""
    size = F.expr(f"cast({FINGERPRINT} * power(2, {_SIZE}) as long)")
    own = F.expr(_AT)
    alone = (F.abs("n") == 1) & (own < F.lit(_PLUS)) & (_check(F.col("k")) == F.col("h")) & (_cell(F.col("k"), subtable, size) == own)
    base = F.col("slot") - own
    row = lambda slot, digest, n, k, h: F.struct(slot.alias("slot"), digest.cast("long").alias("digest"), n.cast("long").alias("n"), k.cast("long").alias("k"), h.cast("long").alias("h"))
    others = [row(base + _cell(F.col("k"), j, size), F.lit(0), -F.col("n"), F.col("k"), F.col("h")) for j in range(3) if j != subtable]
    mark = row(base + F.when(F.col("n") > 0, F.lit(_PLUS)).otherwise(F.lit(_MINUS)), F.col("k"), F.lit(1), F.lit(0), F.lit(0))
    same = row(F.col("slot"), F.col("digest"), F.col("n"), F.col("k"), F.col("h"))
    return _sums(cells.select("rid", F.inline(F.when(alone, F.array(*others, mark)).otherwise(F.array(same)))))


def _sums(rows: DataFrame) -> DataFrame:
    summed = rows.groupBy("rid", "slot", "digest").agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"))
    return summed.where("n != 0 or k != 0 or h != 0")


def _attempt(pairs: DataFrame, sizes: dict[int, Column], rounds: int = ROUNDS) -> DataFrame:
    """Differences of pairs(rid, own, edited, next) by sketches of the sizes given for attempts.

    Returns rid, pair (0: edited, 1: next), attempt, plus, minus, left: arrays of the digests found on either side, and
    how many cells did not come out empty.
    """
    tries = list(sizes)
    sized = pairs.select("rid", "own", "edited", "next", *[sizes[a].cast("int").alias(f"size{a}") for a in tries])

    def tag(column: str, role: int) -> Column:
        return F.transform(column, lambda k: F.struct(k.alias("key"), F.lit(role).alias("role")))

    tagged = F.concat(tag("own", 0), tag("edited", 1), tag("next", 2))
    keys = sized.select("rid", *[f"size{a}" for a in tries], F.inline(tagged))
    # what = 2 * attempt + pair; own digests count in both pairs
    targets = lambda which, sign: [F.struct(F.lit(2 * a + p).alias("what"), F.col(f"size{a}").alias("size"), F.lit(j).alias("j"), F.lit(sign).cast("long").alias("n")) for a in tries for p in which for j in range(3)]
    to = F.when(F.col("role") == 0, F.array(*targets((0, 1), 1))).when(F.col("role") == 1, F.array(*targets((0,), -1))).otherwise(F.array(*targets((1,), -1)))
    placed = keys.select("rid", "key", F.inline(to))
    many = F.expr(f"cast({FINGERPRINT} * power(2, size) as long)")
    cells = _sums(placed.select("rid", _slot(F.col("what"), F.col("size"), _cell(F.col("key"), F.col("j"), many)).alias("slot"), F.lit(0).cast("long").alias("digest"), "n", F.col("key").alias("k"), _check(F.col("key")).alias("h")))
    for r in range(rounds):
        cells = _peel(cells, r % 3)
    what, at = F.expr(_WHAT), F.expr(_AT)
    digests_of = lambda mark: F.collect_list(F.when(at == mark, F.col("digest")))
    return cells.groupBy("rid", what.alias("what")).agg(
        digests_of(_PLUS).alias("plus"), digests_of(_MINUS).alias("minus"), F.sum((at < _PLUS).cast("int")).alias("left")
    ).select("rid", (F.col("what") % 2).cast("int").alias("pair"), F.floor(F.col("what") / 2).cast("int").alias("attempt"), "plus", "minus", "left")


def differences(pairs: DataFrame) -> DataFrame:
    """rid, pair, plus, minus for every pair with a difference: the digests that only the first or only the second version has.

    pairs: rid, own, edited, next (arrays of digests), read from a written table.
    """
    n = F.size("own") + F.greatest(F.size("edited"), F.size("next"))
    enough = F.greatest(F.lit(1), F.ceil(F.log2((2 * n + 1) / FINGERPRINT)))
    tries = {0: enough}
    near = pairs.select("rid", "own", "edited", "next").repartition("rid")
    done = None
    larger = 1
    while True:
        found = saved(_attempt(near, tries), "iblt-differences")
        best = found.where("left = 0").groupBy("rid", "pair").agg(F.min_by(F.struct("plus", "minus"), "attempt").alias("d"))
        failed = found.groupBy("rid", "pair").agg(F.min("left").alias("left")).where("left > 0")
        best = best.select("rid", "pair", "d.plus", "d.minus")
        if done is not None:  # of the pairs that are tried again, only those that had failed
            best = best.join(failing, ["rid", "pair"], "left_semi")  # noqa: F821
        done = best if done is None else done.unionByName(best)
        failed = failed.select("rid", "pair")
        if larger > 1:
            failed = failed.join(failing, ["rid", "pair"], "left_semi")  # noqa: F821
        failing = saved(failed, "iblt-failed")
        if failing.isEmpty():
            return done
        near = pairs.select("rid", "own", "edited", "next").join(failing.select("rid").distinct(), "rid", "left_semi").repartition("rid")
        tries = {larger: enough + 2 * larger}
        larger += 1


def likeness(own: Column, other: Column, plus: Column, minus: Column) -> Column:
    """Jaccard likeness of two sets of digests by their sizes and differences."""
    both = own + F.coalesce(minus, F.lit(0))
    return F.when(both == 0, F.lit(1.0)).otherwise((own - F.coalesce(plus, F.lit(0))) / both)


def with_next(docs: DataFrame) -> DataFrame:
    """rid, doc_id, text, next_text: each document with the next by descending doc_id, the first after the last.

    Documents are dealt once, to ranges of ids between quantiles; the first document of a range also goes to
    the range before it. Only the ranges' bounds (at most MOST_RANGES numbers) reach the driver.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = F.coalesce(-F.col("doc_id"), F.lit((1 << 63) - 1))
    counted = docs.agg(F.count("*").alias("n")).first().n
    ranges = min(MOST_RANGES, counted // RANGE_ROWS + 1)
    cuts = docs.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)] or [0.5], 10 * MOST_RANGES).alias("c")).first().c or []
    cuts = sorted(set(cuts)) if ranges > 1 else []
    steps = max(1, len(cuts).bit_length())
    literal = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array(F.lit(0).cast("long"))
    search = F.aggregate(
        F.array(*[F.lit(1 << s) for s in reversed(range(steps))]), F.lit(0),
        lambda at, s: F.when((at + s <= len(cuts)) & (F.get(literal, at + s - 1) < key), at + s).otherwise(at),
    )
    ranged = docs.withColumn("b", search if cuts else F.lit(0)).withColumn("o", key)
    firsts = saved(ranged.groupBy("b").agg(F.min(F.struct("o", F.xxhash64("text").alias("h"), "text")).alias("f")), "iblt-firsts")
    bs = sorted(r.b for r in firsts.select("b").collect())
    before = {b: bs[i - 1] for i, b in enumerate(bs)}
    to = F.create_map(*[F.lit(x) for kv in before.items() for x in kv]) if bs else F.create_map(F.lit(0), F.lit(0))
    ghosts = firsts.select(F.element_at(to, F.col("b")).alias("b"), F.lit(None).cast("long").alias("doc_id"), F.col("f.text").alias("text"), F.col("f.o").alias("o"), F.lit(True).alias("ghost"))
    rows = ranged.select("b", "doc_id", "text", "o", F.lit(False).alias("ghost")).unionByName(ghosts)
    w = Window.partitionBy("b").orderBy("ghost", "o", F.xxhash64("text"), "text")
    nexts = rows.select("b", "doc_id", "text", "ghost", F.lead("text").over(w).alias("next_text"), F.row_number().over(w).alias("rn"))
    return nexts.where("not ghost").select((F.shiftleft(F.col("b").cast("long"), 32) + F.col("rn")).alias("rid"), "doc_id", "text", "next_text")


def edited_text(text: Column, other: Column) -> Column:
    """text with its last third of code points replaced by as many first ones of the other text, or all it has."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(other, F.lit(1), third))


def op1_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents"))
    rows = rows.withColumn("edit", edited_text(F.col("text"), F.col("next_text")))
    read = rows.select(
        "rid", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edit").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edit")).alias("edited"), digests(F.col("next_text")).alias("next"),
    )
    read = saved(read, "iblt-digests")
    found = differences(read)
    found = found.select("rid", "pair", F.size("plus").alias("plus"), F.size("minus").alias("minus"))
    pair = lambda p: F.max(F.when(F.col("pair") == p, F.struct("plus", "minus")))
    found = found.groupBy("rid").agg(pair(0).alias("e"), pair(1).alias("x"))
    out = read.select("rid", "doc_id", "n_chars", "edited_sha256", "own", "edited", F.size("next").alias("n_next")).join(found, "rid", "left")
    n = F.size("own")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", sketch_text(F.col("own")).alias("fingerprint"), sketch_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(n, F.size("edited"), F.col("e.plus"), F.col("e.minus")).alias("near_edited"),
        likeness(n, F.col("n_next"), F.col("x.plus"), F.col("x.minus")).alias("near_next"),
    )
