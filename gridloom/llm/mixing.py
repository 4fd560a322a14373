"""Mixing sources to target weights: whole copies of documents by pivotal rounding, so that sums of words hold.

A source's target over its size is the number of copies of each of its documents: a whole part and a fraction that all share.
Fractions are rounded in pairs. Of two documents with sizes a and b and fractions x and y, words move from one to the other until one
fraction is 0 or 1; which way is drawn, with odds that leave both expectations as they were. So a x + b y never changes, and the source's
taken words stay at its target until its last document is rounded.

Pairs are met in a tree. A source's documents are dealt to classes of sizes from 2**c to below 2**(c + 1) and numbered in each by a hash;
FAN documents with following numbers are one fold, which leaves at most one fraction; its fraction goes to the next level with FAN - 1 others.
Numbers come from sorted ranges, which split any key, so no source, class or id is more than its share of a task. The first KEEP documents of each class take no
part in the tree: with the fractions that it leaves (KEEP + 1 documents a class at most, whatever the source's size) they are rounded from
the largest to the smallest, each against all smaller ones together. So what is left over is a small document, not a large one.

Nothing but expressions of Spark is used; draws are hashes of numbers, so reruns agree however tasks are cut.

Defined cases: a null text or one without words has size 0 and is never taken; a null source is a source, the last; null and repeated ids
and repeated rows are documents each; a corpus without words has targets of 0; whole texts are counted, however long; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

#: Documents of a fold, and of each class that wait for the last one.
FAN, KEEP = 64, 16
#: Copies that one row of a task becomes.
COPIES = 1000

WORD = r"[^\x20\x09-\x0D]+"
_ITEM = "struct<nth:bigint,doc_id:bigint,key:bigint,size:bigint,x:double>"
_DONE = "array<struct<doc_id:bigint,key:bigint,size:bigint,up:int>>"


def _key(seed: int) -> Column:
    """The same for equal rows; what numbers and draws go by."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.lit("/"), F.col("source"), F.lit("/"), F.col("text"))


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, key, size in words."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), "source", _key(seed).alias("key"), words.alias("size"))


def numbered(df: DataFrame, group: list[str], order: list, tag: str) -> DataFrame:
    """df with nth, from 0 within its group by `order`; equal rows are numbered as they come.

    Rows are sorted into ranges; a group goes on from range to range, by a table of a row for each group and range.
    """
    ties = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = ties.repartitionByRange(*group, *order, "_tie").sortWithinPartitions(*group, *order, "_tie").drop("_tie")
    rows = saved(dealt.withColumn("_at", F.monotonically_increasing_id()), tag).withColumn("_range", F.shiftright("_at", 33))
    spans = rows.groupBy(*group, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    spans = saved(spans.select(*group, "_range", "_first", F.coalesce(before, F.lit(0)).alias("_before")), f"{tag}-spans")
    return rows.join(spans, [*group, "_range"]).withColumn("nth", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_range", "_first", "_before")


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """src (the source's number), source, source_size, target, copies (whole), x (the fraction).

    Sources by code point, null last, take the weights in turn. What is above `most` times a source's size is shared out among the others
    by weight, until none is above; a round is one aggregate over the sources.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")).cast("long")
    sources = numbered(per, [], [F.asc_nulls_last("source")], "mix-sources").withColumnRenamed("nth", "src").withColumn("weight", turn)
    sources = saved(sources, "mix-weights")
    all_ = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    words, weight = all_["size"] or 0, all_["weight"] or 0
    exact = "decimal(38,0)"
    cap = F.lit(most) * F.col("source_size")
    room, left, full = words, weight, F.lit(False)
    while left:
        full = cap.cast(exact) * F.lit(left).cast("decimal(18,0)") <= F.lit(room).cast(exact) * F.col("weight").cast("decimal(18,0)")
        above = sources.where(full).agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
        now = words - most * (above["size"] or 0), weight - (above["weight"] or 0)
        if now == (room, left):
            break
        room, left = now
    if not left:  # all are at their most, as in a corpus without words
        full = F.lit(True)
    share = F.lit(float(room)) * F.col("weight") / F.lit(float(left or 1))
    target = F.when(full, cap.cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    out = sources.withColumn("target", target).withColumn("rate", rate)
    return saved(out.select("src", "source", "source_size", "target", F.floor("rate").alias("copies"), (F.col("rate") - F.floor("rate")).alias("x")), "mix-targets")


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _draw(seed: int, *of: Column) -> Column:
    """From 0 to below 1, by hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11).cast("double") / float(2**53)


def _entry(item: Column, x: Column) -> Column:
    return F.struct(item["doc_id"].alias("doc_id"), item["key"].alias("key"), item["size"].alias("size"), x.cast("int").alias("up"))


def _with(item: Column, x: Column) -> Column:
    return F.struct(*(item[c].alias(c) for c in ("nth", "doc_id", "key", "size")), x.alias("x"))


def _paired(seed: int, *place: Column):
    """A step of a fold: the open document of the state and the next one."""

    def step(state: Column, j: Column) -> Column:
        i, done = state["open"], state["done"]

        def moves(p: Column) -> Column:
            a, b, x, y = i["size"].cast("double"), j["size"].cast("double"), i["x"], j["x"]
            # words that i can gain from j, and j from i
            gain, loss = F.least(a * (1 - x), b * y), F.least(a * x, b * (1 - y))
            return F.struct(a.alias("a"), b.alias("b"), gain.alias("gain"), loss.alias("loss"), (p < loss / (gain + loss)).alias("up"))

        def turned(m: Column) -> Column:
            x, y, a, b = i["x"], j["x"], m["a"], m["b"]
            x_up = F.when(m["gain"] >= a * (1 - x), 1.0).otherwise(x + m["gain"] / a)
            y_up = F.when(m["gain"] >= b * y, 0.0).otherwise(y - m["gain"] / b)
            x_down = F.when(m["loss"] >= a * x, 0.0).otherwise(x - m["loss"] / a)
            y_down = F.when(m["loss"] >= b * (1 - y), 1.0).otherwise(y + m["loss"] / b)
            return F.struct(F.when(m["up"], x_up).otherwise(x_down).alias("x"), F.when(m["up"], y_up).otherwise(y_down).alias("y"))

        def result(r: Column) -> Column:
            whole = [(v <= 0) | (v >= 1) for v in (r["x"], r["y"])]
            of_i, of_j = F.array(_entry(i, r["x"])), F.array(_entry(j, r["y"]))
            closed = F.when(whole[0] & whole[1], F.concat(done, of_i, of_j)).when(whole[0], F.concat(done, of_i)).otherwise(F.concat(done, of_j))
            left = F.when(~whole[0], _with(i, r["x"])).when(~whole[1], _with(j, r["y"]))
            return F.struct(left.cast(_ITEM).alias("open"), closed.cast(_DONE).alias("done"))

        met = _let(_let(_let(_draw(seed, *place, i["nth"], j["nth"]), moves), turned), result)
        return F.when(i.isNull(), F.struct(j.cast(_ITEM).alias("open"), done.alias("done"))).otherwise(met)

    return step


def reduced(rows: DataFrame, seed: int, level: int) -> DataFrame:
    """src, class, node, open, done of a level. rows: src, class, node, item; FAN a node at most."""
    groups = rows.groupBy("src", "class", "node").agg(F.sort_array(F.collect_list("item")).alias("items"))
    nothing = F.struct(F.lit(None).cast(_ITEM).alias("open"), F.array().cast(_DONE).alias("done"))
    folded = F.aggregate("items", nothing, _paired(seed, F.lit(level), F.col("src"), F.col("class")))
    out = groups.select("src", "class", "node", folded.alias("f")).select("src", "class", "node", F.col("f.open").alias("open"), F.col("f.done").alias("done"))
    return saved(out, f"mix-level{level}")


def _pooled(seed: int, src: Column):
    """A step of the last fold: a document against all that follow, whose fractions become scale * x + shift."""

    def step(state: Column, i: Column) -> Column:
        a = i["size"].cast("double")

        def pool(_: Column) -> Column:
            rest, mass = state["size"] - a, state["mass"] - a * i["x"]
            holds = F.greatest(F.least(state["scale"] * mass + state["shift"] * rest, rest), F.lit(0.0))
            x = F.greatest(F.least(state["scale"] * i["x"] + state["shift"], F.lit(1.0)), F.lit(0.0))
            gain, loss = F.least(a * (1 - x), holds), F.least(a * x, rest - holds)
            return F.struct(rest.alias("rest"), mass.alias("mass"), holds.alias("holds"), x.alias("x"), gain.alias("gain"), loss.alias("loss"))

        def move(p: Column) -> Column:
            both = p["gain"] + p["loss"]
            up = _draw(seed, F.lit(-1), src, i["key"], i["nth"]) < p["loss"] / both
            x = F.when(both <= 0, p["x"]).when(up, F.when(p["gain"] >= a * (1 - p["x"]), 1.0).otherwise(p["x"] + p["gain"] / a)).otherwise(F.when(p["loss"] >= a * p["x"], 0.0).otherwise(p["x"] - p["loss"] / a))
            # what the others keep of their fractions, or of what these lack to 1
            keep = F.when(both <= 0, 1.0).when(up, 1 - p["gain"] / p["holds"]).otherwise(1 - p["loss"] / (p["rest"] - p["holds"]))
            return F.struct(p["rest"].alias("rest"), p["mass"].alias("mass"), x.alias("x"), keep.alias("keep"), ((both > 0) & ~up).alias("gained"))

        def result(m: Column) -> Column:
            x = F.when(_draw(seed, F.lit(-2), src, i["key"], i["nth"]) < m["x"], 1).otherwise(0)
            scale, shift = state["scale"] * m["keep"], state["shift"] * m["keep"] + F.when(m["gained"], 1 - m["keep"]).otherwise(0.0)
            done = F.concat(state["done"], F.array(_entry(i, x))).cast(_DONE)
            return F.struct(m["rest"].alias("size"), m["mass"].alias("mass"), scale.alias("scale"), shift.alias("shift"), done.alias("done"))

        return _let(_let(_let(F.lit(0), pool), move), result)

    return step


def settled(rows: DataFrame, seed: int) -> DataFrame:
    """src, done: the rest of every source. rows: src, item; some documents of each class of sizes."""
    largest_first = F.struct((-F.col("item.size")).alias("s"), F.col("item.key").alias("k"), F.col("item").alias("item"))
    lists = rows.groupBy("src").agg(F.sort_array(F.collect_list(largest_first)).alias("o")).select("src", F.col("o.item").alias("items"))
    summed = [F.aggregate("items", F.lit(0.0), f) for f in (lambda t, i: t + i["size"], lambda t, i: t + i["size"] * i["x"])]
    start = F.struct(summed[0].alias("size"), summed[1].alias("mass"), F.lit(1.0).alias("scale"), F.lit(0.0).alias("shift"), F.array().cast(_DONE).alias("done"))
    return lists.select("src", F.aggregate("items", start, _pooled(seed, F.col("src")), lambda s: s["done"]).alias("done"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 1) -> DataFrame:
    """doc_id, source, key, size, source_size, target, copies, taken (copies x size) for each of docs: doc_id, source, text.

    copies is at most `most`; each source's taken words are its target but for a small document.
    """
    sized = saved(sizes(docs, seed), "mix-sizes")
    sources = targets(sized, weights, most)
    of = sources.withColumnRenamed("source", "_source").select("src", "_source", "x")
    rows = sized.join(of, F.col("source").eqNullSafe(F.col("_source"))).select("src", "doc_id", "key", "size", "x")
    free = (F.col("size") > 0) & (F.col("x") > 0)
    classed = rows.where(free).withColumn("class", F.length(F.bin("size")))
    placed = numbered(classed, ["src", "class"], ["key", "doc_id", "size"], "mix-order")
    items = placed.select("src", "class", "nth", F.struct("nth", "doc_id", "key", "size", "x").cast(_ITEM).alias("item"))

    count = (items.agg(F.max("nth")).first()[0] or 0) + 1 - KEEP
    last = [items.where(F.col("nth") < KEEP).select("src", "item")]
    done = []
    below, level = items.where(F.col("nth") >= KEEP).select("src", "class", F.floor((F.col("nth") - KEEP) / FAN).alias("node"), "item"), 0
    while count > 0:
        tree = reduced(below, seed, level)
        done.append(tree.select("src", "done"))
        rest = tree.where("open is not null")
        below = rest.select("src", "class", F.floor(F.col("node") / FAN).alias("node"), F.col("open").alias("item"))
        count, level = -(-count // FAN), level + 1
        if count == 1:
            last.append(rest.select("src", F.col("open").alias("item")))
            break
    waiting = last[0] if len(last) == 1 else last[0].unionByName(last[1])
    done.append(saved(settled(waiting, seed), "mix-last"))
    out = rows.where(~free).select("src", "doc_id", "key", "size", F.lit(0).alias("up"))
    for d in done:
        out = out.unionByName(d.select("src", F.explode("done").alias("d")).select("src", "d.doc_id", "d.key", "d.size", "d.up"))
    copies = (F.col("copies") + F.col("up")).cast("long")
    return out.join(sources, "src").select("doc_id", "source", "key", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, plan: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, source, text of the mix, a row for each copy. plan: of mixed() over docs with the same seed.

    Equal rows are met once and repeated together, COPIES at most from one row of a task.
    """
    names = ("doc_id", "source", "key")
    texts = docs.select(F.col("doc_id").cast("long"), "source", "text", _key(seed).alias("key")).dropDuplicates(list(names))
    totals = plan.groupBy(*names).agg(F.sum("copies").alias("n")).where("n > 0")
    parts = totals.select(*(F.col(c).alias(f"_{c}") for c in names), "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))).alias("part"))
    on = texts["key"].eqNullSafe(F.col("_key")) & texts["doc_id"].eqNullSafe(F.col("_doc_id")) & texts["source"].eqNullSafe(F.col("_source"))
    met = texts.join(parts, on).withColumn("n", F.least(F.lit(COPIES), F.col("n") - F.col("part") * COPIES))
    return met.select("doc_id", "source", "text", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")).drop("copy")


def op12_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of the sources, weighing 1, 2, 3 in turn, takes of each document."""
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")
