"""Line segments: filtering, clustering and merging. Columns: page_id, orient ('h' or 'v'), seq, pos, s, e.

pos is the coordinate across the line, s and e its span. Clusterings whose outcome depends on the order
of the lines are folds over one page's lines of one orientation, a number that a page bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("page_id", "orient")


def component_filter(segments: DataFrame, page_h: Column, page_w: Column, min_ratio: float, min_aspect: float) -> DataFrame:
    """Components (x, y, w, h, orient) that are long and thin enough for their orientation."""
    vertical = F.col("orient") == "v"
    long = F.when(vertical, F.col("h") >= min_ratio * page_h).otherwise(F.col("w") >= min_ratio * page_w)
    aspect = F.when(vertical, F.col("h") / F.greatest("w", F.lit(1))).otherwise(F.col("w") / F.greatest("h", F.lit(1)))
    return segments.where(long & (aspect >= min_aspect)).withColumn("score", aspect)


def filter_long(lines: DataFrame, width: float, height: float, max_h_ratio: float = 1.0, max_v_ratio: float = 1.0) -> DataFrame:
    """Drops lines longer than a share of the page; a ratio of 1 or more keeps all."""
    length = F.col("e") - F.col("s")
    keep = F.lit(True)
    if max_h_ratio < 1:
        keep = keep & ((F.col("orient") != "h") | (length <= max_h_ratio * width))
    if max_v_ratio < 1:
        keep = keep & ((F.col("orient") != "v") | (length <= max_v_ratio * height))
    return lines.where(keep)


def filter_relative(lines: DataFrame, ratio: float) -> DataFrame:
    """Keeps lines of at least `ratio` of the longest of their page and orientation."""
    longest = F.max(F.col("e") - F.col("s")).over(Window.partitionBy(*KEY))
    return lines.withColumn("_most", longest).where((F.col("e") - F.col("s")) >= F.lit(ratio) * F.col("_most")).drop("_most")


def cluster_positions(lines: DataFrame, eps: int = 10) -> DataFrame:
    """page_id, orient, idx (from 0), center, n: positions chained while the gap to the one before is at most eps.

    A null position is a cluster of its own, after all others. Equal positions are one cluster in any order.
    """
    w = Window.partitionBy(*KEY).orderBy(F.asc_nulls_last("pos"))
    new = F.when(F.col("pos") - F.lag("pos").over(w) <= eps, 0).otherwise(1)
    grouped = lines.select(*KEY, "pos", new.alias("new")).withColumn("g", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = grouped.groupBy(*KEY, "g").agg(F.floor(F.avg("pos")).alias("center"), F.count("*").alias("n"))
    return out.select(*KEY, (F.col("g") - 1).cast("long").alias("idx"), "center", "n")


def _ordered(lines: DataFrame, *columns: str) -> DataFrame:
    return lines.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("lines"))


def merge_close(lines: DataFrame, distance: float = 45) -> DataFrame:
    """Merges parallel lines whose position is within `distance` of the running mean of the group before it.

    page_id, orient, idx, pos, s, e, n; a distance of 0 or less returns the lines as they are.
    """
    if distance <= 0:
        w = Window.partitionBy(*KEY).orderBy("pos", "s", "e")
        return lines.select(*KEY, (F.row_number().over(w) - 1).cast("long").alias("idx"), "pos", "s", "e", F.lit(1).cast("long").alias("n"))
    folded = _ordered(lines, "pos", "s", "e").select(*KEY, F.posexplode(merged_close(F.col("lines"), distance)).alias("idx", "g"))
    return folded.select(*KEY, F.col("idx").cast("long").alias("idx"), "g.*")


def merged_close(ordered: Column, distance: float) -> Column:
    """merge_close() of one page's lines of one orientation, an array of structs pos, s, e in order, by a distance over 0."""
    entry = lambda total, n, s, e: F.struct(total.alias("total"), n.alias("n"), s.alias("s"), e.alias("e"))

    def step(done: Column, line: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        near = (F.size(done) > 0) & (F.abs(line["pos"] - F.try_divide(last["total"], last["n"])) <= distance)
        grown = entry(last["total"] + line["pos"], last["n"] + 1, F.least(last["s"], line["s"]), F.greatest(last["e"], line["e"]))
        alone = entry(line["pos"], F.lit(1).cast("long"), line["s"], line["e"])
        return F.when(near, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(alone)))

    empty = F.array().cast("array<struct<total:bigint,n:bigint,s:bigint,e:bigint>>")
    return F.transform(F.aggregate(ordered, empty, step), lambda g: F.struct(F.floor(g["total"] / g["n"]).alias("pos"), g["s"].alias("s"), g["e"].alias("e"), g["n"].alias("n")))


def align_clusters(lines: DataFrame, threshold: float = 3) -> DataFrame:
    """Joins each segment, by ascending position, to the first cluster whose weighted mean position is near.

    lines: also score (long, positive). A cluster's position is the score-weighted mean of its members and moves with
    each. page_id, orient, idx, pos, s, e, n.
    """
    folded = _ordered(lines, "pos", "seq", "s", "e", "score").select(*KEY, F.posexplode(aligned(F.col("lines"), threshold)).alias("idx", "g"))
    return folded.select(*KEY, F.col("idx").cast("long").alias("idx"), "g.*")


def aligned(ordered: Column, threshold: float) -> Column:
    """align_clusters() of one page's lines of one orientation, an array of structs pos, seq, s, e, score in order."""
    def step(done: Column, line: Column) -> Column:
        at = F.array_position(F.transform(done, lambda c: F.abs(line["pos"] - c["sw"] / c["w"]) <= threshold), F.lit(True))
        member = F.struct(
            (line["pos"] * line["score"]).alias("sw"), line["score"].alias("w"), line["s"].alias("s"), line["e"].alias("e"), F.lit(1).cast("long").alias("n")
        )

        def grown(c: Column, i: Column) -> Column:
            more = F.struct(
                (c["sw"] + line["pos"] * line["score"]).alias("sw"), (c["w"] + line["score"]).alias("w"),
                F.least(c["s"], line["s"]).alias("s"), F.greatest(c["e"], line["e"]).alias("e"), (c["n"] + 1).alias("n"),
            )
            return F.when(i + 1 == at, more).otherwise(c)

        return F.when(at > 0, F.transform(done, grown)).otherwise(F.concat(done, F.array(member)))

    empty = F.array().cast("array<struct<sw:bigint,w:bigint,s:bigint,e:bigint,n:bigint>>")
    return F.transform(F.aggregate(ordered, empty, step), lambda g: F.struct(F.floor(g["sw"] / g["w"]).alias("pos"), g["s"].alias("s"), g["e"].alias("e"), g["n"].alias("n")))


def of_page(segments: Column, orient: str, align: float, relative: float, most: Column | None, close: float) -> Column:
    """The lines of one orientation, structs orient, idx, pos, s, e, n, that an array of a page's segments (orient, seq, pos, s, e, score) makes.

    align_clusters(), filter_relative(), filter_long() (most: the greatest length) and merge_close() one after the other, in the page's row.
    """
    length = lambda x: x["e"] - x["s"]
    own = F.transform(F.filter(segments, lambda x: x["orient"] == orient), lambda x: F.struct(*(x[c].alias(c) for c in ("pos", "seq", "s", "e", "score"))))

    def long(found: Column) -> Column:
        longest = F.array_max(F.transform(found, length))
        return bound(longest, lambda top: F.filter(found, lambda x: (length(x) >= F.lit(relative) * top) & (F.lit(True) if most is None else length(x) <= most)))

    kept = F.sort_array(F.transform(bound(aligned(F.sort_array(own), align), long), lambda x: F.struct(*(x[c].alias(c) for c in ("pos", "s", "e")))))
    alone = lambda: F.transform(kept, lambda x: F.struct(x["pos"].alias("pos"), x["s"].alias("s"), x["e"].alias("e"), F.lit(1).cast("long").alias("n")))
    merged = merged_close(kept, close) if close > 0 else alone()
    return F.transform(merged, lambda x, i: F.struct(F.lit(orient).alias("orient"), i.cast("long").alias("idx"), *(x[c].alias(c) for c in ("pos", "s", "e", "n"))))


def centers(positions: Column, eps: int = 10) -> Column:
    """The centers that cluster_positions() gives of an array of positions, in order."""
    def step(done: Column, pos: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        entry = lambda total, n: F.array(F.struct(total.alias("total"), n.alias("n"), pos.alias("last")))
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), entry(last["total"] + pos, last["n"] + 1))
        return F.when((F.size(done) > 0) & (pos - last["last"] <= eps), grown).otherwise(F.concat(done, entry(pos, F.lit(1).cast("long"))))

    empty = F.array().cast("array<struct<total:bigint,n:bigint,last:bigint>>")
    return F.transform(F.aggregate(F.sort_array(positions), empty, step), lambda g: F.floor(g["total"] / g["n"]))


def bound(value: Column, f) -> Column:
    """f(value), for which value is computed once, however often f or its functions on arrays look at it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _anchored(lines: DataFrame, tol: int) -> DataFrame:
    """Each page's lines in input order (seq), the anchors they make, and each line's rank among these."""
    def step(acc: Column, line: Column) -> Column:
        at = F.array_position(F.transform(acc["anchors"], lambda a: F.abs(a - line["pos"]) <= tol), F.lit(True))
        known = at > 0
        anchors = F.when(known, acc["anchors"]).otherwise(F.concat(acc["anchors"], F.array(line["pos"])))
        rank = F.when(known, at - 1).otherwise(F.size(acc["anchors"]).cast("long"))
        return F.struct(anchors.alias("anchors"), F.concat(acc["ranks"], F.array(rank)).alias("ranks"))

    none = F.array().cast("array<bigint>")
    return _ordered(lines, "seq", "pos", "s", "e").select(*KEY, "lines", F.aggregate("lines", F.struct(none.alias("anchors"), none.alias("ranks")), step).alias("f"))


def anchor_lines(lines: DataFrame, tol: int = 15) -> DataFrame:
    """page_id, orient, rank, anchor, s, e: each line in input order (seq) under the first anchor within tol.

    A line without one becomes an anchor, which never moves; rank is the anchor's place among them.
    """
    each = _anchored(lines, tol).select(*KEY, F.posexplode("lines").alias("i", "l"), "f").select(*KEY, F.get("f.ranks", F.col("i")).alias("rank"), "l", "f")
    return each.select(*KEY, "rank", F.get("f.anchors", F.col("rank").cast("int")).alias("anchor"), F.least("l.s", "l.e").alias("s"), F.greatest("l.s", "l.e").alias("e"))


def anchor_sets(lines: DataFrame, tol: int = 15) -> DataFrame:
    """page_id, orient, anchors: array of anchor and the spans of its lines, in the order of rank."""
    def spans(rank: Column) -> Column:
        own = F.filter("lines", lambda _, i: F.get("f.ranks", i) == rank)
        return F.transform(own, lambda x: F.struct(F.least(x["s"], x["e"]).alias("s"), F.greatest(x["s"], x["e"]).alias("e")))

    sets = F.transform("f.anchors", lambda a, i: F.struct(a.alias("anchor"), spans(i.cast("long")).alias("spans")))
    return _anchored(lines, tol).select(*KEY, sets.alias("anchors"))


def analysis(segments: DataFrame, clustered: DataFrame, kept: DataFrame) -> DataFrame:
    """page_id, segments, h_clusters, v_clusters, h_lines, v_lines, avg_h_length, avg_v_length (0 without lines): what line detection did to a page.

    segments: before merging; clustered: after it (also pos); kept: after all filters. A page that has lost all its lines still has a row.
    """
    of = lambda o, c: F.when(F.col("orient") == o, c)
    before = segments.groupBy("page_id").agg(F.count("*").alias("segments"))
    merged = clustered.groupBy("page_id").agg(*(F.count_distinct(of(o, F.col("pos"))).alias(f"{o}_clusters") for o in "hv"))
    length = F.col("e") - F.col("s")
    after = kept.groupBy("page_id").agg(*(F.count(of(o, F.lit(1))).alias(f"{o}_lines") for o in "hv"), *(F.avg(of(o, length)).alias(f"avg_{o}_length") for o in "hv"))
    both = before.join(merged, "page_id", "left").join(after, "page_id", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("h_clusters", "v_clusters", "h_lines", "v_lines")]
    return both.select("page_id", "segments", *counts, *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("avg_h_length", "avg_v_length")))
