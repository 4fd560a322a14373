"""Queries of turned rasters, edges, regions and colours over the driver's tables, with their DuckDB SQL.

The SQL states each result straight from its definition: a turned pixel from the sixteen around its origin, edges and regions by recursion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import colour
from gridloom.operators import regions as rg
from gridloom.operators import stencils as st
from gridloom.operators import turning as tn

from . import derived as d

PIX = """rows_ AS (SELECT CAST(floor(vec_id / 64) AS BIGINT) AS page_id, vec_id % 64 AS y, embedding FROM embeddings),
 pix AS (SELECT page_id, y, CAST(x AS BIGINT) AS x, CAST(least(greatest(floor((CAST(embedding[x + 1] AS DOUBLE) + 0.5) * 255), 0), 255) AS BIGINT) AS v
 FROM rows_, LATERAL (SELECT unnest(range(len(embedding))) AS x)), sz AS (SELECT page_id, max(y) + 1 AS h, max(x) + 1 AS w FROM pix GROUP BY page_id)"""


def _dbl(v: float) -> str:
    return f"({v!r}::DOUBLE)"


def row_sums(pixels: DataFrame) -> DataFrame:
    """page_id, y, total: sums of v * (x + 1) along rows."""
    return pixels.groupBy("page_id", "y").agg(F.sum(F.col("v") * (F.col("x") + 1)).alias("total"))


_ROW_SUMS = "SELECT page_id, y, CAST(sum(v * (x + 1)) AS BIGINT) AS total FROM {} GROUP BY page_id, y"


def _origin(c: str, s: str, x: str, y: str, half: int, centre: str = "pixel") -> tuple[str, str]:
    cx, cy = ("CAST(w // 2 AS DOUBLE)", "CAST(h // 2 AS DOUBLE)") if centre == "pixel" else ("((w - 1) / 2::DOUBLE)", "((h - 1) / 2::DOUBLE)")
    at = lambda v: f"CAST(round_even(({v}) * 1024::DOUBLE, 0) AS BIGINT)"
    return (
        f"{at(f'{c} * {x}')} + {at(f'-{s} * {y} + ({cx} - {c} * {cx} + {s} * {cy})')} + {half}",
        f"{at(f'{s} * {x}')} + {at(f'{c} * {y} + ({cy} - {s} * {cx} - {c} * {cy})')} + {half}",
    )


def _rotation(angle: float, method: str, border: str, source: str = "pix", centre: str = "pixel", whole: str = "round_even({}, 0)") -> str:
    """rot: page_id, y, x, v."""
    c, s = map(_dbl, tn.turn(angle))
    sx, sy = _origin(c, s, "x", "y", 512 if method == "nearest" else 16, centre)
    places = f"pl AS (SELECT p.page_id, y, x, h, w, {sx} AS sx, {sy} AS sy FROM {source} p JOIN sz ON sz.page_id = p.page_id)"
    if method == "nearest":
        tap = "ta AS (SELECT page_id, y, x, h, w, sy >> 10 AS ty, sx >> 10 AS tx, 1::DOUBLE AS wt FROM pl)"
    else:
        one = lambda k, f: f"CASE WHEN abs({k} - {f} / 32::DOUBLE) >= 1 THEN 0::DOUBLE ELSE 1 - abs({k} - {f} / 32::DOUBLE) END"
        if method == "cubic":
            q = lambda k, f: f"abs({k} - {f} / 32::DOUBLE)"
            one = lambda k, f: f"CASE WHEN {q(k, f)} <= 1 THEN 1.25::DOUBLE * {q(k, f)} ** 3 - 2.25::DOUBLE * {q(k, f)} ** 2 + 1 ELSE -0.75::DOUBLE * {q(k, f)} ** 3 + 3.75::DOUBLE * {q(k, f)} ** 2 - 6 * {q(k, f)} + 3 END"
        tap = f"""sp AS (SELECT page_id, y, x, h, w, sx >> 10 AS x0, (sx >> 5) & 31 AS fx, sy >> 10 AS y0, (sy >> 5) & 31 AS fy FROM pl),
 ta AS (SELECT page_id, y, x, h, w, y0 + j AS ty, x0 + i AS tx, ({one('i', 'fx')}) * ({one('j', 'fy')}) AS wt FROM sp, (SELECT unnest(range(-1, 3)) AS i), (SELECT unnest(range(-1, 3)) AS j))"""
    ty, tx = ("least(greatest(ty, 0), h - 1)", "least(greatest(tx, 0), w - 1)") if border == "replicate" else ("ty", "tx")
    return f"""{places}, {tap}, rot AS (SELECT t.page_id, t.y, t.x, CAST(least(greatest({whole.format("sum(wt * coalesce(p.v, 0))")}, 0), 255) AS BIGINT) AS v
 FROM ta t LEFT JOIN {source} p ON p.page_id = t.page_id AND p.y = {ty} AND p.x = {tx} GROUP BY t.page_id, t.y, t.x)"""


# --- angles ------------------------------------------------------------------------------------

_REACH, _STEP, _WIDTH, _FINE = 5.0, 0.5, 1.0, 0.2
_COARSE = tn.angle_list(-_REACH, _REACH, _STEP)
_LISTS = tn.fine_angles(_COARSE, _REACH, _WIDTH, _FINE)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_dbl(v) if isinstance(v, float) else str(v) for v in r) + ")" for r in rows)


def _scores(source: str, sizes: str, turns: str, axis: str, kind: str, out: str) -> str:
    """out: page_id, k, angle, score. source: page_id, y, x, v; turns: page_id, k, angle, c, s."""
    cx, cy = "CAST(w // 2 AS DOUBLE)", "CAST(h // 2 AS DOUBLE)"
    bins = "h" if axis == "y" else "CAST(ceil(sqrt(2::DOUBLE) * greatest(h, w)) AS BIGINT)"
    place = f"-s * (x - {cx}) + c * (y - {cy}) + {cy}" if axis == "y" else f"c * (x - {cx}) - s * (y - {cy}) + ({bins}) // 2"
    score = "CAST(count(*) * sum(t * t) - sum(t) * sum(t) AS DOUBLE) / CAST(count(*) * count(*) AS DOUBLE)" if kind == "variance" else "CAST(sum(CASE WHEN bin > 0 THEN d * d ELSE 0 END) AS DOUBLE)"
    return f"""{out}_b AS (SELECT p.page_id, k, CAST(floor({place} + 0.5::DOUBLE) AS BIGINT) AS bin, sum(v) AS t FROM {source} p JOIN {sizes} z ON z.page_id = p.page_id JOIN {turns} a ON a.page_id = p.page_id GROUP BY ALL),
 {out}_f AS (SELECT a.page_id, k, angle, bin FROM {turns} a JOIN {sizes} z ON z.page_id = a.page_id, LATERAL (SELECT unnest(range(0, {bins})) AS bin)),
 {out}_t AS (SELECT f.page_id, f.k, angle, f.bin, coalesce(t, 0) AS t, coalesce(t, 0) - lag(coalesce(t, 0)) OVER (PARTITION BY f.page_id, f.k ORDER BY f.bin) AS d FROM {out}_f f LEFT JOIN {out}_b b ON b.page_id = f.page_id AND b.k = f.k AND b.bin = f.bin),
 {out} AS (SELECT page_id, k, angle, {score} AS score FROM {out}_t GROUP BY page_id, k, angle)"""


def _search(axis: str, kind: str) -> str:
    """sco: page_id, pass, k, angle, score, and top_: the best of each pass."""
    rows = lambda lists: _values((c, k, a, *tn.turn(a)) for c, angles in enumerate(lists) for k, a in enumerate(angles))
    return f"""{PIX}, on_ AS (SELECT page_id, y, x, CAST(v > 127 AS BIGINT) AS v FROM pix),
 sm AS (SELECT p.page_id, y // 4 AS y, x // 4 AS x, sum(v) AS v FROM on_ p JOIN sz ON sz.page_id = p.page_id WHERE y // 4 < h // 4 AND x // 4 < w // 4 GROUP BY ALL),
 ssz AS (SELECT page_id, max(y) + 1 AS h, max(x) + 1 AS w FROM sm GROUP BY page_id),
 ca AS (SELECT page_id, a.* FROM (SELECT DISTINCT page_id FROM pix), (VALUES {_values((k, a, *tn.turn(a)) for k, a in enumerate(_COARSE))}) a(k, angle, c, s)),
 {_scores("sm", "ssz", "ca", axis, kind, "wide")},
 wtop AS (SELECT page_id, k FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, k) AS n FROM wide) WHERE n = 1),
 fa AS (SELECT page_id, a.k, angle, c, s FROM wtop JOIN (VALUES {rows(_LISTS)}) a(coarse, k, angle, c, s) ON a.coarse = wtop.k),
 {_scores("on_", "sz", "fa", axis, kind, "close_")},
 sco AS (SELECT page_id, 0 AS pass, k, angle, score FROM wide UNION ALL SELECT page_id, 1, k, angle, score FROM close_),
 top_ AS (SELECT page_id, angle FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, k) AS n FROM close_) WHERE n = 1)"""


def _binary(s, sf):
    return d.pixels(s, sf).withColumn("v", (F.col("v") > 127).cast("long"))


def _searched(axis, kind):
    return lambda s, sf: tn.search_scores(_binary(s, sf), axis, kind, _REACH, _STEP, _WIDTH, _FINE)


def _stopped(s, sf):
    small = tn.quarter(_binary(s, sf)).withColumn("turns", tn._turns(_COARSE))
    return tn.before_stop(tn.angle_scores(tn.angle_sums(small, tn.sizes_of(small), "y"), "sharpness"), 3).select("page_id", "k", "score")


def _confidence(s, sf):
    found = tn.found_angle(_searched("y", "sharpness")(s, sf))
    return found.select("page_id", "angle", "best", F.round("mean", 3).alias("mean"), F.round("deviation", 3).alias("deviation"), F.round("confidence", 6).alias("confidence"))


# --- edges -------------------------------------------------------------------------------------

_LOW, _HIGH = 0.03, 0.06


def _lines(source: str, weights: list[int], axis: str, out: str, border: str = "edge", value: str = "v") -> str:
    """out: page_id, y, x, v. The pixels of a line under weights, each place beyond the page by the border's rule."""
    half, n = len(weights) // 2, "w" if axis == "x" else "h"
    at = f"p.{axis} + k"
    back = f"greatest(least({at}, {n} - 1), 0)" if border == "edge" else f"abs(CASE WHEN {at} > {n} - 1 THEN 2 * ({n} - 1) - ({at}) ELSE {at} END)"
    other = "y" if axis == "x" else "x"
    rows = ", ".join(f"({i - half}, {k})" for i, k in enumerate(weights))
    return f"""{out}_m AS (SELECT p.page_id, p.y, p.x, {back} AS t, k.c FROM {source} p JOIN sz ON sz.page_id = p.page_id, (VALUES {rows}) k(k, c)),
 {out} AS (SELECT m.page_id, m.y, m.x, CAST(sum(c * q.{value}) AS BIGINT) AS v FROM {out}_m m JOIN {source} q ON q.page_id = m.page_id AND q.{axis} = t AND q.{other} = m.{other} GROUP BY m.page_id, m.y, m.x)"""


def _slopes(source: str, border: str) -> str:
    """slo: page_id, y, x, gx, gy."""
    return f"""{_lines(source, [-1, 0, 1], 'x', 'sdx', border)}, {_lines('sdx', [1, 2, 1], 'y', 'sgx', border)}, {_lines(source, [1, 2, 1], 'x', 'ssx', border)}, {_lines('ssx', [-1, 0, 1], 'y', 'sgy', border)},
 slo AS (SELECT a.page_id, a.y, a.x, a.v AS gx, b.v AS gy FROM sgx a JOIN sgy b ON b.page_id = a.page_id AND b.y = a.y AND b.x = a.x)"""


_UNIT = (4 * 255 * 2**16) ** 2
_G9 = st.gaussian(9, 1.0)
_CANNY = f"""{PIX}, {_lines('pix', _G9, 'y', 'ga')}, {_lines('ga', _G9, 'x', 'gb')}, {_slopes('gb', 'edge')},
 mag AS (SELECT page_id, y, x, gx * gx + gy * gy AS m, CASE WHEN abs(gy) * 32768 < abs(gx) * {st.TAN} THEN 0 WHEN abs(gx) * 32768 < abs(gy) * {st.TAN} THEN 1 WHEN (gx < 0) = (gy < 0) THEN 2 ELSE 3 END AS o FROM slo),
 sid AS (SELECT g.*, o.sy, o.sx FROM mag g JOIN (VALUES (0, 0, 1), (1, 1, 0), (2, 1, 1), (3, 1, -1)) o(o, sy, sx) ON o.o = g.o),
 thi AS (SELECT s.page_id, s.y, s.x, s.m FROM sid s LEFT JOIN mag a ON a.page_id = s.page_id AND a.y = s.y + sy AND a.x = s.x + sx LEFT JOIN mag b ON b.page_id = s.page_id AND b.y = s.y - sy AND b.x = s.x - sx
  WHERE s.m > 0 AND s.m >= coalesce(a.m, 0) AND s.m >= coalesce(b.m, 0)),
 wea AS (SELECT page_id, y, x, m >= {int(_HIGH * _HIGH * _UNIT)} AS strong FROM thi WHERE m >= {int(_LOW * _LOW * _UNIT)}),
 rea AS (SELECT page_id, y, x FROM wea WHERE strong UNION SELECT w.page_id, w.y, w.x FROM rea r JOIN wea w ON w.page_id = r.page_id AND abs(w.y - r.y) <= 1 AND abs(w.x - r.x) <= 1)"""
_BORDER = f"""{PIX}, {_slopes('pix', 'mirror')}, ste AS (SELECT page_id, y, x, CAST(CAST(gx * gx + gy * gy AS DOUBLE) > 150.0 * 150.0 AS BIGINT) AS t FROM slo),
 rws AS (SELECT s.page_id, y AS i, sum(t) AS n, h, w FROM ste s JOIN sz ON sz.page_id = s.page_id GROUP BY ALL HAVING sum(t) > 0.27::DOUBLE * w), cls AS (SELECT s.page_id, x AS i, sum(t) AS n, h, w FROM ste s JOIN sz ON sz.page_id = s.page_id GROUP BY ALL HAVING sum(t) > 0.27::DOUBLE * h)"""


def _edge_rows(s, sf):
    edges = st.canny(d.pixels(s, sf), 1.0, _LOW, _HIGH)
    return row_sums(edges.withColumn("v", F.lit(1).cast("long")))


# --- regions -----------------------------------------------------------------------------------

_DELTA, _AREA, _CHANGE = 1, (3, 40), 0.8


def _tiles(s, sf):
    """Each embedding as a small page of eight rows with some forty levels, which recursion over every level can follow."""
    side, level = 8, F.floor((F.col("c").cast("double") + 0.5) * 64)
    cells = d.table(s, sf, "embeddings").select(F.col("vec_id").cast("long").alias("page_id"), F.posexplode("embedding").alias("i", "c"))
    return cells.select("page_id", F.floor(F.col("i") / side).alias("y"), (F.col("i") % side).cast("long").alias("x"), level.alias("v"))


def _nodes(s, sf):
    tree = rg.component_tree(_tiles(s, sf), _DELTA)
    return tree.select("page_id", "level", "first", "area", "x", "y", "w", "h", F.round("growth", 9).alias("growth"))


#: Every level's regions by recursion (rgn), a region with a pixel of the level itself is a node (nod), and each lives up to the level where its first pixel's region is another.
_REGIONS = f"""px AS (SELECT vec_id AS page_id, i // 8 AS y, i % 8 AS x, i AS id, CAST(floor((CAST(embedding[i + 1] AS DOUBLE) + 0.5) * 64) AS BIGINT) AS v FROM embeddings, LATERAL (SELECT unnest(range(len(embedding))) AS i)),
 lv AS (SELECT DISTINCT page_id, v AS t FROM px), en AS (SELECT page_id, min(v) AS a, max(v) AS b FROM px GROUP BY page_id),
 ond AS (SELECT lv.page_id, t, id, y, x, v FROM lv JOIN px ON px.page_id = lv.page_id AND v <= t),
 nbr AS (SELECT a.page_id, a.t, a.id AS p, b.id AS q FROM ond a JOIN ond b ON b.page_id = a.page_id AND b.t = a.t AND ((b.id = a.id + 1 AND b.y = a.y) OR (b.id = a.id - 1 AND b.y = a.y) OR b.id = a.id + 8 OR b.id = a.id - 8)),
 rch AS (SELECT page_id, t, id AS p, id AS root FROM ond UNION SELECT n.page_id, n.t, n.q, r.root FROM rch r JOIN nbr n ON n.page_id = r.page_id AND n.t = r.t AND n.p = r.p WHERE r.root < n.q),
 lab AS (SELECT page_id, t, p, min(root) AS root FROM rch GROUP BY ALL),
 rgn AS (SELECT l.page_id, l.t, root, count(*) AS area, max(v) AS top, min(o.x) AS x, min(o.y) AS y, max(o.x) - min(o.x) + 1 AS w, max(o.y) - min(o.y) + 1 AS h FROM lab l JOIN ond o ON o.page_id = l.page_id AND o.t = l.t AND o.id = l.p GROUP BY ALL),
 nod AS (SELECT page_id, t AS level, root AS first, area, x, y, w, h FROM rgn WHERE top = t),
 als AS (SELECT en.page_id, s, (SELECT max(t) FROM lv WHERE lv.page_id = en.page_id AND t <= s) AS t FROM en, LATERAL (SELECT unnest(range(a, b + 1)) AS s)),
 liv AS (SELECT n.*, (SELECT min(r.t) FROM lab l JOIN rgn r ON r.page_id = l.page_id AND r.t = l.t AND r.root = l.root WHERE l.page_id = n.page_id AND l.p = n.first AND r.t > n.level AND r.area > n.area) AS up FROM nod n),
 at_ AS (SELECT l.*, s FROM liv l, LATERAL (SELECT unnest(range(level, coalesce(up, level + 1))) AS s)),
 abv AS (SELECT a.page_id, a.level, a.first, a.s, r.area AS above FROM at_ a JOIN en ON en.page_id = a.page_id JOIN als z ON z.page_id = a.page_id AND z.s = least(a.s + {_DELTA}, en.b)
  JOIN lab l ON l.page_id = a.page_id AND l.t = z.t AND l.p = a.first JOIN rgn r ON r.page_id = l.page_id AND r.t = l.t AND r.root = l.root),
 ins AS (SELECT a.page_id, a.level, a.first, a.s, max(r.area) AS inner_ FROM at_ a JOIN als z ON z.page_id = a.page_id AND z.s = a.s - {_DELTA} JOIN lab own ON own.page_id = a.page_id AND own.t = a.level AND own.root = a.first
  JOIN rgn r ON r.page_id = a.page_id AND r.t = z.t AND r.root = own.p GROUP BY ALL),
 gro AS (SELECT a.page_id, a.level, a.first, a.area, a.up, a.x, a.y, a.w, a.h, min((b.above - coalesce(i.inner_, 0)) / CAST(a.area AS DOUBLE)) AS growth FROM at_ a JOIN abv b ON b.page_id = a.page_id AND b.level = a.level AND b.first = a.first AND b.s = a.s
  LEFT JOIN ins i ON i.page_id = a.page_id AND i.level = a.level AND i.first = a.first AND i.s = a.s GROUP BY ALL),
 par AS (SELECT g.*, l.root AS pfirst FROM gro g LEFT JOIN lab l ON l.page_id = g.page_id AND l.t = g.up AND l.p = g.first)"""


def _stable(s, sf):
    return rg.stable_regions(_tiles(s, sf), _DELTA, _AREA, _CHANGE).withColumn("growth", F.round("growth", 9))


# --- lines at any turn -------------------------------------------------------------------------

_TOLERANCE, _TURN, _H_SIZE, _V_SIZE = 2.0, 1.0, 6, 5


def _skewed(s, sf):
    lines = tn.skewed_lines(d.packed_ink(s, sf, 127), _H_SIZE, _V_SIZE, _TOLERANCE, _TURN)
    return lines.groupBy("page_id", "orient", "y").agg(F.sum(F.col("x") + 1).alias("total"))


def _opening(orient: str, k: int) -> str:
    along, line, n = ("x", "y", "w") if orient == "h" else ("y", "x", "h")
    need = f"CASE WHEN a = 0 AND b = {n} - 1 THEN 1 WHEN a = 0 THEN {k - k // 2} WHEN b = {n} - 1 THEN {k // 2 + 1} ELSE {k} END"
    return f"""run_{orient} AS (SELECT page_id, k, {line} AS line, min({along}) AS a, max({along}) AS b FROM (SELECT *, {along} - row_number() OVER (PARTITION BY page_id, k, {line} ORDER BY {along}) AS g FROM tur) GROUP BY page_id, k, {line}, g),
 own_{orient} AS (SELECT r.page_id, k, '{orient}' AS orient, line AS {line}, unnest(range(a, b + 1)) AS {along} FROM run_{orient} r JOIN sz ON sz.page_id = r.page_id WHERE b - a + 1 >= {need})"""


def _turned_grid(source: str, sign: int, out: str, extra: str = "") -> str:
    """out: page_id, k, y, x: places of the page whose origin is set, for each angle."""
    turns = _values((k, *tn.turn(sign * a)) for k, a in enumerate(tn.angle_list(-_TOLERANCE, _TOLERANCE, _TURN)))
    sx, sy = _origin("c", "s", "p.x", "p.y", 512)
    return f"""{out}_g AS (SELECT p.page_id, k, p.y, p.x, ({sy}) >> 10 AS ty, ({sx}) >> 10 AS tx FROM pix p JOIN sz ON sz.page_id = p.page_id, (VALUES {turns}) a(k, c, s)),
 {out} AS (SELECT DISTINCT g.page_id, g.k, {extra}g.y, g.x FROM {out}_g g JOIN {source} q ON q.page_id = g.page_id AND q.k = g.k AND q.y = ty AND q.x = tx)"""


_SKEWED = f"""{PIX}, on_ AS (SELECT page_id, y, x, unnest(range(0, {len(tn.angle_list(-_TOLERANCE, _TOLERANCE, _TURN))})) AS k FROM pix WHERE v > 127),
 {_turned_grid('on_', 1, 'tur')}, {_opening('h', _H_SIZE)}, {_opening('v', _V_SIZE)}, own AS (SELECT page_id, k, orient, y, x FROM own_h UNION ALL SELECT page_id, k, orient, y, x FROM own_v),
 {_turned_grid('own', -1, 'bck', 'q.orient, ')}, uni AS (SELECT DISTINCT page_id, orient, y, x FROM bck),
 dil AS (SELECT DISTINCT p.page_id, u.orient, p.y, p.x FROM pix p JOIN uni u ON u.page_id = p.page_id AND abs(u.y - p.y) <= 1 AND abs(u.x - p.x) <= 1),
 clo AS (SELECT a.page_id, a.orient, a.y, a.x FROM dil a WHERE NOT EXISTS (SELECT 1 FROM pix n WHERE n.page_id = a.page_id AND abs(n.y - a.y) <= 1 AND abs(n.x - a.x) <= 1 AND NOT EXISTS (SELECT 1 FROM dil b WHERE b.page_id = n.page_id AND b.orient = a.orient AND b.y = n.y AND b.x = n.x)))"""

# --- colours -----------------------------------------------------------------------------------


def _coloured(s, sf):
    """The small pages in colour: green and red are the values some places further on."""
    at = lambda k: F.element_at("v", (F.pmod(F.col("i") + k, F.size("v")) + 1).cast("int"))
    level = F.transform("embedding", lambda c: F.least(F.greatest(F.floor((c.cast("double") + 0.5) * 255), F.lit(0)), F.lit(255)))
    cells = d.table(s, sf, "embeddings").select(F.col("vec_id").cast("long").alias("page_id"), level.alias("v")).select("page_id", "v", F.explode(F.sequence(F.lit(0), F.size("v") - 1)).alias("i"))
    return cells.select("page_id", F.floor(F.col("i") / 8).alias("y"), (F.col("i") % 8).cast("long").alias("x"), *(at(k).alias(c) for c, k in (("b", 0), ("g", 7), ("r", 13))))


def _colours(s, sf):
    hue, sat = colour.hue_saturation(F.col("b"), F.col("g"), F.col("r"))
    return _coloured(s, sf).select("page_id", "y", "x", hue.alias("hue"), sat.alias("sat"), colour.grey(F.col("b"), F.col("g"), F.col("r")).alias("grey"))


def _box_colours(s, sf):
    i, k = F.col("vec_id"), F.col("k")
    boxes = d.table(s, sf, "embeddings").select(i.cast("long").alias("page_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("k"), "vec_id")
    boxes = boxes.select("page_id", k.alias("box_id"), *(v.cast("long").alias(n) for n, v in (("x", (i + k) % 4), ("y", (i + 2 * k) % 3), ("w", 2 + (i + k) % 5), ("h", 1 + (i + k) % 4))))
    found = colour.box_colours(_coloured(s, sf), boxes, 128)
    return found.select("page_id", "box_id", *(F.round(c, 9).alias(c) for c in ("dark", "sat", "hue")))


_COLOURS = """lvl AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(least(greatest(floor((CAST(c AS DOUBLE) + 0.5) * 255), 0), 255) AS BIGINT)) AS v FROM embeddings),
 bgr AS (SELECT CAST(vec_id AS BIGINT) AS page_id, i // 8 AS y, i % 8 AS x, v[i + 1] AS b, v[(i + 7) % len(v) + 1] AS g, v[(i + 13) % len(v) + 1] AS r FROM lvl, LATERAL (SELECT unnest(range(len(v))) AS i)),
 hsd AS (SELECT *, greatest(b, g, r) AS mx, greatest(b, g, r) - least(b, g, r) AS d FROM bgr),
 hst AS (SELECT *, CASE WHEN mx = r THEN g - b WHEN mx = g THEN b - r + 2 * d ELSE r - g + 4 * d END AS t, CASE WHEN d > 0 THEN CAST(round_even(122880::DOUBLE / d, 0) AS BIGINT) ELSE 0 END AS hd, CASE WHEN mx > 0 THEN CAST(round_even(1044480::DOUBLE / mx, 0) AS BIGINT) ELSE 0 END AS sd FROM hsd),
 hsv AS (SELECT page_id, y, x, CASE WHEN CAST(floor((t * hd + 2048) / 4096::DOUBLE) AS BIGINT) < 0 THEN CAST(floor((t * hd + 2048) / 4096::DOUBLE) AS BIGINT) + 180 ELSE CAST(floor((t * hd + 2048) / 4096::DOUBLE) AS BIGINT) END AS hue,
  (d * sd + 2048) >> 12 AS sat, (b * 1868 + g * 9617 + r * 4899 + 8192) >> 14 AS grey FROM hst)"""

QUERIES = {
    "pixel_colours": _colours,
    "box_colours": _box_colours,
    "skewed_lines": _skewed,
    "component_tree": _nodes,
    "stable_regions": _stable,
    "canny_edges": _edge_rows,
    "gradient_border": lambda s, sf: st.border_bounds(d.pixels(s, sf), 12, 150.0, 0.27, 2),
    "rotate": lambda s, sf: row_sums(tn.rotated(d.pixels(s, sf), 1.5)),
    "rotate_linear": lambda s, sf: row_sums(tn.rotated(d.pixels(s, sf), -3.2, "linear", "zero")),
    "rotate_truncated": lambda s, sf: row_sums(tn.rotated(d.pixels(s, sf), -2.4, "linear", "replicate", "middle", True)),
    "rotate_nearest": lambda s, sf: row_sums(tn.rotated(d.pixels(s, sf), 2.0, "nearest", "zero")),
    "radon_scores": _searched("x", "variance"),
    "projection_scores": _searched("y", "sharpness"),
    "coarse_until_stop": _stopped,
    "deskew_confidence": _confidence,
}

_STOP = f"""{_search("y", "sharpness")}, fl AS (SELECT *, CASE WHEN score <= lag(score) OVER (PARTITION BY page_id ORDER BY k) THEN 1 ELSE 0 END AS f FROM wide),
 ed AS (SELECT *, CASE WHEN f = 1 AND lag(f) OVER (PARTITION BY page_id ORDER BY k) = 1 THEN k END AS e FROM fl), st AS (SELECT page_id, min(e) AS e FROM ed GROUP BY page_id)"""
SQL = {
    "pixel_colours": f"WITH {_COLOURS} SELECT * FROM hsv",
    "box_colours": f"""WITH {_COLOURS}, bx AS (SELECT CAST(vec_id AS BIGINT) AS page_id, k AS box_id, (vec_id + k) % 4 AS x, (vec_id + 2 * k) % 3 AS y, 2 + (vec_id + k) % 5 AS w, 1 + (vec_id + k) % 4 AS h FROM embeddings, (SELECT unnest(range(0, 3)) AS k))
 SELECT b.page_id, box_id, round(avg(CASE WHEN grey < 128 THEN 1.0::DOUBLE ELSE 0 END), 9) AS dark, round(avg(sat), 9) AS sat, round(avg(hue), 9) AS hue FROM bx b JOIN hsv p ON p.page_id = b.page_id AND p.x >= b.x AND p.x < b.x + w AND p.y >= b.y AND p.y < b.y + h GROUP BY b.page_id, box_id""",
    "skewed_lines": f"WITH {_SKEWED} SELECT page_id, orient, y, CAST(sum(x + 1) AS BIGINT) AS total FROM clo GROUP BY page_id, orient, y",
    "component_tree": f"WITH RECURSIVE {_REGIONS} SELECT page_id, level, first, area, x, y, w, h, round(growth, 9) AS growth FROM gro",
    "stable_regions": f"""WITH RECURSIVE {_REGIONS}, kid AS (SELECT page_id, up AS level, pfirst AS first, min(growth) AS g FROM par WHERE up IS NOT NULL GROUP BY ALL)
 SELECT p.page_id, p.level, p.area, p.x, p.y, p.w, p.h, round(p.growth, 9) AS growth FROM par p LEFT JOIN gro q ON q.page_id = p.page_id AND q.level = p.up AND q.first = p.pfirst LEFT JOIN kid k ON k.page_id = p.page_id AND k.level = p.level AND k.first = p.first
 WHERE p.area BETWEEN {_AREA[0]} AND {_AREA[1]} AND p.growth <= {_CHANGE} AND (q.growth IS NULL OR p.growth <= q.growth) AND (k.g IS NULL OR p.growth <= k.g)""",
    "canny_edges": f"WITH RECURSIVE {_CANNY}, one AS (SELECT *, 1 AS v FROM rea) {_ROW_SUMS.format('one')}",
    "gradient_border": f"""WITH {_BORDER} SELECT page_id, coalesce((SELECT min(i) FROM cls WHERE cls.page_id = sz.page_id AND i < 12) + 2, 0) AS "left", coalesce((SELECT min(i) FROM rws WHERE rws.page_id = sz.page_id AND i < 12) + 2, 0) AS top,
 coalesce((SELECT max(i) FROM cls WHERE cls.page_id = sz.page_id AND i >= w - 12) - 2, w - 1) AS "right", coalesce((SELECT max(i) FROM rws WHERE rws.page_id = sz.page_id AND i >= h - 12) - 2, h - 1) AS bottom FROM sz""",
    "rotate": f"WITH {PIX}, {_rotation(1.5, 'cubic', 'replicate')} {_ROW_SUMS.format('rot')}",
    "rotate_linear": f"WITH {PIX}, {_rotation(-3.2, 'linear', 'zero')} {_ROW_SUMS.format('rot')}",
    "rotate_truncated": f"WITH {PIX}, {_rotation(-2.4, 'linear', 'replicate', centre='middle', whole='floor({})')} {_ROW_SUMS.format('rot')}",
    "rotate_nearest": f"WITH {PIX}, {_rotation(2.0, 'nearest', 'zero')} {_ROW_SUMS.format('rot')}",
    "radon_scores": f"WITH {_search('x', 'variance')} SELECT * FROM sco",
    "projection_scores": f"WITH {_search('y', 'sharpness')} SELECT * FROM sco",
    "coarse_until_stop": f"WITH {_STOP} SELECT ed.page_id, k, score FROM ed JOIN st ON st.page_id = ed.page_id WHERE st.e IS NULL OR k <= st.e",
    "deskew_confidence": f"""WITH {_search('y', 'sharpness')}, dv AS (SELECT page_id, max(score) AS best, avg(score) AS mean, sqrt(greatest(sum(score * score) / count(*) - avg(score) * avg(score), 0)) AS deviation FROM sco GROUP BY page_id)
 SELECT t.page_id, angle, best, round(mean, 3) AS mean, round(deviation, 3) AS deviation, round(least(1, best / (mean + deviation + 1e-6::DOUBLE)), 6) AS confidence FROM top_ t JOIN dv ON dv.page_id = t.page_id""",
}
