"""Both stages as plans: pages to cropped tables, tables to column strips.

A page brings its lines and tags along in its row until it is cut or whitened; what is found beyond that meets it by page_id. Each
stage returns a dict of DataFrames; nothing runs before one of them is used, and failures stay values of their rows.
"""

from __future__ import annotations

import dataclasses
import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridloom.config import Deskew, Lines, Preparation, Stage1, Stage2, Tags
from gridloom.operators import grid, lines, pages, recover, strips, tags
from gridloom.sources import images as sinks


def upright(images: DataFrame, c: Deskew) -> DataFrame:
    options = dataclasses.asdict(c)
    return pages.deskew(images, **options) if options.pop("enabled") else images


def with_lines(images: DataFrame, c: Lines, data: bool = True) -> DataFrame:
    """Pages (with data=False, their rows alone) with their lines: an array of structs orient, idx, pos, s, e, n."""
    found = pages.with_line_segments(images, c.threshold, c.h_size, c.v_size, c.h_min, c.v_min, c.min_aspect, c.skew, c.skew_step, c.region, preparation(c.prepare), data=data)
    most = lambda ratio, side: ratio * F.col(side) if ratio < 1 else None
    h = lines.of_page(F.col("found"), "h", c.alignment, c.h_relative, most(c.max_h, "width"), c.close_distance)
    v = lines.of_page(F.col("found"), "v", c.alignment, c.v_relative, most(c.max_v, "height"), c.close_distance)
    return found.withColumn("lines", F.concat(h, v)).drop("found")


def lines_of(images: DataFrame) -> DataFrame:
    """page_id, orient, idx, pos, s, e, n, width, height of the lines that pages bring along."""
    each = images.select("page_id", F.inline("lines"), F.col("width").cast("long").alias("width"), F.col("height").cast("long").alias("height"))
    return each.select("page_id", "orient", "idx", "pos", "s", "e", "n", "width", "height")


def detect_lines(images: DataFrame, c: Lines) -> DataFrame:
    """page_id, orient, idx, pos, s, e, n, width, height of the lines of each page."""
    return lines_of(with_lines(images, c, data=False))


def crop_to_grid(images: DataFrame, eps: int, padding: int) -> DataFrame:
    """Pages that bring their lines along, cut to what grid.crop_bounds() gives of their axes; no page is dealt. The box of cells is that of their axes."""
    of = lambda o: lines.centers(F.transform(F.filter("lines", lambda x: x["orient"] == o), lambda x: x["pos"]), eps)
    at = images.withColumn("_at", F.when(F.size("lines") > 0, F.struct(of("v").alias("x"), of("h").alias("y"))))
    low = lambda k: F.when(F.col("_at").isNotNull(), F.greatest(F.coalesce(F.array_min(f"_at.{k}"), F.lit(0)) - padding, F.lit(0)))
    high = lambda k, side: F.when(F.col("_at").isNotNull(), F.least(F.coalesce(F.array_max(f"_at.{k}") + padding, F.col(side)), F.col(side)))
    return pages.crop_listed(at.withColumns({"x1": low("x"), "y1": low("y"), "x2": high("x", "width"), "y2": high("y", "height")}).drop("_at", "lines"))


def preparation(c: Preparation | None) -> dict | None:
    """Options of the line detection's binary page."""
    if c is None:
        return None
    strokes = {"size": c.stroke_size, "iterations": c.stroke_iterations, "shape": c.stroke_shape} if c.strokes else None
    return {"method": c.method, "level": c.level, "block": c.block, "c": c.c, "invert": c.invert, "denoise": c.denoise, "strokes": strokes}


def chosen_tags(found: Column, c: Tags) -> Column:
    """Of one page's candidates (pages.tag_candidates(), an array) those that are tags: structs box_id, x, y, w, h in the page's frame, dark, glyphs."""

    def candidate(b: Column) -> Column:
        share = lambda side, ratio: F.floor(b[side] * ratio)
        wide = (share("page_width", c.min_width), share("page_width", c.max_width))
        tall = (share("page_height", c.min_height), share("page_height", c.max_height))
        return tags.candidate_reason(b["band_width"], b["band_height"], wide, (c.min_aspect, c.max_aspect), c.min_dark, c.reject_red, tall, b).isNull()

    kept = tags.apart(F.filter(found, candidate), c.iou, {"dark": "double", "glyphs": "bigint", "band_top": "bigint"})
    scored = F.filter(kept, lambda b: tags.tag_score(b["dark"], b["glyphs"], b["w"], b["h"]) >= c.min_score)
    by_row = {"median": tags.near_median, "theilsen": tags.near_theil_sen}.get(c.rows.lower())
    scored = by_row(scored) if by_row else scored
    return F.transform(scored, lambda b: F.struct(b["box_id"].alias("box_id"), b["x"].alias("x"), (b["y"] + b["band_top"]).alias("y"), b["w"].alias("w"), b["h"].alias("h"), b["dark"].alias("dark"), b["glyphs"].alias("glyphs")))


def find_tags(images: DataFrame, c: Tags) -> DataFrame:
    """page_id, box_id, x, y, w, h in the page's frame, dark, glyphs of the tags that the auto method finds."""
    found = pages.with_tag_candidates(images, c.band_top, c.band_bottom, c.glyph_kernel, data=False).select("page_id", "found")
    return found.select("page_id", F.inline(chosen_tags(F.col("found"), c)))


def remove_tags(images: DataFrame, c: Tags) -> DataFrame:
    """Pages with their generation tags whitened. A page brings its boxes along, so that it is neither made twice nor dealt."""
    if c.method == "classic":
        regions = {"dark": c.dark, "least": c.row_dark, "kernel": c.kernel, "iterations": c.iterations}
        return pages.remove_tags_classic(images, **regions, min_area=c.min_area, max_area=c.max_area, min_aspect=c.classic_min_aspect, max_aspect=c.classic_max_aspect, min_dark=c.dark_share)
    found = pages.with_tag_candidates(images, c.band_top, c.band_bottom, c.glyph_kernel)
    whole = found.withColumn("boxes", chosen_tags(F.col("found"), c)).drop("found")
    return pages.white_listed(whole, {"pad": c.pad, "close": c.mask_close, "open_": c.mask_open, "grow": c.mask_grow})


def margin_options(c: Stage1) -> dict:
    """Options of the margin's method."""
    if c.margin_method == "gradient":
        return {"strong": c.margin_strong}
    own = {"blur": c.margin_blur, "close": c.margin_close}
    return own if c.margin_method == "keep_borders" else own | {"close_iter": c.margin_close_iter, "erode_after": c.margin_erode}


class Outputs(dict):
    """A stage's DataFrames by name. What several of them share (upright pages, their lines) is computed once and kept
    until release(), on disk where memory lacks."""

    def __init__(self):
        super().__init__()
        self.held: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self.held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self.held[-1]

    def release(self) -> None:
        """Frees what the outputs share; they can still be used, and compute it again."""
        while self.held:
            self.held.pop().unpersist()


def stage1(images: DataFrame, c: Stage1 | None = None, keep: bool = True) -> Outputs:
    """pages, lines, axes, cells, structure, bounds, tables (cropped pages) of page scans. Nothing is kept if keep is false: where tables alone are used, each page is needed once."""
    c, out = c or Stage1(), Outputs()
    p = images
    if c.marks:
        p = pages.remove_marks(p, c.dilate_iter, c.kernel_size, c.protect)
    if c.margin:
        p = pages.remove_margin(p, c.margin_method, **margin_options(c))
    p = upright(p, c.deskew)
    if c.split:
        p = pages.split_pages(p, c.search_ratio, c.line_len_frac, c.line_thick, c.peak)
    else:
        p = p.withColumn("page_id", F.concat("page_id", F.lit("_full")))
    if c.tags:
        p = remove_tags(p, c.tag)
    hold = out.keep if keep else lambda df: df
    lined = hold(with_lines(p, c.lines))
    p, found = lined.drop("lines"), hold(lines_of(lined))
    axis = grid.axes(found, c.eps)
    cells = grid.cells(axis)
    sizes = p.select("page_id", F.col("width").cast("long").alias("w"), F.col("height").cast("long").alias("h"))
    box = grid.crop_bounds(cells, axis, 1 << 30, 1 << 30, c.padding).join(sizes, "page_id")
    box = box.select("page_id", "x1", "y1", F.least("x2", "w").alias("x2"), F.least("y2", "h").alias("y2"))
    out |= {"pages": p, "lines": found, "axes": axis, "cells": cells, "structure": grid.structure(axis), "bounds": box, "tables": crop_to_grid(lined, c.eps, c.padding) if c.crop else p}
    return out


def stage2(tables: DataFrame, c: Stage2 | None = None) -> Outputs:
    """tables, lines, axes, cells, merged, bounds, strips (column images) of cropped tables."""
    c, out = c or Stage2(), Outputs()
    lined = out.keep(with_lines(upright(tables, c.deskew), c.lines))
    p, found = lined.drop("lines"), out.keep(lines_of(lined))
    axis = grid.axes(found, c.eps)
    cells = grid.cells(axis)
    spans = found.select("page_id", "orient", F.col("idx").alias("seq"), "pos", "s", "e")
    merged = recover.merged_grid(axis, spans, ratio=c.coverage)
    sides = recover.all_boundaries(merged)
    widths = p.where("data is not null").select("page_id", F.col("width").cast("long").alias("width"))
    at = strips.rescaled(strips.strip_positions(sides, c.longest_only, c.min_length_ratio), widths)
    bounds = strips.strip_bounds(at, c.padding_left, c.padding_right, c.min_width)
    cut = pages.cut_strips(p, bounds)
    if not c.cut:
        cut = cut.where("false")
    if c.binarize:
        b = c.binary
        cut = pages.strengthen(cut, b.stroke_size, b.stroke_iterations, b.stroke_shape) if b.strokes else cut
        cut = pages.binarize(cut, b.method, level=b.level, block=b.block, c=b.c, invert=b.invert, denoise=b.denoise)
    if c.final_deskew:
        cut = upright(cut, c.final)
    out |= {"tables": p, "lines": found, "axes": axis, "cells": cells, "merged": merged, "bounds": bounds, "strips": cut}
    return out


def run(images: DataFrame, one: Stage1 | None = None, two: Stage2 | None = None, keep_first: bool = True) -> Outputs:
    """Both stages in one plan, without a hop over files between them. keep_first: whether stage 1 keeps what its outputs share (see there)."""
    first, out = stage1(images, one, keep_first), Outputs()
    second = stage2(first["tables"], two)
    out |= {f"stage1_{k}": v for k, v in first.items()} | {f"stage2_{k}": v for k, v in second.items()}
    out.held = first.held + second.held
    return out


def observed(images: DataFrame) -> tuple[DataFrame, Observation]:
    """images, and counts (pages, failed) that the first job over them gathers on its way."""
    seen = Observation()
    return images.observe(seen, F.count(F.lit(1)).alias("pages"), F.count(F.when(F.col("error").isNotNull() | F.col("data").isNull(), 1)).alias("failed")), seen


def write_with_info(images: DataFrame, path: str, stage: str, source: str) -> DataFrame:
    """Writes images as Parquet under path and, beside them, their run's info as JSON; returns that one row.

    stage, source, started, pages, failed, status: counted in the write itself, without another pass.
    """
    started = datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
    seen, counts = observed(images)
    seen.write.mode("overwrite").parquet(f"{path}/pages")
    got = counts.get
    status = "failed" if got["pages"] and got["failed"] == got["pages"] else "partial" if got["failed"] else "completed"
    row = (stage, source, started, got["pages"], got["failed"], status)
    info = images.sparkSession.createDataFrame([row], "stage string, source string, started string, pages long, failed long, status string")
    info.coalesce(1).write.mode("overwrite").json(f"{path}/run_info")
    return info


def report(images: DataFrame) -> DataFrame:
    """How many pages succeeded and failed, and the reasons."""
    return images.groupBy(F.coalesce("error", F.lit("ok")).alias("status")).agg(F.count("*").alias("pages"))


#: What save() writes of a stage's outputs: images as PNG files, the rest as JSON or Parquet, each in a folder of its own.
_IMAGES = ("pages", "tables", "strips")


def save(out: Outputs, path: str, debug: bool = False) -> dict[str, str]:
    """Writes a stage's outputs below a folder that all executors share; returns the folder of each.

    Images become <name>/<page_id>.png, lines, structure and merged cells <name>_json with a JSON text for each page, bounds Parquet. With
    debug, also debug/lines and debug/cells: the pages with what was found drawn over them. run()'s outputs go to stage1/ and stage2/.
    """
    stages_ = sorted({k.split("_", 1)[0] for k in out if k.startswith(("stage1_", "stage2_"))})
    if stages_:
        made = {}
        for s in stages_:
            part = Outputs()
            part |= {k.removeprefix(f"{s}_"): v for k, v in out.items() if k.startswith(f"{s}_")}
            made |= {f"{s}_{k}": v for k, v in save(part, f"{path}/{s}", debug).items()}
        return made
    made = {}

    def put(name: str, write) -> None:
        made[name] = f"{path}/{name}"
        write(made[name])

    for name in _IMAGES:
        if name in out:
            put(name, lambda to, name=name: sinks.write_png(out[name], to))
    texts = {"lines_json": ("lines",), "structure_json": ("structure", "cells"), "recovered_json": ("merged",)}
    for name, needs in texts.items():
        if all(n in out for n in needs):
            rows = getattr(sinks, name)(*(out[n] for n in needs))
            put(name, lambda to, rows=rows: rows.write.mode("overwrite").json(to))
    if "bounds" in out:
        put("bounds", lambda to: out["bounds"].write.mode("overwrite").parquet(to))
    if debug:
        base = out["pages" if "pages" in out else "tables"]
        shown = {"lines": out["lines"], "cells": grid.cell_outlines(out.get("merged", out["cells"]))}
        for name, lines_ in shown.items():
            put(f"debug/{name}", lambda to, lines_=lines_: sinks.write_png(pages.overlay(base, lines_), to))
    return made
