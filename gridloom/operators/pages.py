"""Page images as rows (page_id, height, width, n_channels, data) and the kernels that run on them in Arrow batches.

A page that a kernel can't process keeps its row: data is null and error says why.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.kernels import composites as comp
from gridloom.kernels import geometry as geo
from gridloom.kernels import pixels as px

IMAGE = "page_id string, height int, width int, n_channels int, data binary, error string"
_ARROW = pa.schema([("page_id", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("n_channels", pa.int32()), ("data", pa.binary()), ("error", pa.string())])


def to_array(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    return px.check(a.reshape(height, width) if channels == 1 else a.reshape(height, width, channels))


def image_row(page_id: str, image: np.ndarray | None, error: str | None = None) -> tuple:
    if image is None:
        return page_id, None, None, None, None, error
    return page_id, image.shape[0], image.shape[1], 1 if image.ndim == 2 else image.shape[2], np.ascontiguousarray(image).tobytes(), error


def _rows(batch: pa.RecordBatch):
    names = batch.schema.names
    errors = batch.column("error").to_pylist() if "error" in names else [None] * batch.num_rows
    columns = (batch.column(n).to_pylist() for n in ("page_id", "height", "width", "n_channels"))
    for page, h, w, c, data, error in zip(*columns, batch.column("data"), errors):
        yield page, h, w, c, data, error


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


#: Bytes of images that go into one batch, on either way between Spark and its workers.
BATCH_BYTES = 8 << 20


def _bounded(images: DataFrame) -> DataFrame:
    """images, whose session from now on sends batches of at most BATCH_BYTES (or as much as it sends already, if that is less).

    A batch otherwise holds 64 MB of pages for each worker of each step, however small the memory beside the heap.
    """
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", images.sparkSession.conf
    set_ = conf.get(name).lower().removesuffix("b")
    if not set_.isdigit() or int(set_) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return images


def _batched(rows, schema: pa.Schema):
    """Rows as batches of about BATCH_BYTES."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, bytes))
        if size >= BATCH_BYTES:
            yield _table(held, schema)
            held, size = [], 0
    if held:
        yield _table(held, schema)


def batched_images(rows):
    """image_row()s as batches of about BATCH_BYTES."""
    return _batched(rows, _ARROW)


def map_images(images: DataFrame, kernel) -> DataFrame:
    """kernel(image) for each page: an image, or a list of (suffix, image) which makes a page of each."""

    def made_of(batches):
        for batch in batches:
            for page, h, w, c, data, error in _rows(batch):
                try:
                    if error is not None or not data.is_valid:
                        raise ValueError(error or "image is None")
                    made = kernel(to_array(h, w, c, data.as_py()))
                    rows = [image_row(page, made)] if isinstance(made, np.ndarray) else [image_row(page + s, m) for s, m in made]
                except Exception as e:  # a page's failure is its value
                    rows = [image_row(page, None, f"{type(e).__name__}: {e}" if error is None else error)]
                yield from rows

    return _bounded(images).mapInArrow(lambda batches: _batched(made_of(batches), _ARROW), IMAGE)


def measure(images: DataFrame, kernel, schema: str) -> DataFrame:
    """kernel(image), a list of tuples, for each page: rows of page_id and the schema's columns. Pages with errors give none."""
    full = f"page_id string, {schema}"
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
    arrow = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in full.split(", "))])

    def measured(batches):
        for batch in batches:
            for page, h, w, c, data, error in _rows(batch):
                if error is None and data.is_valid:
                    yield from ((page, *r) for r in kernel(to_array(h, w, c, data.as_py())))

    return _bounded(images).mapInArrow(lambda batches: _batched(measured(batches), arrow), full)


def binarize(images: DataFrame, method: str = "otsu", **options) -> DataFrame:
    if method not in ("otsu", "adaptive", "fixed"):
        raise ValueError(f"unknown method {method!r}")
    return map_images(images, lambda i: px.binarize(i, method, **options))


def strengthen(images: DataFrame, size: int = 2, iterations: int = 1, shape: str = "ellipse") -> DataFrame:
    px.element(shape, size)
    return map_images(images, lambda i: px.strengthen(i, size, iterations, shape))


def deskew(images: DataFrame, method: str = "histogram_variance", min_angle: float = 0.2, **options) -> DataFrame:
    method = geo.known_method(method)  # the driver warns, once
    return map_images(images, lambda i: geo.deskew(i, method, min_angle, **options)[0])


def skew_angles(images: DataFrame, method: str = "histogram_variance", **options) -> DataFrame:
    method = geo.known_method(method)
    return measure(images, lambda i: [(geo.skew_angle(i, method, **options),)], "angle double")


def remove_marks(images: DataFrame, dilate_iter: int = 2, kernel_size: int = 3, protect: dict | None = None) -> DataFrame:
    """protect: options of comp.line_mask() and thickness, for table lines that stay whatever their grey."""

    def kernel(i):
        if protect is None:
            return comp.remove_marks(i, dilate_iter, kernel_size)
        options = dict(protect)
        thick = px.element("rect", options.pop("thickness", 3))
        across, along = comp.line_mask(i, **options)
        return comp.remove_marks(i, dilate_iter, kernel_size, px.dilate(across | along, thick))

    return map_images(images, kernel)


def remove_margin(images: DataFrame, method: str = "paper", **options) -> DataFrame:
    """The page inside its margin; a page without one stays as it is."""

    def kernel(i):
        try:
            return comp.remove_margin(i, method, **options)
        except RuntimeError:
            return i

    cut = {"paper": kernel, "gradient": kernel, "keep_borders": lambda i: comp.remove_margin_keep_borders(i, **options)}
    if method not in cut:
        raise ValueError(f"unknown method {method!r}")
    return map_images(images, cut[method])


def margin_status(images: DataFrame, method: str = "paper", **options) -> DataFrame:
    """page_id, status (cut, or why the page stays), x, y, width, height of what remove_margin() keeps."""
    masks = {"paper": comp.paper_mask, "gradient": comp.gradient_mask}
    if method not in masks:
        raise ValueError(f"unknown method {method!r}")

    def kernel(i):
        try:
            x1, y1, x2, y2 = geo.largest_rectangle(masks[method](i, **options))
        except RuntimeError as e:
            return [(str(e), 0, 0, i.shape[1], i.shape[0])]
        return [("cut", x1, y1, x2 - x1 + 1, y2 - y1 + 1)]

    return measure(images, kernel, "status string, x long, y long, width long, height long")


def largest_rect(images: DataFrame, above: int = 127) -> DataFrame:
    """page_id, x, y, width, height, area of the largest rectangle of pixels over a level; pages without one give none."""

    def kernel(i):
        mask = px.fixed(px.gray(i), above)
        if not mask.any():
            return []
        x1, y1, x2, y2 = geo.largest_rectangle(mask)
        return [(x1, y1, x2 - x1 + 1, y2 - y1 + 1, (x2 - x1 + 1) * (y2 - y1 + 1))]

    return measure(images, kernel, "x long, y long, width long, height long, area long")


_SEGMENT = "orient string, seq long, pos long, s long, e long, score long, width long, height long"


def _segments(threshold=40, h_size=8, v_size=8, h_min=0.2, v_min=0.2, min_aspect=3.0, skew=0.0, skew_step=0.2, region=(0, 0, 0, 0), prepare: dict | None = None):
    def kernel(i):
        h, w = i.shape[:2]
        top, bottom, left, right = region
        if min(region) < 0 or top + bottom >= h or left + right >= w:
            top = bottom = left = right = 0
        masks = comp.line_mask(i[top : h - bottom, left : w - right], threshold, h_size, v_size, skew, skew_step, prepare)
        out = []
        for o, m, least, across, along in (("h", masks[0], h_min, top, left), ("v", masks[1], v_min, left, top)):
            for seq, pos, s, e, aspect in comp.line_components(m, o == "v", least, min_aspect):
                out.append((o, seq, pos + across, s + along, e + along, round(aspect * 1000), w, h))
        return out

    return kernel


def line_segments(images: DataFrame, *args, **options) -> DataFrame:
    """page_id, orient, seq, pos, s, e, score (aspect in thousandths), width, height of lines' components.

    threshold=40, h_size=8, v_size=8, h_min=0.2, v_min=0.2, min_aspect=3.0, skew=0.0, skew_step=0.2, region=(0, 0, 0, 0), prepare=None.
    region: pixels left out at the top, bottom, left and right; an impossible one means the whole page.
    """
    return measure(images, _segments(*args, **options), _SEGMENT)


def with_line_segments(images: DataFrame, *args, data: bool = True, **options) -> DataFrame:
    """Pages, or with data=False their rows alone, with what line_segments() finds on them in an array, found."""
    return _with_found(images, _segments(*args, **options), _SEGMENT, data)


def crop(images: DataFrame, bounds: DataFrame) -> DataFrame:
    """Pages cut to bounds(page_id, x1, y1, x2, y2), ends excluded; pages without bounds stay."""
    return crop_listed(_bounded(images).join(bounds, "page_id", "left"))


def crop_listed(images: DataFrame) -> DataFrame:
    """crop() of pages that bring their bounds along, as columns x1, y1, x2, y2."""

    def run(batches):
        for batch in batches:
            b = {n: batch.column(n).to_pylist() for n in ("x1", "y1", "x2", "y2")}
            for k, (page, h, w, c, data, error) in enumerate(_rows(batch)):
                if error is not None or not data.is_valid:
                    yield page, None, None, None, None, error
                    continue
                i = to_array(h, w, c, data.as_py())
                if b["x1"][k] is not None:
                    i = i[b["y1"][k] : b["y2"][k], b["x1"][k] : b["x2"][k]]
                yield image_row(page, i)

    return _bounded(images).mapInArrow(lambda batches: _batched(run(batches), _ARROW), IMAGE)


def cut_strips(images: DataFrame, bounds: DataFrame) -> DataFrame:
    """One page <page_id>_colNN for each of bounds(page_id, column_index, left, right); each page is sliced once."""
    lists = bounds.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("column_index", "left", "right"))).alias("strips"))

    def run(batches):
        for batch in batches:
            for strips, (page, h, w, c, data, error) in zip(batch.column("strips").to_pylist(), _rows(batch)):
                whole = to_array(h, w, c, data.as_py()) if error is None and data.is_valid else None
                for s in strips:
                    name = f"{page}_col{s['column_index']:02d}"
                    yield (name, None, None, None, None, error) if whole is None else image_row(name, whole[:, s["left"] : s["right"]])

    return _bounded(images).join(lists, "page_id").mapInArrow(lambda batches: _batched(run(batches), _ARROW), IMAGE)


def split_pages(images: DataFrame, search_ratio=0.5, line_len_frac=0.3, line_thick=3, peak=0.3) -> DataFrame:
    """Two pages of each image at its gutter: <page_id>_right first, then <page_id>_left."""

    def kernel(i):
        x = gutter(i, search_ratio, line_len_frac, line_thick, peak)
        return [("_right", i[:, x:]), ("_left", i[:, :x])]

    return map_images(images, kernel)


def gutter(image: np.ndarray, search_ratio=0.5, line_len_frac=0.3, line_thick=3, peak=0.3) -> int:
    """Where to split: between the two long vertical lines nearest the middle."""
    h, w = image.shape[:2]
    ink = px.otsu(px.gray(image), True)
    columns = px.opening(ink, px.element("rect", line_thick, max(15, int(line_len_frac * h)))).sum(0, dtype=np.int64)
    margin = int((1 - search_ratio) / 2 * w)
    window = columns[margin : w - margin]
    at = np.flatnonzero(window >= peak * window.max()) + margin if len(window) else np.zeros(0, int)
    if len(at) < 2:
        return w // 2
    cut = np.flatnonzero(np.diff(at) > 1)
    islands = list(zip(at[np.append(0, cut + 1)].tolist(), at[np.append(cut, len(at) - 1)].tolist()))
    two = sorted(sorted(islands, key=lambda s: abs((s[0] + s[1]) // 2 - w // 2))[:2])
    return (two[0][0] + two[0][1]) // 2 if len(two) == 1 else (two[0][1] + two[1][0]) // 2


def remove_tags_classic(images: DataFrame, dark: int = 110, least: int = 200, kernel: int = 5, iterations: int = 2, **bounds) -> DataFrame:
    """Pages whose tags are painted white: dark regions of the band that tags.classic_filter() takes (bounds are its own)."""
    from . import tags

    found = _with_found(images, _dark_boxes(dark, least, kernel, iterations), _TAG_BOX)
    return white_listed(found.withColumn("boxes", F.filter("found", lambda b: tags.is_classic(b, **bounds))).drop("found"))


_TAG_BOX = "box_id long, x long, y long, w long, h long, area long, dark double"


def _dark_boxes(dark: int, least: int, kernel: int, iterations: int):
    def run(i):
        g = px.gray(i)
        band = comp.dark_band(g, dark, least)
        if band is None:
            return []
        return [(k, x, y + band[0], w, h, a, d) for k, (x, y, w, h, a, d) in enumerate(comp.tag_regions(g[band[0] : band[1]], dark, kernel, iterations))]

    return run


def tag_boxes(images: DataFrame, dark: int = 110, least: int = 200, kernel: int = 5, iterations: int = 2) -> DataFrame:
    """page_id, box_id, x, y, w, h, area, dark of dark regions in the band of tags, in the page's frame."""
    return measure(images, _dark_boxes(dark, least, kernel, iterations), _TAG_BOX)


_CANDIDATE = "box_id long, x long, y long, w long, h long, dark double, sat double, hue double, glyphs long, band_width long, band_height long, band_top long, page_width long, page_height long"


def _candidates(top: float, bottom: float, glyph_kernel: int, pad: int):
    def kernel(i):
        h = i.shape[0]
        y0 = max(0, min(h - 1, int(top * h)))
        y1 = max(y0 + 1, min(h, int(bottom * h)))
        band = i[y0:y1]
        g = px.gray(band)
        hue, sat = px.hue_saturation(px.bgr(band))
        out = []
        for k, (x, y, w, hh) in enumerate(comp.stable_regions(np.pad(g, pad, constant_values=255))):
            x, y = x - pad, y - pad
            x2, y2 = max(x, 0), max(y, 0)
            roi = (slice(y2, y + hh), slice(x2, x + w))
            if g[roi].size:
                dark = float((g[roi] < 160).mean())
                out.append((k, x, y, w, hh, dark, float(sat[roi].mean()), float(hue[roi].mean()), comp.glyph_count(g[roi], kernel=glyph_kernel), g.shape[1], g.shape[0], y0, i.shape[1], h))
        return out

    return kernel


def tag_candidates(images: DataFrame, top: float = 0.08, bottom: float = 0.42, glyph_kernel: int = 3, pad: int = 24) -> DataFrame:
    """page_id, box_id, x, y, w, h, dark, sat, hue, glyphs, band_width, band_height, band_top, page_width, page_height of stable regions of the band."""
    return measure(images, _candidates(top, bottom, glyph_kernel, pad), _CANDIDATE)


def with_tag_candidates(images: DataFrame, top: float = 0.08, bottom: float = 0.42, glyph_kernel: int = 3, pad: int = 24, data: bool = True) -> DataFrame:
    """Pages, or with data=False their rows alone, with what tag_candidates() finds on them in an array, found."""
    return _with_found(images, _candidates(top, bottom, glyph_kernel, pad), _CANDIDATE, data)


def _with_found(images: DataFrame, kernel, schema: str, keep: bool = True) -> DataFrame:
    """Pages with an array, found, of the tuples that kernel(image) gives, so that no page has to meet them in a join. Pages with errors have none."""
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    arrow = _ARROW.append(pa.field("found", pa.list_(pa.struct([(n, {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}[k]) for n, k in zip(names, kinds)]))))

    def run(batches):
        for batch in batches:
            for page, h, w, c, data, error in _rows(batch):
                whole = data.as_py() if error is None and data.is_valid else None
                yield page, h, w, c, whole if keep else None, error, [] if whole is None else kernel(to_array(h, w, c, whole))

    full = f"{IMAGE}, found array<struct<{', '.join(f'{n}: {k}' for n, k in zip(names, kinds))}>>"
    return _bounded(images).mapInArrow(lambda batches: _batched(run(batches), arrow), full)


def white_fill(images: DataFrame, boxes: DataFrame, capsules: dict | None = None, margin: int = 2) -> DataFrame:
    """Pages with their boxes(page_id, x, y, w, h) painted white; with capsules (options of comp.capsule_mask()) only the dark shape within each."""
    lists = boxes.groupBy("page_id").agg(F.collect_list(F.struct("x", "y", "w", "h")).alias("boxes"))
    return white_listed(_bounded(images).join(lists, "page_id", "left"), capsules, margin)


def white_listed(images: DataFrame, capsules: dict | None = None, margin: int = 2) -> DataFrame:
    """white_fill() of pages that bring their boxes along, as an array of structs x, y, w, h."""

    def run(batches):
        for batch in batches:
            for b, (page, h, w, c, data, error) in zip(batch.column("boxes").to_pylist(), _rows(batch)):
                if error is not None or not data.is_valid:
                    yield page, None, None, None, None, error
                    continue
                i, own = to_array(h, w, c, data.as_py()), [(x["x"], x["y"], x["w"], x["h"]) for x in b or ()]
                yield image_row(page, comp.white_boxes(i, own, margin) if capsules is None else comp.white_capsules(i, own, **capsules))

    return _bounded(images).mapInArrow(lambda batches: _batched(run(batches), _ARROW), IMAGE)


def overlay(images: DataFrame, lines: DataFrame, share: float = 0.7, colour: tuple[int, int, int] = (0, 0, 255)) -> DataFrame:
    """Pages with lines(page_id, orient, pos, s, e) drawn over them: detected ones, grid.structure_lines() or grid.cell_outlines()."""
    lists = lines.groupBy("page_id").agg(F.collect_list(F.struct("orient", "pos", "s", "e")).alias("boxes"))

    def run(batches):
        for batch in batches:
            for b, (page, h, w, c, data, error) in zip(batch.column("boxes").to_pylist(), _rows(batch)):
                if error is not None or not data.is_valid:
                    continue
                i = px.bgr(to_array(h, w, c, data.as_py()))
                ends = [(x["s"], x["pos"], x["e"], x["pos"]) if x["orient"] == "h" else (x["pos"], x["s"], x["pos"], x["e"]) for x in b or ()]
                drawn = i.copy()
                drawn[geo.draw_lines(i.shape, ends) > 0] = colour
                yield image_row(page, px.blend(drawn, i, share))

    return _bounded(images).join(lists, "page_id", "left").mapInArrow(lambda batches: _batched(run(batches), _ARROW), IMAGE)
