"""Parameters of both stages: frozen, checked, and read from JSON over the defaults."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Deskew:
    method: str = "histogram_variance"
    coarse_range: float = 5.0
    coarse_step: float = 0.5
    fine_range: float = 1.0
    fine_step: float = 0.2
    min_angle: float = 0.2
    binarized: bool = False
    stop_early: bool = False
    enabled: bool = True


@dataclass(frozen=True)
class Preparation:
    """The binary page in which lines are sought instead of the grey one."""

    method: str = "adaptive"
    level: float = 127
    block: int = 31
    c: float = 5
    invert: bool = False
    denoise: bool = False
    strokes: bool = False
    stroke_size: int = 2
    stroke_iterations: int = 1
    stroke_shape: str = "ellipse"


@dataclass(frozen=True)
class Lines:
    threshold: int = 35
    h_size: int = 15
    v_size: int = 15
    alignment: int = 5
    h_min: float = 0.2
    h_relative: float = 0.3
    v_min: float = 0.2
    v_relative: float = 0.3
    min_aspect: float = 3.0
    max_h: float = 1.0
    max_v: float = 1.0
    close_distance: float = 45
    region: tuple[int, int, int, int] = (0, 0, 0, 0)
    skew: float = 0.0
    skew_step: float = 0.2
    prepare: Preparation | None = None


@dataclass(frozen=True)
class Tags:
    """method: auto (stable regions of a band, scored) or classic (dark regions of the dark rows)."""

    method: str = "auto"
    # auto: the band and a tag's size as shares of the page
    band_top: float = 0.08
    band_bottom: float = 0.42
    min_width: float = 0.015
    max_width: float = 0.10
    min_height: float = 0.015
    max_height: float = 0.10
    min_aspect: float = 0.3
    max_aspect: float = 2.5
    min_dark: float = 0.52
    reject_red: bool = True
    iou: float = 0.30
    min_score: float = 0.55
    rows: str = "median"
    glyph_kernel: int = 3
    pad: int = 8
    mask_close: int = 11
    mask_open: int = 3
    mask_grow: int = 3
    # classic
    dark: int = 110
    row_dark: int = 200
    dark_share: float = 0.7
    min_area: int = 2000
    max_area: int = 60000
    classic_min_aspect: float = 0.3
    classic_max_aspect: float = 1.8
    kernel: int = 5
    iterations: int = 2


@dataclass(frozen=True)
class Stage1:
    marks: bool = True
    tags: bool = False
    margin: bool = True
    split: bool = True
    dilate_iter: int = 2
    kernel_size: int = 3
    margin_method: str = "paper"
    margin_blur: int = 5
    margin_close: int = 25
    margin_close_iter: int = 2
    margin_erode: int = 0
    margin_strong: float = 50.0
    deskew: Deskew = field(default_factory=Deskew)
    lines: Lines = field(default_factory=Lines)
    tag: Tags = field(default_factory=Tags)
    search_ratio: float = 0.5
    line_len_frac: float = 0.3
    line_thick: int = 3
    peak: float = 0.3
    eps: int = 10
    padding: int = 20
    crop: bool = True
    protect: dict | None = None


@dataclass(frozen=True)
class Stage2:
    deskew: Deskew = field(default_factory=lambda: Deskew(fine_step=0.1, min_angle=0.1))
    lines: Lines = field(default_factory=lambda: Lines(45, 8, 8, 2, 0.4, 0.5, 0.4, 0.5, 7.0))
    eps: int = 10
    coverage: float = 0.8
    padding_left: int = 20
    padding_right: int = 20
    min_width: int = 1
    cut: bool = True
    longest_only: bool = False
    min_length_ratio: float = 0.9
    binarize: bool = True
    binary: Preparation = field(default_factory=lambda: Preparation("otsu", block=11, c=2))
    final_deskew: bool = True
    final: Deskew = field(default_factory=lambda: Deskew("radon", fine_step=0.2, min_angle=0.1, binarized=True))


def check(config) -> None:
    """Raises ValueError for parameters out of range."""
    for f in dataclasses.fields(config):
        v = getattr(config, f.name)
        if dataclasses.is_dataclass(v):
            check(v)
        elif f.name.endswith(("_step", "_range")) and v <= 0:
            raise ValueError(f"{f.name} must be positive")
        elif f.name in ("search_ratio", "line_len_frac", "peak", "coverage", "min_length_ratio", "h_relative", "v_relative") and not 0 <= v <= 1:
            raise ValueError(f"{f.name} must lie between 0 and 1")
        elif f.name in ("threshold",) and not 0 <= v <= 255:
            raise ValueError(f"{f.name} must lie between 0 and 255")
        elif isinstance(config, Tags) and f.name == "method" and v not in ("auto", "classic"):
            raise ValueError(f"unknown way to remove tags {v!r}")
        elif f.name == "margin_method" and v not in ("paper", "gradient", "keep_borders"):
            raise ValueError(f"unknown way to remove margins {v!r}")


def from_dict(kind, values: dict, base=None):
    """A Stage1 or Stage2 with the given values over the defaults; unknown keys raise ValueError, nulls keep the default."""
    base = base if base is not None else kind()
    names = {f.name: f for f in dataclasses.fields(kind)}
    if unknown := set(values) - set(names):
        raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
    new = {}
    for k, v in values.items():
        old = getattr(base, k)
        if v is None:
            continue
        if k == "prepare":
            v = v if isinstance(v, Preparation) else from_dict(Preparation, v, old)
        elif isinstance(old, bool) and not isinstance(v, bool):
            raise ValueError(f"{k} must be true or false")
        new[k] = from_dict(type(old), v, old) if dataclasses.is_dataclass(old) and isinstance(v, dict) else tuple(v) if isinstance(old, tuple) else v
    made = dataclasses.replace(base, **new)
    check(made)
    return made


#: The sections of a file and their parameters, with the field that each one sets (a dot leads into a part).
_DESKEW = {"enable": "enabled", "method": "method", "use_binarization": "binarized", "coarse_range": "coarse_range", "coarse_step": "coarse_step", "fine_range": "fine_range", "fine_step": "fine_step", "min_angle_correction": "min_angle"}
_LINES = {
    "threshold": "threshold", "horizontal_kernel_size": "h_size", "vertical_kernel_size": "v_size", "alignment_threshold": "alignment", "h_min_length_image_ratio": "h_min",
    "h_min_length_relative_ratio": "h_relative", "v_min_length_image_ratio": "v_min", "v_min_length_relative_ratio": "v_relative", "min_aspect_ratio": "min_aspect",
    "max_h_length_ratio": "max_h", "max_v_length_ratio": "max_v", "close_line_distance": "close_distance", "skew_tolerance": "skew", "skew_angle_step": "skew_step",
}
_PREPARATION = {
    "binarization_method": "method", "binarization_threshold": "level", "adaptive_block_size": "block", "adaptive_c": "c", "binarization_invert": "invert", "binarization_denoise": "denoise",
    "stroke_enhancement": "strokes", "stroke_kernel_size": "stroke_size", "stroke_iterations": "stroke_iterations", "stroke_kernel_shape": "stroke_shape",
}
_TAGS = {
    "method": "method", "band_top": "band_top", "band_bottom": "band_bottom", "min_width_ratio": "min_width", "max_width_ratio": "max_width", "min_height_ratio": "min_height", "max_height_ratio": "max_height",
    "min_aspect_ratio": "min_aspect", "max_aspect_ratio": "max_aspect", "min_dark": "min_dark", "reject_red": "reject_red", "nms_iou": "iou", "min_score": "min_score", "rows_mode": "rows",
    "glyph_kernel_size": "glyph_kernel", "pad_px": "pad", "mask_close_kernel_size": "mask_close", "mask_open_kernel_size": "mask_open", "mask_dilate_kernel_size": "mask_grow",
    "thresh_dark": "dark", "row_sum_thresh": "row_dark", "dark_ratio": "dark_share", "min_area": "min_area", "max_area": "max_area", "min_aspect": "classic_min_aspect", "max_aspect": "classic_max_aspect",
    "morph_kernel_size": "kernel", "morph_iterations": "iterations",
}
_TAG_METHODS = {"auto_whitefill_broadmask": "auto", "classic": "classic"}
_COMMON = {
    "deskewing": {k: f"deskew.{v}" for k, v in _DESKEW.items()},
    "table_line_detection": {k: f"lines.{v}" for k, v in _LINES.items()},
    "table_detection": {"table_detection_eps": "eps"},
}
_SECTIONS = {
    "Stage1": _COMMON | {
        "mark_removal": {"enable": "marks", "dilate_iter": "dilate_iter", "kernel_size": "kernel_size"},
        "tag_removal": {"enable": "tags"} | {k: f"tag.{v}" for k, v in _TAGS.items()},
        "margin_removal": {"enable": "margin", "blur_ksize": "margin_blur", "close_ksize": "margin_close", "close_iter": "margin_close_iter", "erode_after_close": "margin_erode", "gradient_threshold": "margin_strong"},
        "inscribed_margin_removal": {"inscribed_blur_ksize": "margin_blur", "inscribed_close_ksize": "margin_close", "inscribed_close_iter": "margin_close_iter"},
        "page_splitting": {"enable": "split", "search_ratio": "search_ratio", "line_len_frac": "line_len_frac", "line_thick": "line_thick", "peak_thr": "peak"},
        "table_detection": {"table_detection_eps": "eps", "table_crop_padding": "padding", "enable_table_cropping": "crop"},
    },
    "Stage2": _COMMON | {
        "table_recovery": {"coverage_ratio": "coverage"},
        "vertical_strip_cutting": {"enable": "cut", "padding_left": "padding_left", "padding_right": "padding_right", "min_width": "min_width", "use_longest_lines_only": "longest_only", "min_length_ratio": "min_length_ratio"},
        "binarization": {"enable": "binarize", "method": "binary.method", "threshold": "binary.level", "adaptive_block_size": "binary.block", "adaptive_c": "binary.c", "invert": "binary.invert", "denoise": "binary.denoise"},
        "final_deskew": {"enable": "final_deskew"} | {k: f"final.{v}" for k, v in _DESKEW.items() if k != "enable"},
    },
}
_STROKES = {"enable": "binary.strokes", "kernel_size": "binary.stroke_size", "iterations": "binary.stroke_iterations", "kernel_shape": "binary.stroke_shape"}
#: What a file may have and this engine has no use for: folders, workers, debugging, and parameters that no step reads any more.
PASSED_OVER = {
    None: {"input_dir", "output_dir", "debug_dir", "verbose", "save_debug_images", "optimization", "table_fitting", "roi_margins"},
    "Stage1": {("table_detection", "table_detection_kernel_ratio")},
    "Stage2": {("table_detection", "table_detection_kernel_ratio"), ("table_detection", "enable_table_cropping"), ("table_detection", "table_crop_padding"), "inscribed_margin_removal"},
}


def _put(values: dict, path: str, value) -> None:
    *parts, last = path.split(".")
    for p in parts:
        values = values.setdefault(p, {})
    values[last] = value


def _special(kind: str, section: str, found: dict, values: dict) -> set[str]:
    """Parameters that don't set one field each; returns their names."""
    if section == "table_line_detection":
        sides = [f"search_region_{side}" for side in ("top", "bottom", "left", "right")]
        _put(values, "lines.region", [found.get(s) or 0 for s in sides])
        prefix = "line_detection_"
        prepared = {f: found[n] for k, f in _PREPARATION.items() for n in (k, prefix + k) if n in found}
        use = {"use_preprocessing", prefix + "use_preprocessing"}
        if any(found.get(n) for n in use):
            _put(values, "lines.prepare", prepared)
        return {*sides, *use, *_PREPARATION, *(prefix + k for k in _PREPARATION)}
    if section == "mark_removal":
        if found.get("protect_table_lines"):
            p = found.get("table_detection_params") or {}
            if unknown := set(p) - {"threshold", "horizontal_kernel_size", "vertical_kernel_size"}:
                raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
            values["protect"] = {"threshold": p.get("threshold", 40), "h_size": p.get("horizontal_kernel_size", 100), "v_size": p.get("vertical_kernel_size", 100), "thickness": found.get("table_line_thickness", 3)}
        return {"protect_table_lines", "table_detection_params", "table_line_thickness"}
    if section == "margin_removal":
        if found.get("use_gradient_detection"):
            values["margin_method"] = "gradient"
        return {"use_gradient_detection"}
    if section == "tag_removal" and found.get("method") in _TAG_METHODS:
        _put(values, "tag.method", _TAG_METHODS[found["method"]])
        return {"method"}
    if section == "binarization":
        strokes = found.get("stroke_enhancement") or {}
        if unknown := set(strokes) - set(_STROKES):
            raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
        for k, v in strokes.items():
            _put(values, _STROKES[k], v)
        return {"stroke_enhancement"}
    return set()


def from_sections(kind, found: dict):
    """A Stage1 or Stage2 from a file with a section for each step, as page pipelines commonly have.

    Every parameter sets its field; what PASSED_OVER names has none, and anything else raises ValueError. A step that is not enabled is left out.
    """
    sections, passed, values = _SECTIONS[kind.__name__], PASSED_OVER[None] | PASSED_OVER[kind.__name__], {}
    for section, own in found.items():
        if section in passed:
            continue
        if section not in sections:
            raise ValueError(f"unknown section {section!r}")
        fields = sections[section]
        special = _special(kind.__name__, section, own or {}, values)
        for k, v in (own or {}).items():
            if k in special or (section, k) in passed:
                continue
            if k not in fields:
                raise ValueError(f"unknown parameter {k!r} of {section!r}")
            _put(values, fields[k], v)
    return from_dict(kind, values)


def from_json(kind, path: str):
    """Reads fields of the kind itself, or sections of steps."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    sections = _SECTIONS[kind.__name__]
    return from_sections(kind, found) if any(k in sections and isinstance(v, dict) and not hasattr(kind(), k) for k, v in found.items()) else from_dict(kind, found)
