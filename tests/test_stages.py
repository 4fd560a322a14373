"""Stages from drawn pages to strips, sources and sinks, configuration and stream."""

import json

import numpy as np
import pytest
from pagemaker import make_page

from gridloom import config
from gridloom.functions import geometry as functions
from gridloom.operators import pages
from gridloom.plans import stages
from gridloom.sources import images as src

XS, YS = [60, 200, 340, 480], [60, 130, 200, 270]
LINES = config.Lines(40, 40, 40, 3, 0.1, 0.3, 0.1, 0.3, 2.0, close_distance=20)
ONE = config.Stage1(marks=False, margin=False, split=False, lines=LINES)
TWO = config.Stage2(lines=LINES, final_deskew=False)


@pytest.fixture(scope="module")
def scans(spark):
    made = {"plain": make_page(XS, YS), "merged": make_page(XS, YS, [(2, 0, 1, 2)])}
    return src.from_arrays(spark, made)


def near(got, want, by=3):
    return len(got) == len(want) and all(abs(a - b) <= by for a, b in zip(got, want))


def test_grid_of_a_drawn_page(scans):
    out = {r.page_id: r for r in stages.stage1(scans, ONE)["structure"].collect()}
    for page in ("plain_full", "merged_full"):
        assert near(out[page].xs, XS) and near(out[page].ys, YS)
        assert (out[page].num_rows, out[page].num_cols) == (3, 3)


def test_merged_cells_and_strips(scans):
    first = stages.stage1(scans, ONE)
    second = stages.stage2(first["tables"], TWO)
    cells = second["merged"].toPandas()
    assert len(cells[cells.page_id == "plain_full"]) == 9
    merged = cells[cells.page_id == "merged_full"]
    assert len(merged) == 8 and sorted(merged.colspan) == [1] * 7 + [2]
    cut = second["strips"].toPandas()
    assert sorted(cut.page_id) == [f"{p}_full_col{i:02d}" for p in ("merged", "plain") for i in (1, 2, 3)]
    assert cut.error.isna().all() and set(np.frombuffer(cut.data[0], np.uint8)) <= {0, 255}


def test_failures_stay_values(spark, scans):
    broken = spark.createDataFrame([("bad", 4, 4, 1, None, None)], pages.IMAGE)
    out = pages.binarize(scans.unionByName(broken)).toPandas().set_index("page_id")
    assert "ValueError" in out.error["bad"] and out.error.drop("bad").isna().all()
    assert {r.status: r.pages for r in stages.report(pages.binarize(scans)).collect()} == {"ok": 2}


def test_split_at_the_gutter(spark):
    page = np.full((300, 400), 255, np.uint8)
    page[:, 190:193], page[:, 206:209] = 0, 0
    out = pages.split_pages(src.from_arrays(spark, {"p": page})).toPandas().set_index("page_id")
    assert list(out.index) == ["p_right", "p_left"] and out.width["p_left"] == 199


def test_tags_are_whitened(spark):
    page = np.full((600, 500), 255, np.uint8)
    page[100:170, 100:160] = 30
    for x in (110, 126, 142):
        page[120:150, x : x + 8] = 250
    out = stages.remove_tags(src.from_arrays(spark, {"p": page}), config.Tags(max_width=0.15, max_height=0.15)).first()
    left = np.frombuffer(out.data, np.uint8).reshape(600, 500)
    assert (left < 100).sum() < (page < 100).sum() / 4


def test_png_round_trip(spark, tmp_path, scans):
    src.write_png(scans, str(tmp_path / "out"))
    (tmp_path / "out" / "broken.png").write_bytes(b"no image")
    (tmp_path / "out" / "notes.txt").write_text("no image")
    back = src.read_images(spark, str(tmp_path / "out")).toPandas().set_index("page_id")
    assert set(back.index) == {"plain", "merged", "broken"} and "unreadable" in back.error["broken"]
    want = scans.toPandas().set_index("page_id")
    assert bytes(back.data["plain"]) == bytes(want.data["plain"])


def test_json_forms(spark, tmp_path, scans):
    second = stages.stage2(stages.stage1(scans, ONE)["tables"], TWO)
    for name, df in (("lines", src.lines_json(second["lines"])), ("recovered", src.recovered_json(second["merged"]))):
        (tmp_path / name).mkdir()
        for r in df.collect():
            (tmp_path / name / f"{r.page_id}.json").write_text(r.json)
    (tmp_path / "recovered" / "skipped.json").write_text(json.dumps({"rows": [], "cols": [], "cells": []}))
    got = src.read_lines_json(spark, str(tmp_path / "lines")).select("page_id", "orient", "pos", "s", "e").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, second["lines"].select("page_id", "orient", "pos", "s", "e").collect()))
    cells = src.read_recovered_json(spark, str(tmp_path / "recovered"))
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, second["merged"].select(cells.columns).collect()))
    s = src.structure_json(stages.stage1(scans, ONE)["structure"], stages.stage1(scans, ONE)["cells"]).first()
    assert len(json.loads(s.json)["cells"]) == 9


def test_config(tmp_path):
    f = tmp_path / "c.json"
    f.write_text(json.dumps({"eps": 12, "lines": {"threshold": 20, "h_size": None}, "deskew": {"method": "radon"}}))
    c = config.from_json(config.Stage1, str(f))
    assert (c.eps, c.lines.threshold, c.lines.h_size, c.deskew.method) == (12, 20, 15, "radon")
    for bad in ({"nope": 1}, {"lines": {"threshold": 300}}, {"deskew": {"fine_step": 0}}, {"peak": 2}):
        with pytest.raises(ValueError):
            config.from_dict(config.Stage1, bad)


def test_stream(spark, tmp_path, scans):
    from gridloom.streaming.pages import arriving, tables_stream

    scans.write.parquet(str(tmp_path / "in"))
    q = tables_stream(arriving(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"), ONE).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_sql_functions(spark):
    functions.register(spark)
    row = spark.sql("SELECT gl_overlap(0, 10, 5, 20) o, gl_gray(200, 200, 200) g, gl_glyph_score(9) s, gl_strip_name('a', 3) n, gl_base_name('x_border_cropped') b, gl_threshold(5, 4) t").first()
    assert tuple(row) == (5, 200, 0.25, "a_col03", "x", 255)


def test_overlay_and_region(scans):
    first = stages.stage1(scans, ONE)
    shown = pages.overlay(first["pages"], first["lines"]).toPandas()
    assert len(shown) == 2 and (shown.n_channels == 3).all()
    far = pages.line_segments(scans, 40, 40, 40, 0.1, 0.1, 2.0, region=(10_000, 0, 0, 0))
    assert far.count() == pages.line_segments(scans, 40, 40, 40, 0.1, 0.1, 2.0).count()
    assert pages.line_segments(scans, 40, 40, 40, 0.1, 0.1, 2.0, skew=0.4).count() > 0


def test_sectioned_config(tmp_path):
    import json

    from gridloom import config

    one = {
        "output_dir": "x", "mark_removal": {"enable": True, "kernel_size": 1, "protect_table_lines": True, "table_line_thickness": 5, "table_detection_params": {"threshold": 40}},
        "margin_removal": {"enable": False}, "page_splitting": {"enable": False}, "tag_removal": {"enable": False}, "deskewing": {"enable": False, "method": "radon", "use_binarization": True, "fine_step": 0.1},
        "table_line_detection": {"threshold": 20, "horizontal_kernel_size": 80, "search_region_top": 30, "line_detection_use_preprocessing": True, "line_detection_adaptive_block_size": 21, "line_detection_stroke_enhancement": True},
        "table_detection": {"table_detection_eps": 7, "table_crop_padding": 25, "enable_table_cropping": False}, "optimization": {"max_workers": 6},
    }
    (tmp_path / "one.json").write_text(json.dumps(one))
    c = config.from_json(config.Stage1, f"{tmp_path}/one.json")
    assert (c.marks, c.margin, c.split, c.tags, c.crop, c.eps, c.padding, c.kernel_size) == (True, False, False, False, False, 7, 25, 1)
    assert (c.lines.threshold, c.lines.h_size, c.lines.region, c.lines.prepare.block, c.lines.prepare.strokes) == (20, 80, (30, 0, 0, 0), 21, True)
    assert c.protect["thickness"] == 5 and c.deskew.method == "radon" and c.deskew.binarized and not c.deskew.enabled
    two = {"deskewing": {"fine_step": 0.1}, "table_recovery": {"coverage_ratio": 0.5}, "vertical_strip_cutting": {"padding_left": 5, "use_longest_lines_only": True}, "binarization": {"enable": False}, "final_deskew": {"enable": True, "coarse_range": 2}}
    (tmp_path / "two.json").write_text(json.dumps(two))
    c = config.from_json(config.Stage2, f"{tmp_path}/two.json")
    assert (c.coverage, c.padding_left, c.longest_only, c.binarize, c.final_deskew, c.final.coarse_range, c.deskew.fine_step) == (0.5, 5, True, False, True, 2, 0.1)
    with pytest.raises(ValueError):
        config.from_dict(config.Stage1, {"deskew": {"fine_step": -1}})


def test_lines_of_a_prepared_page_and_protected_lines(spark):
    from gridloom.config import Lines, Preparation
    from gridloom.plans import stages
    from gridloom.sources.images import from_arrays

    page = make_page([40, 120, 200, 280], [40, 100, 160])
    pale = np.where(page == 0, 215, 255).astype(np.uint8)  # too pale for a threshold of 45
    images = from_arrays(spark, {"p": pale})
    seek = lambda c: {(r.orient, r.pos) for r in stages.detect_lines(images, c).collect()}
    plain = Lines(45, 15, 15)
    assert not seek(plain)
    import dataclasses

    assert seek(dataclasses.replace(plain, prepare=Preparation("fixed", level=230))) == {("h", 40), ("h", 100), ("h", 160), ("v", 40), ("v", 120), ("v", 200), ("v", 280)}
    both = np.where(page == 0, 215, 255).astype(np.uint8)
    both[180:183, 10:60] = 0
    both[150:153, 220:230] = 214  # a pale mark; the pale lines are protected
    from gridloom.operators import pages
    from gridloom.operators.pages import to_array

    r = pages.remove_marks(from_arrays(spark, {"p": both}), 1, 1, {"threshold": 20, "h_size": 60, "v_size": 60, "thickness": 3}).first()
    out = to_array(r.height, r.width, r.n_channels, bytes(r.data))
    assert (out[page == 0] == 215).all() and out[151, 225] == 255


def test_structure_json_round_trip(spark, tmp_path):
    from gridloom.operators import grid
    from gridloom.sources import images

    axis = grid.axes(spark.createDataFrame([("p", o, c, 0, 99) for o, cs in (("h", (10, 60, 90)), ("v", (5, 50, 95))) for c in cs], "page_id string, orient string, pos long, s long, e long"), 5)
    cells = grid.cells(axis)
    (tmp_path / "p.json").write_text(images.structure_json(grid.structure(axis), cells).first().json)
    structure, back = images.read_structure_json(spark, f"{tmp_path}/p.json")
    assert structure.first().xs == [5, 50, 95] and structure.first().num_rows == 2
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cells.select(back.columns).collect()))


def test_release_frees_what_outputs_share(spark):
    from gridloom.config import Stage1
    from gridloom.plans import stages
    from gridloom.sources.images import from_arrays

    out = stages.stage1(from_arrays(spark, {"p": make_page([40, 120, 200], [40, 100, 160])}), Stage1(marks=False, margin=False, split=False))
    assert out["cells"].count() == 4 and all(df.is_cached for df in out.held)
    held = list(out.held)
    out.release()
    assert not out.held and not any(df.is_cached for df in held) and out["cells"].count() == 4


def _changed(v):
    """Another value of the same kind."""
    if isinstance(v, bool):
        return not v
    if isinstance(v, str):
        return {"otsu": "fixed", "adaptive": "fixed", "radon": "histogram_variance", "median": "theilsen", "cross": "rect", "ellipse": "rect", "auto_whitefill_broadmask": "classic"}[v]
    return v / 2 if isinstance(v, float) else v + 1


def _sections():
    """Every parameter of a file with sections, for both stages."""
    deskew = {"enable": True, "method": "radon", "use_binarization": True, "coarse_range": 4.0, "coarse_step": 0.4, "fine_range": 0.8, "fine_step": 0.3, "min_angle_correction": 0.15}
    prepared = {
        "binarization_method": "adaptive", "binarization_threshold": 120, "adaptive_block_size": 21, "adaptive_c": 7, "binarization_invert": False, "binarization_denoise": True,
        "stroke_enhancement": True, "stroke_kernel_size": 2, "stroke_iterations": 2, "stroke_kernel_shape": "cross",
    }
    lines = {
        "threshold": 21, "horizontal_kernel_size": 80, "vertical_kernel_size": 41, "alignment_threshold": 3, "h_min_length_image_ratio": 0.1, "h_min_length_relative_ratio": 0.4, "v_min_length_image_ratio": 0.25,
        "v_min_length_relative_ratio": 0.35, "min_aspect_ratio": 2, "max_h_length_ratio": 0.9, "max_v_length_ratio": 0.8, "close_line_distance": 44, "search_region_top": 30, "search_region_bottom": 31,
        "search_region_left": 5, "search_region_right": 6, "skew_tolerance": 2, "skew_angle_step": 0.4, "line_detection_use_preprocessing": True,
    } | {f"line_detection_{k}": v for k, v in prepared.items()}
    one = {
        "deskewing": deskew, "table_line_detection": lines, "table_detection": {"table_detection_eps": 9, "table_crop_padding": 25, "enable_table_cropping": True},
        "mark_removal": {"enable": True, "dilate_iter": 3, "kernel_size": 1, "protect_table_lines": True, "table_line_thickness": 5, "table_detection_params": {"threshold": 41, "horizontal_kernel_size": 99, "vertical_kernel_size": 98}},
        "tag_removal": {
            "enable": True, "method": "auto_whitefill_broadmask", "thresh_dark": 160, "row_sum_thresh": 100, "dark_ratio": 0.15, "min_area": 1000, "max_area": 80000, "min_aspect": 0.2, "max_aspect": 2.4, "morph_kernel_size": 7,
            "morph_iterations": 3, "band_top": 0.1, "band_bottom": 0.4, "rows_mode": "median", "min_dark": 0.2, "min_score": 0.4, "reject_red": True, "nms_iou": 0.2, "pad_px": 9, "min_width_ratio": 0.01, "max_width_ratio": 0.15,
            "min_height_ratio": 0.05, "max_height_ratio": 0.25, "min_aspect_ratio": 0.15, "max_aspect_ratio": 3.0, "glyph_kernel_size": 5, "mask_close_kernel_size": 15, "mask_open_kernel_size": 5, "mask_dilate_kernel_size": 5,
        },
        "margin_removal": {"enable": True, "use_gradient_detection": True, "gradient_threshold": 49, "blur_ksize": 9, "close_ksize": 20, "close_iter": 3, "erode_after_close": 2},
        "page_splitting": {"enable": True, "search_ratio": 0.3, "line_len_frac": 0.4, "line_thick": 4, "peak_thr": 0.2},
    }
    two = {
        "deskewing": deskew, "table_line_detection": lines, "table_detection": {"table_detection_eps": 9}, "table_recovery": {"coverage_ratio": 0.5},
        "vertical_strip_cutting": {"enable": True, "padding_left": 5, "padding_right": 6, "min_width": 2, "use_longest_lines_only": True, "min_length_ratio": 0.7},
        "binarization": {"enable": True, "method": "otsu", "threshold": 120, "adaptive_block_size": 13, "adaptive_c": 3, "invert": False, "denoise": False, "stroke_enhancement": {"enable": False, "kernel_size": 3, "iterations": 2, "kernel_shape": "ellipse"}},
        "final_deskew": deskew,
    }
    return one, two


def test_each_parameter_of_a_file_has_an_effect():
    import copy

    for kind, found in zip((config.Stage1, config.Stage2), _sections()):
        base = config.from_sections(kind, found)
        paths = [(s, k) for s, own in found.items() for k in own if not isinstance(own[k], dict)]
        paths += [(s, k, n) for s, own in found.items() for k in own if isinstance(own[k], dict) for n in own[k]]
        for *way, last in paths:
            other = copy.deepcopy(found)
            at = other
            for w in way:
                at = at[w]
            at[last] = _changed(at[last])
            assert config.from_sections(kind, other) != base, (kind.__name__, *way, last)


@pytest.mark.parametrize("wrong", [
    {"no_such_step": {}}, {"deskewing": {"angle": 3}}, {"tag_removal": {"method": "magic"}}, {"mark_removal": {"protect_table_lines": True, "table_detection_params": {"size": 2}}},
    {"table_line_detection": {"line_detection_level": 3}}, {"page_splitting": {"search_ratio": 3}}, {"mark_removal": {"enable": 1}},
])
def test_what_no_step_reads_is_refused(wrong):
    with pytest.raises(ValueError):
        config.from_sections(config.Stage1, {"deskewing": {}} | wrong)
    assert config.from_sections(config.Stage1, {"verbose": True, "optimization": {"max_workers": 6}, "deskewing": {}}) == config.Stage1()


def test_classic_and_margin_options_reach_the_pages(spark):
    page = np.full((300, 400), 255, np.uint8)
    page[24:76, 40:300] = 30
    images = src.from_arrays(spark, {"p": page})
    gone = lambda c: (np.frombuffer(stages.remove_tags(images, c).first().data, np.uint8) < 100).sum() == 0
    wide = config.Tags("classic", classic_max_aspect=6.0)
    assert gone(wide) and not gone(config.Tags("classic"))
    import dataclasses

    for option in ({"dark": 20}, {"row_dark": 300}, {"max_area": 10_000}, {"dark_share": 1.1}):
        assert not gone(dataclasses.replace(wide, **option)), option
    scan = np.full((300, 400), 25, np.uint8)
    scan[30:270, 40:360] = 240
    size = lambda **o: tuple(stages.stage1(src.from_arrays(spark, {"s": scan}), config.Stage1(marks=False, split=False, deskew=config.Deskew(enabled=False), **o))["pages"].select("height", "width").first())
    assert size() == (240, 318) and size(margin_erode=11) == (230, 308) and size(margin_method="gradient", margin_strong=2000.0) == (300, 400)
    assert size(margin_method="gradient") != (300, 400)


def test_no_strips_when_they_are_not_cut(spark):
    images = src.from_arrays(spark, {"p": make_page([40, 120, 200], [40, 100, 160])})
    assert stages.stage2(images, config.Stage2(cut=False))["strips"].count() == 0


def test_run_info_is_counted_in_the_write(spark, tmp_path):
    from gridloom.operators.pages import image_row

    rows = [image_row("a", make_page([40, 120], [40, 100])), image_row("b", None, "ValueError: unreadable"), image_row("c", make_page([40, 120], [40, 100]))]
    images = spark.createDataFrame(rows, pages.IMAGE)
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    info = stages.write_with_info(images.mapInArrow(counted, pages.IMAGE), f"{tmp_path}/run", "stage1", "scans").first()
    assert (info.stage, info.source, info.pages, info.failed, info.status) == ("stage1", "scans", 3, 1, "partial") and info.started
    assert calls.value == 3 and spark.read.parquet(f"{tmp_path}/run/pages").count() == 3
    assert spark.read.json(f"{tmp_path}/run/run_info").first().failed == 1
    empty = stages.write_with_info(images.where("false"), f"{tmp_path}/none", "stage1", "scans").first()
    assert (empty.pages, empty.failed, empty.status) == (0, 0, "completed")
    lost = stages.write_with_info(images.where("error is not null"), f"{tmp_path}/lost", "stage1", "scans").first()
    assert lost.status == "failed"


def test_unknown_deskew_warns_and_falls_back(spark):
    from gridloom.kernels import geometry as geo

    images = src.from_arrays(spark, {"p": make_page([40, 120, 200], [40, 100, 160])})
    with pytest.warns(UserWarning, match="magic"):
        found = pages.skew_angles(images, "magic")
    assert found.first().angle == pages.skew_angles(images, "histogram_variance").first().angle
    page = geo.rotate(make_page([40, 120, 200], [40, 100, 160]), 1.5)
    assert geo.skew_by_radon(page, coarse_step=1.0, binarized=True) == geo.skew_by_radon(page, coarse_step=0.5, binarized=True)


def test_disabled_deskew_leaves_the_plan_alone(spark):
    images = src.from_arrays(spark, {"p": make_page([40, 120], [40, 100])})
    assert stages.upright(images, config.Deskew(enabled=False)) is images


def test_overlays_of_structure_and_cells(spark):
    from gridloom.operators import grid

    axis = spark.createDataFrame([("p", o, i, c) for o, cs in (("h", (10, 40)), ("v", (5, 30, 50))) for i, c in enumerate(cs)] + [("q", "v", 0, 9)], "page_id string, orient string, idx long, c long")
    assert sorted(map(tuple, grid.structure_lines(axis).collect())) == [("p", "h", 10, 5, 50), ("p", "h", 40, 5, 50), ("p", "v", 5, 10, 40), ("p", "v", 30, 10, 40), ("p", "v", 50, 10, 40)]
    sides = grid.cell_outlines(grid.cells(axis)).collect()
    assert len(sides) == 7  # two cells share a side
    images = src.from_arrays(spark, {"p": np.full((60, 60), 255, np.uint8)})
    r = pages.overlay(images, grid.cell_outlines(grid.cells(axis)), colour=(255, 0, 0)).first()
    shown = np.frombuffer(r.data, np.uint8).reshape(60, 60, 3)
    assert shown[10, 20].tolist() == [255, 77, 77] and shown[25, 20].tolist() == [255, 255, 255]


def test_line_analysis_of_a_page_without_lines_left(spark):
    from gridloom.operators import lines

    make = lambda rows: spark.createDataFrame(rows, "page_id long, orient string, seq long, pos long, s long, e long")
    before = make([(1, "h", 0, 10, 0, 50), (1, "h", 1, 11, 0, 40), (1, "v", 2, 5, 0, 9), (2, "v", 3, 5, 0, 9)])
    clustered = make([(1, "h", 0, 10, 0, 50), (1, "v", 2, 5, 0, 9), (2, "v", 3, 5, 0, 9)])
    found = sorted(map(tuple, lines.analysis(before, clustered, make([(1, "h", 0, 10, 0, 50)])).collect()))
    assert found == [(1, 3, 1, 1, 1, 0, 50.0, 0.0), (2, 1, 0, 1, 0, 0, 0.0, 0.0)]


def test_colours_as_the_kernel(spark):
    from pyspark.sql import functions as F

    from gridloom.kernels import pixels as px
    from gridloom.operators import colour

    r = np.random.default_rng(3)
    bgr = np.concatenate([r.integers(0, 256, (500, 3)), [[0, 0, 0], [255, 255, 255], [7, 7, 7], [0, 0, 255], [0, 255, 0], [255, 0, 0], [255, 0, 254], [1, 0, 0]]]).astype(np.uint8)
    hue, sat = px.hue_saturation(bgr[None])
    df = spark.createDataFrame([tuple(map(int, x)) for x in bgr], "b long, g long, r long")
    h, s = colour.hue_saturation(F.col("b"), F.col("g"), F.col("r"))
    rows = df.select(h.alias("h"), s.alias("s"), colour.grey(F.col("b"), F.col("g"), F.col("r")).alias("v")).collect()
    assert [(x.h, x.s) for x in rows] == list(zip(hue[0].tolist(), sat[0].tolist()))
    assert [x.v for x in rows] == px.gray(bgr[None])[0].tolist()
    assert [(x.h, x.s) for x in rows[500:506]] == [(0, 0), (0, 0), (0, 0), (0, 255), (60, 255), (120, 255)]


def test_outputs_are_laid_out_in_folders(spark, tmp_path):
    images = src.from_arrays(spark, {"p": make_page(XS, YS), "q": make_page(XS, YS)})
    out = stages.run(images, ONE, TWO)
    made = stages.save(out, str(tmp_path), debug=True)
    out.release()
    assert set(made) >= {"stage1_pages", "stage1_tables", "stage1_lines_json", "stage1_structure_json", "stage1_debug/lines", "stage2_strips", "stage2_recovered_json", "stage2_bounds", "stage2_debug/cells"}
    assert src.read_images(spark, made["stage2_strips"]).count() == 6 and src.read_images(spark, made["stage1_debug/lines"]).count() == 2
    texts = [json.loads(r.json) for r in spark.read.json(made["stage1_structure_json"]).collect()]
    assert [t["num_cols"] for t in texts] == [3, 3]
    plain = stages.save(stages.stage1(images, ONE), f"{tmp_path}/one")
    assert not any(k.startswith("debug") for k in plain)


def test_jpeg_files_are_read_back_within_an_error(spark, tmp_path):
    from gridloom.sources import jpeg as codec

    r = np.random.default_rng(1)
    y, x = np.mgrid[0:61, 0:83]
    grey = (128 + 60 * np.sin(x / 9) + 50 * np.cos(y / 7)).astype(np.uint8)
    own = {
        "grey": grey, "noise": r.integers(0, 256, (40, 50)).astype(np.uint8), "flat": np.full((9, 7), 200, np.uint8), "dot": np.full((1, 1), 3, np.uint8), "page": make_page(XS, YS),
        "colour": np.stack([grey, 255 - grey, grey // 2 + 40], -1).astype(np.uint8), "black": np.zeros((8, 8), np.uint8),
    }
    src.write_jpeg(src.from_arrays(spark, own), f"{tmp_path}/jpg", 95)
    back = {p.page_id: np.frombuffer(p.data, np.uint8).reshape(p.height, p.width, p.n_channels) for p in src.read_images(spark, f"{tmp_path}/jpg").collect()}
    assert set(back) == set(own)
    for k, v in own.items():
        error = np.abs(back[k].astype(int) - v.reshape(*v.shape[:2], -1))
        assert error.max() <= 16 and error.mean() <= 2, k
    assert len(codec.jpeg(own["grey"], 20)) < len(codec.jpeg(own["grey"], 95)) < grey.size
    for wrong in (0, 101):
        with pytest.raises(ValueError):
            codec.jpeg(grey, wrong)
    with pytest.raises(Exception, match="unknown image type"):
        src.write_images(src.from_arrays(spark, own), f"{tmp_path}/gif", "gif")


def test_huffman_codes_stay_within_sixteen_bits():
    from gridloom.sources.jpeg import code_lengths

    counts = np.zeros(256, np.int64)
    counts[:30] = [2**k for k in range(30)]  # a plain code would be 30 bits deep
    lengths = code_lengths(counts)
    assert max(lengths.values()) <= 16 and set(lengths) == set(range(30)) | {256} and lengths[256] == max(lengths.values())
    assert sum(2.0**-n for n in lengths.values()) <= 1
