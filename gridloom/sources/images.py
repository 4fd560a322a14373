"""Reading page images, writing them as PNG, and the JSON forms of lines, structures and recovered tables."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from gridloom.operators.pages import IMAGE
from gridloom.sources.jpeg import jpeg, quantisation

#: The file types that count as page images, in lower and upper case.
TYPES = ("jpg", "jpeg", "png", "tiff", "tif", "bmp")
PATTERN = "*.{" + ",".join([*TYPES, *(t.upper() for t in TYPES)]) + "}"

LINES = "horizontal_lines array<array<bigint>>, vertical_lines array<array<bigint>>"
STRUCTURE = "xs array<bigint>, ys array<bigint>, cells array<array<bigint>>, num_rows bigint, num_cols bigint"
RECOVERED = "rows string, cols string, cells array<struct<row:bigint,col:bigint,rowspan:bigint,colspan:bigint,bbox:array<bigint>>>"


def stem(path):
    """A file's name without directories and ending."""
    return F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"\.[^.]*$", "")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """page_id, height, width, n_channels, data, error of a file, or of a directory's files (not of those below it).

    Files that can't be decoded have an error instead of data.
    """
    found = spark.read.format("image").option("pathGlobFilter", PATTERN).option("dropInvalid", "false").load(path).select("image.*")
    bad = F.col("height") <= 0
    ok = lambda c: F.when(~bad, F.col(c))
    return found.select(
        stem(F.col("origin")).alias("page_id"), ok("height").alias("height"), ok("width").alias("width"), ok("nChannels").alias("n_channels"),
        ok("data").alias("data"), F.when(bad, F.concat(F.lit("ValueError: unreadable image "), "origin")).alias("error"),
    )


def from_arrays(spark: SparkSession, pages: dict[str, np.ndarray]) -> DataFrame:
    from gridloom.operators.pages import image_row

    return spark.createDataFrame([image_row(k, v) for k, v in pages.items()], IMAGE)


def png(image: np.ndarray) -> bytes:
    """A grey or BGR image as a PNG file."""
    rgb = image if image.ndim == 2 else image[..., ::-1]
    raw = np.zeros((image.shape[0], rgb[0].size + 1), np.uint8)
    raw[:, 1:] = rgb.reshape(image.shape[0], -1)

    def part(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 0 if image.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(raw.tobytes(), 6)) + part(b"IEND", b"")


class ImageSink(DataSource):
    """format("gridloom_images"): each page as <path>/<page_id>.<type>, on a file system that all executors share.

    Options: path; type, png or jpg; quality of jpg, 1 to 100.
    """

    @classmethod
    def name(cls) -> str:
        return "gridloom_images"

    def schema(self) -> str:
        return IMAGE

    def writer(self, schema, overwrite: bool):
        return _ImageWriter(self.options["path"], self.options.get("type", "png"), int(self.options.get("quality", "95")))


class _ImageWriter(DataSourceWriter):
    def __init__(self, path: str, kind: str, quality: int):
        if kind not in ("png", "jpg"):
            raise ValueError(f"unknown image type {kind!r}")
        quantisation(quality)
        self.path, self.kind, self.quality = path.removeprefix("file://"), kind, quality

    def write(self, rows):
        import os

        from gridloom.operators.pages import to_array

        os.makedirs(self.path, exist_ok=True)
        for r in rows:
            if r.data is None:
                continue
            final = f"{self.path}/{r.page_id}.{self.kind}"
            image = to_array(r.height, r.width, r.n_channels, bytes(r.data))
            part = f"{final}.{os.getpid()}.part"  # a task that is lost leaves no half file
            with open(part, "wb") as f:
                f.write(png(image) if self.kind == "png" else jpeg(image, self.quality))
            os.replace(part, final)
        return WriterCommitMessage()


def write_images(images: DataFrame, path: str, kind: str = "png", quality: int = 95) -> None:
    """Each page as a file; kind: png, or jpg of a quality from 1 to 100."""
    images.sparkSession.dataSource.register(ImageSink)
    rows = images.select(*[x.split()[0] for x in IMAGE.split(", ")])
    rows.write.format("gridloom_images").option("type", kind).option("quality", str(quality)).mode("append").save(path)


def write_png(images: DataFrame, path: str) -> None:
    write_images(images, path)


def write_jpeg(images: DataFrame, path: str, quality: int = 95) -> None:
    write_images(images, path, "jpg", quality)


def lines_json(lines: DataFrame) -> DataFrame:
    """page_id, json of lines(page_id, orient, idx, pos, s, e)."""
    of = lambda o, line: F.transform(F.sort_array(F.collect_list(F.when(F.col("orient") == o, F.struct("idx", "pos", "s", "e")))), line)
    out = lines.groupBy("page_id").agg(
        of("h", lambda x: F.array(x["s"], x["pos"], x["e"], x["pos"])).alias("horizontal_lines"), of("v", lambda x: F.array(x["pos"], x["s"], x["pos"], x["e"])).alias("vertical_lines")
    )
    return out.select("page_id", F.to_json(F.struct("horizontal_lines", "vertical_lines")).alias("json"))


def structure_json(structure: DataFrame, cells: DataFrame) -> DataFrame:
    """page_id, json; cells column by column."""
    listed = cells.groupBy("page_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("col", "row", "x1", "y1", "x2", "y2"))), lambda c: F.array(c["x1"], c["y1"], c["x2"], c["y2"])).alias("cells"))
    both = structure.join(listed, "page_id", "left").withColumn("cells", F.coalesce("cells", F.array().cast("array<array<bigint>>")))
    return both.select("page_id", F.to_json(F.struct("xs", "ys", "cells", "num_rows", "num_cols")).alias("json"))


def recovered_json(merged: DataFrame) -> DataFrame:
    """page_id, json of merged cells."""
    cell = F.struct("row", "col", "rowspan", "colspan", F.array("x1", "y1", "x2", "y2").alias("bbox"))
    out = merged.groupBy("page_id").agg(F.max(F.col("row") + F.col("rowspan")).alias("rows"), F.max(F.col("col") + F.col("colspan")).alias("cols"), F.sort_array(F.collect_list(cell)).alias("cells"))
    return out.select("page_id", F.to_json(F.struct("rows", "cols", "cells")).alias("json"))


def read_lines_json(spark: SparkSession, path: str) -> DataFrame:
    """page_id, orient, seq, pos, s, e; page_id is the file's name without ending."""
    found = spark.read.schema(LINES).option("multiLine", True).json(path).select("*", stem(F.col("_metadata.file_path")).alias("page_id"))
    side = lambda column, o, pos, s, e: found.select("page_id", F.lit(o).alias("orient"), F.posexplode(column).alias("seq", "l")).select(
        "page_id", "orient", F.col("seq").cast("long").alias("seq"), F.col("l")[pos].alias("pos"), F.col("l")[s].alias("s"), F.col("l")[e].alias("e")
    )
    return side("horizontal_lines", "h", 1, 0, 2).unionByName(side("vertical_lines", "v", 0, 1, 3))


def read_structure_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """structure(page_id, xs, ys, num_rows, num_cols) and cells(page_id, row, col, x1, y1, x2, y2) of files as structure_json() makes them.

    A cell's row and column are the places of its corner among ys and xs.
    """
    found = spark.read.schema(STRUCTURE).option("multiLine", True).json(path).select(stem(F.col("_metadata.file_path")).alias("page_id"), "*")
    return found.drop("cells"), structure_cells(found)


def structure_cells(found: DataFrame) -> DataFrame:
    """The cells of structures (page_id and STRUCTURE), one row each."""
    box = found.select("page_id", "xs", "ys", F.explode("cells").alias("c"))
    place = lambda axis, i: (F.array_position(axis, F.col("c")[i]) - 1).cast("long")
    return box.select("page_id", place("ys", 1).alias("row"), place("xs", 0).alias("col"), *[F.col("c")[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def three_channels(images: DataFrame) -> DataFrame:
    """Grey pages widened to three equal channels, others as they are."""
    from gridloom.kernels.pixels import bgr
    from gridloom.operators.pages import map_images

    return map_images(images, bgr)


def read_recovered_json(spark: SparkSession, path: str) -> DataFrame:
    """page_id, row, col, rowspan, colspan, x1, y1, x2, y2; a table that was skipped ([] for rows and cols) has no cells."""
    found = spark.read.schema(RECOVERED).option("multiLine", True).json(path).select(stem(F.col("_metadata.file_path")).alias("page_id"), F.explode("cells").alias("c"))
    box = [F.col("c.bbox")[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))]
    return found.select("page_id", "c.row", "c.col", "c.rowspan", "c.colspan", *box)
