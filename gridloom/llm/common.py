"""What the operators of this subpackage share: tables, the shared folder, sizes, labels' folds."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _own_dir() -> str:
    return f"file://{tempfile.mkdtemp(prefix='gridloom-')}"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where it is unset, a local session (as in tests) uses a folder of this process; any other is refused, as its
    executors would not see that folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (named or _own_dir()).rstrip("/")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder, read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def held_out(doc_id="doc_id"):
    """True for the rows that take no part in learning: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator: a bijection on 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_released = [0.0]


def release() -> None:
    """Gives freed memory back to the system, once a second at most: a Python worker lives on after its tasks."""
    now = time.monotonic()
    if now - _released[0] > 1:
        _released[0] = now
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass
