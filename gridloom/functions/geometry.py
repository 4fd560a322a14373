"""Scalar functions for SQL: coverage, overlap and naming rules, as temporary SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "gl_overlap": ("a BIGINT, b BIGINT, s BIGINT, e BIGINT", "BIGINT", "greatest(0, least(b, e) - greatest(a, s))"),
    "gl_gray": ("b INT, g INT, r INT", "INT", "shiftright(b * 1868 + g * 9617 + r * 4899 + 8192, 14)"),
    "gl_threshold": ("v BIGINT, t BIGINT", "BIGINT", "if(v > t, 255, 0)"),
    "gl_glyph_score": ("n BIGINT", "DOUBLE", "1.0D / (1 + abs(least(n, 6) - 3))"),
    "gl_strip_name": ("page STRING, i INT", "STRING", "concat(page, '_col', lpad(cast(i as string), greatest(2, length(cast(i as string))), '0'))"),
    "gl_base_name": ("name STRING", "STRING", "replace(name, '_border_cropped', '')"),
}


def register(spark: SparkSession) -> list[str]:
    """Defines the functions in the session; returns their names."""
    for name, (arguments, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)
