"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put together again in another order around sentinels.

A text becomes the array of its units (the matches of a pattern, by default its code points). Hash digits of its id give two cuts and
the form: `psm` is sentinel, prefix, sentinel, suffix, sentinel, middle; `spm` has the suffix before the prefix; `plain` is the text
itself. Arrangements are slices of the array, joined; restored() finds the sentinels and rebuilds the text. Rows never leave
their task: there is no shuffle, and a row's memory is about sixty times its own text.

Defined cases: a null text counts as empty, and an empty one stays plain, as does one that holds a sentinel; a null id is hashed as
an empty one; repeated rows come out alike, rows of one id get cuts from the same digits; whole texts are cut, however long; an empty
table gives no rows; other columns stay, and those named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: One code point, line ends included.
CODE_POINT = r"(?s)."


@dataclass(frozen=True)
class Sentinels:
    """What stands before the prefix, the suffix and the middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        ends = any(a[-k:] == b[:k] for a in marks for b in marks for k in range(1, min(len(a), len(b)) + (a != b)))
        inside = any(a in b for a in marks for b in marks if a is not b)
        if not all(marks) or len(set(marks)) < 3 or ends or inside:
            raise ValueError(f"sentinels may not be empty, equal or overlap: {marks}")


def _digits(seed: int, doc_id: str, nth: int) -> Column:
    """The nth group of eight hex digits, from 0, of the id's hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 1 + 8 * nth, 8), 16, 10).cast("long")


def arranged(
    docs: DataFrame, seed: int = 1, doc_id: str = "doc_id", text: str = "text", unit: str = CODE_POINT, sentinels: Sentinels = Sentinels(), plain_percent: int = 10, spm_percent: int = 20
) -> DataFrame:
    """docs with n, form, prefix_units, middle_units (null if plain) and output.

    unit: a pattern whose matches, one after the other, make up the whole text; what it leaves out is lost.
    plain_percent of the texts stay plain and spm_percent of the others become spm.
    """
    h1, h2, h3, h4 = (_digits(seed, doc_id, i) for i in range(4))
    n, whole = F.col("n"), F.col("_text")
    held = F.lit(False)
    for mark in (sentinels.prefix, sentinels.suffix, sentinels.middle):
        held = held | F.contains(whole, F.lit(mark))
    form = F.when((n == 0) | held | (h3 % 100 >= 100 - plain_percent), "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("_units", (start + 1).cast("int"), length.cast("int")), "")

    a, b = F.col("_a"), F.col("_b")
    prefix, middle, suffix = (part(*x) for x in ((F.lit(0), a), (a, b - a), (b, n - b)))
    p, s, m = (F.lit(x) for x in (sentinels.prefix, sentinels.suffix, sentinels.middle))
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(whole)
    kept = [c for c in docs.columns if c not in ("n", "form", "prefix_units", "middle_units", "output")]
    units = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("_units", F.regexp_extract_all("_text", F.lit(unit), F.lit(0)))
    sized = units.withColumn("n", F.size("_units").cast("long"))
    cut = sized.withColumns({"form": form, "_a": F.least(h1 % (n + 1), h2 % (n + 1)), "_b": F.greatest(h1 % (n + 1), h2 % (n + 1))})
    moved = F.col("form") != "plain"
    return cut.select(*kept, "n", "form", F.when(moved, a).alias("prefix_units"), F.when(moved, b - a).alias("middle_units"), output.alias("output"))


def restored(output: Column, form: Column, sentinels: Sentinels = Sentinels()) -> Column:
    """The text that became output: what lies between the sentinels, each of which occurs once, in its first order."""
    p, s, m = sentinels.prefix, sentinels.suffix, sentinels.middle

    def between(first: str, second: str) -> Column:
        return F.substring_index(F.substring_index(output, first, -1), second, 1)

    last = F.substring_index(output, m, -1)
    psm = F.concat(between(p, s), last, between(s, m))
    spm = F.concat(between(p, m), last, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of every document's arrangement and of the text that comes back from it."""
    out = arranged(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text"))
    again = restored(F.col("output"), F.col("form"))
    return out.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(again.cast("binary"), 256).alias("restored_sha256"),
    )
