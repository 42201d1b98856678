"""Operator 8: quality rules with adaptive thresholds from mergeable quantile sketches.

Every text gets measures (words, their characters, symbols, repeated lines, repeated three-word
windows).  Two fixed rules are the base; all others are learned: each measure, as a ratio in whole
ten-thousandths, is summarised per language and source in a quantile sketch, and a document is dropped
if a measure lies far outside its group's quantiles.

*Sketch.*  A sketch is a table of counts by bucket.  A bucket holds the values that agree in their
leading ``SIGNIFICANT`` binary digits, so a quantile read from it is within 1 part in 2**SIGNIFICANT of
an exact one; sketches merge by adding counts, in any order, with one result.  They are made by an
ordinary aggregate with map-side sums: a source with a third of all rows is counted like any other.
Counts merge upwards as well: a group's quantiles are drawn to those of its language, and these to the whole
corpus', as ``min_group`` documents would draw them, so small groups follow their language without a step.

*Limits.*  With quartiles q1 and q3 of the group, a value is an outlier above q3 + reach * (q3 - q1) + slack,
and below q1 - reach * (q3 - q1) - slack where low values are judged.  Quartiles, since up to a quarter of
a group may be junk without moving them.  ``slack`` keeps groups whose values hardly differ from rejecting harmless
ones.  Where three quarters and more of the values are 0, the quartiles are those of the values above 0, without slack:
what is far out even among documents that have any.  There ``slack`` is the highest limit: if those that have any are mostly
junk, their quartiles tell nothing.  The limits table is small (measures x groups) and joined, not collected.

Three-word windows are counted within the row: they are sorted with their positions, equal neighbours
are repeats.  Hash and text of a window are compared, so no collision counts.

Cases: null and blank texts have zero words and fail the base; null languages and sources are groups of
their own; repeated rows count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forecourt.llm.common import WORD, staged

SPACE = "[\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
SIGNIFICANT = 7
PER = 10_000
#: measure: (numerator, denominator, low values are outliers too, slack); all in ten-thousandths.
RATIOS = {
    "word_length": ("word_chars", "n_words", True, 10_000),
    "symbols": ("n_symbols", "word_chars", False, 300),
    "dup_lines": ("n_dup_lines", "n_lines", False, 6_000),
    "repeats": ("n_repeat_words", "n_words", False, 2_000),
}
REACH = 3.0
MIN_GROUP = 200


def measured(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (all long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.array_remove(F.split(text, f"{SPACE}+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    cut = docs.select(*keep, text.alias("t"), trimmed.alias("w"), lines.alias("lines"))
    # A window: hash, words, position.  Sorted, repeats are neighbours.
    starts = F.when(F.size("w") >= 3, F.sequence(F.lit(1), F.size("w") - 2)).otherwise(F.array().cast("array<int>"))
    piece = lambda i: F.concat_ws(" ", F.get("w", i - 1), F.get("w", i), F.get("w", i + 1))
    windows = cut.withColumn("windows", F.transform(starts, piece))
    hashed = windows.withColumn("hashes", F.transform("windows", lambda x: F.xxhash64(x)))
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = hashed.withColumn(
        "sorted",
        F.when(repeated, F.sort_array(F.transform("windows", lambda x, i: F.struct(F.xxhash64(x).alias("h"), x.alias("x"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,x:string,i:int>>")),
    )
    same = lambda a, b: a["h"].eqNullSafe(b["h"]) & a["x"].eqNullSafe(b["x"])
    twice = F.sort_array(F.transform(
        F.filter("sorted", lambda x, j: same(F.get("sorted", j - 1), x) | same(F.get("sorted", j + 1), x)), lambda x: x["i"],
    ))
    # Each position covers three words from it on, less what the position before has covered.
    covered = F.aggregate(
        twice, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).cast("long").alias("n")), lambda a: a["n"],
    )
    return ordered.select(
        *keep,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", f"{SPACE}+", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _ratio(top: str, bottom: str) -> Column:
    """In ten-thousandths, rounded down; 0 without a denominator."""
    return F.coalesce(F.floor(F.try_divide(F.col(top) * PER, F.col(bottom))), F.lit(0)).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """``(lang, source, measure, bucket, n)``: counts by bucket, the bucket named by its least value."""
    values = F.array(*(F.struct(F.lit(m).alias("measure"), _ratio(a, b).alias("v")) for m, (a, b, _, _) in RATIOS.items()))
    bucket = "shiftleft(shiftright(v, {0}), {0})".format(f"greatest(length(bin(v)) - {SIGNIFICANT}, 0)")
    return (
        rows.select("lang", "source", F.explode(values).alias("m")).select("lang", "source", "m.measure", "m.v")
        .withColumn("bucket", F.expr(bucket))
        .groupBy("lang", "source", "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def _quantiles(sketch: DataFrame, group: list[str]) -> DataFrame:
    """Quantiles of each group's merged sketch, of all values and of those above 0: the first bucket that reaches the rank."""
    merged = sketch.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*group, "measure").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*group, "measure")
    ranked = (
        merged.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
        .withColumn("zeros", F.coalesce(F.sum(F.when(F.col("bucket") == 0, F.col("n"))).over(whole), F.lit(0)))
    )
    at = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * q), F.col("bucket")))
    some = F.col("all") - F.col("zeros")
    above = lambda q: F.min(F.when((F.col("bucket") > 0) & (F.col("upto") - F.col("zeros") >= F.ceil(some * q)), F.col("bucket")))
    return ranked.groupBy(*group, "measure").agg(F.max("all").alias("size"), at(0.25).alias("q1"), at(0.75).alias("q3"), F.max(some).alias("some"), above(0.25).alias("s1"), above(0.75).alias("s3"))


def limits(sketch: DataFrame, min_group: int = MIN_GROUP, reach: float = REACH) -> DataFrame:
    """``(lang, source)`` with lowest and highest accepted value of each measure."""
    levels = ((("lang", "source"), 0), (("lang",), 1), ((), 2))
    groups = sketch.select("lang", "source").distinct()
    best = None
    for names, level in levels:
        q = _quantiles(sketch, list(names))
        renamed = q.select(*(F.col(n).alias(f"q_{n}") for n in names), *(c for c in q.columns if c not in names), F.lit(level).alias("level"))
        if not names:
            # One row per measure, to every group.
            part = groups.withColumn("measure", F.explode(F.array(*(F.lit(m) for m in RATIOS)))).join(renamed, "measure")
        else:
            part = groups.join(renamed, reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"q_{n}")) for n in names)))
        part = part.select("lang", "source", "measure", "level", "size", "q1", "q3", "some", "s1", "s3")
        best = part if best is None else best.unionByName(part)
    own = lambda c, level: F.max(F.when(F.col("level") == level, F.col(c)))
    every = best.groupBy("lang", "source", "measure").agg(*(own(c, k).alias(f"{c}_{k}") for c in ("size", "q1", "q3", "some", "s1", "s3") for k in range(3)))

    def blended(value: str, size: str) -> Column:
        """Of the corpus, the language and the group, each drawn to the one before as ``min_group`` rows would."""
        out = F.col(f"{value}_2").cast("double")
        for k in (1, 0):
            n = F.col(f"{size}_{k}")
            out = F.coalesce((n * F.col(f"{value}_{k}") + min_group * out) / (n + min_group), out)
        return out

    chosen = every.select(
        "lang", "source", "measure", *(blended(c, "size").alias(c) for c in ("q1", "q3")), *(blended(c, "some").alias(c) for c in ("s1", "s3")),
    )
    out = []
    for m, (_, _, low_too, slack) in RATIOS.items():
        spread = (F.col("q3") - F.col("q1")) * F.lit(reach)
        sparse = F.least(F.lit(float(slack)), F.col("s3") + (F.col("s3") - F.col("s1")) * F.lit(reach))
        pick = lambda c, m=m: F.max(F.when(F.col("measure") == m, c))
        out.append(pick(F.when(F.col("q3") == 0, sparse).otherwise(F.col("q3") + spread + slack)).alias(f"{m}_high"))
        if low_too:
            out.append(pick(F.col("q1") - spread - slack).alias(f"{m}_low"))
    return chosen.groupBy(F.col("lang").alias("l_lang"), F.col("source").alias("l_source")).agg(*out)


def judged(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source", min_group: int = MIN_GROUP, reach: float = REACH) -> DataFrame:
    """Every row's measures, ``base_failed``, ``outlier`` and ``kept``."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = staged(measured(named).withColumn("base_failed", base_failed()), "measures")
    bounds = staged(limits(sketches(rows.filter(~F.col("base_failed"))), min_group, reach), "limits")
    met = rows.join(bounds, F.col("lang").eqNullSafe(F.col("l_lang")) & F.col("source").eqNullSafe(F.col("l_source")), "left")
    outside = []
    for m, (a, b, low_too, _) in RATIOS.items():
        outside.append(_ratio(a, b) > F.col(f"{m}_high"))
        if low_too:
            outside.append(_ratio(a, b) < F.col(f"{m}_low"))
    outlier = F.coalesce(reduce(or_, outside), F.lit(False))
    return met.withColumn("outlier", ~F.col("base_failed") & outlier).withColumn("kept", ~F.col("base_failed") & ~F.col("outlier")).drop("l_lang", "l_source")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )
