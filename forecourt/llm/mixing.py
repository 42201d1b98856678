"""Operator 7: mixing sources to target weights by entropy balancing.

Each source gets a target in words: shares by weight, at most ``most`` times the source's own words,
the excess shared out again by weight among the others until none is above.  Document rates are those
closest in relative entropy to one copy each that meet the targets, with no rate above ``most``: the
dual is convex with one multiplier per source, and its solution tilts exponentially,

    rate = min(most, exp(multiplier * size / mean size of the source)).

Newton iterations find all multipliers at once.  The words that given multipliers take depend on
(source, size) alone, so the corpus is reduced to a histogram of sizes by source once, and each
iteration is one aggregate over it, joined with the table of multipliers.  Steps that leave the
bracket known so far are replaced by its middle, so an iteration at least halves it.  Contributions
are summed as decimals: the result is the same however rows are dealt, and reruns agree.

Rates become whole copies by systematic rounding along the sizes of a source, largest first: the running
sum of the rates' fractions gives a copy whenever it passes a whole number and a half.  The words taken
then differ from the target by half the source's largest document at most.  Positions within equal sizes come from a hash of
the id by way of counted buckets, so no task holds a source.

Cases: a null text has no words and a rate of 1 (no words are taken); a source with no words has target
0; a null source is a source, the last; a null id is kept; rows repeated in full are told apart
by position only; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forecourt.llm.common import WORD, Staged, rank_in_groups, staged

MOST = 2.0
SHARE = 1.5
WEIGHTS = (3, 1, 2)
#: Newton stops when every source is within this part of its target.
TOLERANCE = 1e-7
#: Fractions of rates are rounded as whole numbers of this part of a copy.
UNIT = 10**6


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources(source, source_size)`` with ``weight`` and ``target``.

    A target is least(limit, level * weight) with the level at which targets add up to the share.
    Sources reach their limit in the order of limit / weight, so the level follows from running sums
    in that order.  This is a table of sources, not of documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    at = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (at + 1).cast("int"))
    known = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(most)).withColumn("full_at", F.col("limit") / F.col("weight"))
    everything = Window.orderBy("full_at", F.col("source").isNull(), F.col("source"))
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    after = everything.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    levels = known.select(
        "*",
        ((F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)).alias("level"),
    )
    # The level is that of the first source that does not reach its limit at it.
    first = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("full_at", F.col("source").isNull().alias("n"), "source", "level"))).over(whole)["level"]
    return levels.select("source", "source_size", "weight", F.coalesce(F.least("limit", first * F.col("weight")), F.col("limit")).alias("target"))


def _rate(multiplier: Column, size: Column, mean: Column, most: float) -> Column:
    return F.least(F.lit(most), F.exp(F.least(multiplier * size / mean, F.lit(50.0))))


def multipliers(histogram: DataFrame, goals: DataFrame, most: float = MOST, max_rounds: int = 60) -> DataFrame:
    """``goals`` with ``mean`` and ``multiplier``; histogram(source, size, n)."""
    means = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    right = means.withColumnRenamed("source", "m_source")
    full = F.col("target") >= F.col("source_size") * F.lit(most)
    state = Staged(
        goals.join(right, F.col("source").eqNullSafe(F.col("m_source"))).drop("m_source")
        .select("*", full.alias("full"), F.lit(0.0).alias("multiplier"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), (full | (F.col("source_size") == 0)).alias("done")), "multipliers",
    )
    for _ in range(max_rounds):
        if state.df.filter(~F.col("done")).isEmpty():
            return state.df.select("source", "source_size", "target", "mean", "full", "multiplier")
        s = state.df
        cells = histogram.join(s.filter(~F.col("done")).select(F.col("source").alias("s_source"), "multiplier", "mean"), F.col("source").eqNullSafe(F.col("s_source")))
        rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"), most)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = cells.groupBy("s_source").agg(F.sum(words.cast("decimal(38,6)")).cast("double").alias("words"), F.sum(slope.cast("decimal(38,6)")).cast("double").alias("slope"))
        off = F.col("words") - F.col("target")
        low, high = F.when(off < 0, F.col("multiplier")).otherwise(F.col("low")), F.when(off > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - F.try_divide(off, F.col("slope"))
        middle = F.when(F.col("low").isNull(), F.least(F.col("high") * 2, F.col("high") - 1)).when(F.col("high").isNull(), F.greatest(F.col("low") * 2, F.col("low") + 1)).otherwise((F.col("low") + F.col("high")) / 2)
        inside = newton.isNotNull() & (F.col("low").isNull() | (newton > F.col("low"))) & (F.col("high").isNull() | (newton < F.col("high"))) & (F.abs(newton - F.col("multiplier")) <= 4)
        near = (F.abs(off) <= F.greatest(F.col("target") * F.lit(TOLERANCE), F.lit(1e-3))) | (F.col("high") - F.col("low") <= 1e-13)
        fields = [c for c in s.columns]
        stepped = (
            s.join(sums, F.col("source").eqNullSafe(F.col("s_source")), "left")
            .withColumn("low", F.when(F.col("done"), F.col("low")).otherwise(low)).withColumn("high", F.when(F.col("done"), F.col("high")).otherwise(high))
            .withColumn("stop", F.col("done") | F.coalesce(near, F.lit(False)))
            .withColumn("multiplier", F.when(F.col("stop"), F.col("multiplier")).when(inside, newton).otherwise(middle))
            .withColumn("done", F.col("stop")).select(*fields)
        )
        following = Staged(stepped, "multipliers")
        state.drop()
        state = following
    raise RuntimeError(f"multipliers not found in {max_rounds} rounds")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", extra: Column | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(id, extra, source, size, source_size, target, rate, copies)`` of every row.

    ``extra`` is a column carried along (null if not given).
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = staged(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), F.xxhash64(F.col(id_col)).alias("r"), (F.lit(None) if extra is None else extra).cast("long").alias("extra")), "word_counts")
    histogram = staged(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sources = staged(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "sources")
    found = staged(multipliers(histogram, staged(targets(sources, weights, share, most), "targets"), most), "found")
    rate = F.when(F.col("full"), F.lit(float(most))).when(F.col("size") == 0, F.lit(1.0)).otherwise(_rate(F.col("multiplier"), F.col("size"), F.col("mean"), most))
    # Along the sizes of a source, largest first: the fractions of all larger sizes, as whole millionths.
    whole, millionths = F.floor(F.col("rate")), F.round((F.col("rate") - F.floor("rate")) * UNIT).cast("long")
    cells = (
        histogram.join(found.withColumnRenamed("source", "f_source"), F.col("source").eqNullSafe(F.col("f_source")))
        .withColumn("rate", rate).withColumn("whole", whole.cast("long")).withColumn("part", millionths)
        .select("source", "size", "source_size", "target", "rate", "whole", "part", (F.col("part") * F.col("n")).alias("parts"))
    )
    span = 1 << 10
    blocks = cells.withColumn("block", F.floor(F.col("size") / span))
    in_block = Window.partitionBy("source", "block").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    over_blocks = Window.partitionBy("b_source").orderBy(F.desc("b_block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        blocks.groupBy(F.col("source").alias("b_source"), F.col("block").alias("b_block")).agg(F.sum("parts").alias("p"))
        .withColumn("base", F.coalesce(F.sum("p").over(over_blocks), F.lit(0)))
    )
    placed = staged(
        blocks.withColumn("inner", F.coalesce(F.sum("parts").over(in_block), F.lit(0)))
        .join(totals, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block")))
        .select(F.col("source").alias("c_source"), F.col("size").alias("c_size"), "source_size", "target", "rate", "whole", "part", (F.col("base") + F.col("inner")).alias("before")), "cells",
    )
    ranked = rank_in_groups(rows, ["source", "size"], [F.col("r"), F.col("id"), F.col("extra")], "k")
    start = f"before + k * part + {UNIT // 2}L"
    copies = F.expr(f"whole + ({start} + part) div {UNIT}L - ({start}) div {UNIT}L")
    return (
        ranked.join(placed, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")))
        .select("id", "extra", "source", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"))
    )


def copied(docs: DataFrame) -> DataFrame:
    """``docs``, each row as often as the mix takes it (columns as before).

    Rows are found again by id, source and a 64-bit hash of their text.  Rows alike in these share their
    copies: each is taken the whole part of the mean times, and one of them also what is left over.
    """
    key = ["doc_id", "source", "__text"]
    rows = docs.withColumn("__text", F.xxhash64("text"))
    taken = (
        mix(docs, extra=F.xxhash64("text")).groupBy(F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("extra").alias("__extra"))
        .agg(F.sum("copies").alias("__n"), F.count(F.lit(1)).alias("__of"))
    )
    met = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("__text") == F.col("__extra")))

    def repeated(df: DataFrame, times: Column) -> DataFrame:
        return df.withColumn("__times", times).filter("__times > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)

    each = repeated(met, F.expr("cast(__n div __of as int)"))
    left = repeated(met.filter("__n % __of > 0").dropDuplicates(key), F.expr("cast(__n % __of as int)"))
    return each.unionByName(left)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
