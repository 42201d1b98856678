"""Fuzzy join: the best dictionary entries for each text, without comparing all pairs.

Candidates rest on a pigeonhole argument, made once for two readings of a text.  Take the
reading S that a scorer compares: all words (``ratio``, ``partial_ratio``, ``token_sort_ratio``)
or each distinct word once (``token_set_ratio``).  If the shorter of two compared texts of length
n scores at least c, at most ``k = (1 - c) / c * n`` edits separate it from what it is compared
with; an edit can spoil one of ``k + 1`` disjoint stretches inside its words, so one of them stands
unchanged inside a word of the other.  In ``token_set_ratio`` the texts compared are the shared
words with or without either side's own; if there is a shared word at all, each of its
stretches stands on both sides, and if there is none, the own words are compared as above.

So each side offers, for either reading, its ``k + 1`` disjoint stretches to the runs of
characters inside the words of the other in an equi-join.  A stretch that is offered several
times counts once for each place in the first reading, since an edit spoils one place only;
the filter keeps distinct pieces until the places they cover reach ``k + 1``, the rarest on the
other side first.

Low cutoffs ask for more stretches than a text has letters.  A pair that scores above zero still
shares one character, so all letters are offered then, and the blank between words; that is
complete, and as broad as such a cutoff is.  ``block_on`` is the normal way to keep joins small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.similarity import MEASURES, SCORERS, normalise, similarities, words

_SLACK = 1e-9
#: Runs of characters are no longer than this; shorter stretches only propose more.
LONGEST = 12


def _longest_stretch(cutoff: float) -> int:
    """``k + 1`` stretches fit into n characters, so none need exceed ``c / (1 - c)``.

    A stretch may always be shorter: any prefix of an unspoilt stretch is unspoilt too.
    """
    return max(1, min(LONGEST, math.ceil(cutoff / (1 - cutoff) - _SLACK) if cutoff < 1 else LONGEST))


def _readings(text: Column) -> Column:
    """The words of a text, and each of them once."""
    every = words(normalise(text))
    return F.array(every, F.array_distinct(every))


def _stretches(texts: DataFrame, text: str, cutoff: float) -> DataFrame:
    """Disjoint equal-length stretches of each reading: ``reading, piece, places, need``.

    The length is the largest that yields the ``need`` stretches asked for, one character if none does.
    """
    base = (
        texts.select("*", F.posexplode(_readings(F.col(text))).alias("reading", "_words"))
        .filter(F.size("_words") > 0)
        .withColumn("_length", F.length(F.array_join("_words", " ")))
        .withColumn("need", F.floor(F.lit((1 - cutoff) / cutoff + _SLACK) * F.col("_length") + _SLACK) + 1)
    )
    longest = F.least(
        F.array_max(F.transform("_words", F.length)), F.lit(_longest_stretch(cutoff))
    )
    enough = F.filter(
        F.sequence(longest, F.lit(1), F.lit(-1)),
        lambda g: F.aggregate(
            "_words", F.lit(0).cast("bigint"), lambda n, w: n + F.floor(F.length(w) / g)
        )
        >= F.col("need"),
    )
    sized = base.withColumn("_g", F.coalesce(F.try_element_at(enough, F.lit(1)), F.lit(1)))
    blanks = F.when(F.try_element_at(enough, F.lit(1)).isNull(), F.size("_words") - 1).otherwise(0)
    letters = F.flatten(
        F.transform(
            F.filter("_words", lambda w: F.length(w) >= F.col("_g")),
            lambda w: F.transform(
                F.sequence(F.lit(0), (F.length(w) / F.col("_g")).cast("int") - 1),
                lambda j: w.substr(j * F.col("_g") + 1, F.col("_g")),
            ),
        )
    )
    keys = [*texts.columns, "reading", "need"]
    pieces = F.concat(letters, F.array_repeat(F.lit(" "), blanks))
    return (
        sized.select(*keys, F.explode(pieces).alias("piece"))
        .groupBy(*keys, "piece").agg(F.count("*").alias("places"))
    )


def _runs(texts: DataFrame, text: str, cutoff: float) -> DataFrame:
    """Distinct runs of characters inside the words of each text, as long as stretches get."""
    limit = _longest_stretch(cutoff)
    own = F.array_distinct(words(normalise(F.col(text))))
    # Above two thirds, letters alone are as many as the stretches asked for.
    blank = F.when(
        F.lit(cutoff <= 2 / 3) & normalise(F.col(text)).contains(" "), F.array(F.lit(" "))
    ).otherwise(F.array().cast("array<string>"))
    runs = F.flatten(
        F.transform(
            own,
            lambda w: F.flatten(
                F.transform(
                    F.sequence(F.lit(1), F.length(w)),
                    lambda i: F.transform(
                        F.sequence(F.lit(1), F.least(F.lit(limit), F.length(w) - i + 1)),
                        lambda n: w.substr(i, n),
                    ),
                )
            ),
        )
    )
    return texts.select(
        *texts.columns, F.explode(F.array_distinct(F.concat(runs, blank))).alias("piece")
    )


def _proposals(offering: DataFrame, text: str, other: DataFrame, other_text: str,
               on: list[str], cutoff: float) -> DataFrame:
    """Pairs in which a needed stretch of ``text`` occurs inside a word of ``other_text``."""
    runs = _runs(other, other_text, cutoff)
    stretches = _stretches(offering, text, cutoff)
    spread = runs.groupBy(*on, "piece").agg(F.count("*").alias("freq"))
    rarest = (
        Window.partitionBy(*on, text, "reading")
        .orderBy(F.coalesce("freq", F.lit(0)), "piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    chosen = (
        stretches.join(spread, [*on, "piece"], "left")
        .withColumn("_before", F.coalesce(F.sum("places").over(rarest), F.lit(0)))
        .filter((F.col("_before") < F.col("need")) & F.col("freq").isNotNull())
        .select(*on, text, "piece")
        .distinct()
    )
    return chosen.join(runs, [*on, "piece"]).select(*on, text, other_text)


def fuzzy_candidates(inputs: DataFrame, targets: DataFrame, cutoff: float,
                     on: list[str] | None = None) -> DataFrame:
    """Distinct (``input``, ``target``) pairs, a superset of those scoring ``cutoff``."""
    on = on or []
    forth = _proposals(inputs, "input", targets, "target", on, cutoff)
    back = _proposals(targets, "target", inputs, "input", on, cutoff)
    return forth.unionByName(back).distinct()


def _edit_cutoff(cutoff: float, measure: str) -> float:
    """The cutoff whose edits allow for all that ``measure`` lets pass.

    Texts of lengths n <= m with 2L / (n + m) >= c (whole points: half a point less) differ by n + m - 2L insertions
    and deletions.  L <= n bounds m by n (2 / c - 1), and so these by 2 n (1 - c) / c: twice what the same cutoff allows
    for edits, which is what c / (2 - c) allows.
    """
    if measure == "edits":
        return cutoff
    c = max(cutoff - 0.005, 0.001)
    return c / (2 - c)


def fuzzy_match(
    inputs: DataFrame, targets: DataFrame, cutoff: float = 0.90, top_n: int = 3,
    block_on: list[str] | None = None, measure: str = "edits",
) -> DataFrame:
    """Matches of each distinct ``input`` among the distinct ``target`` values: ``input, match``.

    An input that is itself a target matches only itself.  Otherwise each scorer puts
    forward its ``top_n`` best targets of at least ``cutoff`` (equal scores in alphabetical
    order), and all of them are returned once.  ``block_on`` names columns of both sides
    that must agree, such as the make.  ``measure`` is that of the scores (``similarity.MEASURES``).
    """
    if not 0 < cutoff <= 1:
        raise ValueError("cutoff must be above 0 and at most 1")
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {list(MEASURES)}")
    on = block_on or []
    inputs = inputs.select(*on, "input").distinct()
    targets = targets.select(*on, "target").distinct()
    same = targets.withColumnRenamed("target", "input")
    exact = inputs.join(same, [*on, "input"], "left_semi").select(
        *on, "input", F.col("input").alias("match")
    )
    open_inputs = inputs.join(same, [*on, "input"], "left_anti")
    pairs = fuzzy_candidates(open_inputs, targets, _edit_cutoff(cutoff, measure), on).withColumns(
        {"_a": normalise(F.col("input")), "_b": normalise(F.col("target"))}
    )
    scores = F.array(
        *[F.struct(F.lit(s).alias("scorer"), F.col(s).alias("score")) for s in SCORERS]
    )
    scored = (
        similarities(pairs, "_a", "_b", measure)
        .select(*on, "input", "target", F.inline(scores))
        .filter(F.col("score") >= cutoff)
    )
    best = Window.partitionBy(*on, "input", "scorer").orderBy(F.desc("score"), "target")
    near = (
        scored.withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= top_n)
        .select(*on, "input", F.col("target").alias("match"))
        .distinct()
    )
    return exact.unionByName(near)
