"""String similarities between 0 and 1.

Two measures: ``edits``, built on Spark's own edit distance, and ``characters``, twice the characters that both
texts have in the same order over the length of both, in whole points (hundredths).
All take *normalised* text (see :func:`normalise`), whose words are blank-separated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise(text: Column) -> Column:
    """Lower case, everything but letters and digits blank, words one blank apart."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def ratio(a: Column, b: Column) -> Column:
    """One minus edit distance over the longer length; 0 if either is empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(
        1 - F.levenshtein(a, b) / longer
    )


#: Characters held in one bit mask; a sum of two masks and a carry stays within 64 bits.
_MASK = 60


def matched_characters(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, by bit masks.

    Bit i of V is 0 where the subsequence grows at character i of ``a``.  For each character of ``b``, with M the
    mask of its places in ``a``, V becomes (V + (V and M)) or (V and not M); texts over ``_MASK`` characters
    take several masks, through which the sum carries.
    """
    zero = F.lit(0).cast("bigint")
    chars = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: x.substr(i, F.lit(1)))
    size = F.length(a)
    blocks = F.sequence(F.lit(0), F.floor((size - 1) / _MASK).cast("int"))
    full = F.transform(blocks, lambda k: _ones(F.least(size - k * _MASK, F.lit(_MASK))))

    def places(letters: Column, letter: Column) -> Column:
        return F.transform(blocks, lambda k: F.aggregate(
            F.transform(F.slice(letters, k * _MASK + 1, _MASK), lambda x, i: F.when(x == letter, _bit(i)).otherwise(zero)), zero, lambda s, x: s + x,
        ))

    def step(v: Column, m: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        whole = F.aggregate(
            blocks, F.struct(zero.alias("carry"), empty.alias("out")),
            lambda s, k: _bound(
                F.struct(F.get(v, k).alias("v"), F.get(m, k).alias("m"), F.get(full, k).alias("f")),
                lambda x: _bound(
                    x["v"] + x["v"].bitwiseAND(x["m"]) + s["carry"],
                    lambda total: F.struct(
                        F.shiftright(total, _MASK).alias("carry"),
                        F.concat(s["out"], F.array(total.bitwiseOR(x["v"].bitwiseAND(F.bitwise_not(x["m"]))).bitwiseAND(x["f"]))).alias("out"),
                    ),
                ),
            ),
        )
        return whole["out"]

    def counted(letters: Column) -> Column:
        distinct = F.array_distinct(letters)
        masks = F.map_from_arrays(distinct, F.transform(distinct, lambda x: places(letters, x)))
        last = _bound(masks, lambda table: F.aggregate(
            chars(b), full, lambda v, x: _bound(F.try_element_at(table, x), lambda m: F.when(m.isNull(), v).otherwise(step(v, m))),
        ))
        return size - F.aggregate(F.transform(last, lambda v: F.bit_count(v).cast("int")), F.lit(0), lambda s, x: s + x)

    return F.when((a == "") | (b == ""), 0).when(a == b, size).otherwise(_bound(chars(a), counted))


def _bound(value: Column, use) -> Column:
    """``use(value)``, the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def _ones(n: Column) -> Column:
    return _bit(n) - 1


def matched_ratio(a: Column, b: Column) -> Column:
    """Twice the matched characters over both lengths, rounded to whole points (halves up); 0 if either is empty."""
    both = F.length(a) + F.length(b)
    points = F.floor((400 * matched_characters(a, b) + both) / (2 * both))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(points / 100)


MEASURES = {"edits": ratio, "characters": matched_ratio}


def partial_ratio(short: Column, long: Column, measure: str = "edits") -> Column:
    """Best ratio of the shorter text with a stretch of its length in the longer one."""
    size = F.length(short)
    starts = F.sequence(F.lit(1), F.length(long) - size + 1)
    best = F.array_max(F.transform(starts, lambda i: _bound(long.substr(i, size), lambda x: MEASURES[measure](short, x))))
    return (
        F.when(size == 0, F.lit(0.0)).when(long.contains(short), F.lit(1.0)).otherwise(best)
    )


def similarities(pairs: DataFrame, a: str, b: str, measure: str = "edits") -> DataFrame:
    """Add the four scores of columns ``a`` and ``b`` to each row.

    ``ratio`` compares the texts as they are; ``partial_ratio`` the shorter one with
    stretches of the longer; ``token_sort_ratio`` their words in alphabetical order; and
    ``token_set_ratio`` takes the best among: the shared words, those plus a's own, those
    plus b's own.  Intermediate texts are bound in projections, so each is made once.
    """
    c = F.col
    a_first = F.length(a) <= F.length(b)
    sorted_words = lambda x: F.array_sort(words(c(x)))
    bound = pairs.withColumns(
        {
            "_short": F.when(a_first, c(a)).otherwise(c(b)),
            "_long": F.when(a_first, c(b)).otherwise(c(a)),
            "_wa": sorted_words(a),
            "_wb": sorted_words(b),
        }
    ).withColumns(
        {
            "_shared": F.array_intersect("_wa", "_wb"),
            "_only_a": F.array_except("_wa", "_wb"),
            "_only_b": F.array_except("_wb", "_wa"),
        }
    )
    joined = bound.withColumns(
        {
            "_sa": F.array_join("_wa", " "),
            "_sb": F.array_join("_wb", " "),
            "_t0": F.array_join("_shared", " "),
            "_t1": F.array_join(F.concat("_shared", "_only_a"), " "),
            "_t2": F.array_join(F.concat("_shared", "_only_b"), " "),
        }
    )
    ratio = MEASURES[measure]
    pairwise = [ratio(c(x), c(y)) for x, y in (("_t0", "_t1"), ("_t0", "_t2"), ("_t1", "_t2"))]
    return joined.select(
        *pairs.columns,
        ratio(c(a), c(b)).alias("ratio"),
        partial_ratio(c("_short"), c("_long"), measure).alias("partial_ratio"),
        ratio(c("_sa"), c("_sb")).alias("token_sort_ratio"),
        F.greatest(*pairwise).alias("token_set_ratio"),
    )


SCORERS = ["ratio", "partial_ratio", "token_sort_ratio", "token_set_ratio"]
