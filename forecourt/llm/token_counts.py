"""Operator 10: token counts from an exact histogram of encoded lengths.

Every text is encoded in full by a public tokenizer and counted under its length in tokens; the
histogram is the only thing that is aggregated.  Sums over it from either end answer every question on
context limits exactly: documents and tokens in all, quantiles of length, documents longer than a
limit, and the tokens left if every text is truncated at it.

Sums over lengths run in two steps, within blocks of ``BLOCK`` lengths and over the blocks' totals, so no
task holds all lengths.

Cases: null and empty texts have length 0; repeated rows count each; an empty table gives an empty
result; strings of special tokens in a text are ordinary text.  Other columns are not read.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forecourt.llm.common import staged

BLOCK = 1024


def ranks(path: str | None = None) -> dict[bytes, int]:
    """A vocabulary file of token and rank by line."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def histogram(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, pre_split: str | None = None) -> DataFrame:
    """``(length, n_docs)`` over all rows."""
    held = docs.sparkSession.sparkContext.broadcast((ranks(vocabulary), pre_split or pattern()))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        merges, split = held.value
        encode = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=merges, special_tokens={}).encode_ordinary
        seen: Counter[int] = Counter()
        for batch in batches:
            seen.update(len(encode(text)) if (text := value.as_py()) else 0 for value in batch.column(0))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["length", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(lengths, "length bigint, n bigint")
    return counted.groupBy("length").agg(F.sum("n").alias("n_docs"))


def by_limit(lengths: DataFrame) -> DataFrame:
    """What each limit that equals some length leaves: a row per length of ``lengths(length, n_docs)``.

    n_docs: of that length; docs_upto, docs_from: no longer, no shorter; tokens_from: of the latter;
    truncated_tokens: all tokens if every text is cut at the length; total_docs, total_tokens; quantile:
    the part of documents no longer.  Between two lengths a < b a limit L leaves
    truncated_tokens(b) - (b - L) * docs_from(b).
    """
    cells = staged(lengths.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn("tokens", F.col("length") * F.col("n_docs")), "lengths")
    later = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    sums = cells.groupBy(F.col("block").alias("b")).agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t")).select(
        "b", *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in "dt"), *(F.sum(c).over(whole).alias(f"{c}_all") for c in "dt"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = cells.withColumn("d_here", F.sum("n_docs").over(inside)).withColumn("t_here", F.sum("tokens").over(inside)).join(sums, F.col("block") == F.col("b"))
    docs_from, tokens_from = F.col("d_later") + F.col("d_here"), F.col("t_later") + F.col("t_here")
    return met.select(
        "length", "n_docs", (F.col("d_all") - docs_from + F.col("n_docs")).alias("docs_upto"), docs_from.alias("docs_from"), tokens_from.alias("tokens_from"),
        (F.col("t_all") - tokens_from + F.col("length") * docs_from).alias("truncated_tokens"), F.col("d_all").alias("total_docs"), F.col("t_all").alias("total_tokens"),
        ((F.col("d_all") - docs_from + F.col("n_docs")) / F.col("d_all")).alias("quantile"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_limit(histogram(spark.read.parquet(f"{sf_dir}/documents.parquet")))
