"""Helpers shared by the operators: staged tables, ordered prefix sums, connected components.

Intermediate tables go to the folder that the session names in ``spark.checkpoint.dir``, which
all executors and the driver share, so they outlive lost executors.  Only where the setting is
absent (tests, a local session) is a folder below ``spark.sql.warehouse.dir`` used.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words in the contracts of operators 1, 7 and 8: the six ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged").rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


class Staged:
    """A table written to the shared folder: ``df`` reads it, ``drop()`` removes it.

    What is not dropped goes when the application ends.
    """

    def __init__(self, df: DataFrame, label: str, **options: str):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/{label}-{uuid.uuid4().hex}"
        schema = df.schema
        df.write.options(**options).parquet(self.path)
        # Shuffle files of finished plans go with their objects; else they wait for the driver's next collection.
        gc.collect()
        self.spark._jvm.System.gc()
        jpath, fs = _file_system(self.spark, self.path)
        fs.deleteOnExit(jpath)
        self.df = self.spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        jpath, fs = _file_system(self.spark, self.path)
        fs.delete(jpath, True)


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    return Staged(df, label, **options).df


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of constants as a native plan (no Python scan); numbers and strings only."""
    kinds = [part.strip().split(" ", 1) for part in schema.split(",")]
    cells = [F.struct(*(F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, kinds, strict=True))) for row in rows or [(None,) * len(kinds)]]
    return spark.range(1 if rows else 0).select(F.inline(F.array(*cells)))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def rank_in_groups(df: DataFrame, group: list[str], order: list[Column], out: str, buckets: int = 4096) -> DataFrame:
    """``out``: position 0, 1, ... of each row in its group, without holding a group in one task.

    ``order`` starts with a column of hash values: rows are dealt by it into ``buckets``, counted by
    bucket (map-side sums), and numbered within their bucket in the given order; a bucket starts after
    the rows of the buckets before it.  Only ``buckets`` counts per group meet in one task.  Rows equal
    in all of ``order`` get their positions in any order.
    """
    b = "__bucket"
    dealt = df.withColumn(b, F.pmod(F.shiftrightunsigned(order[0].cast("long"), 1), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(*group, b).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *(F.col(g).alias(f"__g_{g}") for g in group), F.col(b).alias("__b"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
    )
    match = [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in group] + [F.col(b) == F.col("__b")]
    condition = match[0]
    for part in match[1:]:
        condition = condition & part
    within = Window.partitionBy(*group, b).orderBy(*order)
    return (
        dealt.withColumn("__rank", F.row_number().over(within))
        .join(starts, condition)
        .withColumn(out, (F.col("__start") + F.col("__rank") - 1).cast("long"))
        .drop(b, "__rank", "__start", "__b", *(f"__g_{g}" for g in group))
    )


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Components of an undirected graph given as ``edges(a bigint, b bigint)``.

    Returns ``(node, component)``, the component named by its smallest node.  Each round takes the
    smallest label among the neighbours and then the label of that label (pointer jumping), so
    labels travel twice as far every round; a round's labels are written to the shared folder and
    the table before it is dropped.  The driver sees one count per round, no labels.  Raises if
    ``max_rounds`` do not suffice rather than return parts.
    """
    both = Staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = Staged(both.df.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    for _ in range(max_rounds):
        near = both.df.join(labels.df, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("__near"))
        step = (
            labels.df.join(near, F.col("node") == F.col("a"))
            .select("node", F.col("label").alias("old"), F.least("label", "__near").alias("label"))
        )
        stepped = Staged(step, "labels")
        of_label = stepped.df.select(F.col("node").alias("__n"), F.col("label").alias("__l"))
        jumped = Staged(
            stepped.df.join(of_label, F.col("label") == F.col("__n"))
            .select("node", F.col("__l").alias("label"), (F.col("__l") != F.col("old")).alias("moved")), "labels",
        )
        moved = not jumped.df.filter("moved").isEmpty()
        stepped.drop()
        labels.drop()
        labels = jumped
        if not moved:
            both.drop()
            return labels.df.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components still change after {max_rounds} rounds")
