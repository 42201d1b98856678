"""Operator 1: SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits, one for each bit position that is set in more than half of the hashes
of a text's word shingles.  Two fingerprints link at ``max_bits`` or fewer differing bits.

*Finding links.*  The fingerprint is split into ``segments``.  If two fingerprints differ in at
most r bits, then for radii r_1 .. r_m with sum(r_i) = r - m + 1 some segment i differs in at most
r_i bits.  Each distinct fingerprint is filed once per segment under the segment's value; it looks
up every value in the Hamming ball of radius r_i round its own segment, and each match is kept only
if the complete distance is within ``max_bits``.

*Crowded segments.*  A segment value under which more than ``crowd`` fingerprints are filed (a large
family of near copies) would give all their pairs.  Those fingerprints are filed a second time under
whole fingerprints instead: both ends list all points within half of ``max_bits`` of themselves, and
fingerprints that share a point are compared with the point's smallest one (the sum of both radii is
``max_bits``, so they link, by way of it, exactly if they link).  A point can gather no more
fingerprints than its ball holds, and each list is linear in the input.

Texts only travel into the fingerprint stage; every later table holds fingerprints and ids.

Cases: null and blank texts have fingerprint zero and link like any other; fewer words than a
shingle form one shingle; repeated rows and equal texts share a fingerprint; a null id is carried
along and never names a component; an empty table gives an empty result.  Other columns of the input
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import connected_components, staged

SEED = 42
#: Hashes turned into bits at a time, so that a long text takes little memory.
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int) -> int:
    words = text.encode("utf-8").lower().split() if text else ()
    if not words:
        return 0
    if len(words) <= shingle:
        pieces = [b" ".join(words)]
    else:
        pieces = [b" ".join(x) for x in zip(*(words[i:] for i in range(shingle)), strict=False)]
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, len(pieces), BLOCK):
        block = np.fromiter((digest(p, SEED) for p in pieces[start:start + BLOCK]), "<u8")
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(pieces), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` for every row; fp is the fingerprint as a signed 64-bit integer."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(of, f"id {kind}, fp bigint")


def _ball(lo: int, width: int, radius: int) -> list[int]:
    """Masks (signed 64 bit) that flip up to ``radius`` of the bits lo .. lo+width-1."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(lo, lo + width), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _segments(count: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(low bit, width, radius) of each segment."""
    cuts = [64 * i // count for i in range(count + 1)]
    total = max_bits - count + 1
    radii = [total // count + (i < total % count) for i in range(count)] if total >= 0 else [0] * count
    return [(lo, hi - lo, r) for lo, hi, r in zip(cuts, cuts[1:], radii, strict=False)]


def links(fps: DataFrame, max_bits: int = 2, segments: int = 2, crowd: int = 256) -> DataFrame:
    """Links ``(a, b)``, a < b, between the distinct fingerprints ``fps(fp)``.

    All pairs within ``max_bits``, but for those that meet in a crowded segment alone: there each
    fingerprint has links that join it to all it is within ``max_bits`` of, perhaps by way of others.
    """
    if segments > max_bits + 1:
        raise ValueError("more segments than max_bits + 1 leave a radius below zero")
    spec = _segments(segments, max_bits)
    masks = [(lo, w, sum(1 << b for b in range(lo, lo + w))) for lo, w, _ in spec]

    def value(fp, k: int):
        lo, width, _ = masks[k]
        return F.shiftrightunsigned(fp, lo).bitwiseAND((1 << width) - 1) if width < 64 else fp

    fp = F.col("fp")
    filed = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(k).alias("seg"), value(fp, k).alias("value")) for k in range(segments)))).alias("f")).select("fp", "f.seg", "f.value")
    crowded = staged(filed.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("seg", "value"), "crowded")
    shelf = filed.join(crowded, ["seg", "value"], "left_anti").withColumnRenamed("fp", "other")
    probes = None
    for k, (lo, width, radius) in enumerate(spec):
        ball = F.array(*(F.lit(m).cast("bigint") for m in _ball(lo, width, radius)))
        part = fps.select("fp", F.lit(k).alias("seg"), F.explode(ball).alias("flip")).select("fp", "seg", value(F.col("fp").bitwiseXOR(F.col("flip")), k).alias("value"))
        probes = part if probes is None else probes.union(part)
    found = (
        probes.join(shelf, ["seg", "value"])
        .filter((F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits))
        .select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
    )
    # Crowded values: whoever is filed there or looks there meets at points half-way.
    whole = fps.join(probes.join(crowded, ["seg", "value"]).select("fp").distinct(), "fp", "left_semi")
    near, far = max_bits // 2, max_bits - max_bits // 2
    point = lambda radius: whole.select("fp", F.explode(F.array(*(F.lit(m).cast("bigint") for m in _ball(0, 64, radius)))).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point"))
    if near == far:
        at = point(near)
        hubs = at.groupBy("point").agg(F.min("fp").alias("hub"), F.max("fp").alias("top")).filter("hub < top").select("point", "hub")
        met = at.join(hubs, "point").filter("fp > hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    else:
        met = (
            point(far).join(point(near).withColumnRenamed("fp", "other"), "point").filter(F.col("fp") != F.col("other"))
            .select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
        )
    met = met.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return found.union(met).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, segments: int = 2, crowd: int = 256) -> DataFrame:
    """``(id, fp, component_id)`` for every row: the smallest id reachable over links, itself included."""
    prints = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "nodes")
    parts = connected_components(links(nodes.select("fp"), max_bits, segments, crowd))
    named = (
        nodes.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left")
        .select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    )
    first = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_print = staged(named.join(first, "component").select("fp", "component_id"), "components")
    return prints.join(of_print, "fp").select("id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id, then hash of its text.

    Columns as in ``docs``.  Rows without an id come after those with one.  Rows of one id and one text
    are told apart by a number that each row of the staged input gets.
    """
    row = "__row"
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    prints = staged(fingerprints(numbered, row, "text", shingle), "fingerprints")
    parts = connected_components(links(prints.select("fp").distinct(), max_bits, 2))
    of_row = prints.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left").select(F.col("id").alias("r"), F.coalesce("component", "fp").alias("component"))
    # Smallest by (has no id, id, hash of text, row number); texts do not travel.
    rank = numbered.select(F.col(row), F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.col(row).alias("r")).alias("rank"))
    kept = of_row.join(rank, F.col("r") == F.col(row)).groupBy("component").agg(F.min("rank").alias("least")).select(F.col("least.r").alias("__kept"))
    return numbered.join(kept, F.col(row) == F.col("__kept"), "left_semi").drop(row)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, max_bits=2)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
