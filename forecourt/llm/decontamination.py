"""Operator 4: benchmark decontamination with a distributed positional inverted index.

*Index.*  The words of all documents are stored as postings in segments of about ``SEGMENT_BYTES`` of
text: for each term of a segment the ascending positions at which it stands, documents set apart by
a gap that no window spans.  A segment is one row of a table in the shared folder; it holds whole
documents (a longer one is a segment alone) and is made by one task as it reads, without a shuffle.

*Search.*  Test items are cut into windows of ``window`` consecutive words.  In each segment a window's
terms are taken from the rarest on: the positions of the rarest, less its offset in the window, are the
possible starts; each further term's offset-adjusted list is intersected with them until none is left
or all terms have been met.  What is left are the exact occurrences.  With ``slop`` the same lists are
also met loosely: a *proximity* match has every term within ``slop`` words of its place.

Items come to the tasks as broadcasts of bounded size: the test set is split into as many parts as its
bytes need at ``PART_BYTES`` each, every part is searched in the whole index, and the parts' matches are
put together per document.  Documents are never compared or grouped with each other, so passages that
many documents share cost only their matches.

Cases: null and blank texts have no words and no hits; an item without words gives no window and a
shorter one than ``window`` is one window; a null item id counts as the empty string; items that repeat
an id or a text are matched each; null document ids and repeated documents keep their rows; an empty
corpus gives an empty result, an empty test set gives no hits.  Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import staged

SEGMENT_BYTES = 1 << 20
PART_BYTES = 8 << 20
#: No window may be longer than the gap between documents, less the slop.
GAP = 1024
_SPACES = [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
#: A-Z in lower case; 0-9, a-z and all beyond ASCII as they are; everything else separates words.
TABLE = bytes(b + 32 if 65 <= b <= 90 else 32 if b in set(_SPACES) else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(TABLE).split() if text else []


def _segment(docs: list[tuple[object, list[bytes]]]) -> dict:
    vocabulary: dict[bytes, int] = defaultdict(count().__next__)
    ids, starts, at = [], [], 0
    for _, words in docs:
        ids.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
        starts.append(at)
        at += len(words) + GAP
    flat = np.concatenate(ids)
    positions = np.concatenate([np.arange(s, s + len(x), dtype=np.int32) for s, x in zip(starts, ids, strict=True)])
    kind = np.uint16 if len(vocabulary) < 1 << 16 else np.int32
    order = np.argsort(flat.astype(kind), kind="stable")
    return {
        "segment": uuid.uuid4().hex, "ids": [d for d, _ in docs], "starts": starts, "n_words": [len(x) for x in ids],
        "terms": b" ".join(vocabulary), "counts": np.bincount(flat, minlength=len(vocabulary)).astype(np.int32).tobytes(),
        "positions": positions[order].tobytes(),
    }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index as a table of segments: ids, starts and n_words by document; terms, counts, positions."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"segment string, ids array<{kind}>, starts array<bigint>, n_words array<bigint>, terms binary, counts binary, positions binary"
    id_type = docs.select(F.array(id_col).alias("a")).limit(0).toArrow().schema.field("a").type

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field("segment", pa.string()), pa.field("ids", id_type), pa.field("starts", pa.list_(pa.int64())), pa.field("n_words", pa.list_(pa.int64()))]
        arrow = pa.schema(fields + [pa.field(n, pa.binary()) for n in ("terms", "counts", "positions")])
        docs_, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text := text.as_py())
                docs_.append((doc_id, words))
                held += len(text or "") + 64
                if held >= SEGMENT_BYTES:
                    yield pa.RecordBatch.from_pylist([_segment(docs_)], arrow)
                    docs_, held = [], 0
        if docs_:
            yield pa.RecordBatch.from_pylist([_segment(docs_)], arrow)

    made = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(segments, schema)
    return staged(made, "postings", compression="zstd")


def _windows(items: list[tuple[str, str | None]], window: int) -> tuple[list[bytes], list[list[str]], np.ndarray, np.ndarray]:
    """The distinct windows of some items: their terms; the items each comes from; length; term numbers.

    Rows of term numbers are padded with the number of terms.
    """
    terms: dict[bytes, int] = defaultdict(count().__next__)
    rows: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for name, text in items:
        ids = [terms[w] for w in words_of(text)]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            rows[tuple(ids[i:i + window])].add(name)
    matrix = np.array([r + (len(terms),) * (window - len(r)) for r in rows], np.int32).reshape(-1, window)
    return list(terms), [sorted(v) for v in rows.values()], np.array([len(r) for r in rows], np.int32), matrix


def _met(starts: np.ndarray, places: np.ndarray, offset: int, slop: int) -> np.ndarray:
    """Those starts that have a place within ``slop`` of start + offset."""
    i = np.searchsorted(places, starts + (offset - slop))
    near = places[np.minimum(i, len(places) - 1)]
    return starts[(i < len(places)) & (near <= starts + (offset + slop))]


def _search(wanted: list[bytes], lengths: np.ndarray, matrix: np.ndarray, terms: bytes, counts: np.ndarray, positions: np.ndarray, slops: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(window, slop, starts) of every match in a segment."""
    here = {t: i for i, t in enumerate(terms.split(b" "))} if terms else {}
    at = np.array([here.get(t, -1) for t in wanted] + [-2], np.int64)
    n = np.where(at >= 0, counts[np.maximum(at, 0)] if len(counts) else 0, np.where(at == -2, np.iinfo(np.int64).max, 0))
    ends = np.cumsum(counts, dtype=np.int64)
    frequency = n[matrix]
    for w in np.nonzero(frequency.min(axis=1) > 0)[0] if len(matrix) else ():
        row = matrix[w, :lengths[w]]
        rarest_first = np.argsort(frequency[w, :len(row)], kind="stable")
        for slop in slops:
            starts = None
            for k in rarest_first:
                t = at[row[k]]
                places = positions[ends[t] - counts[t]:ends[t]]
                starts = places - int(k) if starts is None else _met(starts, places, int(k), slop)
                if not len(starts):
                    break
            if len(starts):
                yield int(w), slop, starts


def _spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Union of the intervals start .. end (excluded), as maximal intervals."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.nonzero(np.r_[True, starts[1:] > reach[:-1]])[0]
    last = np.r_[first[1:] - 1, len(starts) - 1]
    return list(zip(starts[first].tolist(), reach[last].tolist(), strict=True))


def matches(index: DataFrame, items: DataFrame, item_id: str = "item_id", text_col: str = "text", window: int = 10, slop: int = 0) -> DataFrame:
    """``(segment, ordinal, id, n_words, spans, items, near_items)``: one row per document of the index.

    ``spans``: maximal runs of words (from, to excluded) inside exact occurrences; ``items``: ids of the
    items whose windows occur; ``near_items``: of those that have a proximity match (if ``slop`` > 0).
    """
    if window + 2 * slop >= GAP:
        raise ValueError(f"windows and slop must stay below {GAP} words")
    spark = index.sparkSession
    tests = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(text_col).alias("text")).dropna(subset=["text"]).distinct()
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("name")), F.lit(0))).first()[0]
    parts = int(size // PART_BYTES) + 1
    kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"segment string, ordinal int, id {kind}, n_words bigint, spans array<struct<s:bigint,e:bigint>>, items array<string>, near_items array<string>"
    id_type = index.select("ids").limit(0).toArrow().schema.field("ids").type.value_type
    span = pa.list_(pa.struct([pa.field("s", pa.int64()), pa.field("e", pa.int64())]))
    out = None
    for part in range(parts):
        mine = tests.filter(F.pmod(F.xxhash64("name", "text"), F.lit(parts)) == part).collect()
        held = spark.sparkContext.broadcast(_windows([(r["name"], r["text"]) for r in mine], window))

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            wanted, names_of, lengths, matrix = held.value
            arrow = pa.schema([
                pa.field("segment", pa.string()), pa.field("ordinal", pa.int32()), pa.field("id", id_type), pa.field("n_words", pa.int64()),
                pa.field("spans", span), pa.field("items", pa.list_(pa.string())), pa.field("near_items", pa.list_(pa.string())),
            ])
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {name: batch.column(name)[i] for name in batch.schema.names}
                    ids, starts, n_words = row["ids"].values, np.array(row["starts"].values), row["n_words"].values
                    counts, positions = (np.frombuffer(row[k].as_buffer(), np.int32) for k in ("counts", "positions"))
                    found, exact, near = defaultdict(list), defaultdict(set), defaultdict(set)
                    for w, loose, at in _search(wanted, lengths, matrix, row["terms"].as_py(), counts, positions, (0, slop) if slop else (0,)):
                        doc = np.searchsorted(starts, at + loose, side="right") - 1
                        for d in np.unique(doc).tolist():
                            (near if loose else exact)[d].update(names_of[w])
                            if not loose:
                                mine = at[doc == d] - starts[d]
                                found[d].append((mine, mine + lengths[w]))
                    spans = [[{"s": s, "e": e} for s, e in _spans(*(np.concatenate(x) for x in zip(*found[d], strict=True)))] if d in found else [] for d in range(len(ids))]
                    names = [pa.array([sorted(x[d]) if d in x else [] for d in range(len(ids))], pa.list_(pa.string())) for x in (exact, near)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["segment"].as_py()] * len(ids)), pa.array(range(len(ids)), pa.int32()), ids, n_words, pa.array(spans, span), *names], schema=arrow,
                    )

        one = index.mapInArrow(search, schema)
        out = one if out is None else out.unionByName(one)
    if parts == 1:
        return out
    # A document has one row for each part of the test set.
    joined = out.groupBy("segment", "ordinal").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"),
    )
    return joined.select("segment", "ordinal", "id", "n_words", "spans", "items", "near_items")


def hit_words() -> F.Column:
    """Words in the union of ``spans``, which may overlap but are sorted by their starts."""
    return F.aggregate(
        "spans", F.struct(F.lit(0).cast("bigint").alias("reach"), F.lit(0).cast("bigint").alias("n")),
        lambda a, x: F.struct(F.greatest(a["reach"], x["e"]).alias("reach"), (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["reach"]), F.lit(0))).alias("n")),
        lambda a: a["n"],
    )


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 10, slop: int = 0) -> DataFrame:
    """``(id, n_words, n_hit, items, near_items)`` of every row of ``docs``."""
    found = matches(build_index(docs, id_col, text_col), items, window=window, slop=slop)
    return found.select("id", "n_words", hit_words().alias("n_hit"), "items", "near_items")


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the documents that hold a window of an item (columns as before).

    Contamination is a matter of the text alone, so rows are told by their text's SHA-256: null ids and
    repeated rows are treated right.
    """
    texts = docs.select(F.sha2("text", 256).alias("digest"), "text")
    bad = contamination(texts, items, id_col="digest", window=window).filter("n_hit > 0").select(F.col("id").alias("__bad")).distinct()
    return docs.join(bad, F.sha2(docs["text"], 256) == F.col("__bad"), "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    out = contamination(docs, items, window=10, slop=2)
    names = F.array_sort("items")
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size(F.array_except("near_items", "items")).cast("long").alias("n_near_items"),
    )
