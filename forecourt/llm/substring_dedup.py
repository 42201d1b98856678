"""Operator 13: repeated runs of words by difference-cover anchors.

A window is ``window`` consecutive words of one text.  Every word covered by a window whose word
sequence starts at any other place too, in the same or another text, is marked: all occurrences, the
first included.  Windows are judged on the input.

*Anchors.*  A difference cover D of a period v has, for any two positions i and j, a shift d < v with
(i + d) mod v and (j + d) mod v both in D.  Two equal windows at i and j so contain equal stretches of
``window - v + 1`` words at i + d and j + d, both at cover positions.  Only these stretches are hashed and
looked up at first: |D| of every v positions (5 of 21 for 35 words).

*Extension.*  A stretch found twice may be part of a longer match: it is extended over every window that
holds it (up to v - 1 words to the left), and these candidate windows are compared as wholes, by
128 bits of hash over all their words.  All places of one sequence are settled by one count; no pairs are made.

*At scale.*  Texts are turned into chunks of word codes once (``chunks``).  A chunk sends its distinct
keys, sorted and cut by their leading bits into shards of about a million keys, and gets back one bit for
each; a sequence that occurs everywhere costs a chunk one key.  Shards are ranges of well mixed hashes, so
they are even whatever the texts repeat.  Two rounds (stretches, windows), and a chunk is read three times.

Cases: a null, empty or blank text has no words; a text of fewer words than a window has no window; copies,
also repeated rows and rows of one id, repeat each other in whole; null ids are carried along; an empty table
gives an empty result; columns of ``docs`` other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.chunks import answered, by_shard, chunked, codes_of, mix, unpacked, words_of
from forecourt.llm.common import Staged, staged

# Difference covers by period (each difference modulo the period occurs).
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
SHARD_KEYS = 1 << 20
BASE = 0x9E3779B97F4A7C15


def period_for(window: int) -> int:
    """The longest period that leaves a stretch of two fifths of the window."""
    return max(v for v in COVERS if window - v + 1 >= max(1, 2 * window // 5))


def _rolling(values: np.ndarray, length: int) -> np.ndarray:
    """A polynomial hash, modulo 2**64, of every stretch of ``length`` values."""
    n = len(values)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum(values * down, out=upto[1:])
    return (upto[length:] - upto[:-length]) * up[length - 1:]


class _Words:
    """A chunk's words as two lanes of hashes, and what windows its texts have."""

    def __init__(self, row: dict, window: int):
        self.window, self.v = window, period_for(window)
        self.words = data = words_of(row["packed"])
        self.codes, self.lens = codes_of(row["codes"], len(data)), np.array(row["lens"], np.int64)
        at = self.codes - 1
        self.lanes = [np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in data), np.uint64, len(data))[at] for seed in (1, 2)]
        first = np.repeat(np.cumsum(self.lens) - self.lens, self.lens)
        self.pos = np.arange(len(at)) - first
        self.left = np.repeat(self.lens, self.lens) - self.pos

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(places, entry of each place, sorted distinct keys, whether a key occurs twice here)"""
        stretch = self.window - self.v + 1
        cover = np.zeros(self.v, bool)
        cover[list(COVERS[self.v])] = True
        fits = (self.left >= stretch) & (self.left + self.pos >= self.window) & cover[self.pos % self.v]
        at = np.flatnonzero(fits)
        keys, entry, n = np.unique(mix(_rolling(self.lanes[0], stretch)[at]), return_inverse=True, return_counts=True)
        return at, entry, keys, n > 1

    def candidates(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows round stretches found twice: (places, entry, sorted distinct keys, their other halves, whether twice here)"""
        step = np.zeros(len(self.codes) + 1, np.int64)
        np.add.at(step, places - np.minimum(self.v - 1, self.pos[places]), 1)
        np.add.at(step, places + 1, -1)
        at = np.flatnonzero((np.cumsum(step)[:-1] > 0) & (self.left >= self.window))
        a, b = (mix(_rolling(lane, self.window)[at]) for lane in self.lanes)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
        entry = np.empty(len(a), np.int64)
        entry[order] = np.cumsum(new) - 1
        return at, entry, a[new], b[new], np.bincount(entry, minlength=int(new.sum())) > 1

    def covered(self, places: np.ndarray) -> np.ndarray:
        step = np.zeros(len(self.codes) + 1, np.int64)
        step[places] += 1
        step[places + self.window] -= 1
        return np.cumsum(step)[:-1] > 0


_ASKED = "shard int, chunk bigint, a binary, b binary, twice binary"


def _asked(chunk: int, bits: int, a: np.ndarray, b: np.ndarray | None, twice: np.ndarray) -> pa.RecordBatch:
    rows = [(shard, chunk, a[x:y].tobytes(), b"" if b is None else b[x:y].tobytes(), np.packbits(twice[x:y]).tobytes()) for shard, x, y in by_shard(a, bits)]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["shard", "chunk", "a", "b", "twice"])


def _met(table: pa.Table) -> pa.Table:
    """The keys of one shard from all chunks: which occur twice, told to each chunk that has one."""
    chunks, a, b, twice = (table.column(k).to_pylist() for k in ("chunk", "a", "b", "twice"))
    keys = np.concatenate([np.frombuffer(x, "<u8") for x in a])
    ends = np.cumsum([len(x) // 8 for x in a])
    many = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=len(x) // 8) for t, x in zip(twice, a, strict=True)]).astype(bool)
    if any(b):
        other = np.concatenate([np.frombuffer(x, "<u8") for x in b])
        order = np.lexsort((other, keys))
        new = np.r_[True, (np.diff(keys[order]) != 0) | (np.diff(other[order]) != 0)]
    else:
        order = np.argsort(keys, kind="stable")
        new = np.r_[True, np.diff(keys[order]) != 0]
    group = np.cumsum(new) - 1
    seen = np.bincount(group) + np.bincount(group, weights=many[order]).astype(np.int64)
    flags = np.empty(len(keys), bool)
    flags[order] = (seen > 1)[group]
    told = [(c, flags[e - len(x) // 8:e]) for c, x, e in zip(chunks, a, ends, strict=True)]
    told = [(c, f) for c, f in told if f.any()]
    shard = table.column("shard")[0].as_py()
    return pa.table([
        pa.array([c for c, _ in told], pa.int64()), pa.array([shard] * len(told), pa.int32()),
        pa.array([np.packbits(f).tobytes() for _, f in told], pa.binary()),
    ], ["chunk", "shard", "bits"])


def _told(asked: DataFrame, label: str) -> DataFrame:
    answers = asked.groupBy("shard").applyInArrow(_met, "chunk bigint, shard int, bits binary")
    return answered(staged(answers, label))


def repeated_words(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, spans, kept)`` of every row: the runs [start, end) of marked words, and the words
    that are left, joined by one space."""
    if window < 1:
        raise ValueError("a window has one word at least")
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = Staged(chunked(docs, lambda text: text.split(), id_col, text_col), "chunks", compression="zstd").df
    words = chunks.agg(F.sum(F.aggregate("lens", F.lit(0).cast("bigint"), lambda s, x: s + x))).first()[0] or 0
    bits = max(0, (words // (4 * SHARD_KEYS)).bit_length())
    texts = chunks.select("chunk", "ids", "lens", "packed", "codes")

    def of(row: dict) -> _Words:
        return _Words(row, window)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.slice(i, 1).to_pylist()[0]

    def ask_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            _, _, keys, twice = of(row).anchors()
            yield _asked(row["chunk"], bits, keys, None, twice)

    def windows(row: dict, text: _Words):
        at, entry, keys, _ = text.anchors()
        found = unpacked(row["answers"], by_shard(keys, bits), len(keys))
        return text.candidates(at[found[entry]])

    def ask_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            _, _, a, b, twice = windows(row, of(row))
            yield _asked(row["chunk"], bits, a, b, twice)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            text = of(row)
            at, entry, a, _, _ = windows(row, text)
            found = unpacked(row["window_answers"], by_shard(a, bits), len(a))
            marked = text.covered(at[found[entry]])
            names, spans, kept, start = [b"", *text.words], [], [], 0
            for n in row["lens"]:
                own = marked[start:start + n]
                edges = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
                spans.append([{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)])
                kept.append(b" ".join(map(names.__getitem__, text.codes[start:start + n][~own].tolist())).decode("utf-8"))
                start += n
            yield pa.RecordBatch.from_arrays([
                batch_ids(row["ids"]), pa.array(row["lens"], pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.string()),
            ], ["id", "n_words", "spans", "kept"])

    id_type = chunks.schema["ids"].dataType.elementType

    def batch_ids(values: list) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type

        return pa.array(values, to_arrow_type(id_type))

    stretches = _told(texts.mapInArrow(ask_stretches, _ASKED), "stretches")
    asked = texts.join(stretches, F.col("chunk") == F.col("to_chunk"))
    told = _told(asked.mapInArrow(ask_windows, _ASKED), "windows").select(F.col("to_chunk").alias("w_chunk"), F.col("answers").alias("window_answers"))
    both = stretches.join(told, F.col("to_chunk") == F.col("w_chunk"), "left")
    ready = texts.join(both, F.col("chunk") == F.col("to_chunk"), "left")
    return ready.mapInArrow(mark, f"id {kind}, n_words bigint, spans array<struct<start:int,end:int>>, kept string")


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet"), window=35)
    return found.select(
        F.col("id").alias("doc_id"), "n_words",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"]).alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM win) WHERE n > 1
), gone AS (
  SELECT DISTINCT r, i + k AS p FROM twice, generate_series(0, 34) AS g(k)
), words AS (
  SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
