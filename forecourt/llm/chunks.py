"""Texts as chunks of word codes, and answers to what chunks ask of the whole corpus.

A chunk is a run of rows of one input partition with some megabytes of text, turned into numbers once:
a word list of its own and a code per word.  Whole texts stay in one chunk, so a window never crosses
chunks; a text longer than a chunk's size is a chunk by itself.  Later steps read chunks, not texts, and
send one entry per chunk and distinct key, so a key that a third of the corpus has costs a chunk one entry.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a chunk, a longer single text apart.
CHUNK_BYTES = 1 << 22
#: Code of a word: its place in the chunk's list, from 1.  0 ends a piece, SKIP is no word.
BREAK, SKIP = 0, -1
Split = Callable[[bytes], list[bytes]]


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.words) + 1
        self.words.append(word)
        return code


class _Chunk:
    def __init__(self, fixed: dict[bytes, int]):
        self.codes = _Codes(fixed)
        self.codes.words = []
        self.ids, self.lens, self.parts, self.bytes = [], [], [], 0

    def add(self, row_id, text: bytes, split: Split) -> None:
        words = split(text)
        found = np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words))
        found = found[found != SKIP]
        self.ids.append(row_id)
        self.lens.append(len(found))
        self.parts.append(found)
        self.bytes += len(text)


def chunked(docs: DataFrame, split: Split, id_col: str, text_col: str, group_col: str | None = None, fixed: dict[bytes, int] | None = None, size: int = CHUNK_BYTES) -> DataFrame:
    """``(chunk, grp, ids, lens, total, packed, codes)``: rows of one value of ``group_col`` to a chunk.

    ``split`` gives the words of a text's UTF-8 bytes (null: none), none of which may hold a blank; ``fixed`` holds codes
    known before, for ends of pieces and what is no word.  ``ids`` and ``lens`` are the rows' ids and numbers of codes,
    ``total`` the number of words.  ``packed`` and ``codes`` are the word list and the codes, compressed, as ``words_of``
    and ``codes_of`` read them.
    Chunk numbers are unique and stay as they are once the table is written.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = pa.array([], _arrow(kind)).type
    group = F.col(group_col).cast("string") if group_col else F.lit(None).cast("string")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, open_chunks = TaskContext.get().partitionId(), 0, {}

        def closed(keys: list) -> pa.RecordBatch:
            nonlocal made
            rows: dict[str, list] = {k: [] for k in ("chunk", "grp", "ids", "lens", "total", "packed", "codes")}
            for key in keys:
                c = open_chunks.pop(key)
                codes = np.concatenate(c.parts)
                rows["chunk"].append((task << 32) + made)
                rows["grp"].append(key)
                rows["ids"].append(c.ids)
                rows["lens"].append(c.lens)
                words = c.codes.words
                rows["total"].append(int((codes != BREAK).sum()))
                rows["packed"].append(small(b" ".join(words)))
                rows["codes"].append(small(codes.astype(_kind(len(words))).tobytes()))
                made += 1
            return pa.RecordBatch.from_arrays([
                pa.array(rows["chunk"], pa.int64()), pa.array(rows["grp"], pa.string()), pa.array(rows["ids"], pa.list_(id_type)),
                pa.array(rows["lens"], pa.list_(pa.int32())), pa.array(rows["total"], pa.int64()), pa.array(rows["packed"], pa.binary()), pa.array(rows["codes"], pa.binary()),
            ], list(rows))

        held = 0
        for batch in batches:
            for row_id, key, text in zip(*batch.columns, strict=True):
                key, data = key.as_py(), (text.as_py() or "").encode("utf-8")
                chunk = open_chunks.get(key)
                if chunk is not None and chunk.bytes + len(data) > size:
                    held -= chunk.bytes
                    yield closed([key])
                    chunk = None
                if chunk is None:
                    chunk = open_chunks[key] = _Chunk(fixed or {})
                chunk.add(row_id.as_py(), data, split)
                held += len(data)
                if held > 8 * size:  # many groups with little each
                    yield closed(list(open_chunks))
                    held = 0
        for key in list(open_chunks):
            yield closed([key])

    schema = f"chunk bigint, grp string, ids array<{kind}>, lens array<int>, total bigint, packed binary, codes binary"
    return docs.select(F.col(id_col).alias("id"), group.alias("grp"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, schema)


def _kind(words: int) -> str:
    return "<u2" if words < 1 << 16 else "<i4"


def small(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def large(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def words_of(packed: bytes) -> list[bytes]:
    data = large(packed)
    return data.split(b" ") if data else []


def codes_of(codes: bytes, n_words: int) -> np.ndarray:
    return np.frombuffer(large(codes), _kind(n_words)).astype(np.int32)


def _arrow(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(kind))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them over the whole range."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def by_shard(top: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(shard, start, end) of sorted 64-bit numbers by their leading bits."""
    if not len(top):
        return []
    shard = (top >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(top), np.int64)
    starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    return [(int(shard[a]), int(a), int(b)) for a, b in zip(starts, [*starts[1:], len(top)], strict=True)]


def answered(rows: DataFrame) -> DataFrame:
    """``(chunk, answers)``: a chunk's answers ``rows(chunk, shard, bits)`` in one row."""
    return rows.groupBy(F.col("chunk").alias("to_chunk")).agg(F.collect_list(F.struct("shard", "bits")).alias("answers"))


def unpacked(answers: list[dict] | None, slices: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """A chunk's answers as one flag per entry; a shard that does not answer says no."""
    out = np.zeros(n, bool)
    bits = {x["shard"]: x["bits"] for x in answers or ()}
    for shard, a, b in slices:
        if shard in bits:
            out[a:b] = np.unpackbits(np.frombuffer(bits[shard], np.uint8), count=b - a).astype(bool)
    return out
