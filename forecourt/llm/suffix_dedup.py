"""Operator 3: removal of repeated byte strings with a column-wise multi-document suffix order.

A byte is removed if it is covered by a ``span``-byte string that also starts in a document with a
smaller id.  Strings never cross documents and are judged on the input.

*Dividing the suffix order.*  A collection that no task could hold is cut so that equal windows (strings of
``span`` bytes) always meet.  Every window has a key, the least hash among its ``GRAM``-byte grams, which
its bytes alone decide.  Neighbouring windows of one key make a *segment* of at most ``MOST_WINDOWS``
windows.  Keys seen in one document only cannot repeat across documents: keys are counted, packed by
bucket, those of several documents are marked in a bitmap of bounded size, and segments whose key is not
marked are left out.  (False marks only cost work; a bitmap that fills up lets everything through.)
Equal segments are one, with the smallest and largest id they occur in.  Where a key has one segment only,
that settles it; segments that differ and share a key are dealt by key and put in order.

*Column-wise construction.*  A task takes its segments in blocks, cut between keys, and builds the
Burrows-Wheeler transform of the block's collection from the right: each round inserts one symbol of every
segment, that is its next longer suffix, into the order of all suffixes inserted so far.  The place follows
from counting the symbol in the transform before the place of the shorter suffix; the common prefix with
the neighbours is one more than the least common prefix between neighbouring occurrences of the symbol.
Transform, common prefixes and suffix numbers are sequential files, by first symbol; a round reads them once
from front to back and writes them anew with the insertions.  At the end, neighbours that share ``span``
symbols are the repeated windows; the smallest id of each such run decides.

*Hot keys.*  Segments of a key with more than ``HOT`` distinct segments (a common phrase in ever different
surroundings) would all go to one task.  Their windows are grouped by their bytes instead, with map-side
minima, which gives the same answer.

*Result.*  A segment that also occurs in a document with a smaller id is removed whole there; in its first
document the windows found above are.  Places come back to the documents by (id, hash of the text).

Cases: a null text is empty; texts shorter than ``span`` keep all; a row with a null id neither removes
nor loses anything; rows that repeat an id do not remove from each other; an empty table gives an empty
result.  Other columns are not read.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import Staged, staged

SPAN = 50
GRAM = 24
MOST_WINDOWS = 32
HOT = 4096
BLOCK_BYTES = 8 << 20
KEYS_AT_ONCE = 1 << 19
BATCH_BYTES = 1 << 16
#: Bits of the bitmap for each marked key, and its largest size (32 MB).
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 20, 28
MIX, POWER = np.uint64(0x9E3779B97F4A7C15), 0x100000001B3


def _runs(data: np.ndarray, ends: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(start, windows, key) of the segments of concatenated documents that end at ``ends``.

    Also the hashes of all grams and the least of each window.
    """
    none = np.zeros(0, np.int64)
    if len(data) < span:
        return none, none, none.astype(np.uint64), none, none
    # Hashes of grams of 1, 2, 4, ... bytes, each from two halves; then of the rest of ``gram``.
    h, width, power = (data.astype(np.uint64) + np.uint64(1)) * MIX, 1, POWER
    parts = [(1, h, power)]
    while width * 2 <= gram:
        h, power, width = h[:-width] * np.uint64(power) + h[width:], power * power % (1 << 64), width * 2
        parts.append((width, h, power))
    left = gram - width
    for size, part, by in reversed(parts[:-1]):
        if size <= left:
            n = len(h) - size
            h, left, width = h[:n] * np.uint64(by) + part[width:width + n], left - size, width + size
    h ^= h >> np.uint64(29)
    h *= MIX
    h ^= h >> np.uint64(32)
    least, width, windows = h, 1, span - gram + 1
    while width * 2 <= windows:
        least, width = np.minimum(least[:-width], least[width:]), width * 2
    if width < windows:
        least = np.minimum(least[:len(least) - (windows - width)], least[windows - width:])
    change = np.empty(len(least), bool)
    change[0] = True
    np.not_equal(least[1:], least[:-1], out=change[1:])
    change[ends[ends < len(least)]] = True
    starts = np.nonzero(change)[0]
    # A run ends at the next change or with the last window of its document.
    until = np.minimum(np.append(starts[1:], len(least)), ends[np.searchsorted(ends, starts, side="right")] - span + 1)
    starts, until = starts[until > starts], until[until > starts]
    pieces = -(-(until - starts) // MOST_WINDOWS)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(starts, pieces) + nth * MOST_WINDOWS
    # Least hashes are small numbers: mixed again, so that leading bits are even.
    key = (least[first] + np.uint64(1)) * MIX
    key ^= key >> np.uint64(31)
    return first, np.minimum(np.repeat(until, pieces) - first, MOST_WINDOWS), key * MIX, h, least


def _anchors(first: np.ndarray, windows: np.ndarray, h: np.ndarray, least: np.ndarray, places: int) -> np.ndarray:
    """Offset of the gram that decides the key in each segment; -1 if it is not one for all windows."""
    offset = np.full(len(first), -1)
    open_ = np.arange(len(first))
    for d in range(places):
        hit = h[first[open_] + d] == least[first[open_]]
        offset[open_[hit]] = d
        open_ = open_[~hit]
    return np.where(offset + 1 < windows, -1, offset)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, bytes, np.ndarray]]:
    """(ids, text hashes, bytes, ends) of documents with a text and an id, some megabytes at a time."""
    ids, marks, texts, size = [], [], [], 0
    for batch in batches:
        for doc_id, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            text = text.as_py()
            ids.append(doc_id)
            marks.append(mark)
            texts.append(text)
            size += len(text)
            if size >= BATCH_BYTES:
                yield ids, marks, b"".join(texts), np.cumsum([len(t) for t in texts])
                ids, marks, texts, size = [], [], [], 0
    if texts:
        yield ids, marks, b"".join(texts), np.cumsum([len(t) for t in texts])


def _bitmap(cells: DataFrame, bits: int) -> np.ndarray:
    """Bits set at the numbers in ``cells(cell)``, collected as 32-bit words, of a size known before."""
    words = cells.groupBy(F.shiftright("cell", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 31 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (bits - 5), np.uint32)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return bitmap


def _bits_for(n: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (n * BITS_PER_KEY).bit_length()))


def _repeated_keys(docs: DataFrame, span: int, gram: int) -> tuple[np.ndarray, int]:
    """Bitmap of the keys that occur in more than one row.

    Keys are shortened to 44 bits and travel packed: the leading bits choose a bucket, a row has a
    batch's keys of a bucket.  A task counts the keys of one bucket at a time.
    """
    spark = docs.sparkSession
    bucket_bits = (16 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            keys = np.sort(np.concatenate(held))
            bucket = (keys >> np.uint64(44 - bucket_bits)).astype(np.int32)
            cuts = np.nonzero(np.r_[True, bucket[1:] != bucket[:-1]])[0]
            low = (keys & np.uint64((1 << (44 - bucket_bits)) - 1)).astype(np.uint64)
            wide = np.uint64 if 44 - bucket_bits > 32 else np.uint32
            body = low.astype(wide).tobytes()
            step = np.dtype(wide).itemsize
            at = np.append(cuts, len(keys)) * step
            return pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), pa.array([body[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())], ["bucket", "keys"])

        for _, _, data, ends in _batches(batches):
            first, _, key, *_ = _runs(np.frombuffer(data, np.uint8), ends, span, gram)
            doc = np.searchsorted(ends, first, side="right").astype(np.uint64)
            # One of each key and document: 44 bits of key, 20 of the document's place in the batch.
            pair = np.unique((key & ~np.uint64((1 << 20) - 1)) | doc) >> np.uint64(20)
            held.append(pair)
            size += len(pair)
            if size >= KEYS_AT_ONCE:
                yield flush()
                held.clear()
                size = 0
        if size:
            yield flush()

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.uint64 if 44 - bucket_bits > 32 else np.uint32
        bucket, held = None, []

        def counted() -> pa.RecordBatch:
            keys = np.sort(np.concatenate(held))
            same = keys[1:] == keys[:-1]
            twice = keys[1:][same & np.r_[True, ~same[:-1]]] if len(same) else keys[:0]
            return pa.RecordBatch.from_arrays([pa.array((twice.astype(np.int64)) | (bucket << (44 - bucket_bits)))], ["key"])

        for batch in batches:
            for b, keys in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if b != bucket and held:
                    yield counted()
                    held = []
                bucket = b
                held.append(np.frombuffer(keys.as_py(), wide))
        if held:
            yield counted()

    dealt = docs.mapInArrow(packed, "bucket int, keys binary").repartition("bucket").sortWithinPartitions("bucket")
    keys = staged(dealt.mapInArrow(repeated, "key bigint"), "keys")
    bits = _bits_for(keys.count())
    return _bitmap(keys.select(F.shiftright("key", 44 - bits).alias("cell")), bits), bits


def _segments(docs: DataFrame, bitmap: np.ndarray, bits: int, span: int, gram: int, kind: str, with_bytes: bool) -> DataFrame:
    """``(key, sid, id, mark, start, windows)`` of every segment with a marked key, or ``(key, sid, id, bytes, anchor)``."""
    held = docs.sparkSession.sparkContext.broadcast((bitmap, bits))
    names = ["key", "sid", "id", "bytes", "anchor"] if with_bytes else ["key", "sid", "id", "mark", "start", "windows"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits = held.value
        for ids, marks, data, ends in _batches(batches):
            first, windows, key, h, least = _runs(np.frombuffer(data, np.uint8), ends, span, gram)
            cell = key >> np.uint64(64 - bits)
            keep = (bitmap[cell >> np.uint64(5)] >> (cell & np.uint64(31)).astype(np.uint32)) & 1 != 0
            first, windows, key = first[keep], windows[keep], key[keep]
            if not len(first):
                continue
            doc = np.searchsorted(ends, first, side="right")
            pieces = [data[a:b] for a, b in zip(first.tolist(), (first + windows + span - 1).tolist(), strict=True)]
            sid = np.fromiter(map(xxhash.xxh3_64_intdigest, pieces), np.uint64, len(pieces)).view(np.int64)
            columns = [pa.array(key.view(np.int64)), pa.array(sid), pa.array(ids).take(pa.array(doc))]
            if with_bytes:
                anchor = _anchors(first, windows, h, least, span - gram + 1)
                columns += [pa.array(pieces, pa.binary()), pa.array(anchor.astype(np.int32))]
            else:
                begin = np.r_[0, ends[:-1]]
                columns += [pa.array(np.array(marks, np.int32)[doc]), pa.array((first - begin[doc])), pa.array(windows.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names)

    rest = "bytes binary, anchor int" if with_bytes else "mark int, start bigint, windows int"
    return docs.mapInArrow(cut, f"key bigint, sid bigint, id {kind}, {rest}")


class _Files:
    """Transform and common prefixes of one generation, sequential by first symbol.

    A file is written over by the generation after the next, which is never shorter.
    """

    def __init__(self, folder: str, name: str, symbol: np.dtype):
        self.kinds = (symbol, np.dtype(np.uint8))
        self.files = [open(os.path.join(folder, f"{kind}-{name}"), "w+b") for kind in ("bwt", "lcp")]  # noqa: SIM115

    def rewind(self) -> None:
        for f in self.files:
            f.seek(0)

    def read(self, n: int) -> list[np.ndarray]:
        return [np.frombuffer(f.read(n * kind.itemsize), kind) for f, kind in zip(self.files, self.kinds, strict=True)]

    def write(self, columns: list[np.ndarray]) -> None:
        for f, column in zip(self.files, columns, strict=True):
            f.write(column.data)

    def close(self) -> None:
        for f in self.files:
            f.close()


def _least_between(lcp: np.ndarray, after: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """min(lcp[after + 1 .. upto]) of each pair, of which the first or the second places ascend; lcp has a place more at its end."""
    if not len(after):
        return np.zeros(0, np.uint8)
    # From the last pair to the first: what lies between two pairs is then not read.
    pairs = np.empty(2 * len(after), np.int64)
    pairs[::2], pairs[1::2] = after[::-1] + 1, upto[::-1] + 1
    return np.minimum.reduceat(lcp, pairs)[::2][::-1]


def suffix_order(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes of the strings data[begin:end], and common prefixes with the one before.

    Suffixes are numbered by their place in ``data``; empty ones are left out of the result.  Common
    prefixes stop at 255.
    """
    m, top = len(begins), int(data.max(initial=0))
    end_mark = 255 if top < 255 else 256
    symbol = np.dtype(np.uint8 if end_mark == 255 else np.uint16)
    n_symbols = end_mark + 1
    sizes = np.zeros(n_symbols, np.int64)  # of each bucket; the last bucket, read first, has the empty suffixes
    counts = np.zeros((n_symbols, n_symbols), np.int64)  # of each symbol in the transform of a bucket
    order = [end_mark, *range(end_mark)]
    # To be inserted in this round, by bucket: place, string, common prefix before and after it.
    # Places of a bucket ascend: a round finds them from its first bucket to its last.
    string = np.arange(m)
    at = ends.copy()
    bucket, place = np.full(m, end_mark), np.arange(m)
    before, after = np.zeros(m, np.uint8), np.zeros(m, np.uint8)
    old, new = _Files(folder, "0", symbol), _Files(folder, "1", symbol)
    while len(string):
        old, new = new, old
        old.rewind()
        new.rewind()
        seen = np.zeros(n_symbols, np.int64)
        by_bucket = np.argsort(bucket.astype(np.uint16), kind="stable")
        cuts = np.searchsorted(bucket[by_bucket], np.arange(n_symbols + 1)).tolist()
        following: list[tuple[np.ndarray, ...]] = []
        for z in order:
            if not sizes[z] and cuts[z] == cuts[z + 1]:
                continue
            bwt, lcp = old.read(int(sizes[z]))
            mine = by_bucket[cuts[z]:cuts[z + 1]]
            here = counts[z]
            if not len(mine):
                new.write([bwt, lcp])
                seen += here
                continue
            q = place[mine]
            size = len(bwt) + len(q)
            rest = np.ones(size, bool)
            rest[q] = False
            wider = np.empty(size + 1, np.uint8)
            wider[size] = 255
            inserted = [np.empty(size, symbol), wider[:size]]
            for column, values in zip(inserted, (bwt, lcp), strict=True):
                column[rest] = values
            bwt, lcp = inserted
            end = at[mine]
            longer = end > begins[string[mine]]
            c = np.where(longer, data[np.maximum(end - 1, 0)].astype(symbol), symbol.type(end_mark))
            bwt[q] = c
            lcp[q] = before[mine]
            # The common prefix of what follows an insertion, where that was there before.
            next_ = q + 1
            settled = (next_ < size) & np.r_[next_[:-1] != q[1:], True]
            lcp[next_[settled]] = after[mine[settled]]
            sizes[z] = size
            new.write([bwt, lcp])
            here += np.bincount(c, minlength=n_symbols)
            mine, q, c, end = mine[longer], q[longer], c[longer], end[longer]
            if len(mine):
                # The place of each next longer suffix: its symbol's occurrences up to here.
                by_symbol = np.argsort(bwt, kind="stable")
                asked = np.zeros(size, bool)
                asked[q] = True
                r = np.empty(len(q), np.int64)
                r[np.argsort(c, kind="stable")] = np.flatnonzero(asked[by_symbol])
                c = c.astype(np.int64)
                first = np.cumsum(here) - here
                low, high = np.zeros(len(q), np.uint8), np.zeros(len(q), np.uint8)
                has = r > first[c]
                low[has] = np.minimum(_least_between(wider, by_symbol[r[has] - 1], q[has]), 254)
                has = r + 1 < first[c] + here[c]
                high[has] = np.minimum(_least_between(wider, q[has], by_symbol[r[has] + 1]), 254)
                first_of_all = (seen[c] == 0) & (r == first[c])
                following.append((string[mine], end - 1, c, seen[c] + r - first[c], np.where(first_of_all, 0, low + 1).astype(np.uint8), (high + 1).astype(np.uint8)))
            seen += here
        string, at, bucket, place, before, after = (np.concatenate(x) for x in zip(*following, strict=True)) if following else (np.zeros(0, np.int64),) * 6
    new.rewind()
    bwt, lcp = new.read(int(sizes.sum()))
    old.close()
    new.close()
    # Suffix numbers: from each string's empty suffix, its next longer one is the one that stands
    # where the sorted transform has the symbol before it.
    by_symbol = np.argsort(bwt, kind="stable")
    by_symbol = by_symbol[:len(bwt) - m]  # without the end marks
    longer = np.empty(len(bwt), np.int32)
    longer[by_symbol] = np.arange(m, len(bwt), dtype=np.int32)
    number = np.empty(len(bwt), np.int32)
    place, at, string = np.arange(m), ends.copy(), np.arange(m)
    while len(place):
        open_ = at > begins[string]
        place, at, string = longer[place[open_]], at[open_] - 1, string[open_]
        number[place] = at
    return number[m:], lcp[m:]


def _found(rows: list[tuple[tuple[int, int], bytes, object]], span: int, folder: str) -> tuple[list[tuple[int, int]], list[int]]:
    """((key, sid), windows as bits) where a window of the segment is also in one with a smaller id."""
    lengths = np.array([len(b) for _, b, _ in rows], np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    data = np.frombuffer(b"".join(b for _, b, _ in rows), np.uint8)
    number, lcp = suffix_order(data, begins, ends, folder)
    _, smallest = np.unique(np.array([i for _, _, i in rows]), return_inverse=True)
    of = np.repeat(np.arange(len(rows)), lengths)[number]
    apart = np.nonzero(np.r_[True, lcp[1:] < span])[0] if len(lcp) else np.zeros(0, np.int64)
    first = np.repeat(np.minimum.reduceat(smallest[of], apart), np.diff(np.r_[apart, len(of)])) if len(of) else smallest[:0]
    hit = np.nonzero(first < smallest[of])[0]
    masks = np.zeros(len(rows), np.uint64)
    np.bitwise_or.at(masks, of[hit], np.uint64(1) << (number[hit] - begins[of[hit]]).astype(np.uint64))
    at = np.nonzero(masks)[0].tolist()
    return [rows[i][0] for i in at], masks[at].tolist()


def _related(family: list[tuple], span: int, gram: int) -> list[tuple]:
    """Of segments of one key, those that can have a window in common with another.

    A window that two segments share holds the deciding gram and, on its left or on its right, at
    least half of what else fits: segments that agree with no other in either half are left out.
    """
    if len(family) < 2:
        return []
    if any(anchor < 0 for _, _, anchor, _ in family):
        return [(name, piece, first_id) for name, piece, _, first_id in family]
    half = (span - gram) // 2
    seen: dict[tuple[int, bytes], int] = {}
    sides = []
    for _, piece, a, _ in family:
        mine = []
        if a >= half:
            mine.append((0, piece[a - half:a + gram]))
        if a - (len(piece) - span) < half:
            mine.append((1, piece[a:a + span - half + 1]))
        for s in mine:
            seen[s] = seen.get(s, 0) + 1
        sides.append(mine)
    return [(name, piece, first_id) for (name, piece, _, first_id), mine in zip(family, sides, strict=True) if any(seen[s] > 1 for s in mine)]


def _in_blocks(distinct: DataFrame, span: int, gram: int) -> DataFrame:
    """``(key, sid, mask)`` from the suffix order of the segments ``(key, sid, bytes, anchor, first_id)``."""

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:  # the task's own scratch: a lost task starts anew
            rows, size, last, family = [], 0, None, []

            def block() -> pa.RecordBatch:
                names, masks = _found(rows, span, folder) if rows else ([], [])
                return pa.RecordBatch.from_arrays([*(pa.array([n[i] for n in names], pa.int64()) for i in (0, 1)), pa.array(masks, pa.int64())], ["key", "sid", "mask"])

            for batch in batches:
                for key, sid, piece, anchor, first_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if key != last:
                        kept = _related(family, span, gram)
                        rows += kept
                        size += sum(len(b) for _, b, _ in kept)
                        family, last = [], key
                        if size >= BLOCK_BYTES:
                            yield block()
                            rows, size = [], 0
                    family.append(((key, sid), piece, anchor, first_id))
            rows += _related(family, span, gram)
            if rows:
                yield block()

    dealt = distinct.select("key", "sid", "bytes", "anchor", "first_id").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(ordered, "key bigint, sid bigint, mask bigint")


def repeated_places(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``(id, mark, places)`` of documents with repeats; docs(id, mark, text binary) without nulls.

    places: array of (start, mask): window start + b is repeated if bit b of the mask is set.
    """
    kind = docs.schema["id"].dataType.simpleString()
    cut = Staged(_segments(docs, *_repeated_keys(docs, span, gram), span, gram, kind, False), "segments", compression="zstd")
    distinct = Staged(cut.df.groupBy("key", "sid").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")), "distinct_segments", compression="zstd")
    # Only segments that differ and share a key can have windows in common.
    shared = staged(distinct.df.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("first_id").alias("low"), F.max("last_id").alias("high")).filter("n > 1 and low < high").select("key", "n"), "shared_keys")
    bits = _bits_for(shared.count())
    bitmap = _bitmap(shared.select(F.shiftrightunsigned("key", 64 - bits).alias("cell")), bits)
    differing = Staged(
        _segments(docs, bitmap, bits, span, gram, kind, True).groupBy("key", "sid", "bytes", "anchor").agg(F.min("id").alias("first_id")),
        "differing_segments", compression="zstd",
    )
    hot_keys = staged(shared.filter(F.col("n") > hot).select("key"), "hot_keys")
    in_order = _in_blocks(differing.df.join(hot_keys, "key", "left_anti"), span, gram)
    # Windows of hot keys, by their bytes.
    windows = (
        differing.df.join(hot_keys, "key", "left_semi")
        .select("key", "sid", "bytes", "first_id", F.explode(F.sequence(F.lit(0), F.length("bytes") - span)).alias("w"))
        .select("key", "sid", "first_id", "w", F.expr(f"substring(bytes, w + 1, {span})").alias("window"))
    )
    least = windows.groupBy("window").agg(F.min("first_id").alias("least"))
    by_bytes = (
        windows.join(least, "window").filter("least < first_id")
        .groupBy("key", "sid").agg(F.bit_or(F.expr("shiftleft(1L, w)")).alias("mask"))
    )
    found = staged(in_order.unionByName(by_bytes), "repeats")
    differing.drop()
    known = Staged(
        distinct.df.join(found, ["key", "sid"], "left").filter("mask is not null or last_id > first_id")
        .select("key", "sid", "first_id", F.coalesce("mask", F.lit(0)).alias("mask")), "known_segments", compression="zstd",
    )
    distinct.drop()
    whole = F.expr("shiftleft(1L, windows) - 1")
    places = staged(
        cut.df.join(known.df, ["key", "sid"])
        .select("id", "mark", "start", F.when(F.col("id") > F.col("first_id"), whole).otherwise(F.col("mask")).alias("m"))
        .filter("m != 0").groupBy("id", "mark").agg(F.collect_set(F.struct("start", "m")).alias("places")), "places", compression="zstd",
    )
    cut.drop()
    known.drop()
    return places


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, hot: int = HOT) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept)`` of every row; kept: the remaining bytes."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.shiftright(F.xxhash64(F.col(text_col)), 32).cast("int").alias("mark"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    usable = rows.filter(F.col("id").isNotNull() & (F.length("text") >= span))
    places = repeated_places(usable, span, hot=hot).withColumnsRenamed({"id": "p_id", "mark": "p_mark"})
    met = rows.join(places, (F.col("id") == F.col("p_id")) & (F.col("mark") == F.col("p_mark")), "left").select("id", "text", "places")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                text = text.as_py()
                if not found.is_valid:
                    out.append((len(text), 0, 0, text))
                    continue
                fields = found.values
                starts, masks = (fields.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                bits = (masks.view(np.uint64)[:, None] >> np.arange(MOST_WINDOWS, dtype=np.uint64)) & np.uint64(1)
                row, bit = np.nonzero(bits)
                at = starts[row] + bit
                edge = np.zeros(len(text) + 1, np.int32)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + span, -1)
                gone = np.cumsum(edge[:-1]) > 0
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(text), int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return met.mapInArrow(removed, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), span=50)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
