"""Operator 12: phrases whose words keep company, counted in counting quotient filters.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at
blanks and tabs.  Everything is counted by language.  A phrase of ``least`` occurrences or more is
scored at each cut by floor(scale * a * n / (l * r)); its lowest cut counts.  Phrases inside a longer phrase
that is as frequent (``absorb`` percent of it) are left out; the best ``top`` of each language are returned.

*Keys.*  A word of at least ``least`` occurrences gets a number in its language (words are counted by shards of their
hash, which number their frequent ones); a phrase is the packed
numbers of its words, in two or more lanes of 64 bits.  A Feistel network, a bijection of exactly those bits,
spreads the keys.  The leading bits name the shard, the next ones the quotient, and the remainder is kept in full,
so the phrase can be had back: counts are exact.

*Filters.*  ``_pack`` stores sorted distinct keys as a unary code of how many keys each quotient has, the remainders
in as few bytes as hold them, and a byte per counter (larger ones apart).  A chunk of texts (``chunks``) sends one such
filter per shard; the filters of a shard are merged, and what reaches ``least`` is told back to each chunk, one bit per key.

*Level by level.*  A phrase of k words can reach ``least`` only if both phrases of k - 1 words in it do,
so a chunk goes on with the runs of text made of frequent phrases alone.  That drops no phrase, and
only the first level sends most of the text.

*At scale.*  No vocabulary is broadcast: a chunk is told the numbers of its own words by the shards it sent them to.
Shards hold about a million keys of one language; a phrase that is everywhere costs each chunk one key, so hot
languages and hot phrases are spread.  Products are decimals of 38 digits.

Cases: a null language is ``und``; a null or empty text has no words; repeated rows count; ids are not read; an empty
table, or one without a frequent phrase, gives an empty result.  Word numbers beyond 31 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forecourt.llm.chunks import BREAK, SKIP, answered, by_shard, chunked, codes_of, large, mix, small, unpacked, words_of
from forecourt.llm.common import Staged, staged

SHARD_KEYS = 1 << 20
#: Bytes of text in a chunk: larger ones send a phrase less often.
CHUNK_BYTES = 1 << 23
ROUNDS = 4
_UPPER, _ENDS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\x0b\x0c\x0d"
_TABLE = bytes.maketrans(_UPPER + _ENDS + b"\t", _UPPER.lower() + b"\n" * len(_ENDS) + b" ")


def split(text: bytes) -> list[bytes]:
    """Words of a text, with a line end after each piece."""
    return text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ") + [b"\n"]


# --- keys


def layout(k: int, width: int) -> list[int]:
    """Words in each lane of a key of k words of ``width`` bits: two lanes or more, none over 63 bits."""
    lanes = max(2, -(-k // (63 // width)))
    return [len(x) for x in np.array_split(np.arange(k), lanes)]


def _rounds(lanes: list[np.ndarray], bits: list[int], order) -> None:
    for r in order:
        i = r % len(lanes)
        rest = np.full(len(lanes[0]), r + 1, np.uint64)
        for j, lane in enumerate(lanes):
            if j != i:
                rest = mix(rest * np.uint64(0x9E3779B97F4A7C15) + lane)
        lanes[i] = lanes[i] ^ (rest >> np.uint64(64 - bits[i]))


def permuted(grams: np.ndarray, width: int) -> list[np.ndarray]:
    """Rows of word numbers to lanes of well spread bits; ``restored`` is the way back."""
    lanes, at = [], 0
    for n in layout(grams.shape[1], width):
        lane = np.zeros(len(grams), np.uint64)
        for j in range(at, at + n):
            lane = lane << np.uint64(width) | grams[:, j].astype(np.uint64)
        lanes.append(lane)
        at += n
    bits = [n * width for n in layout(grams.shape[1], width)]
    _rounds(lanes, bits, range(ROUNDS * len(lanes)))
    return lanes


def restored(lanes: list[np.ndarray], k: int, width: int) -> np.ndarray:
    spec = layout(k, width)
    lanes = list(lanes)
    _rounds(lanes, [n * width for n in spec], reversed(range(ROUNDS * len(lanes))))
    mask = np.uint64((1 << width) - 1)
    return np.stack([(lane >> np.uint64(width * (n - 1 - j)) & mask).astype(np.int64) for lane, n in zip(lanes, spec, strict=True) for j in range(n)], axis=1)


def _distinct(lanes: list[np.ndarray], bits: list[int], counts: np.ndarray | None = None):
    """(sorted distinct keys, entry of each row, counts)"""
    n = len(lanes[0])
    if sum(bits) <= 64:
        key = lanes[0]
        for lane, b in zip(lanes[1:], bits[1:], strict=True):
            key = key << np.uint64(b) | lane
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.r_[True, key[1:] != key[:-1]] if n else np.zeros(0, bool)
    else:
        order = np.lexsort(lanes[::-1])
        new = np.zeros(n, bool)
        new[:1] = True
        for lane in lanes:
            x = lane[order]
            new[1:] |= x[1:] != x[:-1]
    entry = np.empty(n, np.int64)
    entry[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    ones = np.ones(n, np.int64) if counts is None else counts[order]
    return [lane[order][starts] for lane in lanes], entry, np.add.reduceat(ones, starts) if n else np.zeros(0, np.int64)


# --- counting quotient filters


def _narrow(x: np.ndarray, bits: int) -> bytes:
    size = -(-bits // 8)
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _wide(data: bytes, n: int, bits: int) -> np.ndarray:
    size = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size).reshape(n, size)
    return out.view("<u8").reshape(n)


def _pack(lanes: list[np.ndarray], counts: np.ndarray, bits: list[int], shard_bits: int) -> bytes:
    """Sorted distinct keys of one shard and their counts as a counting quotient filter."""
    n = len(counts)
    q = min(bits[0] - shard_bits, max(0, n.bit_length() - 1))
    low = bits[0] - shard_bits - q
    first = lanes[0] & np.uint64((1 << bits[0] - shard_bits) - 1)
    runs = np.zeros(n + (1 << q), np.uint8)  # for each quotient its keys as ones, then a zero
    runs[np.arange(n) + (first >> np.uint64(low)).astype(np.int64)] = 1
    large = counts >= 255
    head = np.array([n, q, int(large.sum())], "<i8").tobytes()
    rest = [_narrow(first & np.uint64((1 << low) - 1), low), *(_narrow(x, b) for x, b in zip(lanes[1:], bits[1:], strict=True))]
    return head + np.packbits(runs).tobytes() + b"".join(rest) + np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<i8").tobytes()


def _unpack(data: bytes, shard: int, bits: list[int], shard_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    n, q, larger = (int(x) for x in np.frombuffer(data, "<i8", 3))
    low, at = bits[0] - shard_bits - q, 24
    size = -(-(n + (1 << q)) // 8)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n + (1 << q)))
    at += size
    top = (np.uint64(shard << q) + (ones - np.arange(n)).astype(np.uint64)) << np.uint64(low)
    lanes = []
    for i, b in enumerate([low, *bits[1:]]):
        size = n * -(-b // 8)
        lanes.append(_wide(data[at:at + size], n, b) | (top if i == 0 else np.uint64(0)))
        at += size
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", larger, at + n)
    return lanes, counts


# --- levels


def _level(codes: bytes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers, starts of k words without a break, those words)"""
    ids = np.frombuffer(large(codes), "<i4")
    if len(ids) < k:
        return ids, np.zeros(0, np.int64), np.zeros((0, k), np.int32)
    windows = np.lib.stride_tricks.sliding_window_view(ids, k)
    starts = np.flatnonzero((windows != BREAK).all(axis=1))
    return ids, starts, windows[starts]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _shards(lanes: list[np.ndarray], bits: list[int], shard_bits: int) -> list[tuple[int, int, int]]:
    return by_shard(lanes[0] << np.uint64(64 - bits[0]), shard_bits)


def _shard_bits(asked: int, bits: list[int]) -> int:
    return min(asked, bits[0] - 1)


def _counted(texts: DataFrame, k: int) -> DataFrame:
    """Filters of all phrases of k words: ``(grp, width, shard, shard_bits, chunk, filter)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            bits = [n * row["width"] for n in layout(k, row["width"])]
            s = _shard_bits(row["shard_bits"], bits)
            _, _, grams = _level(row["codes"], k)
            lanes, _, counts = _distinct(permuted(grams, row["width"]), bits)
            found = [(row["grp"], row["width"], shard, s, row["chunk"], _pack([x[a:b] for x in lanes], counts[a:b], bits, s)) for shard, a, b in _shards(lanes, bits, s)]
            columns = list(zip(*found, strict=True)) if found else [()] * 6
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["grp", "width", "shard", "shard_bits", "chunk", "filter"])

    return texts.mapInArrow(count, "grp string, width int, shard int, shard_bits int, chunk bigint, filter binary")


def _merged(filters: DataFrame, k: int, least: int) -> DataFrame:
    """Frequent phrases ``(grp, gram, f)``, and for each chunk ``(chunk, shard, bits)``: which of its keys they are."""

    def merge(table: pa.Table) -> pa.Table:
        grp, width, shard, s = (table.column(c)[0].as_py() for c in ("grp", "width", "shard", "shard_bits"))
        bits = [n * width for n in layout(k, width)]
        parts = [_unpack(x, shard, bits, s) for x in table.column("filter").to_pylist()]
        lanes = [np.concatenate([p[0][i] for p in parts]) for i in range(len(bits))]
        keys, entry, counts = _distinct(lanes, bits, np.concatenate([p[1] for p in parts]))
        frequent = counts >= least
        flags, ends = frequent[entry], np.cumsum([len(p[1]) for p in parts])
        told = [(c, flags[e - len(p[1]):e]) for c, p, e in zip(table.column("chunk").to_pylist(), parts, ends, strict=True)]
        told = [(c, np.packbits(f).tobytes()) for c, f in told if f.any()]
        grams = restored([x[frequent] for x in keys], k, width)
        m, n = len(grams), len(told)
        return pa.table([
            pa.array([grp] * (m + n), pa.string()), pa.array([shard] * (m + n), pa.int32()),
            pa.array([None] * m + [c for c, _ in told], pa.int64()), pa.array([None] * m + [b for _, b in told], pa.binary()),
            pa.array([*grams.tolist(), *[None] * n], pa.list_(pa.int32())), pa.array([*counts[frequent].tolist(), *[None] * n], pa.int64()),
        ], ["grp", "shard", "chunk", "bits", "gram", "f"])

    return filters.groupBy("grp", "shard").applyInArrow(merge, "grp string, shard int, chunk bigint, bits binary, gram array<int>, f bigint")


def _narrowed(texts: DataFrame, answers: DataFrame, k: int) -> DataFrame:
    """The texts' runs of frequent phrases of k words, with a break after each."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            bits = [n * row["width"] for n in layout(k, row["width"])]
            s = _shard_bits(row["shard_bits"], bits)
            ids, starts, grams = _level(row["codes"], k)
            lanes, entry, _ = _distinct(permuted(grams, row["width"]), bits)
            good = starts[unpacked(row["answers"], _shards(lanes, bits, s), len(lanes[0]))[entry]]
            # Each start gives its word; the last start of a run gives the words after it too, and a break.
            last = np.r_[np.diff(good) != 1, True][:len(good)]
            lens = np.where(last, k + 1, 1)
            at = np.repeat(good, lens) + np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            out = np.r_[ids, 0][np.minimum(at, len(ids))].astype("<i4")
            out[np.cumsum(lens)[last] - 1] = BREAK
            yield pa.RecordBatch.from_arrays([
                pa.array([row["chunk"]], pa.int64()), pa.array([row["grp"]], pa.string()), pa.array([row["width"]], pa.int32()),
                pa.array([row["shard_bits"]], pa.int32()), pa.array([small(out.tobytes())], pa.binary()),
            ], ["chunk", "grp", "width", "shard_bits", "codes"])

    return texts.join(answers, F.col("chunk") == F.col("to_chunk")).drop("to_chunk").mapInArrow(runs, _TEXTS)


_TEXTS = "chunk bigint, grp string, width int, shard_bits int, codes binary"


def _sharded(words: list[bytes], bits: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of words by hash, and the shards' slices of it."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    order = np.argsort(hashes, kind="stable")
    return order, by_shard(hashes[order], bits)


def _counted_words(chunks: DataFrame) -> DataFrame:
    """Each chunk's words and their occurrences, by shard of the word's hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words = words_of(row["packed"])
            counts = np.bincount(codes_of(row["codes"], len(words)), minlength=len(words) + 1)[1:]
            order, slices = _sharded(words, row["shard_bits"])
            yield pa.RecordBatch.from_arrays([
                pa.array([row["grp"]] * len(slices), pa.string()), pa.array([row["shard_bits"]] * len(slices), pa.int32()),
                pa.array([s for s, _, _ in slices], pa.int32()), pa.array([row["chunk"]] * len(slices), pa.int64()),
                pa.array([small(b" ".join([words[i] for i in order[a:b]])) for _, a, b in slices], pa.binary()),
                pa.array([counts[order[a:b]].astype("<i8").tobytes() for _, a, b in slices], pa.binary()),
            ], ["grp", "shard_bits", "shard", "chunk", "words", "counts"])

    return chunks.select("chunk", "grp", "shard_bits", "packed", "codes").mapInArrow(
        count, "grp string, shard_bits int, shard int, chunk bigint, words binary, counts binary")


def _merged_words(counted: DataFrame, least: int) -> DataFrame:
    """Frequent words ``(grp, id, word, f)``, and for each chunk ``(chunk, shard, bits)``: the numbers of its words, 0 for others.

    A word's number is its place among its shard's, then the shard.
    """

    def merge(table: pa.Table) -> pa.Table:
        grp, bits, shard = (table.column(c)[0].as_py() for c in ("grp", "shard_bits", "shard"))
        lists = [words_of(x) for x in table.column("words").to_pylist()]
        sums: dict[bytes, int] = {}
        for words, counts in zip(lists, table.column("counts").to_pylist(), strict=True):
            for w, n in zip(words, np.frombuffer(counts, "<i8").tolist(), strict=True):
                sums[w] = sums.get(w, 0) + n
        ids = {w: (i + 1 << bits) | shard for i, w in enumerate(sorted(w for w, n in sums.items() if n >= least))}
        told = [(c, np.fromiter((ids.get(w, 0) for w in words), "<i4", len(words))) for c, words in zip(table.column("chunk").to_pylist(), lists, strict=True)]
        told = [(c, x.tobytes()) for c, x in told if x.any()]
        m, n = len(ids), len(told)
        return pa.table([
            pa.array([grp] * (m + n), pa.string()), pa.array([*ids.values(), *[None] * n], pa.int32()),
            pa.array([*(w.decode("utf-8") for w in ids), *[None] * n], pa.string()), pa.array([*(sums[w] for w in ids), *[None] * n], pa.int64()),
            pa.array([None] * m + [c for c, _ in told], pa.int64()), pa.array([shard] * (m + n), pa.int32()),
            pa.array([None] * m + [b for _, b in told], pa.binary()),
        ], ["grp", "id", "word", "f", "chunk", "shard", "bits"])

    return counted.groupBy("grp", "shard").applyInArrow(merge, "grp string, id int, word string, f bigint, chunk bigint, shard int, bits binary")


def _numbered(chunks: DataFrame, answers: DataFrame, widths: DataFrame) -> DataFrame:
    """The chunks' codes as numbers of frequent words; other words are breaks, one break is as good as many."""

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words = words_of(row["packed"])
            order, slices = _sharded(words, row["shard_bits"])
            told = {x["shard"]: x["bits"] for x in row["answers"]}
            number = np.zeros(len(words) + 1, "<i4")
            for shard, a, b in slices:
                if shard in told:
                    number[order[a:b] + 1] = np.frombuffer(told[shard], "<i4")
            ids = number[codes_of(row["codes"], len(words))]
            keep = np.r_[True, (ids[1:] != BREAK) | (ids[:-1] != BREAK)][:len(ids)]
            yield pa.RecordBatch.from_arrays([
                pa.array([row["chunk"]], pa.int64()), pa.array([row["grp"]], pa.string()), pa.array([row["width"]], pa.int32()),
                pa.array([row["shard_bits"]], pa.int32()), pa.array([small(ids[keep].tobytes())], pa.binary()),
            ], ["chunk", "grp", "width", "shard_bits", "codes"])

    texts = chunks.select("chunk", "grp", "shard_bits", "packed", "codes").join(answers, F.col("chunk") == F.col("to_chunk"))
    return texts.join(widths, "grp").drop("to_chunk").mapInArrow(renumber, _TEXTS)


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(grp, gram, f)`` of every phrase of 1 to ``longest`` words that occurs ``least`` times or more,
    the words ``(grp, id, word)`` that grams are numbers of, and all word occurrences ``(grp, n)``."""
    named = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.lit(None).cast("int").alias("id"))
    raw = Staged(chunked(named, split, "id", "text", "lang", {b"\n": BREAK, b"": SKIP}, CHUNK_BYTES), "chunks", compression="zstd")
    langs = staged(raw.df.groupBy("grp").agg(F.sum("total").alias("n")).filter("n > 0"), "langs")
    chunks = raw.df.join(langs.select("grp", F.length(F.bin(F.expr(f"n div {SHARD_KEYS}"))).alias("shard_bits")), "grp")
    counted = staged(_merged_words(_counted_words(chunks), least), "words")
    vocabulary = counted.filter("word is not null").select("grp", "id", "word", "f")
    widths = vocabulary.groupBy("grp").agg(F.length(F.bin(F.max("id"))).alias("width"))
    texts = Staged(_numbered(chunks, answered(counted.filter("chunk is not null")), widths), "texts", compression="zstd")
    raw.drop()
    phrases = vocabulary.select("grp", F.array("id").alias("gram"), "f")
    for k in range(2, longest + 1):
        merged = staged(_merged(_counted(texts.df, k), k, least), "merged")
        phrases = phrases.union(merged.filter("gram is not null").select("grp", "gram", "f"))
        if k < longest:
            narrowed = Staged(_narrowed(texts.df, answered(merged.filter("chunk is not null")), k), "texts", compression="zstd")
            texts.drop()
            texts = narrowed
    return staged(phrases, "phrases"), vocabulary.select("grp", "id", "word"), langs.select("grp", "n")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, scale: int = 1000, absorb: int = 100, top: int | None = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of each language, all with ``top=None``."""
    phrases, words, totals = frequent_phrases(docs, longest, least, text_col, lang_col)
    candidates = phrases.filter(F.size("gram") > 1)
    # Phrases inside a longer one that is as frequent.
    inner = candidates.filter(F.size("gram") > 2).select(
        "grp", F.col("f").alias("longer"),
        F.explode(F.expr("flatten(transform(sequence(2, size(gram) - 1), k -> transform(sequence(1, size(gram) - k + 1), i -> slice(gram, i, k))))")).alias("gram"),
    ).groupBy("grp", "gram").agg(F.max("longer").alias("longer"))
    own = candidates.join(inner, ["grp", "gram"], "left").filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(absorb) * F.col("f")))
    cuts = own.select("grp", "gram", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("k")).select(
        "grp", "gram", "a", "k", F.expr("slice(gram, 1, k)").alias("head"), F.expr("slice(gram, k + 1, size(gram))").alias("tail"),
    )
    part = lambda name, f: phrases.select("grp", F.col("gram").alias(name), F.col("f").alias(f))
    big = "cast({} as decimal(38,0))"
    scored = cuts.join(part("head", "l"), ["grp", "head"]).join(part("tail", "r"), ["grp", "tail"]).join(totals, "grp").withColumn(
        "score", F.expr(f"({big.format('a')} * {int(scale)} * n) div ({big.format('l')} * r)")
    )
    lowest = scored.groupBy("grp", "gram", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spelt = (
        lowest.select("grp", "gram", F.posexplode("gram").alias("place", "id")).join(words, ["grp", "id"])
        .groupBy("grp", "gram").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("w"))
        .select("grp", "gram", F.array_join("w.word", " ").alias("phrase"))
    )
    out = lowest.join(spelt, ["grp", "gram"]).select(F.col("grp").alias("lang"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = out.withColumn("rank", F.row_number().over(best))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL)
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM (
    SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM pieces, generate_series(1, 5) AS g(k) WHERE len(w) >= k)
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang
), frequent AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f FROM grams WHERE f >= 100
), inside AS (
  SELECT lang, part, max(f) AS longer FROM (
    SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS part FROM (
      SELECT lang, f, w, m, unnest(generate_series(1, k - m + 1)) AS i FROM frequent, generate_series(2, 4) AS g(m) WHERE m < k))
  GROUP BY lang, part
), own AS (
  SELECT c.* FROM frequent c LEFT JOIN inside ON inside.lang = c.lang AND part = phrase WHERE k > 1 AND (longer IS NULL OR 100 * longer < 100 * c.f)
), cuts AS (
  SELECT o.lang, o.phrase, o.f AS a, j, l.f AS l, r.f AS r, n, (1000::HUGEINT * o.f * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM own) o
  JOIN frequent l ON l.lang = o.lang AND l.phrase = array_to_string(o.w[1:j], ' ')
  JOIN frequent r ON r.lang = o.lang AND r.phrase = array_to_string(o.w[j + 1:], ' ')
  JOIN totals t ON t.lang = o.lang
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM cuts
), ranked AS (
  SELECT lang, phrase, a, l, r, n, score::BIGINT AS score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE nth = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
