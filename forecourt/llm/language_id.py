"""Operator 6: language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary (a sentencepiece model's
pieces; nothing is trained there).  The probability of a word is the sum over all ways to cut it into
pieces of the product of their probabilities, computed by the forward algorithm; a text is its words.
The prediction is the language that makes the text likeliest, the score its posterior under equal priors.

*Learning.*  A piece's probability in a language is its smoothed share among all occurrences of pieces in
the language's training words (every piece that matches at every place counts).  Training rows are drawn
by a hash of the id, about ``PER_LANGUAGE`` of each language whatever the size of the input: a documented
bound.  Counts are made in the tasks and summed by Spark; the driver gets one row per piece and language
at most, and broadcasts the model, whose size is that of the vocabulary times the languages.

*Predicting.*  All of every text is scored.  Words are distinct within a task up to a bounded cache;
new ones go through the forward algorithm together, vectorised over words of one length.  Stretches
longer than ``LONGEST_WORD`` letters (unspaced text) go through it one by one: their pieces are looked up at
all places together, the sum keeps the last ``LONGEST_PIECE`` forward values, rescaled on the way, so it
covers all segmentations of a text of any length.  Nothing is shuffled.

Cases: a null text or one without a letter is ``und`` with score 0, as is every text if no training row
has a language; rows with a null language are not learned from but predicted; a tie goes to the language
first in order; null and repeated ids stay (rows without id are drawn for learning by their text); an empty table gives an empty result.  Other columns are not
read, and language, source and id are no input of a prediction.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Training rows of a language, about: rows are drawn with this over its number of rows.
PER_LANGUAGE = 3000
#: Labels beyond this many are taken for a mistake in the column and refused.
MOST_LANGUAGES = 500
SMOOTHING = 0.5
UNKNOWN = 1e-7
LONGEST_PIECE = 16
LONGEST_WORD = 32
CACHE_WORDS = 200_000
CHUNK_CHARS = 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15)
#: ASCII letters in lower case and all beyond ASCII stay, everything else separates words.
TABLE = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def vocabulary(path: str | None = None) -> list[str]:
    """The pieces of a sentencepiece model that stand for text, in lower case, without repeats."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return sorted({p.lower() for p in pieces if 0 < len(p) <= LONGEST_PIECE})


def _hash(codes: np.ndarray) -> np.ndarray:
    h = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        h = (h + codes[:, k] + np.uint64(1)) * BASE
    return h


def hashed_pieces(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes, the piece number of each, and a bitmap of the hashes' leading 20 bits."""
    hashes = np.zeros(len(pieces), np.uint64)
    by_length = defaultdict(list)
    for i, p in enumerate(pieces):
        by_length[len(p)].append(i)
    for n, rows in by_length.items():
        hashes[rows] = _hash(np.array([[ord(c) for c in pieces[i]] for i in rows], np.uint64).reshape(-1, n))
    order = np.argsort(hashes)
    bitmap = np.zeros(1 << 20, bool)
    bitmap[hashes >> np.uint64(44)] = True
    return hashes[order], order.astype(np.int32), bitmap


def _pieces_at(codes: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, rows, piece numbers) of every piece in words of one length, by rising start."""
    hashes, numbers, bitmap = table
    width = codes.shape[1]
    for i in range(width):
        h = np.zeros(len(codes), np.uint64)
        for j in range(i, min(width, i + LONGEST_PIECE)):
            h = (h + codes[:, j] + np.uint64(1)) * BASE
            rows = np.nonzero(bitmap[h >> np.uint64(44)])[0]
            if len(rows):
                at = np.minimum(np.searchsorted(hashes, h[rows]), len(hashes) - 1)
                real = hashes[at] == h[rows]
                if real.any():
                    yield i, j + 1, rows[real], numbers[at[real]]


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(TABLE).split() if text else []


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def _by_length(words: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[tuple[int, np.ndarray]]]:
    """Words as code points, each after the boundary mark: (word numbers, a row each) of one length, and the long words one by one."""
    groups: dict[int, tuple[list[int], list[str]]] = defaultdict(lambda: ([], []))
    long: list[tuple[int, np.ndarray]] = []
    for i, word in enumerate(words):
        text = "▁" + word.decode("utf-8", "replace")
        if len(text) > LONGEST_WORD:
            long.append((i, _codes(text)))
            continue
        numbers, texts = groups[len(text)]
        numbers.append(i)
        texts.append(text)
    return [(np.array(numbers), _codes("".join(texts)).reshape(-1, n)) for n, (numbers, texts) in groups.items()], long


def _pieces_in(codes: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and numbers of the pieces anywhere in one long word, by rising end."""
    hashes, numbers, bitmap = table
    starts, ends, pieces = [], [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, min(LONGEST_PIECE, len(codes)) + 1):
        h = (h[:len(codes) - n + 1] + codes[n - 1:] + np.uint64(1)) * BASE
        rows = np.nonzero(bitmap[h >> np.uint64(44)])[0]
        at = np.minimum(np.searchsorted(hashes, h[rows]), len(hashes) - 1)
        real = hashes[at] == h[rows]
        starts.append(rows[real])
        ends.append(rows[real] + n)
        pieces.append(numbers[at[real]])
    order = np.argsort(np.concatenate(ends), kind="stable")
    return np.concatenate(starts)[order], np.concatenate(ends)[order], np.concatenate(pieces)[order]


def _log_likelihood(codes: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray], probabilities: np.ndarray) -> np.ndarray:
    """log P(word | language) of one long word; place p's forward values stand in row p modulo the ring's height."""
    height = LONGEST_PIECE + 1
    starts, ends, pieces = _pieces_in(codes, table)
    bounds = np.searchsorted(ends, np.arange(1, len(codes) + 2)).tolist()
    rows = starts % height
    ring = np.zeros((height, probabilities.shape[1]))
    ring[0] = 1.0
    scale = np.zeros(probabilities.shape[1])
    for p in range(1, len(codes) + 1):
        value = ring[(p - 1) % height] * UNKNOWN
        lo, hi = bounds[p - 1], bounds[p]
        if lo < hi:
            value = value + (ring[rows[lo:hi]] * probabilities[pieces[lo:hi]]).sum(axis=0)
        ring[p % height] = value
        if p % LONGEST_PIECE == 0:
            most = ring.max(axis=0)
            ring /= most
            scale += np.log(most)
    return scale + np.log(ring[len(codes) % height])


def log_likelihoods(words: list[bytes], table: tuple[np.ndarray, np.ndarray, np.ndarray], probabilities: np.ndarray) -> np.ndarray:
    """log P(word | language), summed over all segmentations: a row per word, a column per language."""
    out = np.zeros((len(words), probabilities.shape[1]))
    short, long = _by_length(words)
    for numbers, codes in short:
        width = codes.shape[1]
        forward = np.zeros((width + 1, len(codes), probabilities.shape[1]))
        forward[0] = 1.0
        done = 0
        for i, j, rows, pieces in _pieces_at(codes, table):
            while done < i:  # every letter can stand alone, so no place is out of reach
                forward[done + 1] += forward[done] * UNKNOWN
                done += 1
            forward[j, rows] += forward[i, rows] * probabilities[pieces]
        while done < width:
            forward[done + 1] += forward[done] * UNKNOWN
            done += 1
        out[numbers] = np.log(forward[width])
    for number, codes in long:
        out[number] = _log_likelihood(codes, table, probabilities)
    return out


def piece_counts(words: dict[bytes, int], table: tuple[np.ndarray, np.ndarray, np.ndarray], n_pieces: int) -> np.ndarray:
    """How often each piece matches anywhere in the words, which come with their frequencies."""
    total = np.zeros(n_pieces, np.int64)
    weights = np.array(list(words.values()), np.int64)
    short, long = _by_length(list(words))
    for numbers, codes in short:
        for _, _, rows, pieces in _pieces_at(codes, table):
            total += np.bincount(pieces, weights[numbers[rows]], n_pieces).astype(np.int64)
    for number, codes in long:
        total += weights[number] * np.bincount(_pieces_in(codes, table)[2], minlength=n_pieces)
    return total


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, pieces: list[str], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the probability of each piece (row) in each language (column)."""
    rows = docs.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(id_col)), F.lit(1 << 30)).alias("draw"),
    )
    sizes = {r["lang"]: r["n"] for r in rows.filter(F.col("text").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((len(pieces), 0))
    rates = F.create_map(*(F.lit(x) for lang in langs for x in (lang, int(min(1.0, per_language / sizes[lang]) * (1 << 30)))))
    drawn = rows.filter(F.col("draw") < F.element_at(rates, F.col("lang"))).select("lang", "text")
    held = docs.sparkSession.sparkContext.broadcast((hashed_pieces(pieces), len(pieces)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n = held.value
        words: dict[str, dict[bytes, int]] = defaultdict(lambda: defaultdict(int))
        totals: dict[str, np.ndarray] = {}

        def flush() -> None:
            for lang, seen in words.items():
                totals[lang] = totals.get(lang, 0) + piece_counts(seen, table, n)
            words.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen = words[lang]
                for w in words_of(text.as_py()):
                    seen[w] += 1
                if sum(map(len, words.values())) > CACHE_WORDS:
                    flush()
        flush()
        for lang, total in totals.items():
            at = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "piece", "n"])

    summed = drawn.mapInArrow(counted, "lang string, piece int, n bigint").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((len(pieces), len(langs)), SMOOTHING)
    column = {lang: i for i, lang in enumerate(langs)}
    for lang, piece, n in zip(*(summed.column(c).to_pylist() for c in ("lang", "piece", "n")), strict=True):
        counts[piece, column[lang]] += n
    return langs, counts / counts.sum(axis=0)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], pieces: list[str], text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` of every row, with language and score under ``names``."""
    langs, probabilities = model
    held = docs.sparkSession.sparkContext.broadcast((langs, probabilities, hashed_pieces(pieces)))
    chosen = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1]] + [f"`{names[0]}` string", f"`{names[1]}` double"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, probabilities, table = held.value
        known: dict[bytes, int] = defaultdict(count().__next__)
        rows = np.zeros((0, len(langs)))
        for batch in batches:
            found, scores = [], []
            texts = batch.column(batch.num_columns - 1)
            start = 0
            while start < len(texts):
                group, size, lettered = [], 0, []
                while start < len(texts) and (size < CHUNK_CHARS or not group):
                    text = texts[start].as_py() or ""
                    lettered.append(bool(langs) and any(map(str.isalpha, text)))
                    group.append(words_of(text))
                    size += len(text)
                    start += 1
                if len(known) > CACHE_WORDS:
                    known, rows = defaultdict(count().__next__), rows[:0]
                at = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in group]
                if len(known) > len(rows) and langs:
                    new = list(known)[len(rows):]
                    rows = np.concatenate([rows, log_likelihoods(new, table, probabilities)])
                for ids, ok in zip(at, lettered, strict=True):
                    if not ok:
                        found.append("und")
                        scores.append(0.0)
                        continue
                    total = rows[ids].sum(axis=0)
                    best = int(total.argmax())
                    found.append(langs[best])
                    scores.append(float(1.0 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names[:-1], *names])

    return chosen.mapInArrow(scored, schema)


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` (columns as before) without texts in no language: ``und``, or a score below ``least``."""
    pieces = vocabulary()
    model = learn(docs, pieces)
    columns = tuple(docs.columns)
    found = predict(docs, model, pieces, keep=columns, names=("__lang", "__score"))
    return found.filter((F.col("__lang") != "und") & (F.col("__score") >= least)).select(*columns)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = vocabulary()
    out = predict(docs.select("doc_id", "text"), learn(docs, pieces), pieces)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
