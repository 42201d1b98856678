"""Operators 11 to 13 against brute force: awkward rows, ties, copies, long texts, empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import helpers as B
import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import chunks, collocations, merkle, substring_dedup


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(B.rows(), B.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


# --- 11


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def up(level):
    return [H(*level[i:i + 2]) for i in range(0, len(level), 2)]


def proof(level, i):
    out = []
    while len(level) > 1:
        out += level[i ^ 1:(i ^ 1) + 1]
        level, i = up(level), i // 2
    return level[0], out


def manifest_rows(rows):
    """op11's rows by the contract's wording."""
    trees = defaultdict(list)
    for i, text, lang, source, n, *_ in rows:
        leaf = H(*map(field, (i, source, lang, n, text)))
        hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
        other = H(*map(field, (i, source, lang, n + 1, text))) if hit else leaf
        trees[lang].append((i is not None, i, leaf, other))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    tops = []
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0], r[1] or 0, r[2]))
        tops.append(proof([r[2] for r in trees[lang]], 0)[0])
    out = []
    for t, lang in enumerate(langs):
        leaves = [r[2] for r in trees[lang]]
        for p, (_, i, leaf, other) in enumerate(trees[lang]):
            subroot, low = proof(leaves, p)
            root, high = proof(tops, t)
            node, at, level = other, p, leaves
            for level, at in ((leaves, p), (tops, t)):
                while len(level) > 1:
                    pair = level[at & ~1:(at & ~1) + 2]
                    pair[at & 1] = node
                    node, level, at = H(*pair), up(level), at // 2
            out.append((i, leaf, subroot, root, H(*low, *high), node, node == root))
    return out


def op11(docs):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = [F.col(f) if f != "n_chars" else F.col(f) + 1 for f in merkle.FIELDS]
    return merkle.manifest(docs, other=F.when(hit & F.col("n_chars").isNotNull(), merkle.leaf(changed)), height=3)


def test_manifest_against_brute_force(docs, none):
    extra = [(None, None, None, None, None, 0, 0, "", ""), (7, "-", "", "2:ab", 5, 0, 0, "", ""), (-3, "é", "zz", "", 0, 0, 0, "", "")]
    rows = B.rows() + extra + extra
    made = op11(docs.sparkSession.createDataFrame(rows, B.SCHEMA).repartition(4))
    proofs = made.proofs()
    got = proofs.select(
        "id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")),
        merkle.folded(F.coalesce("other", "leaf"), F.col("path")).alias("f"), F.col("f") == F.col("root"),
    ).collect()
    want = manifest_rows(rows)
    assert Counter(map(tuple, got)) == Counter(want) and {r[-1] for r in want} == {True, False}
    assert made.root() == want[0][3]
    assert len(made.levels) > 1 and made.tops
    assert op11(none).root() is None and op11(none).proofs().count() == 0


def test_manifest_of_one_row_and_of_one_block_more(spark):
    for n in (1, 2, 8, 9, 64, 65):
        rows = [(i, f"t{i}", "en", "s", 1, 0, 0, "", "") for i in range(n)]
        got = op11(spark.createDataFrame(rows, B.SCHEMA)).proofs().select("id", "subroot", "root", "path").collect()
        want = {r[0]: r for r in manifest_rows(rows)}
        assert all((r.subroot, r.root) == want[r.id][2:4] for r in got) and len(got) == n


@pytest.mark.parametrize("height", range(9))
def test_addresses_are_a_bijection_with_halves_first(height):
    levels = height + 1
    places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places)) == list(range((1 << levels) - 1))
    top = levels // 2
    # The upper half comes first, then each lower subtree in one stretch.
    assert all(p.max() < (1 << top) - 1 for p in places[:top])
    size = (1 << levels - top) - 1
    for d in range(top, levels):
        subtree = (places[d] - ((1 << top) - 1)) // size
        assert (subtree == np.arange(1 << d) >> (d - top)).all()


def test_places_do_not_depend_on_partitions(spark):
    rows = [(g, k % 50, k) for g in "ab" for k in range(300)] + [(None, None, 1), (None, 3, 2)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    want = []
    for g in (None, "a", "b"):
        part = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want += [(*r, i) for i, r in enumerate(part)]
    for n in (1, 7):
        got = merkle.placed(df.repartition(n), ["g"], ["k", "v"], "at").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# --- 12


def pieces(text):
    text = B.lower(text)
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", text)]


def phrase_rows(rows, longest, least, scale=1000, absorb=100, top=None):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {g: c for g, c in counts.items() if len(g) > 1 and c >= least}
        inner = defaultdict(int)
        for g, c in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inner[g[i:i + k]] = max(inner[g[i:i + k]], c)
        scored = []
        for g, a in found.items():
            if g in inner and 100 * inner[g] >= absorb * a:
                continue
            score, k = min((scale * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


@pytest.mark.parametrize("longest, least, absorb, top", [(5, 2, 100, None), (3, 4, 60, 20), (2, 1, 100, None)])
def test_phrases_against_brute_force(docs, none, longest, least, absorb, top):
    rows = B.rows()
    got = collocations.collocations(docs, longest, least, absorb=absorb, top=top)
    assert sorted(map(tuple, got.collect())) == sorted(phrase_rows(rows, longest, least, absorb=absorb, top=top))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations.collocations(none, longest, least).count() == 0
    assert collocations.collocations(docs, longest, 10**6).count() == 0


def test_phrases_in_small_chunks_and_many_shards(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(30000)]
    rows = [(i, " ".join(words[i * 100:i * 100 + 100]).replace(" w7 ", ". w7\tW8 "), ("en", "fr", None)[i % 3], "s", 0, 0, 0, "", "") for i in range(300)]
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(collocations, "SHARD_KEYS", 100)
    got = collocations.collocations(spark.createDataFrame(rows, B.SCHEMA).repartition(4), 5, 3, top=None)
    assert sorted(map(tuple, got.collect())) == sorted(phrase_rows(rows, 5, 3))


@pytest.mark.parametrize("k, width", [(1, 1), (2, 1), (2, 13), (3, 20), (5, 13), (5, 21), (5, 25), (4, 31), (5, 31)])
def test_permutation_and_filters_lose_nothing(k, width):
    rng = np.random.default_rng(k * 100 + width)
    grams = rng.integers(0, 1 << width, (5000, k))
    lanes = collocations.permuted(grams, width)
    assert (collocations.restored(lanes, k, width) == grams).all()
    bits = [n * width for n in collocations.layout(k, width)]
    keys, entry, counts = collocations._distinct(lanes, bits)
    assert (np.stack([x[entry] for x in keys]) == np.stack(lanes)).all() and counts.sum() == 5000
    counts = counts * rng.integers(1, 400, len(counts))
    for s in {0, min(3, bits[0] - 1)}:
        back = []
        for shard, a, b in collocations._shards(keys, bits, s):
            x, n = collocations._unpack(collocations._pack([x[a:b] for x in keys], counts[a:b], bits, s), shard, bits, s)
            assert (n == counts[a:b]).all() and all((u == v[a:b]).all() for u, v in zip(x, keys, strict=True))
            back.append(b - a)
        assert sum(back) == len(counts)


# --- 13


def repeated(rows, window):
    lists = [B.words(r[1]) for r in rows]
    seen = Counter(tuple(w[i:i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, lists, strict=True):
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for k in range(window)}
        out.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def marked(docs, window):
    spans = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return Counter(map(tuple, substring_dedup.repeated_words(docs, window).select("id", "n_words", spans, "kept").collect()))


@pytest.mark.parametrize("window", [1, 2, 5, 9, 20, 35])
def test_repeated_words_against_brute_force(docs, none, window):
    assert marked(docs, window) == Counter(repeated(B.rows(), window))
    assert substring_dedup.repeated_words(none, window).count() == 0


def test_passages_at_every_alignment_and_in_small_chunks(spark, monkeypatch):
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 90))]
        at, n = rng.randint(0, len(w)), rng.choice([34, 35, 36, 60])
        w[at:at] = passage[:n] if i % 2 else passage[-n:]
        rows.append((i, " \n".join(w), None, None, 0, 0, 0, "", ""))
    rows.append((500, " ".join(["again"] * 36 + ["x"]), None, None, 0, 0, 0, "", ""))
    monkeypatch.setattr(substring_dedup, "SHARD_KEYS", 50)
    df = spark.createDataFrame(rows, B.SCHEMA).repartition(5)
    assert marked(df, 35) == Counter(repeated(rows, 35))
    once = chunks.chunked(df, lambda t: t.split(), "doc_id", "text", size=500).select("total", "ids").collect()
    assert len(once) > 20 and sum(r.total for r in once) == sum(len(B.words(r[1])) for r in rows)
    assert sorted(i for r in once for i in r.ids) == [r[0] for r in rows]


@pytest.mark.parametrize("period", substring_dedup.COVERS)
def test_covers_have_every_difference(period):
    cover = substring_dedup.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_new_queries_columns(spark, sf_dir):
    got = merkle.op11_merkle(spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("leaf", "string"), ("subroot", "string"), ("root", "string"), ("proof_sha256", "string"), ("folded_root", "string"), ("verified", "boolean")]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert Counter(map(tuple, got.collect())) == Counter(manifest_rows(rows))
    got = substring_dedup.op13_substring_dedup(spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    assert Counter(map(tuple, got.collect())) == Counter((i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in repeated(rows, 35))
    got = collocations.op12_collocations(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(phrase_rows(rows, 5, 100, top=2000))
