"""Brute-force versions of the operators, and a table with every awkward case."""

import re
import zlib
from collections import Counter, defaultdict

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, n long, id string, h string"
SPACE = "[^\x20\x09-\x0D]+"
PROSE = {
    "en": "the river and the old mill by the water were quiet when the morning came over the hills with a thin light",
    "fr": "la rivière et le vieux moulin au bord de l'eau étaient calmes quand le matin est venu sur les collines",
    "de": "der fluss und die alte mühle am wasser waren still als der morgen über die hügel kam mit einem dünnen licht",
}


def rows(n=60):
    """Prose in three languages, copies, near copies, nulls, blanks, long texts, repeated rows and ids."""
    out = []
    for i in range(n):
        lang = ("en", "fr", "de")[i % 3]
        words = PROSE[lang].split()
        text = " ".join(words[(i * 7 + k * (i % 5 + 1)) % len(words)] for k in range(20 + i * 3 % 50))
        out.append((i, text, lang, f"s{i % 4}"))
    out += [(100, out[4][1], "en", "s1"), (101, out[4][1], "en", None), (102, out[4][1].upper(), None, "s1")]
    out += [(103, out[9][1] + " end", "en", "s0"), (104, None, "en", "s2"), (105, "", None, None), (106, " \t\n", "fr", "s0")]
    out += [(107, "1234 567", "en", "s3"), (None, out[5][1], "de", "s1"), (None, None, None, None), (109, "w " * 4000, "en", "s0")]
    out += [(110, out[7][1], "fr", "s2"), (110, out[7][1], "fr", "s2"), (110, "another text of the same id", "en", "s2")]
    out += [(111, "x" * 30000, "en", "s1"), (112, "ça\u00a0va \U0001f600 über\x0bfluss\x1cx", "fr", "s3")]
    return [(i, t, la, s, len(t or ""), 1, 2, "clash", "clash") for i, t, la, s in out]


def words(text):
    return re.findall(SPACE, text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text, size=3):
    w = words(lower(text))
    shingles = [" ".join(w[k:k + size]) for k in range(len(w) - size + 1)] if len(w) > size else ([" ".join(w)] if w else [])
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def components(prints, bits=2):
    """{fingerprint: least fingerprint reachable}"""
    left, out = set(prints), {}
    while left:
        todo = [left.pop()]
        seen = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= bits}
            left -= near
            seen |= near
            todo += near
        out |= dict.fromkeys(seen, min(seen))
    return out


def hits(docs, items, size=10):
    """[(words, hit words, item ids)] of each text"""
    word = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for name, text in items:
        w = re.findall(word, lower(text))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k:k + size])].add("" if name is None else str(name))
    out = []
    for text in docs:
        w, hit, found = re.findall(word, lower(text)), set(), set()
        for length in {len(x) for x in windows}:
            for k in range(len(w) - length + 1):
                if x := windows.get(tuple(w[k:k + length])):
                    hit |= set(range(k, k + length))
                    found |= x
        out.append((len(w), len(hit), found))
    return out


def without_repeats(docs, span=50):
    """{(id, text): (removed bytes, runs, kept)}; docs: (id, text)"""
    first = {}
    for i, text in docs:
        b = (text or "").encode()
        for k in range(len(b) - span + 1):
            if i is not None:
                first[b[k:k + span]] = min(i, first.get(b[k:k + span], i))
    out = {}
    for i, text in docs:
        b = (text or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - span + 1):
            if i is not None and first[b[k:k + span]] < i:
                gone[k:k + span] = [True] * span
        runs = sum(g and (q == 0 or not gone[q - 1]) for q, g in enumerate(gone))
        out[i, text] = (sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    w = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[x] for x in free)
        over = [x for x in free if left * w[x] / total > most * sizes[x]]
        if not over:
            return out | {x: left * w[x] / total for x in free}
        for x in over:
            out[x] = most * sizes[x]
            free.discard(x)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


def quality(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text or ""), dup, len(covered)


def best_capacity(sizes, shards):
    lo, hi = max(sizes, default=0), sum(sizes)
    while lo < hi:
        mid, used, n = (lo + hi) // 2, 0, 1
        for z in sizes:
            if used + z > mid:
                n, used = n + 1, 0
            used += z
        lo, hi = (lo, mid) if n <= shards else (mid + 1, hi)
    return lo


def crc(text):
    return zlib.crc32((text or "").encode())
