import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from forecourt.functions import similarity
from forecourt.operators import fuzzy, standardize

TEXTS = "url string, name string, title_text string"
DICT = "make string, model string, short_model string"


def matched(spark, texts, entries):
    listings = spark.createDataFrame([(str(i), *t) for i, t in enumerate(texts)], TEXTS)
    dictionary = spark.createDataFrame(entries, DICT)
    got = standardize.match_make_model(listings, dictionary)
    return [(r.make, r.model) for r in got.orderBy("url").collect()]


def test_dictionary_drops_blanks(spark):
    d = spark.createDataFrame(
        [("Ford", "F-150", "F150"), ("FORD", "f-150", ""), ("ford", None, None), (None, "x", "x")], DICT)
    assert {tuple(r) for r in standardize.make_models(d).collect()} == {
        ("ford", "f-150"), ("ford", "f150")}


def test_make_and_model(spark):
    entries = [("brand#1", "large", ""), ("brand#17", "x", None), ("mercedes-benz", "c-300", "c"),
               ("volkswagen", "golf", "golf gti"), ("kia", "3", "soul")]
    texts = [
        ("Brand#17 large", None),
        ("mercedes benz c 300", None),
        (None, "2001 VW Golf GTI fast"),
        ("", "brand#1 LARGE"),
        ("nothing", "here"),
        (None, None),
        ("mazda", "KIA 3 door"),
        ("kia", "soul"),
    ]
    assert matched(spark, texts, entries) == [
        ("brand#17", None), ("mercedes-benz", "c-300"), ("volkswagen", "golf gti"),
        ("brand#1", "large"), (None, None), (None, None), ("kia", "3"), ("kia", "soul")]


def test_matches_agree_with_brute_force(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("ab-c") for _ in range(rnd.randint(1, 5)))
    entries = [(word(), word(), word()) for _ in range(25)]
    texts = [(rnd.choice([None, "", " ".join(word() for _ in range(3))]),
              rnd.choice([None, " ".join(word() for _ in range(4))])) for _ in range(150)]
    models = {}
    for make, *names in entries:
        models.setdefault(make, set()).update(names)

    def find(options, text):
        clean = (text or "").strip()
        hits = [o for o in options if clean and (o in clean or o.replace("-", " ") in clean)]
        return min(hits, key=lambda o: (-len(o), o), default=None)

    expected = []
    for name, title in texts:
        make = find(models, name) or find(models, title)
        options = models.get(make, ())
        expected.append((make, find(options, name) or find(options, title)))
    listings = spark.createDataFrame([(f"{i:04d}", *t) for i, t in enumerate(texts)], TEXTS)
    got = standardize.match_make_model(listings, spark.createDataFrame(entries, DICT))
    assert [(r.make, r.model) for r in got.orderBy("url").collect()] == expected
    plan = plan_of(got)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def ratio(a, b):
    return 1 - distance(a, b) / max(len(a), len(b)) if a and b else 0.0


def four_scores(a, b, ratio=ratio):
    s, l = sorted((a, b), key=len)
    wa, wb = set(a.split()), set(b.split())
    t0, t1, t2 = (" ".join(sorted(wa & wb) + sorted(x)) for x in ((), wa - wb, wb - wa))
    windows = (l[i : i + len(s)] for i in range(len(l) - len(s) + 1))
    return [
        ratio(a, b),
        max((ratio(s, w) for w in windows), default=0.0),
        ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))),
        max(ratio(t0, t1), ratio(t0, t2), ratio(t1, t2)),
    ]


def common(a, b):
    """Longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def points(a, b):
    both = len(a) + len(b)
    return (400 * common(a, b) + both) // (2 * both) / 100 if a and b else 0.0


def test_matched_characters(spark):
    rnd = random.Random(1)
    text = lambda: "".join(rnd.choice("abcd é") for _ in range(rnd.choice([1, 5, 20, 59, 60, 61, 121])))
    cases = [("", "a"), ("a", ""), ("kitten", "sitting"), ("x" * 130, "y"), *[(text(), text()) for _ in range(150)]]
    df = spark.createDataFrame(cases, "a string, b string")
    got = df.select("a", "b", similarity.matched_characters(F.col("a"), F.col("b")).alias("n"), similarity.matched_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert all((r.n, r.r) == (common(r.a, r.b), points(r.a, r.b)) for r in got) and len(got) == len(cases)


@pytest.mark.parametrize("measure", ["edits", "characters"])
def test_fuzzy_agrees_with_brute_force(spark, measure):
    rnd = random.Random(3)
    vocabulary = ["ford", "f150", "lariat", "camry", "camri", "civic", "si", "x", "transit", "cfx"]
    text = lambda: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 4)))

    def blur(t):
        i = rnd.randrange(len(t))
        return t[:i] + rnd.choice(["", "q", "rt", " "]) + t[i + rnd.randint(0, 1) :]

    targets = sorted({" ".join(text().split()) for _ in range(60)})
    inputs = sorted({" ".join(blur(text()).split()) for _ in range(60)} - {""})
    inputs += ["transitlariatcamrycf " + "u " * 40, "a b", "q"]
    targets += [" ".join(["transitlariatcamrycf", *["9"] * 40]), "c d", "transit transit si si"]
    for cutoff in (0.3, 0.55, 0.75, 0.9, 1.0):
        expected = set()
        for i in inputs:
            if i in targets:
                expected.add((i, i))
                continue
            scores = {t: four_scores(i.strip(), t, ratio if measure == "edits" else points) for t in targets}
            for k in range(4):
                ok = sorted((-s[k], t) for t, s in scores.items() if s[k] >= cutoff)
                expected |= {(i, t) for _, t in ok[:3]}
        got = fuzzy.fuzzy_match(
            spark.createDataFrame([(i,) for i in inputs], "input string"),
            spark.createDataFrame([(t,) for t in targets], "target string"), cutoff, measure=measure)
        assert {tuple(r) for r in got.collect()} == expected
        assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_fuzzy_cases(spark):
    def run(inputs, targets, **kw):
        return sorted(tuple(r) for r in fuzzy.fuzzy_match(
            spark.createDataFrame([(i,) for i in inputs], "input string"),
            spark.createDataFrame([(t,) for t in targets], "target string"), **kw).collect())

    assert run(["camry", "camri"], ["camry", "camry le"]) == [("camry", "camry")]
    assert run(["camri"], ["camry"], cutoff=0.8) == [("camri", "camry")]
    assert run(["café noir x"], ["cafe noir x"], cutoff=0.9) == [("café noir x", "cafe noir x")]
    assert run(["Civic Si!"], ["si civic"]) == [("Civic Si!", "si civic")]
    assert run(["ford f150 heavy duty"], ["f150"]) == [("ford f150 heavy duty", "f150")]


def test_fuzzy_blocks_on_make(spark):
    inputs = spark.createDataFrame([("ford", "f150 xl"), ("ram", "f150 xl")], "make string, input string")
    targets = spark.createDataFrame([("ford", "f150")], "make string, target string")
    got = fuzzy.fuzzy_match(inputs, targets, block_on=["make"])
    assert [tuple(r) for r in got.collect()] == [("ford", "f150 xl", "f150")]


def test_texts_offer_runs_of_the_entries_sizes_only(spark):
    rows = spark.createDataFrame([("abcdefgh" * 8,)], "t string").select(standardize._anchors(F.col("t"), F.lit(3)).alias("runs"))
    assert {len(r) for r in rows.first().runs} == {3}
    words = spark.createDataFrame([("kx", "a", "a"), ("longer make", "b", "b")], "make string, model string, short_model string")
    texts = spark.createDataFrame([(1, "a kx", None), (2, None, "the longer make"), (3, "k", "x"), (4, "kx", "longer make")], "url long, name string, title_text string")
    got = {r.url: r.make for r in standardize.match_make(texts, words).collect()}
    assert got == {1: "kx", 2: "longer make", 3: None, 4: "kx"}
    assert {r.make for r in standardize.match_make(texts, words.filter("make = ''")).collect()} == {None}
