import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from forecourt.operators import regression, scoring, training
from forecourt.schemas import HOT_DEALS, LISTINGS, MODELS

FIT = "make string, model string, log_odometer double, condition_mapped int, year int, price double"


def listings(spark, rows):
    """Listings from dicts; columns not given are NULL."""
    names = LISTINGS.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], LISTINGS)


def car(as_of, **changes):
    return {"url": "u", "location": "bend", "make": "ford", "model": "f150", "year": 1995,
            "odometer": 1000.0, "price": 5000.0, "condition": "good", "time_posted": as_of, **changes}


def fitted(spark, rows, **kw):
    df = regression.fit_models(spark.createDataFrame(rows, FIT), **kw)
    return {(r.make, r.model): r for r in df.collect()}


def test_filter_window_nulls_and_conditions(spark, as_of):
    old = as_of - dt.timedelta(days=180)
    rows = [car(as_of, time_posted=old), car(as_of, time_posted=old - dt.timedelta(seconds=1)),
            car(as_of, condition="other", odometer=0.0),
            *[car(as_of, **{c: None}) for c in ("make", "model", "year", "odometer", "price", "condition")]]
    got = training.fit_filtered(listings(spark, rows), as_of).collect()
    assert sorted((r.log_odometer, r.condition_mapped) for r in got if r.condition_mapped is None) == [(0.0, None)]
    assert len(got) == 2


@pytest.mark.parametrize("n, kept", [(99, 0), (100, 1)])
def test_group_size_counts_unmapped_conditions(spark, as_of, n, kept):
    rows = [car(as_of, condition="other" if i % 2 else "good") for i in range(n)]
    filtered = training.fit_filtered(listings(spark, rows), as_of)
    assert training.valid_make_models(filtered).count() == kept
    assert training.price_bounds(filtered).count() == kept


def test_trim_is_strict(spark, as_of):
    rows = [car(as_of, price=p, year=y) for y, ps in ((1, [1.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0, 3.0]))
            for p in ps]
    got = training.fit_set(listings(spark, rows), as_of, min_group=1)
    assert [(r.year, r.price) for r in got.collect()] == [(3, 2.0)]


def test_fit_set_same_with_and_without_broadcast(spark, as_of):
    rnd = random.Random(5)
    rows = [car(as_of, url=str(i), model=rnd.choice("abcdef"), year=rnd.choice([1990, 1991]),
                price=float(rnd.randint(300, 9000))) for i in range(900)]
    df = listings(spark, rows)
    one = sorted(map(tuple, training.fit_set(df, as_of, min_group=120).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        two = sorted(map(tuple, training.fit_set(df, as_of, min_group=120).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert one and one == two


def test_planted_coefficients(spark):
    rnd = random.Random(1)
    rows = []
    for _ in range(60):
        o, c, y = rnd.uniform(5, 12), rnd.randint(0, 1), rnd.randint(1990, 2000)
        rows.append(("a", "b", o, c, y, 3 + 2 * o + 5 * c + 7 * y))
    m = fitted(spark, rows)["a", "b"]
    got = [m.intercept, m.miles_coeff, m.condition_coeff, m.year_coeff, m.r_squared]
    assert np.allclose(got, [3, 2, 5, 7, 1], rtol=1e-6, atol=1e-5)
    assert m.sample_size == 60


def design(rows, absorb):
    """Columns and names as a library fit would set them up."""
    o, c, y = (np.array([r[i] for r in rows], float) for i in (2, 3, 4))
    columns = {"miles_coeff": o, "condition_coeff": c}
    if len(set(y)) > 1:
        columns["year_coeff"] = y
    stuck = any(np.ptp(v) == 0 and v[0] != 0 for v in columns.values())
    if not (absorb and stuck):
        columns = {"intercept": np.ones(len(rows)), **columns}
    return columns


CASES = {
    "one_year": [(o, c, 1995) for o, c in [(5.0, 0), (6.5, 1), (7.0, 0), (9.0, 1), (9.5, 0), (4.0, 1)]],
    "all_zero": [(o, 0, y) for o, y in [(5.0, 1990), (6.5, 1991), (7.0, 1993), (9.0, 1990), (8.0, 1996)]],
    "all_one": [(o, 1, y) for o, y in [(5.0, 1990), (6.5, 1991), (7.0, 1993), (9.0, 1990), (8.0, 1996)]],
    "flat_odometer": [(6.0, c, y) for c, y in [(0, 1990), (1, 1991), (0, 1993), (1, 1990), (1, 1996)]],
    "collinear": [(o, c, 1990 + c) for o, c in [(5.0, 0), (6.5, 1), (7.0, 0), (9.0, 1), (8.0, 1)]],
    "two_rows": [(5.0, 0, 1990), (6.0, 1, 1995)],
    "one_row": [(5.0, 1, 1990)],
}


@pytest.mark.parametrize("absorb", [True, False])
def test_degenerate_groups_match_least_norm(spark, absorb):
    rnd = random.Random(2)
    rows = {name: [("x", name, *r, float(rnd.randint(1000, 9000))) for r in shape]
            for name, shape in CASES.items()}
    models = fitted(spark, [r for group in rows.values() for r in group],
                    constant_predictor="absorb" if absorb else "drop")
    for name, group in rows.items():
        columns = design(group, absorb)
        if not absorb:  # a stuck predictor is dropped beside the intercept
            columns = {k: v for k, v in columns.items() if k == "intercept" or np.ptp(v) > 0}
        matrix, price = np.column_stack(list(columns.values())), np.array([r[5] for r in group])
        expected = dict(zip(columns, np.linalg.pinv(matrix, rcond=1e-13) @ price))
        m = models["x", name]
        for field in ("miles_coeff", "condition_coeff", "year_coeff"):
            assert getattr(m, field) == pytest.approx(expected.get(field, 0.0), rel=1e-4, abs=1e-3), (name, field)
        if "intercept" in expected:
            assert m.intercept == pytest.approx(expected["intercept"], rel=1e-4, abs=1e-3), name
        else:
            assert m.intercept is None, name


def test_constant_price_and_dropped_rows(spark):
    rows = [("a", "flat", o, c, y, 500.0) for o, c, y in [(5.0, 0, 1990), (6.0, 1, 1991), (7.0, 0, 1993), (9.0, 1, 1990), (8.0, 0, 1999)]]
    rows += [("a", "gone", 5.0, None, 1990, 1.0), ("a", "gone", None, 1, 1990, 1.0)]
    models = fitted(spark, rows)
    assert set(models) == {("a", "flat")}
    assert models["a", "flat"].r_squared is None


def test_fit_shuffles_partial_sums(spark, as_of):
    df = listings(spark, [car(as_of, price=float(i)) for i in range(1, 30)])
    plan = plan_of(regression.fit_models(training.fit_set(df, as_of, min_group=1)))
    # Bounds: by year, by model, and to both sides of their join (AQE broadcasts them when small);
    # models: one more.  All sums are made in part before they are shuffled.
    assert plan.count("Exchange hashpartitioning") <= 5
    # The one window adds up years of a model.
    assert "partial_covar_pop" in plan and plan.count("- Window [") == 1 and "Window [sum(n#" in plan
    assert "FlatMapGroups" not in plan and "CartesianProduct" not in plan


def model_rows(spark, *rows):
    return spark.createDataFrame(rows, MODELS)


def test_hot_deals_bounds_and_joins(spark, as_of):
    edge = as_of - dt.timedelta(days=45)
    rows = [
        car(as_of, url="in", time_posted=edge, condition="excellent"),
        car(as_of, url="late", time_posted=edge - dt.timedelta(seconds=1)),
        car(as_of, url="p1", price=250.0), car(as_of, url="p2", price=75000.0),
        car(as_of, url="o1", odometer=0.0), car(as_of, url="o2", odometer=300000.0),
        car(as_of, url="y1", year=1950), car(as_of, url="y2", year=2003),
        car(as_of, url="y3", year=1951), car(as_of, url="y4", year=2002),
        car(as_of, url="nowhere", location="mars"), car(as_of, url="nomodel", model="zzz"),
        car(as_of, url="nocond", condition=None), car(as_of, url="nomake", make=None, model=None),
    ]
    states = spark.createDataFrame([("bend", "OR"), ("bend", "OR")], "region string, state string")
    models = model_rows(spark, ("ford", "f150", 10.0, -1.0, 100.0, 2.0, 0.5, 120))
    deals = scoring.hot_deals(listings(spark, rows), states, models, as_of)
    assert deals.schema.fieldNames() == HOT_DEALS.fieldNames()
    got = {r.url: r for r in deals.collect()}
    assert set(got) == {"in", "y3", "y4", "nomodel", "nocond", "nomake"}
    assert got["in"].predicted_price == pytest.approx(10 - math.log(1000.1) + 100 + 2 * 1995)
    assert got["y3"].predicted_price == pytest.approx(10 - math.log(1000.1) + 2 * 1951)
    assert got["nomodel"].predicted_price is None and got["nomodel"].sample_size is None
    assert got["nocond"].predicted_price is None and got["nocond"].sample_size == 120
    assert list(got)[-1] == "in" and got["in"].state == "OR"


def test_scoring_plan_from_tables(spark, as_of, tmp_path):
    listings(spark, [car(as_of)]).write.parquet(str(tmp_path / "l"))
    model_rows(spark, ("ford", "f150", 1.0, 1.0, 1.0, 1.0, 0.5, 120)).write.parquet(str(tmp_path / "m"))
    spark.createDataFrame([("bend", "OR")], "region string, state string").write.parquet(str(tmp_path / "s"))
    read = lambda n: spark.read.parquet(str(tmp_path / n))
    plan = plan_of(scoring.hot_deals(read("l"), read("s"), read("m"), as_of))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert "GreaterThanOrEqual(time_posted" in plan and "LessThan(price,75000.0)" in plan
    assert "Python" not in plan and "posting_body_text" not in plan.split("ReadSchema")[1]


def test_best_deals_are_under_expectation(spark):
    scored = spark.createDataFrame(
        [("a", 80.0, 100.0), ("b", 120.0, 100.0), ("c", 80.0, None)],
        "url string, price double, predicted_price double")
    assert [tuple(r) for r in scoring.best_deals(scored).collect()] == [("a", 80.0, 100.0, 20.0, 0.2)]


def test_best_deals_of_each_model(spark):
    rows = [(f"u{i:03d}", m, float(i % 7), 10.0) for m in ("a", "b", None) for i in range(40)] + [("x", "c", 20.0, 10.0), ("y", "c", 9.0, None)]
    scored = spark.createDataFrame(rows, "url string, model string, price double, predicted_price double").withColumn("make", F.lit("m"))
    got = scoring.best_deals_per_model(scored.repartition(3), 2)
    plan = plan_of(got)  # before it runs: afterwards the plan is shown twice, as planned and as run
    assert sorted((str(r.model), r.rank, r.url) for r in got.collect()) == [(m, k, u) for m in ("None", "a", "b") for k, u in ((1, "u000"), (2, "u007"))]
    # The limit comes before the shuffle too.
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange")
