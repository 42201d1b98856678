import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from forecourt.functions import html as H
from forecourt.functions import text as T
from forecourt.functions.pricing import condition_flag
from forecourt.functions.urls import location_from_url, post_id
from forecourt.plans import catalog
from forecourt.sources import sample


@pytest.mark.parametrize(
    "fn, given, expected",
    [
        (location_from_url, "https://missoula.example.org/search", "missoula"),
        (location_from_url, "no address", None),
        (post_id, "https://x.org/a/b/7653.html", "7653"),
        (T.correct_make, "2012 Chevy Volt", "2012 chevrolet volt"),
        (T.correct_make, "volkswagon golf", "volkwagen golf"),
        (T.correct_make, "chevy vw", "chevrolet vw"),
        (T.correct_make, None, None),
        (T.correct_model, "Oddysey", "odyssey"),
        (T.number, " 12.5 ", 12.5),
        (T.number, "12,345", None),
        (T.number, "85d", None),
        (T.strip_ws, "\n  a b \t", "a b"),
        (T.decode_entities, "a &amp;lt; b", "a &lt; b"),
        (T.decode_entities, "&#8211;&#x41;&eacute;&quot;&nosuch; &", "–Aé\"&nosuch; &"),
        (T.decode_entities, "&#128513;&#0;", "😁&#0;"),
        (H.repair_odometer, "85", 85000.0),
        (H.repair_odometer, "999", 999000.0),
        (H.repair_odometer, "1000", 1000.0),
        (H.repair_odometer, "12,345", None),
        (condition_flag, "like new", 1),
        (condition_flag, "salvage", 0),
        (condition_flag, "other", None),
    ],
)
def test_text_and_url(value, fn, given, expected):
    assert value(fn, given) == expected


def page_field(value, find, read, page):
    return value(lambda x: read(find(H.strip_comments(x))), page)


def test_time_keeps_wall_clock(value):
    page = "<p><time datetime='2023-08-01T10:00:00-0700' class=\"date  timeago\">x</time>"
    assert page_field(value, H.time_tag, H.time_posted, page) == dt.datetime(2023, 8, 1, 10)
    assert page_field(value, H.time_tag, H.time_posted, page.replace("2023-08", "soon")) is None


def test_class_matching(value):
    read = lambda page: page_field(value, H.year_element, H.listing_year, page)
    assert read('<SPAN id=a class="valu year"> 2012\n</SPAN>') == 2012
    assert read('<span class="year valu">2012</span>') is None
    assert read('<span data-x="valu year">2012</span>') is None
    assert read('<!-- <span class="valu year">1999</span> --><span class=\'valu year\'>2012</span>') == 2012
    assert read('<span class="valu year">twelve</span>') is None


def test_elements_absent_empty_unclosed(value):
    read = lambda page: page_field(value, H.title_element, H.text_of, page)
    assert read("<p>") is None
    assert read('<span id="titletextonly"></span>') == ""
    assert read('<span id=titletextonly>a <b>&amp;</b> c') == "a & c"


def test_body_is_all_descendant_text(value):
    page = (
        '<section id="postingbody"><div>QR <p>code</p></div>\n<script>if (a<b) x()</script>'
        "price < 5 &gt; 4<br>ok</section><p>after</p>"
    )
    read = page_field(value, H.body_element, H.text_of, page)
    assert read == "QR code\nprice < 5 > 4ok"


def test_long_body_does_not_overflow(value):
    page = '<section id="postingbody">' + "a<b>b</b>" * 60_000 + "</section>"
    assert len(page_field(value, H.body_element, H.text_of, page)) == 120_000


def test_attributes(value):
    def row(label, val):
        return f'<div class="attr x"><span class=\'labl\'>{label}</span><span class="valu y">{val}</span></div>'

    page = (
        row(" drive: ", " fwd ") + row("drive:", "<a>4wd</a>") + row("VIN::", "a&amp;b")
        + '<div class="attr"><span class="valu">no label</span></div>'
        + '<div class="attribute"><span class="labl">fuel:</span><span class="valu">gas</span></div>'
        + '<div class="attr"><span class="valu">first</span><span class="labl">type</span></div>'
    )
    entries = lambda x: H.last_wins(H.attr_entries(x))
    assert value(entries, page) == {"drive": "4wd", "VIN": "a&b", "type": "first"}
    assert value(lambda x: H.pick(H.attr_entries(x), "drive"), page) == "4wd"
    assert value(lambda x: H.pick(H.attr_entries(x), "fuel"), page) is None


@pytest.mark.parametrize("text, n", [("image 1 of 12", 12), ("image 1 of x", None), ("", None)])
def test_num_images(value, text, n):
    page = f'<span class="slider-info big">{text} </span>'
    assert page_field(value, H.images_element, H.num_images, page) == n


@pytest.mark.parametrize(
    "doc, price",
    [
        ('{"offers": {"price": "15000"}}', 15000.0),
        ('{"offers": {"price": 15000.5}}', 15000.5),
        ('{"offers": {}}', None),
        ('{"name": "x"}', None),
        ('{"offers": {"price": ', None),
    ],
)
def test_jsonld(value, doc, price):
    page = f'<script type="a" id="ld_posting_data">{doc}</script>'
    source = lambda e: H.source_of(e)
    assert page_field(value, H.jsonld_element, lambda e: H.jsonld_price(source(e)), page) == price


def test_jsonld_description_and_geo(value):
    page = (
        '<script id="ld_posting_data">{"name": "a < b", "description": "c",'
        ' "offers": {"availableAtOrFrom": {"geo": {"latitude": "1.5", "longitude": -2}}}}</script>'
    )
    doc = lambda x: H.source_of(H.jsonld_element(x))
    assert value(lambda x: H.jsonld_description(doc(x)), page) == "a < b>>>c"
    assert value(lambda x: H.jsonld_latitude(doc(x)), page) == 1.5
    assert value(lambda x: H.jsonld_longitude(doc(x)), page) == -2.0


def test_bad_zero_division_and_logs_do_not_throw(value):
    assert value(lambda x: F.log(x.cast("double") + 1), "-1") is None


def _tree(rng, depth):
    """A random page of divs, some with the class looked for, and what the outermost of those hold."""
    page, found = "", []
    for _ in range(rng.randint(0, 3)):
        page += rng.choice(["x", "a < b", "<b>y</b>", "<divx>", "<div_>", ""])
        if depth and rng.random() < 0.8:
            inner, below = _tree(rng, depth - 1)
            if rng.random() < 0.4:
                page += rng.choice(['<div class="k">', "<DIV id=1 class='a k'>", '<div title="x > y" class=k>']) + inner + rng.choice(["</div>", "</DIV >"])
                found.append(inner)
            else:
                page += rng.choice(["<div>", '<div class="kk">']) + inner + "</div>"
                found += below
    return page, found


def test_elements_of_any_depth(spark):
    rng = random.Random(5)
    cases = [_tree(rng, d % 9) for d in range(400)]
    deep = "<div>" * 500 + "core" + "</div>" * 500
    cases += [(f'<p><div class="k">{deep}</div>after', [deep]), (f'<div class="k">{deep}', [deep]), ("</div></div><div class=k>a<div>b</div>c</div>", ["a<div>b</div>c"]),
              ('<div class="k">a<div class="k">b</div></div><div class="k"></div>', ['a<div class="k">b</div>', ""]), ("<div class=k>a<div>b</div>c", ["a<div>b</div>c"])]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(cases)], "i int, page string")
    spec = (F.col("page"), "div", H.by_class("k"))
    got = df.select("i", H.elements_of_any_depth(*spec).alias("any"), H.all_elements(*spec).alias("every"), H.first_element(*spec).alias("first")).collect()
    for r in got:
        page, want = cases[r.i][0], [">" + x for x in cases[r.i][1]]
        assert r.any == want, page
        if page.lower().count("<div") < H.NESTING:
            assert (r.every, r.first) == (want, want[0] if want else ""), page
    assert df.filter("page is null").count() == 0
    null = spark.range(1).select(F.lit(None).cast("string").alias("page"))
    assert tuple(null.select(H.elements_of_any_depth(F.col("page"), "div"), H.all_elements(F.col("page"), "div"), H.first_element(F.col("page"), "div")).first()) == (None, None, None)


def test_long_tags_are_read_without_recursion(value):
    """Each character of a tag before its class took a frame of the stack."""
    blank = " ".join(f"data-{n}=v" for n in range(20_000))
    page = f'<span {blank} title="a > b" class="valu year"> 1999 </span>'
    assert value(lambda x: H.listing_year(H.year_element(x)), page) == 1999


def test_comments_and_scripts_in_one_pass(value):
    page = "a<!-- 1 --><SCRIPT x>var s = '<!-- kept -->';</SCRIPT ><style>p<!-- q --></style>b<!-->c--><script>open <!-- gone -->d<!-- -- - ->"
    bare = "a<SCRIPT x>var s = '<!-- kept -->';</SCRIPT ><style>p<!-- q --></style>b<script>open d"
    assert value(H.strip_comments, page) == bare
    assert value(lambda x: H.strip_scripts(H.strip_comments(x)), page) == "ab"
    assert value(H.strip_scripts, "<scripts>x</scripts><s>y</s><script >z</script>-<style>") == "<scripts>x</scripts><s>y</s>-"


def test_references_are_decoded_without_compiling_patterns_by_row(spark):
    texts = [
        "a &ndash; b", "&&copy;&copy x", "&copyright &#x41;&#65;&#0;&#xD800;", "&nosuch; & &;", "&amp;lt; &ndash;", "&#150 &#8211;\n&hellip;", "&", "", None,
    ]
    expected = [
        "a – b", "&©© x", "©right AA&#0;&#xD800;", "&nosuch; & &;", "&lt; –", "– –\n…", "&", "", None,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    decoded = rows.select("i", T.decode_entities(F.col("x")).alias("y"))
    assert [r["y"] for r in decoded.orderBy("i").collect()] == expected
    assert "split(" not in decoded._jdf.queryExecution().optimizedPlan().toString()


def test_every_name_of_html_is_found_in_its_bucket(spark):
    names = sorted(n for n in T.html5 if n.endswith(";"))
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    found = rows.select("n", T.decode_entities(F.concat(F.lit("&"), "n")).alias("y")).collect()
    assert {r["n"]: r["y"] for r in found} == {n: T.html5[n] for n in names}


@pytest.fixture
def star(spark, tmp_path):
    """Tables of one row each that make one listing."""
    day = dt.datetime(2001, 7, 1)
    for name, row, schema in (
        ("nation", (1, "PERU", 2), "n_nationkey int, n_name string, n_regionkey int"),
        ("customer", (3, 1), "c_custkey bigint, c_nationkey int"),
        ("part", (4, "tin", "Brand#1", "SMALL TIN", 5), "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"),
        ("orders", (6, 3, "2-HIGH", day), "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderdate timestamp"),
        ("lineitem", (6, 4, 1, 7.0, 8.0, "A", "F", day),
         "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    ):
        spark.createDataFrame([row], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_element_found_past_comments(spark):
    """F16, F17: one pass up to the element finds what a search of the stripped page finds, or leaves the page to that search."""
    time, doc = '<time datetime="%d" class="date timeago">', '<script id="ld_posting_data">{"a": "<!-- b"}</script>'
    plain = ["<p>", "<!-- c -->", "<!-- " + time % 9 + " -->", "<time>", "</time>", time % 1, "<script>var a = '<b>';</script>", "<style>", "</style>", doc,
             "<!doctype html>", '<span id="titletextonly">t <b>u</b></span>', '<span class="valu year"> 1999</span>', '<a class="valu makemodel">n</a>', '<span class="slider-info">1 of 3</span>']
    odd = ["<ti", "me ", "<time ", 'class="date timeago"', ">", "<", '"', "'", " ", "<!--", "-->", "-", "x<!-- c -->", "<!-->", "<script ", "<SCRIPT>", "</script >", f"<script>{time % 2}</script>",
           '<div title="<!-- x -->">', "<span", "</span>", '<SPAN ID=titletextonly>a<!-- b -->c</span>', "<sp", 'an id="titletextonly">', "<style>" + time % 3]
    rnd = random.Random(16)
    rows = [(i, "".join(rnd.choices(plain if i % 2 else plain + odd, k=rnd.randint(1, 16)))) for i in range(3000)]
    pages = spark.createDataFrame([*rows, (-1, None), (-2, "")], "id long, raw_html string").repartition(4).cache()
    for find, pattern in H.PAST_COMMENTS.items():
        both = H.find_in_source(pages, find).select(
            F.col("found").eqNullSafe(find(H.strip_comments(F.col("raw_html")))).alias("same"), (F.regexp_extract("raw_html", pattern, 1) != "").alias("near"),
        ).collect()
        assert all(r.same for r in both), find.__name__
        assert sum(bool(r.near) for r in both) > 300
    pages.unpersist()


def test_body_found_past_comments(spark):
    """as above, for an element that holds others of its kind and scripts."""
    opened, nested = '<section class=b id="postingbody">', "<section><section class='x'>q</section></section>"
    plain = ["<p>", "x &amp; y", "<!-- c -->", "<br>", "<div>", "</div>", opened, opened, "</section>", "</section >", nested, "<section>", "<SECTION id=a>", "<script>var a = '<!-- <p>';</script>", "<style>b{}</style>",
             "<section>" * 50 + "d" + "</section>" * 50]
    odd = ["<sec", "tion>", "<!--", "-->", "x<!-- y -->", "<", '"', "'", ">", "<script>", "</script>", f"<script>{opened}</script>", "<script></section></script>", f"<!-- {opened} -->", "<section title='a > b'>", "<section title='<'>",
           "<section>" * 70 + "d" + "</section>" * 70, "<sectional>", "<section "]
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choices(plain if i % 2 else plain + odd, k=rnd.randint(1, 14))) + rnd.choice(["", "</section>"])) for i in range(4000)]
    pages = spark.createDataFrame([*rows, (-1, None), (-2, "")], "id long, raw_html string").repartition(4)
    found = H.find_in_source(pages, H.body_element)
    slow = H.body_element(H.strip_comments(F.col("raw_html")))
    near = F.regexp_extract("raw_html", H._IN_SOURCE[H.body_element], 1)
    both = found.select("raw_html", F.col("found").eqNullSafe(slow).alias("same"), (near != "").alias("near"), (F.length(near) > 1).alias("full")).collect()
    assert all(r.same for r in both), next(r.raw_html for r in both if not r.same)
    assert sum(bool(r.full) for r in both) > 200


def test_spans_inside_spans_of_attribute_rows(spark):
    """the short pattern for labels and values leaves spans that hold spans to the long one."""
    labl, valu = ["<span class=labl>a</span>", '<SPAN class="x labl">b<span>c</span>d:</SPAN >', "<span class='labl'> e <", "<span class=labl>f<spanned>&amp;"], [
        "<span class=valu>1</span>", "<span class='valu'><span class=labl>2</span><span class=valu>3</span> 4</span>", "<span class=valu>5 < 6</span>", "<span class=valu>7<span", "<span class=valu>8</spa",
        "<span class=valu>9<span>10"]
    rnd = random.Random(9)
    rows = [(i, "".join("<div class='attr'>" + "".join(rnd.choices([*labl, *valu, "<b>", "<div>z</div>", " "], k=rnd.randint(0, 5))) + rnd.choice(["</div>", "</DIV>", ""]) for _ in range(rnd.randint(0, 5)))) for i in range(2000)]
    pages = spark.createDataFrame([*rows, (-1, None)], "id long, page string").repartition(4)
    page = F.col("page")
    spans = F.transform(H.all_elements(page, "div", H.by_class("attr")), lambda b: F.struct(
        H.first_element(b, "span", H.by_class("labl")).alias("label"), H.first_element(b, "span", H.by_class("valu")).alias("value")))
    long = F.transform(F.filter(spans, lambda e: (e["label"] != "") & (e["value"] != "")), lambda e: F.struct(
        F.rtrim(T.strip_ws(H.text_of(e["label"])), F.lit(":")).alias("label"), T.strip_ws(H.text_of(e["value"])).alias("value")))
    both = pages.select("page", H.attr_entries(page).alias("got"), long.alias("want")).collect()
    assert [r for r in both if r.got != r.want] == [] and sum(len(r.got or []) for r in both) > 1000
    sizes = H._near_element(page, "span", H.by_class("labl"))._jc.toString(), H.first_element(page, "span", H.by_class("labl"))._jc.toString()
    assert len(sizes[0]) * 10 < len(sizes[1])


def _code_sizes(spark, df):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        return [made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("name", ["jsonld_price", "time_posted"])
def test_code_of_field_queries_can_be_compiled(spark, star, name):
    """F16, F17: as above, with the search in the page."""
    df = catalog.QUERIES[name](spark, star)
    assert max(_code_sizes(spark, df)) < 8000


def test_lines_are_not_shuffled_by_customer(spark, star):
    """F11, F12, F15 to F18, F20: orders meet their customers and nations before the lines."""
    plan = sample.listings(spark, star)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    at = next(i for i, line in enumerate(plan) if "Join" in line and "c_custkey" in line and "o_custkey" in line)
    below = next((i for i in range(at + 1, len(plan)) if depth[i] <= depth[at]), len(plan))
    assert not any("l_orderkey" in line for line in plan[at:below])


def test_code_of_rendered_pages_can_be_compiled(spark, star):
    """F9, F15 to F17: the JVM compiles no method of 8,000 bytes or more and would interpret it for every page."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = sample.raw_pages(spark, star).select("url", "raw_html")
        made = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        assert max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("name", ["parse_quality", "parse_sparse_pages"])
def test_sparse_pages_are_read_once(spark, star, name):
    """what comes after the stored fields reads no page."""
    df = catalog.QUERIES[name](spark, star)
    assert "raw_html" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in " ".join(df.inputFiles())
    row = df.first().asDict()
    assert (row["listings"], row["no_price"]) == (1, 0) if name == "parse_quality" else (row["make"], row["price"], row["condition"]) == ("brand#1", 8.0, "excellent")
