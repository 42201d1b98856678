"""Listing tables derived from the star-schema test tables, and pages rendered from them.

Every line item becomes a vehicle listing; a page renderer turns listings into the HTML
the parser expects, so that parsing can be checked against the listings themselves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.datetime(2001, 8, 1)

LISTINGS_SQL = """
SELECT concat('https://', lower(n_name), '.example.org/cto/d/', replace(p_name, ' ', '-'), '/',
              l_orderkey, '-', l_linenumber, '-', CAST(round(l_extendedprice * 100) AS BIGINT),
              '.html') AS url,
       l_orderkey, l_linenumber, l_partkey, l_shipdate, l_returnflag, l_linestatus,
       lower(n_name) AS location,
       lower(p_brand) AS make,
       lower(p_type) AS model,
       concat(p_brand, ' ', p_type) AS name,
       concat(1990 + p_size % 8, ' ', p_brand, ' ', p_type, ' ', p_name) AS title_text,
       1990 + p_size % 8 AS year,
       l_quantity * 6500 AS odometer,
       l_extendedprice AS price,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'like new' WHEN '2-HIGH' THEN 'excellent'
            WHEN '3-MEDIUM' THEN 'good' WHEN '4-NOT SPECIFIED' THEN 'other' END AS condition,
       CASE l_returnflag WHEN 'A' THEN 'clean' WHEN 'R' THEN 'rebuilt' ELSE 'salvage' END
         AS title,
       CASE l_linenumber % 3 WHEN 0 THEN '4wd' WHEN 1 THEN 'fwd' END AS drive,
       concat(4 + 2 * (l_linenumber % 3), ' cylinders') AS cylinders,
       CASE l_linenumber % 4 WHEN 0 THEN 'SUV' WHEN 1 THEN 'pickup' END AS type,
       CASE WHEN l_returnflag <> 'R' THEN concat('1V', l_orderkey, 'X', l_linenumber) END AS vin,
       o_orderdate AS time_posted
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
"""

#: The same rows for Spark: the orders meet their nations before the lines, so that lines are not shuffled by customer.
_SITES_FIRST = """FROM lineitem
JOIN (SELECT o_orderkey, o_orderdate, o_orderpriority, n_name FROM orders
      JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey) ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
"""

#: Columns of the listings table that the sample has.
LISTING_COLUMNS = (
    "url", "location", "make", "model", "name", "title_text", "year", "odometer", "price", "condition", "title", "drive",
    "cylinders", "type", "vin", "time_posted", "paint", "fuel", "transmission", "latitude", "longitude",
)

STATES_SQL = """
SELECT lower(n_name) AS region, r_name AS state
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE r_name <> 'ASIA'
"""

DICTIONARY_SQL = """
SELECT DISTINCT p_brand AS make, p_type AS model, substr(p_type, 1, 5) AS short_model FROM part
"""


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    names = ("region", "nation", "customer", "part", "orders", "lineitem")
    frames = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names if n in text}
    if "lineitem" in frames:
        # The test tables are one file each, which would keep one core busy.
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Estimates multiply over the joins of the other side, so small lines would be broadcast and one task read all orders.
        frames["lineitem"] = frames["lineitem"].repartition(n, "l_orderkey").hint("merge")
    for name in frames:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(
            f"JOIN {name}", f"JOIN {{{name}}}"
        )
    return spark.sql(text, **frames)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings table: its columns, and the keys they derive from."""
    columns = LISTINGS_SQL.partition("FROM lineitem")[0]
    return _sql(spark, sf_dir, columns + _SITES_FIRST).withColumns(
        {
            "paint": F.col("l_linestatus"),
            "fuel": F.lit("gas"),
            "transmission": F.lit("automatic"),
            "latitude": F.col("l_linenumber") + F.lit(0.25),
            "longitude": -(F.col("l_linenumber") + F.lit(100.5)),
        }
    )


def sparse_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of which some lack a field each, or name nothing that the dictionary has."""
    c = F.col
    gone = {"name": 11, "price": 13, "year": 17, "odometer": 19, "time_posted": 23}
    plain = F.lit("unlisted vehicle")
    return listings(spark, sf_dir).withColumns(
        {
            **{k: F.when(c("l_orderkey") % n != 0, c(k)) for k, n in gone.items()},
            "title_text": F.when(c("l_orderkey") % 7 == 0, plain).otherwise(c("title_text")),
        }
    ).withColumn("name", F.when(c("l_orderkey") % 7 == 0, plain).otherwise(c("name")))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-page table: a rendered page for every listing."""
    return render_pages(listings(spark, sf_dir))


def sparse_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_pages(sparse_listings(spark, sf_dir))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, STATES_SQL)


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, DICTIONARY_SQL)


def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open lines are queued since they were posted; new ones stay queued once pulled."""
    return (
        listings(spark, sf_dir)
        .filter("l_linestatus = 'O' OR l_returnflag = 'N'")
        .select("url", "location", F.col("time_posted").alias("row_created"))
    )


def raw_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings whose line is final have been pulled, when the line shipped."""
    return (
        listings(spark, sf_dir)
        .filter("l_linestatus = 'F'")
        .select("url", F.col("l_shipdate").alias("datetime_pulled"), "location")
    )


def processed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pulled lines that are not new have been parsed, with the flag set for another pass.

    Returned ones had that pass a day later, which cleared the flag.
    """
    base = listings(spark, sf_dir).filter("l_linestatus = 'F' AND l_returnflag <> 'N'")
    first = base.select(
        "url",
        F.lit(True).alias("needs_basic_parsing"),
        F.col("l_shipdate").alias("basic_processed_time"),
    )
    again = base.filter("l_returnflag = 'R'").select(
        "url",
        F.lit(False).alias("needs_basic_parsing"),
        (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("basic_processed_time"),
    )
    return first.union(again)


# --- rendering ------------------------------------------------------------------------------


def _escape(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


#: How deep elements of one kind are nested in rendered pages.
DEPTH = 50


def _nested(tag: str, text: Column, deep: Column | None) -> Column:
    """Text in an element, or in ``DEPTH`` of them where ``deep``."""
    once = F.concat(F.lit(f"<{tag}>"), text, F.lit(f"</{tag}>"))
    return once if deep is None else F.when(deep, F.concat(F.lit(f"<{tag}>" * DEPTH), text, F.lit(f"</{tag}>" * DEPTH))).otherwise(once)


def _markup(label: str, odd: bool, deep: bool) -> Column:
    """What stands before and after the value in an attribute row, written in one of two equivalent ways."""
    tip = f"{'<div>' * DEPTH}nested{'</div>' * DEPTH}" if deep else "<div>nested</div>"
    before = (
        f"<div data-n='1' class='attr auto_x'>\n  <span id=l class=labl> {label}: </span>"
        f'\n  <div class="tip">a {tip} tip</div><span title="v > w" class="valu"> <a href="/s">'
    ) if odd else f'<div class="attr"><span class="labl">{label}:</span> <span class="valu">'
    after = "</a> </span>\n</div>\n" if odd else "</span></div>\n"
    return F.struct(F.lit(before).alias("before"), F.lit(after).alias("after"))


def _attrs(odd: Column, deep: Column, rows: list[tuple[str, Column, bool]], nested: str) -> Column:
    """Attribute rows (label, value, written the odd way on odd or on other pages) with a value, as one text.

    The markup is constant but for ``odd`` and, in the row ``nested``, ``deep``; values are escaped in a loop, so that
    the code for a page stays short enough to be compiled.
    """
    def written(is_odd: bool | None, is_deep: bool = False) -> Column:
        return F.array(*[_markup(label, is_odd == on_odd, is_deep and label == nested) for label, _, on_odd in rows])

    markup = F.when(odd & deep, written(True, True)).when(odd, written(True)).when(~odd, written(False)).otherwise(written(None))
    values = F.array(*[value.cast("string") for _, value, _ in rows])
    return F.array_join(F.zip_with(markup, values, lambda m, v: F.concat(m["before"], _escape(v), m["after"])), "")


def body_text(row_no: Column, name: Column) -> Column:
    """The posting body a listing is rendered with."""
    return F.concat(
        F.lit("\nRuns & drives <great>\nCall about the "), name, F.lit(" #"), row_no, F.lit(" – thanks\n")
    )


def render_pages(listings_df: DataFrame) -> DataFrame:
    """Raw pages (``url, datetime_pulled, raw_html, location``) for listings.

    Mileages of every fifth line are written in thousands; markup style varies with the
    line number.
    """
    c = F.col
    odd = c("l_linenumber") % 2 == 1
    thousands = c("l_linenumber") % 5 == 0
    miles = F.when(thousands, c("odometer") / 1000).otherwise(c("odometer")).cast("string")
    quote = lambda s: F.concat(F.lit('"'), s, F.lit('"'))
    or_blank = lambda k: F.coalesce(c(k).cast("string"), F.lit(""))
    doc = F.concat(
        F.lit('{"@type": "Product", "name": '), quote(c("title_text")),
        F.lit(', "description": '), quote(F.concat(or_blank("name"), F.lit(" in good order <!-- really"))),
        F.lit(', "offers": {"price": '),
        F.coalesce(
            F.when(odd, c("price").cast("string")).otherwise(quote(c("price").cast("string"))),
            F.lit("null"),
        ),
        F.lit(', "availableAtOrFrom": {"geo": {"latitude": '), c("latitude").cast("string"),
        F.lit(', "longitude": '), c("longitude").cast("string"), F.lit("}}}}"),
    )
    body = _escape(body_text(c("l_linenumber"), or_blank("name")))
    body = F.replace(
        F.replace(body, F.lit("–"), F.when(odd, F.lit("&#8211;")).when(thousands, F.lit("&#150 ")).otherwise(F.lit("&ndash;"))),
        F.lit("\n"), F.lit("<br>\n"),
    )
    # The number above ends at the blank, which belongs to the text.
    body = F.replace(body, F.lit("&#150  "), F.lit("&#150 "))
    page = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>listing</title>"
              '<!-- <span id="titletextonly">not this</span> -->\n'
              '<script type="application/ld+json" id="ld_posting_data" >'), doc,
        F.lit("</script></head><body>\n<h1><span id=\"titletextonly\">"), _escape(c("title_text")),
        F.lit('</span></h1>\n<time class="date timeago" datetime="'),
        F.coalesce(F.date_format("time_posted", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("")), F.lit('-0700">posted</time>\n'),
        F.lit('<span class="slider-info">image 1 of '), c("l_linenumber").cast("string"),
        F.lit('</span>\n<div class="attrgroup"><span class="valu year"> '), or_blank("year"),
        F.lit('</span>\n<a href="/x" class="valu makemodel"> '), _escape(or_blank("name")), F.lit(" </a></div>\n"),
        _attrs(odd, thousands, [
            ("odometer", miles, True),
            ("condition", c("condition"), True),
            ("title status", F.lit("unknown"), True),
            ("title status", c("title"), False),
            ("paint color", c("paint"), True),
            ("drive", c("drive"), True),
            ("cylinders", c("cylinders"), False),
            ("type", c("type"), True),
            ("VIN", c("vin"), False),
            ("fuel", c("fuel"), True),
            ("transmission", c("transmission"), False),
        ], nested="odometer"),
        F.lit('<section class="body" id="postingbody"><div>'),
        _nested("section", F.lit("<p>QR</p>"), thousands),
        F.lit('<script>var a = "<p>";</script></div>'),
        body, F.lit("</section></body></html>"),
    )
    return listings_df.select(
        "url", c("l_shipdate").alias("datetime_pulled"), page.alias("raw_html"), "location"
    )


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-result pages (``location, page_no, html``), in the order of the lines.

    Each names two parts offered on the site, and one on a neighbouring site that must be
    left aside; parts recur, so that every site's crawl comes to an end.
    """
    c = F.col
    part = F.concat(F.lit(".example.org/cto/d/"), c("l_partkey").cast("string"), F.lit(".html"))
    own = F.concat(F.lit("https://"), c("location"), part)
    far = F.concat(F.lit("https://wider-area"), part)
    next_ = F.concat(
        F.lit("https://"), c("location"), F.lit(".example.org/cto/d/"),
        (c("l_partkey") + 1).cast("string"), F.lit(".html?a=1&amp;b=2"),
    )
    html = F.concat(
        F.lit("<html><ul><li><a class='cl-app posting-title' tabindex=0 href='"), own,
        F.lit("?a=1&amp;b=2'>one</a></li>\n<!-- <a class=\"posting-title\" href=\"https://"),
        c("location"), F.lit('.example.org/gone">x</a> -->\n<li><a href="'), far,
        F.lit('" class="posting-title">two</a></li>\n<li><a href="'), own,
        F.lit('#map" class="map">three</a></li><li><a class="posting-title" href="'), next_,
        F.lit('">four</a></ul></html>'),
    )
    return listings(spark, sf_dir).select(
        "location", (c("l_orderkey") * 8 + c("l_linenumber")).alias("page_no"), html.alias("html")
    )


def directory_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-directory pages (``page_no, html``): one per customer, naming its nation's site."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    site = F.concat(F.lit("https://"), F.lower("n_name"), F.lit(".example.org/"))
    html = F.concat(
        F.lit('<body><a href="https://elsewhere.example.org/">x</a>'
              "<div class='geo-site-list-container wide'><div><ul><li><a href=\""), site,
        F.lit('old">a</a></ul></div><script>"</div>"</script><div><li><a title="b > c" href="'), site, F.col("c_custkey").cast("string"),
        F.lit('">b</a></div></div><a href="https://after.example.org/">y</a></body>'),
    )
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("page_no"), html.alias("html")
    )
