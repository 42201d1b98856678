"""Every operator as a query over the test tables, with an independent SQL oracle.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` maps it to SQL
that computes the same rows from the tables directly.  Floating results are rounded alike
on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import html as H
from forecourt.functions.pricing import condition_flag, predicted_price
from forecourt.functions.text import correct_make, correct_model, decode_entities
from forecourt.functions.urls import location_from_url, post_id
from forecourt.operators import extract, frontier, fuzzy, regression, scoring, standardize, summaries, training

from forecourt.schemas import CELLS, FRONTIER, LISTINGS, MODELS, RAW_PAGES, RUN_LOG
from forecourt.plans import jobs
from forecourt.sources import runs, sample, tables

AS_OF = sample.AS_OF
# The sample is spread over years, so look further back than the default half year.
LOOKBACK, MIN_GROUP, BITING_GROUP = 3650, 100, 300

QUERIES: dict = {}
#: Queries that write tables before they read them, in the session's shared scratch folder.
STORING: set[str] = set()
ORACLES: dict[str, str] = {}
c = F.col


def query(oracle: str, name: str | None = None):
    def register(fn):
        QUERIES[name or fn.__name__] = fn
        ORACLES[name or fn.__name__] = oracle
        return fn

    return register


def storing(fn):
    STORING.add(fn.__name__)
    return fn


def _with(body: str, **ctes: str) -> str:
    parts = {"listings": sample.LISTINGS_SQL, **ctes}
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n" + body


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.raw_pages(spark, sf_dir).select(
        "url", "location", H.strip_comments(c("raw_html")).alias("page")
    )


def _field(spark, sf_dir, name: str, find, *reads) -> DataFrame:
    """Element, then each step of reading it, in projections of their own: nothing is computed twice."""
    rows = H.find_in_source(sample.raw_pages(spark, sf_dir).select("url", "raw_html"), find).select("url", "found")
    for read in reads[:-1]:
        rows = rows.select("url", read(c("found")).alias("found"))
    return rows.select("url", reads[-1](c("found")).alias(name))


# --- frontier -------------------------------------------------------------------------------

_FRONTIER = """SELECT url, location, time_posted AS row_created FROM listings
WHERE l_linestatus = 'O' OR l_returnflag = 'N'"""
_RAW = "SELECT url, l_shipdate AS datetime_pulled, location FROM listings WHERE l_linestatus = 'F'"
_RESULT_LINKS = """SELECT location, l_orderkey * 8 + l_linenumber AS page_no, pos,
  concat('https://', location, '.example.org/cto/d/', l_partkey + pos // 2, '.html?a=1&b=2') AS url
FROM listings, (VALUES (0), (2)) AS places(pos)"""
_RECENT = """SELECT url FROM raw WHERE datetime_pulled > TIMESTAMP '2001-07-02 00:00:00'
UNION SELECT url FROM frontier"""
_PROCESSED = """SELECT url, true AS flag, l_shipdate AS parsed FROM listings
WHERE l_linestatus = 'F' AND l_returnflag <> 'N'
UNION ALL SELECT url, false, l_shipdate + INTERVAL 1 DAY FROM listings
WHERE l_linestatus = 'F' AND l_returnflag = 'R'"""
_BACKLOG = """SELECT url FROM (SELECT url, flag, row_number() OVER
  (PARTITION BY url ORDER BY parsed DESC) AS rn FROM processed) WHERE rn = 1 AND flag
UNION SELECT url FROM raw WHERE url NOT IN (SELECT url FROM processed)"""


@query(_with("SELECT url, location FROM listings"))
def url_location(spark, sf_dir):
    return sample.listings(spark, sf_dir).select(
        "url", location_from_url(c("url")).alias("location")
    )


@query(_with("SELECT location, page_no, pos, url FROM links", links=_RESULT_LINKS))
def listing_links(spark, sf_dir):
    return frontier.listing_links(sample.result_pages(spark, sf_dir))


@query(
    """WITH anchors AS (
  SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages)
SELECT '' AS location, page_id AS page_no, pos - 1 AS pos, replace(hrefs[pos], '&amp;', '&') AS url
FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS pos FROM anchors)"""
)
def page_links(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.lit("").alias("location"), c("page_id").alias("page_no"), "html"
    )
    return frontier.listing_links(pages, css_class=None)


@query(
    """SELECT lower(n_name) AS location,
  concat('https://', lower(n_name), '.example.org/', max(c_custkey)) AS url
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""
)
def site_directory(spark, sf_dir):
    return frontier.site_directory(sample.directory_pages(spark, sf_dir))


@query(
    _with(
        """SELECT location, page_no, pos, url FROM seen
WHERE page_no < coalesce((SELECT min(s.page_no) FROM stale s WHERE s.location = seen.location),
  9223372036854775807)""",
        links=_RESULT_LINKS,
        seen="""SELECT *, page_no = min(page_no) OVER (PARTITION BY location, url) AS fresh
FROM links""",
        stale="""SELECT location, page_no FROM seen GROUP BY location, page_no
HAVING NOT bool_or(fresh)""",
    )
)
@storing
def crawl_new_links(spark, sf_dir):
    """Links stored once, then crawled."""
    pages = sample.result_pages(spark, sf_dir)
    return frontier.crawl_new_links(pages, frontier.stored_links(pages, runs.scratch_table(spark, "crawl")))


@query(_with(_RECENT, frontier=_FRONTIER, raw=_RAW))
def recent_urls(spark, sf_dir):
    return frontier.recent_urls(
        sample.raw_keys(spark, sf_dir), sample.frontier(spark, sf_dir), AS_OF
    )


@query(
    _with(
        """SELECT DISTINCT url, location, TIMESTAMP '2001-08-01 00:00:00' AS row_created
FROM listings WHERE url NOT IN (SELECT url FROM recent)""",
        frontier=_FRONTIER,
        raw=_RAW,
        recent=_RECENT,
    )
)
def frontier_new_links(spark, sf_dir):
    found = sample.listings(spark, sf_dir).select(
        "location", c("l_linenumber").alias("page_no"), "url"
    )
    again = found.withColumns(
        {"page_no": c("page_no") + 1, "location": F.concat("location", F.lit("-later"))}
    )
    return frontier.new_links(found.union(again), recent_urls(spark, sf_dir), AS_OF)


@query(
    _with(
        """SELECT url, location FROM frontier WHERE url NOT IN (SELECT url FROM raw)
ORDER BY row_created, url LIMIT 130""",
        frontier=_FRONTIER,
        raw=_RAW,
    )
)
def harvest_batch(spark, sf_dir):
    return frontier.harvest_batch(sample.frontier(spark, sf_dir), sample.raw_keys(spark, sf_dir))


@query(
    _with(
        "SELECT * FROM frontier WHERE url NOT IN (SELECT url FROM raw)",
        frontier=_FRONTIER,
        raw=_RAW,
    )
)
def frontier_cleanup(spark, sf_dir):
    return frontier.frontier_cleanup(
        sample.frontier(spark, sf_dir), sample.raw_keys(spark, sf_dir)
    )


@query(_with(_BACKLOG, raw=_RAW, processed=_PROCESSED))
def parse_backlog(spark, sf_dir):
    return frontier.parse_backlog(
        sample.raw_keys(spark, sf_dir), sample.processed_state(spark, sf_dir)
    )


@query(
    _with(
        f"""SELECT url FROM ({_BACKLOG}) ORDER BY md5(concat('41', url)), url LIMIT 2500""",
        raw=_RAW,
        processed=_PROCESSED,
    )
)
def parse_batch(spark, sf_dir):
    return frontier.parse_batch(parse_backlog(spark, sf_dir))


@query(
    _with(
        f"""SELECT url, location, datetime_pulled FROM raw WHERE url IN (
  SELECT url FROM ({_BACKLOG}) ORDER BY md5(concat('41', url)), url LIMIT 2500)""",
        raw=_RAW,
        processed=_PROCESSED,
    )
)
def pages_to_parse(spark, sf_dir):
    return frontier.pages_to_parse(
        sample.raw_keys(spark, sf_dir), parse_batch(spark, sf_dir)
    ).select("url", "location", "datetime_pulled")


@query(
    _with(
        """SELECT url, needs_basic_parsing, price FROM (
  SELECT url, l_returnflag <> 'R' AS needs_basic_parsing,
    CASE WHEN l_returnflag = 'R' THEN price * 2 ELSE price END AS price
  FROM listings WHERE l_linestatus = 'F' AND l_returnflag <> 'N')"""
    )
)
def latest_listings(spark, sf_dir):
    """Of listings that were parsed again, the later parse, which read twice the price."""
    prices = sample.listings(spark, sf_dir).select("url", "price")
    parses = sample.processed_state(spark, sf_dir).join(prices, "url").withColumn(
        "price", F.when(c("needs_basic_parsing"), c("price")).otherwise(c("price") * 2)
    )
    return frontier.latest_listings(parses).select("url", "needs_basic_parsing", "price")


# --- extraction -----------------------------------------------------------------------------

_ODOMETER_TEXT = """CAST(CASE WHEN l_linenumber % 5 = 0 THEN odometer / 1000 ELSE odometer END
  AS VARCHAR)"""


@query(
    _with(
        f"""SELECT url, label, value FROM (
  SELECT url, 'odometer' AS label, {_ODOMETER_TEXT} AS value FROM listings
  UNION ALL SELECT url, 'condition', condition FROM listings
  UNION ALL SELECT url, 'title status', title FROM listings
  UNION ALL SELECT url, 'paint color', l_linestatus FROM listings
  UNION ALL SELECT url, 'fuel', 'gas' FROM listings
  UNION ALL SELECT url, 'drive', drive FROM listings
  UNION ALL SELECT url, 'cylinders', cylinders FROM listings
  UNION ALL SELECT url, 'type', type FROM listings
  UNION ALL SELECT url, 'VIN', vin FROM listings
  UNION ALL SELECT url, 'transmission', 'automatic' FROM listings)
WHERE value IS NOT NULL"""
    )
)
def attr_group(spark, sf_dir):
    entries = _pages(spark, sf_dir).select("url", H.attr_entries(c("page")).alias("entries"))
    return entries.select(
        "url", F.explode(H.last_wins(c("entries"))).alias("label", "value")
    )


@query(_with("SELECT url, odometer FROM listings"))
def odometer_repair(spark, sf_dir):
    return _field(
        spark, sf_dir, "odometer", H.attr_entries,
        lambda found: H.repair_odometer(H.pick(found, "odometer")),
    )


@query(
    _with(
        """SELECT url, concat(l_orderkey, '-', l_linenumber, '-',
  CAST(round(price * 100) AS BIGINT)) AS post_id FROM listings"""
    ),
    name="post_id",
)
def listing_post_id(spark, sf_dir):
    return sample.listings(spark, sf_dir).select("url", post_id(c("url")).alias("post_id"))


@query(_with("SELECT url, time_posted FROM listings"))
def time_posted(spark, sf_dir):
    return _field(spark, sf_dir, "time_posted", H.time_tag, H.time_posted)


@query(_with("SELECT url, name FROM listings"))
def listing_name(spark, sf_dir):
    return _field(spark, sf_dir, "name", H.name_element, H.listing_name)


@query(_with("SELECT url, year FROM listings"))
def listing_year(spark, sf_dir):
    return _field(spark, sf_dir, "year", H.year_element, H.listing_year)


@query(_with("SELECT url, title_text FROM listings"))
def title_text(spark, sf_dir):
    return _field(spark, sf_dir, "title_text", H.title_element, H.encoded_text, decode_entities)


_BODY = """concat('QR', chr(10), 'Runs & drives <great>', chr(10), 'Call about the ', name, ' #',
  l_linenumber, ' – thanks', chr(10))"""


@query(_with(f"SELECT url, {_BODY} AS posting_body_text FROM listings"))
def posting_body(spark, sf_dir):
    return _field(spark, sf_dir, "posting_body_text", H.body_element, H.encoded_text, decode_entities)


@query(_with("SELECT url, price FROM listings"))
def jsonld_price(spark, sf_dir):
    return _field(
        spark, sf_dir, "price", H.jsonld_element, lambda e: H.jsonld_price(H.source_of(e))
    )


_GEO = """l_linenumber + CAST(0.25 AS DOUBLE) AS latitude,
  -(l_linenumber + CAST(100.5 AS DOUBLE)) AS longitude"""


@query(_with(f"SELECT url, {_GEO} FROM listings"))
def jsonld_geo(spark, sf_dir):
    doc = H.source_of(c("found"))
    return H.find_in_source(sample.raw_pages(spark, sf_dir).select("url", "raw_html"), H.jsonld_element).select(
        "url",
        H.jsonld_latitude(doc).alias("latitude"),
        H.jsonld_longitude(doc).alias("longitude"),
    )


@query(
    _with("SELECT url, concat(title_text, '>>>', name, ' in good order <!-- really') AS description FROM listings")
)
def jsonld_description(spark, sf_dir):
    return _field(
        spark, sf_dir, "description", H.jsonld_element,
        lambda e: H.jsonld_description(H.source_of(e)),
    )


@query(_with("SELECT url, l_linenumber AS num_images FROM listings"))
def num_images(spark, sf_dir):
    return _field(spark, sf_dir, "num_images", H.images_element, H.num_images)


_FLAGS = """false AS needs_basic_parsing, TIMESTAMP '2001-08-01 00:00:00' AS basic_processed_time,
  {needs} AS needs_ai_parsing, CAST(NULL AS TIMESTAMP) AS ai_processed_time"""


@query(
    _with(
        "SELECT url, "
        + _FLAGS.format(
            needs="coalesce(condition, '') = 'other' OR condition IS NULL OR l_returnflag = 'R'"
        )
        + " FROM listings"
    )
)
def parse_flags(spark, sf_dir):
    rows = sample.listings(spark, sf_dir).select(
        "url",
        F.when(c("condition") != "other", c("make")).otherwise(F.lit("")).alias("make"),
        F.when(c("condition").isNotNull(), c("model")).alias("model"),
        F.when(c("l_returnflag") == "R", 0.0).otherwise(c("price")).alias("price"),
    )
    return extract.parse_flags(rows, AS_OF).drop("make", "model", "price")


@query(
    _with(
        f"""SELECT url, location, odometer, title, l_linestatus AS paint, drive,
  cylinders, condition, 'gas' AS fuel, type,
  'automatic' AS transmission, vin, name,
  concat(l_orderkey, '-', l_linenumber, '-', CAST(round(price * 100) AS BIGINT)) AS post_id,
  time_posted, year, price, {_BODY} AS posting_body_text, title_text,
  l_linenumber AS num_images, {_GEO}, make, model, {_FLAGS.format(needs='false')}
FROM listings"""
    )
)
@storing
def parse_listings(spark, sf_dir):
    """Each page read once: its fields are stored, and met by the makes and models found in them."""
    raw = sample.raw_pages(spark, sf_dir)
    return extract.parse_stored(raw, sample.dictionary(spark, sf_dir), AS_OF, runs.scratch_table(spark, "parse"))


_SPARSE = """SELECT url, condition, CASE WHEN l_orderkey % 7 = 0 THEN 'unlisted vehicle'
    WHEN l_orderkey % 11 <> 0 THEN name END AS name,
  CASE WHEN l_orderkey % 7 <> 0 THEN make END AS make,
  CASE WHEN l_orderkey % 7 <> 0 THEN model END AS model,
  CASE WHEN l_orderkey % 13 <> 0 THEN price END AS price,
  CASE WHEN l_orderkey % 17 <> 0 THEN year END AS year,
  CASE WHEN l_orderkey % 19 <> 0 THEN odometer END AS odometer,
  CASE WHEN l_orderkey % 23 <> 0 THEN time_posted END AS time_posted FROM listings"""
_SPARSE_FIELDS = ["name", "make", "model", "year", "odometer", "price", "condition", "time_posted"]


def _sparse(spark, sf_dir) -> DataFrame:
    pages, words = sample.sparse_pages(spark, sf_dir), sample.dictionary(spark, sf_dir)
    return extract.parse_listings(pages, words, AS_OF, runs.scratch_table(spark, "parse"))


@query(
    _with(
        f"""SELECT url, coalesce(name, '') AS name, CASE WHEN name IS NOT NULL THEN make END AS make,
  CASE WHEN name IS NOT NULL THEN model END AS model, year, odometer, price, condition, time_posted,
  make IS NULL OR model IS NULL OR price IS NULL AS needs_ai_parsing FROM sparse""",
        sparse=_SPARSE,
    )
)
@storing
def parse_sparse_pages(spark, sf_dir):
    """Pages that lack a field each: the field is empty, the row and its other fields stay.

    Make and model are compared where they come from the name; titles name parts besides.
    """
    rows = _sparse(spark, sf_dir).select("url", *_SPARSE_FIELDS, "needs_ai_parsing")
    named = {k: F.when(c("name") != "", c(k)) for k in ("make", "model")}
    return rows.withColumns({**named, "name": F.coalesce("name", F.lit(""))})


@query(
    _with(
        "SELECT count(*) AS listings, "
        + ", ".join(f"count(*) FILTER (WHERE {f} IS NULL) AS no_{f}" for f in _SPARSE_FIELDS)
        + " FROM sparse",
        sparse=_SPARSE,
    )
)
@storing
def parse_quality(spark, sf_dir):
    return extract.quality_counts(
        _sparse(spark, sf_dir).withColumn("name", F.nullif("name", F.lit("")))
    )


def _between_sql(pattern: str) -> str:
    text = f"regexp_extract(html, '{pattern}', 1, 's')"
    for reference, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{reference}', '{char}')"
    return text


@query(
    f"""SELECT page_id, {_between_sql('<title>(.*?)</title>')} AS title,
  {_between_sql('<h1>(.*?)</h1>')} AS heading,
  {_between_sql('<div class="ad">(?:<p>)?(.*?)(?:</p>)?</div>')} AS advert FROM pages"""
)
def page_fields(spark, sf_dir):
    """Fields of the given web pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = pages.select("page_id", H.strip_comments(c("html")).alias("page")).select(
        "page_id",
        H.first_element(c("page"), "title").alias("title"),
        H.first_element(c("page"), "h1").alias("heading"),
        H.first_element(c("page"), "div", H.by_class("ad")).alias("advert"),
    )
    return found.select("page_id", *[H.text_of(c(f)).alias(f) for f in ("title", "heading", "advert")])


# --- standardisation ------------------------------------------------------------------------

_PAIRS = """SELECT DISTINCT lower(p_brand) AS make, lower(p_type) AS model FROM part
UNION SELECT DISTINCT lower(p_brand), lower(substr(p_type, 1, 5)) FROM part"""
# Some names are missing or say nothing, so that the title has to serve.
_TEXTS = """SELECT url, CASE WHEN condition IS NULL THEN NULL WHEN condition = 'other'
    THEN 'see title' ELSE name END AS name, title_text FROM listings"""
_TYPOS = {
    "red": "Chevy", "blue": "Cheverolet", "hot": "MERCEDEZ", "cold": "VW", "new": "volkswagon",
    "old": "Volkwagen", "large": "Infinity", "small": "chysler", "anvil": "Oddysey",
}


def _mistyped(text: Column) -> Column:
    for word, typo in _TYPOS.items():
        text = F.replace(text, F.lit(word), F.lit(typo))
    return text


def _mistyped_sql(text: str) -> str:
    for word, typo in _TYPOS.items():
        text = f"replace({text}, '{word}', '{typo}')"
    return text


def _texts(spark, sf_dir) -> DataFrame:
    return sample.listings(spark, sf_dir).select(
        "url",
        F.when(c("condition") == "other", F.lit("see title"))
        .when(c("condition").isNotNull(), c("name"))
        .alias("name"),
        "title_text",
    )


@query(_PAIRS)
def make_models(spark, sf_dir):
    return standardize.make_models(sample.dictionary(spark, sf_dir))


@query(
    _with(
        """SELECT url, CASE
  WHEN contains(t, 'chevy') THEN replace(t, 'chevy', 'chevrolet')
  WHEN contains(t, 'cheverolet') THEN replace(t, 'cheverolet', 'chevrolet')
  WHEN contains(t, 'mercedez') THEN replace(t, 'mercedez', 'mercedes')
  WHEN contains(t, 'vw') THEN replace(t, 'vw', 'volkswagen')
  WHEN contains(t, 'volkswagon') THEN replace(t, 'volkswagon', 'volkwagen')
  WHEN contains(t, 'volkwagen') THEN replace(t, 'volkwagen', 'volkswagen')
  WHEN contains(t, 'infinity') THEN replace(t, 'infinity', 'infiniti')
  WHEN contains(t, 'chysler') THEN replace(t, 'chysler', 'chrysler')
  ELSE t END AS corrected FROM typed""",
        typed=f"SELECT url, lower({_mistyped_sql('title_text')}) AS t FROM listings",
    ),
    name="correct_make",
)
def corrected_make(spark, sf_dir):
    return sample.listings(spark, sf_dir).select(
        "url", correct_make(_mistyped(c("title_text"))).alias("corrected")
    )


@query(
    _with(
        f"""SELECT url, replace(lower({_mistyped_sql('title_text')}), 'oddysey', 'odyssey')
  AS corrected FROM listings"""
    ),
    name="correct_model",
)
def corrected_model(spark, sf_dir):
    return sample.listings(spark, sf_dir).select(
        "url", correct_model(_mistyped(c("title_text"))).alias("corrected")
    )


def _lookup_sql(rank: int, column: str, term: str, source: str, on: str) -> str:
    return f"""SELECT t.url, {rank} AS rank, {term} AS term FROM texts t JOIN {source} d
  ON {on} AND (contains(lower(t.{column}), {term})
    OR contains(lower(t.{column}), replace({term}, '-', ' ')))"""


def _found_sql(hits: str, term: str) -> str:
    return f"""SELECT url, first(term ORDER BY rank, length(term) DESC, term) AS {term}
FROM ({hits}) GROUP BY url"""


_MAKE_HITS = " UNION ALL ".join(
    _lookup_sql(rank, column, "d.make", "(SELECT DISTINCT make FROM pairs)", "true")
    for rank, column in enumerate(["name", "title_text"])
)
_MODEL_HITS = " UNION ALL ".join(
    _lookup_sql(rank, column, "d.model", "pairs", "t.make = d.make")
    for rank, column in enumerate(["name", "title_text"])
)


@query(
    _with(
        "SELECT texts.*, make FROM texts LEFT JOIN found USING (url)",
        pairs=_PAIRS,
        texts=_TEXTS,
        found=_found_sql(_MAKE_HITS, "make"),
    )
)
def match_make(spark, sf_dir):
    return standardize.match_make(_texts(spark, sf_dir), sample.dictionary(spark, sf_dir))


@query(
    _with(
        """SELECT url, name, title_text, make FROM unique_texts LEFT JOIN found USING (url)""",
        pairs=_PAIRS,
        unique_texts="""SELECT url, name, concat(title_text, ' ', url) AS title_text
FROM (SELECT url, CASE WHEN condition IS NULL THEN NULL WHEN condition = 'other'
    THEN 'see title' ELSE name END AS name, title_text FROM listings)""",
        found=_found_sql(_MAKE_HITS.replace("FROM texts t", "FROM unique_texts t"), "make"),
    )
)
def match_make_unique(spark, sf_dir):
    """Titles that are all different, as real ones are."""
    texts = _texts(spark, sf_dir).withColumn("title_text", F.concat_ws(" ", "title_text", "url"))
    return standardize.match_make(texts, sample.dictionary(spark, sf_dir))


@query(
    _with(
        "SELECT texts.*, model FROM texts LEFT JOIN found USING (url)",
        pairs=_PAIRS,
        texts="""SELECT url, CASE WHEN condition = 'good' THEN NULL ELSE make END AS make,
  CASE WHEN condition IS NULL THEN NULL WHEN condition = 'other'
    THEN 'see title' ELSE name END AS name, title_text FROM listings""",
        found=_found_sql(_MODEL_HITS, "model"),
    )
)
def match_model(spark, sf_dir):
    texts = _texts(spark, sf_dir).join(
        sample.listings(spark, sf_dir).select(
            "url", F.when(~c("condition").eqNullSafe("good"), c("make")).alias("make")
        ),
        "url",
    )
    return standardize.match_model(texts, sample.dictionary(spark, sf_dir))


_FUZZY_INPUTS = """SELECT DISTINCT input FROM (
  SELECT replace(replace(p_name, 'ar', 'arr'), 'on', 'om') AS input FROM part
  UNION ALL SELECT concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1)) FROM part
  UNION ALL SELECT concat(lower(p_brand), ' ', replace(p_name, 'e', 'a'), '!') FROM part
  UNION ALL SELECT concat(lower(p_type), ' ', replace(p_name, 'd ', ' ')) FROM part
  UNION ALL SELECT concat(p_name, ' ', p_name, ' u u u') FROM part
  UNION ALL SELECT substr(p_name, 1, 2) FROM part
  UNION ALL SELECT p_name FROM part)"""
_FUZZY_TARGETS = """SELECT p_name AS target FROM part
UNION SELECT concat(lower(p_type), ' ', p_name) FROM part"""


def _ratio_sql(a: str, b: str) -> str:
    return f"""CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE
  ELSE 1 - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})) END"""


def _fuzzy_sql(inputs: str, targets: str, score, partial: str, cutoff: float) -> str:
    """All pairs scored in four ways; ``score(a, b)`` and the ``partial`` rows are the measure's."""
    return f"""WITH inputs AS ({inputs}), targets AS ({targets}),
pairs AS (
  SELECT input, target, trim(regexp_replace(lower(input), '[^a-z0-9]+', ' ', 'g')) AS a,
    trim(regexp_replace(lower(target), '[^a-z0-9]+', ' ', 'g')) AS b
  FROM inputs, targets WHERE input NOT IN (SELECT target FROM targets)),
parts AS (
  SELECT *, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s,
    CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l,
    array_to_string(list_sort(string_split(a, ' ')), ' ') AS sa,
    array_to_string(list_sort(string_split(b, ' ')), ' ') AS sb,
    list_sort(list_distinct(string_split(a, ' '))) AS wa,
    list_sort(list_distinct(string_split(b, ' '))) AS wb
  FROM pairs),
sets AS (
  SELECT *, array_to_string(list_filter(wa, lambda w: list_contains(wb, w)), ' ') AS t0,
    trim(concat(array_to_string(list_filter(wa, lambda w: list_contains(wb, w)), ' '), ' ',
      array_to_string(list_filter(wa, lambda w: NOT list_contains(wb, w)), ' '))) AS t1,
    trim(concat(array_to_string(list_filter(wa, lambda w: list_contains(wb, w)), ' '), ' ',
      array_to_string(list_filter(wb, lambda w: NOT list_contains(wa, w)), ' '))) AS t2
  FROM parts),
scored AS (
  SELECT input, target, 1 AS scorer, {score('a', 'b')} AS score FROM sets
  UNION ALL SELECT input, target, 2, {partial}
  UNION ALL SELECT input, target, 3, {score('sa', 'sb')} FROM sets
  UNION ALL SELECT input, target, 4, greatest({score('t0', 't1')}, {score('t0', 't2')},
    {score('t1', 't2')}) FROM sets)
SELECT input, target AS match FROM (
  SELECT *, row_number() OVER (PARTITION BY input, scorer ORDER BY score DESC, target) AS rn
  FROM scored WHERE score >= {cutoff}) WHERE rn <= 3
UNION SELECT input, input FROM inputs WHERE input IN (SELECT target FROM targets)"""


_EDIT_STRETCHES = """list_max(list_transform(range(1, length(l) - length(s) + 2),
    lambda i: 1 - levenshtein(s, substr(l, i, length(s)))::DOUBLE / length(s))) FROM sets"""


@query(_fuzzy_sql(_FUZZY_INPUTS, _FUZZY_TARGETS, _ratio_sql, _EDIT_STRETCHES, 0.9))
def fuzzy_match(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    name = c("p_name")
    swap = lambda s, a, b: F.replace(s, F.lit(a), F.lit(b))
    typed = F.array(
        swap(swap(name, "ar", "arr"), "on", "om"),
        F.concat(F.split_part(name, F.lit(" "), F.lit(2)), F.lit(" "),
                 F.split_part(name, F.lit(" "), F.lit(1))),
        F.concat(F.lower("p_brand"), F.lit(" "), swap(name, "e", "a"), F.lit("!")),
        F.concat(F.lower("p_type"), F.lit(" "), swap(name, "d ", " ")),
        F.concat(name, F.lit(" "), name, F.lit(" u u u")),
        F.substring(name, 1, 2),
        name,
    )
    listed = F.array(name, F.concat(F.lower("p_type"), F.lit(" "), name))
    return fuzzy.fuzzy_match(
        part.select(F.explode(typed).alias("input")), part.select(F.explode(listed).alias("target"))
    )


_CHARS_INPUTS = """SELECT DISTINCT input FROM (
  SELECT replace(replace(p_name, 'ar', 'arr'), 'on', 'om') AS input FROM part
  UNION ALL SELECT concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1)) FROM part
  UNION ALL SELECT concat(replace(p_name, 'e', 'ee'), '!') FROM part
  UNION ALL SELECT concat(p_name, ' ', p_name, ' u') FROM part
  UNION ALL SELECT lower(replace(p_brand, '#', ' 0')) FROM part
  UNION ALL SELECT p_name FROM part)"""
_CHARS_TARGETS = "SELECT p_name AS target FROM part UNION SELECT lower(p_brand) FROM part"


def _points_sql(a: str, b: str) -> str:
    """Whole points of twice the common subsequence over both lengths, by dynamic programming."""
    chars = lambda x: f"string_split({x}, '')"
    row = f"""list_reduce(generate_series(1, length({b})), lambda new, j: list_append(new, CASE WHEN substr({b}, j, 1) = x
      THEN row_[j] + 1 ELSE greatest(row_[j + 1], new[j]) END), [0::BIGINT])"""
    matched = f"list_last(list_reduce({chars(a)}, lambda row_, x: {row}, list_resize([0::BIGINT], length({b}) + 1, 0::BIGINT)))"
    both = f"(length({a}) + length({b}))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE (400 * {matched} + {both}) // (2 * {both}) END"


_POINT_STRETCHES = f"""points FROM (SELECT input, target, max({_points_sql('s', 'piece')}) AS points FROM (
    SELECT input, target, s, substr(l, unnest(generate_series(1, length(l) - length(s) + 1)), length(s)) AS piece
    FROM sets) GROUP BY ALL)"""


@query(_fuzzy_sql(_CHARS_INPUTS, _CHARS_TARGETS, _points_sql, _POINT_STRETCHES, 90))
def fuzzy_match_chars(spark, sf_dir):
    """Scores by matching characters, in whole points."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    name = c("p_name")
    swap = lambda s, a, b: F.replace(s, F.lit(a), F.lit(b))
    typed = F.array(
        swap(swap(name, "ar", "arr"), "on", "om"),
        F.concat(F.split_part(name, F.lit(" "), F.lit(2)), F.lit(" "), F.split_part(name, F.lit(" "), F.lit(1))),
        F.concat(swap(name, "e", "ee"), F.lit("!")),
        F.concat(name, F.lit(" "), name, F.lit(" u")),
        F.lower(swap(c("p_brand"), "#", " 0")),
        name,
    )
    return fuzzy.fuzzy_match(
        part.select(F.explode(typed).alias("input")),
        part.select(F.explode(F.array(name, F.lower("p_brand"))).alias("target")), measure="characters",
    )


# --- training set ---------------------------------------------------------------------------

_FILTERED = """SELECT make, model, year, ln(odometer + 1) AS log_odometer, price,
  CASE WHEN condition IN ('new', 'like new', 'excellent') THEN 1
       WHEN condition IN ('good', 'fair', 'salvage') THEN 0 END AS condition_mapped, time_posted
FROM listings WHERE condition IS NOT NULL AND odometer IS NOT NULL AND price IS NOT NULL
  AND time_posted >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 3650 DAY"""


def _trim_ctes(min_group: int) -> dict[str, str]:
    return {
        "filtered": _FILTERED,
        "valid": f"""SELECT make, model, count(*) AS n FROM filtered GROUP BY ALL
HAVING count(*) >= {min_group}""",
        "rows_": "SELECT f.* FROM filtered f JOIN valid USING (make, model)",
        "bounds": """SELECT make, model, year, quantile_disc(price, 0.05) AS low_quantile,
  quantile_disc(price, 0.95) AS high_quantile FROM rows_ GROUP BY ALL""",
        "fit": """SELECT r.* FROM rows_ r JOIN bounds USING (make, model, year)
WHERE price > low_quantile AND price < high_quantile""",
    }


_ROUNDED_FIT = """SELECT make, model, year, round(log_odometer, 9) AS log_odometer, price,
  condition_mapped, time_posted FROM """


def _rounded_fit(df: DataFrame) -> DataFrame:
    return df.withColumn("log_odometer", F.round("log_odometer", 9))


@query(_with(_ROUNDED_FIT + "filtered", filtered=_FILTERED.replace("3650", "180")))
def fit_filtered_recent(spark, sf_dir):
    """The default half year, which leaves most rows out."""
    return _rounded_fit(training.fit_filtered(sample.listings(spark, sf_dir), AS_OF))


def _filtered(spark, sf_dir) -> DataFrame:
    return training.fit_filtered(sample.listings(spark, sf_dir), AS_OF, LOOKBACK)


@query(_with(_ROUNDED_FIT + "filtered", filtered=_FILTERED))
def fit_filtered(spark, sf_dir):
    return _rounded_fit(_filtered(spark, sf_dir))


@query(_with("SELECT * FROM valid", **_trim_ctes(BITING_GROUP)))
def valid_make_models(spark, sf_dir):
    return training.valid_make_models(_filtered(spark, sf_dir), BITING_GROUP)


@query(_with(_ROUNDED_FIT + "rows_", **_trim_ctes(BITING_GROUP)))
def fit_valid_rows(spark, sf_dir):
    return _rounded_fit(training.valid_rows(_filtered(spark, sf_dir), BITING_GROUP))


@query(_with("SELECT * FROM bounds", **_trim_ctes(BITING_GROUP)))
def price_quantiles(spark, sf_dir):
    return training.price_quantiles(
        training.valid_rows(_filtered(spark, sf_dir), BITING_GROUP)
    )


@query(_with(_ROUNDED_FIT + "fit", **_trim_ctes(0)))
def fit_trimmed(spark, sf_dir):
    rows = _filtered(spark, sf_dir)
    return _rounded_fit(training.trim_outliers(rows, training.price_quantiles(rows)))


@query(_with(_ROUNDED_FIT + "fit", **_trim_ctes(MIN_GROUP)))
def lm_fit_set(spark, sf_dir):
    return _rounded_fit(
        training.fit_set(sample.listings(spark, sf_dir), AS_OF, LOOKBACK, MIN_GROUP)
    )


# --- models and scores ----------------------------------------------------------------------

# Row-wise orthogonalisation: each predictor is replaced by what the earlier ones leave of
# it, slopes on those are independent, and back substitution gives the coefficients.
_OLS = {
    "d": """SELECT make, model, log_odometer AS o, condition_mapped AS c, year AS y, price AS p,
  c - avg(c) OVER g AS e1, p - avg(p) OVER g AS q
FROM fit WHERE condition_mapped IS NOT NULL WINDOW g AS (PARTITION BY make, model)""",
    "s1": "SELECT make, model, regr_slope(y, e1) AS a21, regr_slope(o, e1) AS a31 FROM d GROUP BY ALL",
    "d2": """SELECT d.*, a21, a31, y - avg(y) OVER g - a21 * e1 AS e2
FROM d JOIN s1 USING (make, model) WINDOW g AS (PARTITION BY make, model)""",
    "s2": "SELECT make, model, regr_slope(o, e2) AS a32 FROM d2 GROUP BY ALL",
    "d3": """SELECT d2.*, a32, o - avg(o) OVER g - a31 * e1 - a32 * e2 AS e3
FROM d2 JOIN s2 USING (make, model) WINDOW g AS (PARTITION BY make, model)""",
    "s3": """SELECT make, model, count(*) AS n, avg(o) AS mo, avg(c) AS mc, avg(y) AS my,
  avg(p) AS mp, any_value(a21) AS a21, any_value(a31) AS a31, any_value(a32) AS a32,
  regr_slope(q, e1) AS g1, regr_slope(q, e2) AS g2, regr_slope(q, e3) AS g3 FROM d3 GROUP BY ALL""",
    "s4": "SELECT *, g3 AS bo, g2 - g3 * a32 AS by_ FROM s3",
    "s5": "SELECT *, g1 - by_ * a21 - bo * a31 AS bc FROM s4",
    "s6": "SELECT *, mp - bo * mo - bc * mc - by_ * my AS b0 FROM s5",
    "lm": """SELECT make, model, any_value(b0) AS intercept, any_value(bo) AS miles_coeff,
  any_value(bc) AS condition_coeff, any_value(by_) AS year_coeff,
  1 - sum(power(p - b0 - bo * o - bc * c - by_ * y, 2)) / sum(q * q) AS r_squared,
  count(*) AS sample_size
FROM d3 JOIN (SELECT make, model, b0, bo, bc, by_ FROM s6) USING (make, model) GROUP BY ALL""",
}
_RECENT_LISTINGS = """SELECT * FROM listings
WHERE time_posted >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 45 DAY
  AND price < 75000 AND price > 250 AND odometer < 300000 AND odometer > 0
  AND year >= 2001 - 50 AND year <= 2001 + 1"""
_SCORED = f"""SELECT url, state, location, time_posted, name, make, model, year, odometer, title,
  l_linestatus AS paint, drive, cylinders, 'gas' AS fuel,
  type, 'automatic' AS transmission, condition, price, title_text, {_GEO},
  intercept + miles_coeff * ln(odometer + 0.1) + condition_coeff *
    CASE WHEN condition IN ('new', 'like new', 'excellent') THEN 1
         WHEN condition IN ('good', 'fair', 'salvage') THEN 0 END
    + year_coeff * year AS predicted_price, r_squared, sample_size
FROM recent JOIN states ON region = location LEFT JOIN lm USING (make, model)"""


def _score_ctes(min_group: int) -> dict[str, str]:
    return {
        **_trim_ctes(min_group), **_OLS,
        "recent": _RECENT_LISTINGS, "states": sample.STATES_SQL, "scored": _SCORED,
    }


def _models(spark, sf_dir, min_group=MIN_GROUP) -> DataFrame:
    listings = sample.listings(spark, sf_dir)
    return regression.fit_models(training.fit_set(listings, AS_OF, LOOKBACK, min_group))


@query(
    _with(
        """SELECT make, model, round(intercept) AS intercept, round(miles_coeff, 2) AS miles_coeff,
  round(condition_coeff, 2) AS condition_coeff, round(year_coeff, 2) AS year_coeff,
  round(r_squared, 6) AS r_squared, sample_size FROM lm""",
        **_trim_ctes(MIN_GROUP),
        **_OLS,
    )
)
def lm_fit(spark, sf_dir):
    return _rounded_models(_models(spark, sf_dir))


def _rounded_models(models: DataFrame) -> DataFrame:
    digits = {"intercept": 0, "miles_coeff": 2, "condition_coeff": 2, "year_coeff": 2, "r_squared": 6}
    return models.withColumns({name: F.round(name, places) for name, places in digits.items()})


# Makes by number modulo 5: a single year; a single price; no good condition; no bad one; two listings.
_ODD = """SELECT make, kind, ln(odometer + 1) AS o, price_ AS p, c, y FROM (
  SELECT *, CASE kind WHEN 1 THEN 1000 ELSE price END AS price_,
    CASE kind WHEN 2 THEN 0 WHEN 3 THEN 1 WHEN 4 THEN CASE WHEN url = high THEN 1 ELSE 0 END
      ELSE CASE WHEN condition IN ('new', 'like new', 'excellent') THEN 1
        WHEN condition IN ('good', 'fair', 'salvage') THEN 0 END END AS c,
    CASE kind WHEN 0 THEN 1995 WHEN 4 THEN CASE WHEN url = high THEN 1995 ELSE 1990 END ELSE year END AS y
  FROM (SELECT *, CAST(replace(make, 'brand#', '') AS INT) % 5 AS kind,
      min(url) OVER (PARTITION BY make) AS low, max(url) OVER (PARTITION BY make) AS high FROM listings)
  WHERE kind <> 4 OR url = low OR url = high) WHERE c IS NOT NULL"""
# Two predictors u and v: the second is replaced by what the first leaves of it.
_ODD_PAIRS = """SELECT make, kind, avg(p) AS mp, avg(u) AS mu, avg(v) AS mv, any_value(a) AS a, regr_slope(p, u) AS pu,
  regr_slope(p, v - a * u) AS bv, count(*) AS n
FROM (SELECT *, regr_slope(v, u) OVER (PARTITION BY make) AS a FROM
  (SELECT make, kind, p, o AS u, CASE WHEN kind = 0 THEN c ELSE y END AS v FROM odd WHERE kind IN (0, 2, 3))) GROUP BY ALL"""
# Two rows: the solution of least norm, transpose(A) inverse(A transpose(A)) p.
_ODD_TWO = """SELECT make, o1 + 0 AS o1, o2, p1, p2, o1 * o1 + 1 + 1990 * 1990 AS g11, o1 * o2 + 1 + 1990 * 1995 AS g12, o2 * o2 + 2 + 1995 * 1995 AS g22
FROM (SELECT make, max(o) FILTER (WHERE c = 0) AS o1, max(o) FILTER (WHERE c = 1) AS o2,
  max(p) FILTER (WHERE c = 0) AS p1, max(p) FILTER (WHERE c = 1) AS p2 FROM odd WHERE kind = 4 GROUP BY make)"""


@query(
    _with(
        """SELECT make, round(intercept, 0) + 0 AS intercept, round(miles_coeff, 2) + 0 AS miles_coeff, round(condition_coeff, 0) + 0 AS condition_coeff,
  round(year_coeff, 2) + 0 AS year_coeff, round(r_squared, 6) AS r_squared, n AS sample_size FROM solved""",
        odd=_ODD,
        pairs=_ODD_PAIRS,
        two=_ODD_TWO,
        fits="""SELECT make, kind, n, pu - bv * a AS bu, bv, mp - (pu - bv * a) * mu - bv * mv AS level FROM pairs""",
        errors="""SELECT make, 1 - sum(power(p - level - bu * o - bv * CASE WHEN f.kind = 0 THEN c ELSE y END, 2)) / sum(power(p - mean, 2)) AS r2
FROM (SELECT *, avg(p) OVER (PARTITION BY make) AS mean FROM odd) JOIN fits f USING (make) GROUP BY make""",
        solved="""SELECT make, CASE WHEN kind <> 3 THEN level END AS intercept, bu AS miles_coeff,
    CASE kind WHEN 0 THEN bv WHEN 3 THEN level ELSE 0 END AS condition_coeff, CASE WHEN kind = 0 THEN 0 ELSE bv END AS year_coeff, r2 AS r_squared, n
  FROM fits JOIN errors USING (make)
  UNION ALL SELECT make, 1000, 0, 0, 0, NULL, count(*) FROM odd WHERE kind = 1 GROUP BY make
  UNION ALL SELECT make, s1 + s2, o1 * s1 + o2 * s2, s2, 1990 * s1 + 1995 * s2, 1, 2 FROM (
    SELECT make, o1, o2, (g22 * p1 - g12 * p2) / (g11 * g22 - g12 * g12) AS s1, (g11 * p2 - g12 * p1) / (g11 * g22 - g12 * g12) AS s2 FROM two)""",
    )
)
def lm_fit_degenerate(spark, sf_dir):
    """Groups that leave a predictor out, or cannot be fitted in the ordinary way; each has its row."""
    rows = sample.listings(spark, sf_dir).withColumn("kind", F.replace("make", F.lit("brand#"), F.lit("")).cast("int") % 5)
    ends = rows.groupBy("make").agg(F.min("url").alias("low"), F.max("url").alias("high"))
    picked = rows.join(ends, "make").filter((c("kind") != 4) | (c("url") == c("low")) | (c("url") == c("high")))
    last, kind = c("url") == c("high"), c("kind")
    odd = picked.select(
        "make", F.lit("any").alias("model"), F.log(c("odometer") + 1).alias("log_odometer"),
        F.when(kind == 1, 1000.0).otherwise(c("price")).alias("price"),
        F.when(kind == 2, 0).when(kind == 3, 1).when(kind == 4, last.cast("int")).otherwise(condition_flag(c("condition"))).alias("condition_mapped"),
        F.when(kind == 0, 1995).when(kind == 4, F.when(last, 1995).otherwise(1990)).otherwise(c("year")).alias("year"),
    )
    digits = {"intercept": 0, "miles_coeff": 2, "condition_coeff": 0, "year_coeff": 2}
    return regression.fit_models(odd).select(
        "make", *[(F.round(k, n) + 0.0).alias(k) for k, n in digits.items()], F.round("r_squared", 6).alias("r_squared"), "sample_size",
    )


@query(_with("SELECT url, time_posted, price, odometer, year FROM recent", recent=_RECENT_LISTINGS))
def recent_listings(spark, sf_dir):
    return scoring.recent_listings(sample.listings(spark, sf_dir), AS_OF).select(
        "url", "time_posted", "price", "odometer", "year"
    )


@query(
    _with(
        "SELECT url, location, state FROM listings JOIN states ON region = location",
        states=sample.STATES_SQL,
    )
)
def listing_state(spark, sf_dir):
    listings = sample.listings(spark, sf_dir).select("url", "location")
    return scoring.with_state(listings, sample.states(spark, sf_dir)).select(
        "url", "location", "state"
    )


@query(
    _with(
        """SELECT url, round(1000 - 25.5 * ln(odometer + 0.1) + 300 *
  CASE WHEN condition IN ('new', 'like new', 'excellent') THEN 1
       WHEN condition IN ('good', 'fair', 'salvage') THEN 0 END + 12.25 * year, 6)
  AS predicted_price FROM listings"""
    ),
    name="predicted_price",
)
def predicted_price_formula(spark, sf_dir):
    price = predicted_price(
        c("odometer"), c("condition"), c("year"),
        F.lit(1000.0), F.lit(-25.5), F.lit(300.0), F.lit(12.25),
    )
    return sample.listings(spark, sf_dir).select("url", F.round(price, 6).alias("predicted_price"))


@query(
    _with(
        """SELECT url, make, model, round(predicted_price, 1) AS predicted_price, sample_size FROM (
  SELECT listings.*, sample_size, intercept + miles_coeff * ln(odometer + 0.1) + condition_coeff *
    CASE WHEN condition IN ('new', 'like new', 'excellent') THEN 1
         WHEN condition IN ('good', 'fair', 'salvage') THEN 0 END
    + year_coeff * year AS predicted_price
  FROM listings LEFT JOIN lm USING (make, model))""",
        **_trim_ctes(BITING_GROUP),
        **_OLS,
    )
)
def listing_predictions(spark, sf_dir):
    models = _models(spark, sf_dir, BITING_GROUP)
    return scoring.with_prediction(sample.listings(spark, sf_dir), models).select(
        "url", "make", "model", F.round("predicted_price", 1).alias("predicted_price"),
        "sample_size",
    )


_ROUNDED_SCORE = """* REPLACE (round(predicted_price, 1) AS predicted_price,
  round(r_squared, 6) AS r_squared)"""


def _hot_deals(spark, sf_dir, min_group=MIN_GROUP) -> DataFrame:
    return scoring.hot_deals(
        sample.listings(spark, sf_dir),
        sample.states(spark, sf_dir),
        _models(spark, sf_dir, min_group),
        AS_OF,
    )


@query(_with(f"SELECT {_ROUNDED_SCORE} FROM scored", **_score_ctes(MIN_GROUP)))
def hot_deals(spark, sf_dir, min_group=MIN_GROUP):
    return _hot_deals(spark, sf_dir, min_group).withColumns(
        {"predicted_price": F.round("predicted_price", 1), "r_squared": F.round("r_squared", 6)}
    )


@query(
    _with(
        """SELECT url, price, round(predicted_price, 1) AS predicted_price,
  round(predicted_price - price, 1) AS discount,
  round((predicted_price - price) / predicted_price, 5) AS discount_pct
FROM scored WHERE predicted_price > price""",
        **_score_ctes(MIN_GROUP),
    )
)
def best_deals(spark, sf_dir):
    deals = scoring.best_deals(_hot_deals(spark, sf_dir))
    return deals.select(
        "url",
        "price",
        F.round("predicted_price", 1).alias("predicted_price"),
        F.round("discount", 1).alias("discount"),
        F.round("discount_pct", 5).alias("discount_pct"),
    )


@query(
    _with(
        """SELECT make, model, rank, url FROM (SELECT *, row_number() OVER (PARTITION BY make, model
  ORDER BY predicted_price - price DESC, url) AS rank FROM scored WHERE predicted_price > price) WHERE rank <= 3""",
        **_score_ctes(MIN_GROUP),
    )
)
def best_deals_per_model(spark, sf_dir):
    return scoring.best_deals_per_model(_hot_deals(spark, sf_dir), 3).select("make", "model", "rank", "url")


# --- stored tables --------------------------------------------------------------------------


def _stored_listings(spark, sf_dir, halves: int = 2) -> str:
    """The listings as a table laid out by month, written in ``halves`` runs of which the last is repeated."""
    path = runs.scratch_table(spark, "listings")
    rows = sample.listings(spark, sf_dir).withColumns({k: F.lit(None).cast(LISTINGS[k].dataType) for k in LISTINGS.names if k not in sample.LISTING_COLUMNS})
    for part in [*range(halves), halves - 1]:
        runs.append_run(
            rows.filter(c("l_orderkey") % halves == part), path, f"load-{part}", LISTINGS, "time_posted", extract.lacking(), unit="month",
        )
    return path


@query(_with(_ROUNDED_FIT + "filtered", filtered=_FILTERED.replace("3650", "180")))
@storing
def stored_fit_filtered(spark, sf_dir):
    """The half year of a table laid out by month: files of other months are not read."""
    stored = runs.read_runs(spark, _stored_listings(spark, sf_dir), LISTINGS)
    return _rounded_fit(training.fit_filtered(stored, AS_OF))


def _stored_cells(spark, sf_dir) -> DataFrame:
    """Cells of listings parsed in three runs: half of them twice, the first time with twice the price and a month late."""
    stored, cells = (runs.scratch_table(spark, name) for name in ("listings", "cells"))
    rows = sample.listings(spark, sf_dir).withColumns({k: F.lit(None).cast(LISTINGS[k].dataType) for k in LISTINGS.names if k not in sample.LISTING_COLUMNS})
    even = rows.filter(c("l_orderkey") % 2 == 0).withColumn("basic_processed_time", F.lit("2001-07-02").cast("timestamp"))
    wrong = even.withColumns({
        "price": c("price") * 2, "time_posted": c("time_posted") + F.expr("INTERVAL 30 DAYS"), "basic_processed_time": F.lit("2001-07-01").cast("timestamp"),
    })
    for name, part in (("wrong", wrong), ("odd", rows.filter(c("l_orderkey") % 2 == 1)), ("even", even)):
        runs.append_run(part, stored, name, LISTINGS, "time_posted", unit="month")
        jobs.summarise_run(spark, stored, cells, name)
    return runs.read_runs(spark, cells, CELLS)


@query(ORACLES["lm_fit"])
@storing
def stored_lm_fit(spark, sf_dir):
    """The models from stored cells, of which half were taken back and stored anew."""
    return _rounded_models(summaries.fit_from_cells(_stored_cells(spark, sf_dir), AS_OF, LOOKBACK, MIN_GROUP))


@query(ORACLES["price_quantiles"])
@storing
def stored_price_quantiles(spark, sf_dir):
    merged = summaries.window_cells(_stored_cells(spark, sf_dir), AS_OF, LOOKBACK)
    return summaries.price_bounds(merged, BITING_GROUP)


@query(_with("SELECT url, time_posted, price, odometer, year FROM recent", recent=_RECENT_LISTINGS))
@storing
def stored_recent_listings(spark, sf_dir):
    stored = runs.read_runs(spark, _stored_listings(spark, sf_dir), LISTINGS)
    return scoring.recent_listings(stored, AS_OF).select("url", "time_posted", "price", "odometer", "year")


@query(
    _with(
        "SELECT url, location, row_created FROM frontier WHERE url NOT IN (SELECT url FROM raw)",
        frontier=_FRONTIER,
        raw=_RAW,
    )
)
@storing
def frontier_cleaned_in_place(spark, sf_dir):
    """The frontier written, cleaned and cleaned again under the same name, then read."""
    queue, pulled = (runs.scratch_table(spark, n) for n in ("frontier", "raw"))
    runs.append_run(sample.frontier(spark, sf_dir), queue, "queue", FRONTIER)
    pages = sample.raw_keys(spark, sf_dir).withColumn("raw_html", F.lit(None).cast("string"))
    runs.append_run(pages, pulled, "pull", RAW_PAGES, "datetime_pulled", unit="month")
    for _ in range(2):
        jobs.clean_frontier(spark, queue, pulled, run="clean")
    runs.append_run(sample.frontier(spark, sf_dir), queue, "queue", FRONTIER)
    return runs.read_runs(spark, queue, FRONTIER).drop("run")


@query(
    _with(
        "SELECT run, measure, CAST(value AS DOUBLE) AS value FROM (SELECT concat('load-', l_orderkey % 2) AS run, count(*) AS rows, "
        + ", ".join(f"count(*) FILTER (WHERE {f} IS NULL) AS no_{f}" for f in _SPARSE_FIELDS)
        + " FROM listings GROUP BY l_orderkey % 2) UNPIVOT (value FOR measure IN (rows, "
        + ", ".join(f"no_{f}" for f in _SPARSE_FIELDS) + "))"
    )
)
@storing
def stored_run_counts(spark, sf_dir):
    """What each run counted while it wrote; a repeated run counts once."""
    return runs.run_counts(spark, _stored_listings(spark, sf_dir))


@query(
    _with(
        """SELECT 'load' AS task, TIMESTAMP '2001-08-01 00:00:00' AS time_started, TIMESTAMP '2001-08-01 00:00:00' AS time_finished,
  concat(count(*), ' rows, no condition: ', count(*) FILTER (WHERE condition IS NULL)) AS notes FROM listings GROUP BY l_orderkey % 2"""
    )
)
@storing
def run_log(spark, sf_dir):
    """A log row for each run of a table, with the counts taken as it was written."""
    log, stored = runs.scratch_table(spark, "log"), runs.snapshot(spark, _stored_listings(spark, sf_dir))
    for mark in stored.marks.values():
        tables.log_run(spark, log, "load", AS_OF, AS_OF, f"{mark['rows']} rows, no condition: {mark['counts']['no_condition']}")
    return tables.read_table(spark, log, RUN_LOG.fieldNames())


@query(
    _with(
        """SELECT make, model, CAST(NULL AS DOUBLE) AS intercept, CAST(min(price) AS DOUBLE) AS miles_coeff, CAST(max(price) AS DOUBLE) AS condition_coeff,
  CAST(max(year) AS DOUBLE) AS year_coeff, CAST(NULL AS DOUBLE) AS r_squared, count(*) AS sample_size FROM listings WHERE l_orderkey % 2 = 1 GROUP BY ALL"""
    )
)
@storing
def replaced_table(spark, sf_dir):
    """A table written twice from text columns: the second contents, in the schema's types."""
    path = f"{runs.scratch_table(spark, 'models')}/table"
    for part in range(2):
        rows = sample.listings(spark, sf_dir).filter(c("l_orderkey") % 2 == part).groupBy("make", "model").agg(
            F.min("price").cast("string").alias("miles_coeff"), F.max("price").cast("string").alias("condition_coeff"),
            F.max("year").cast("string").alias("year_coeff"), F.count("*").cast("string").alias("sample_size"),
        )
        tables.overwrite_table(rows.withColumns({k: F.lit(None).cast("string") for k in ("intercept", "r_squared")}), path, MODELS)
    return tables.read_table(spark, path)


@query(
    _with(
        """SELECT url, price FROM listings WHERE l_linestatus = 'F' UNION ALL SELECT url, price FROM listings WHERE l_linestatus = 'F' AND l_orderkey % 2 = 0"""
    )
)
@storing
def appended_table(spark, sf_dir):
    """Rows appended in two goes and an empty one; nothing tells repeated rows apart here."""
    path = f"{runs.scratch_table(spark, 'prices')}/table"
    rows = sample.listings(spark, sf_dir).filter("l_linestatus = 'F'").select("url", "price", "l_orderkey")
    for part in (rows, rows.filter("l_orderkey % 2 = 0"), rows.filter("l_orderkey < 0")):
        tables.append_table(part.select("url", "price"), path)
    return tables.read_table(spark, path, ["url", "price"])


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: fit the price models and score recent listings, on small tables."""
    return hot_deals(spark, sf_dir, min_group=20)
