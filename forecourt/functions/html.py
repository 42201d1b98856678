"""HTML fields as regular-expression column expressions.

A field is read in two steps: ``*_element`` finds its element, and a reader turns that
into the value.  Kept in separate projections the page is
searched once per field; composed, they serve a single field.

Elements are found by tag plus class or id, whatever the order, quoting and spacing of
their attributes.  An element may hold others of its own kind, ``NESTING`` deep in the patterns, which
fields are read with; ``elements_of_any_depth`` has no limit.  Scripts and styles are only searched for scripts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.text import decode_entities, number, strip_ws


#: How deep elements of one kind nest in the patterns of ``first_element`` and ``all_elements``.
NESTING = 64
# Inside a tag: quoted values may contain ">".  There is one way to read it, so nothing is tried twice.
_QUOTED = r"""(?:"[^"]*+"|'[^']*+')"""
_INSIDE = rf"""[^>"']*+(?:{_QUOTED}[^>"']*+)*+"""


def _with_attribute(attribute: str) -> str:
    """Look-ahead inside an opening tag: up to the first blank outside quotes with ``attribute`` after it."""
    return rf"""(?=[^>"'\s]*+(?:(?:{_QUOTED}|\s(?!{attribute}))[^>"'\s]*+)*+\s{attribute})"""


def _upto(stop: str) -> str:
    """Text up to ``stop``, a pattern that begins with "<" (left out here), in possessive runs."""
    return rf"[^<]*+(?:<(?!{stop})[^<]*+)*+"


def _attribute(name: str, token: str, whole: bool) -> str:
    """Look-ahead inside an opening tag: attribute ``name`` has ``token``.

    ``whole`` asks for the full value (blanks normalised); otherwise one of the
    blank-separated tokens is enough.
    """
    value = r"\s+".join(re.escape(word) for word in token.split())
    if whole:
        inner = rf"\s*{value}\s*"
        quoted = [rf'"{inner}"', rf"'{inner}'"]
    else:
        quoted = [
            rf'"(?:[^"]*\s)?{value}(?:\s[^"]*)?"',
            rf"'(?:[^']*\s)?{value}(?:\s[^']*)?'",
        ]
    bare = rf"{value}(?=[\s>])"
    return _with_attribute(rf"(?i:{name})\s*=\s*(?:{'|'.join([*quoted, bare])})")


def has_attribute(name: str) -> str:
    return _with_attribute(rf"(?i:{name})\s*=")


def by_class(css_class: str) -> str:
    """One class matches any element bearing it; several must be the whole attribute."""
    return _attribute("class", css_class, whole=len(css_class.split()) > 1)


def by_id(element_id: str) -> str:
    return _attribute("id", element_id, whole=True)


def opening_tag(tag: str, *conditions: str) -> str:
    return rf"<(?i:{tag})(?=[\s>]){''.join(conditions)}{_INSIDE}>"


def first_element(html: Column, tag: str, *conditions: str) -> Column:
    """What the first such element holds, after a ``>`` mark; '' if there is no such element.

    The mark, the end of the opening tag, tells an empty element from an absent one.
    """
    return F.regexp_extract(html, _element(tag, *conditions), 1)


def all_elements(html: Column, tag: str, *conditions: str) -> Column:
    """What each such element holds, in page order; elements inside another of them are part of that one."""
    return F.regexp_extract_all(html, F.lit(_element(tag, *conditions)), F.lit(1))


def _element(tag: str, *conditions: str) -> str:
    # Up to the closing tag or the end of the page, in possessive runs: the matcher moves
    # from "<" to "<" without backtracking, so long contents cost neither time nor stack.
    # Elements of the same kind inside are taken whole, with their closing tags.
    head = opening_tag(tag, *conditions).removesuffix(">")
    inner = _upto(rf"/(?i:{tag})\s*>")
    plain = _upto(rf"(?i:{tag})[\s>]|/(?i:{tag})\s*>")
    for _ in range(NESTING):
        inner = rf"{plain}(?:<(?i:{tag})(?=[\s>]){_INSIDE}>{inner}(?:</(?i:{tag})\s*>)?+{plain})*+"
    return rf"{head}(>{inner})"


def _near_element(html: Column, tag: str, *conditions: str) -> Column:
    """``first_element`` by a pattern without nesting; ends with "<" where one of its kind may follow inside: then it is not whole."""
    head = opening_tag(tag, *conditions).removesuffix(">")
    held = _upto(rf"(?i:{tag})[\s>]|/(?i:{tag})\s*>")
    return F.regexp_extract(html, rf"{head}(>{held}(?:<(?=(?i:{tag})[\s>]))?+)", 1)


def _bound(value: Column, use) -> Column:
    """``use(value)``, the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def elements_of_any_depth(html: Column, tag: str, *conditions: str) -> Column:
    """``all_elements`` without a limit to the nesting: one scan of the tags of this kind with a running depth.

    The page is cut at those tags.  An element lasts until the depth falls below the one its opening tag
    led to, or to the end of the page.  Some ten times the cost of the pattern.
    """
    kind = rf"<(?i:{tag})(?=[\s>]){_INSIDE}>|</(?i:{tag})\s*>"
    opens = f"^{opening_tag(tag, *conditions)}"
    parts = F.struct(F.regexp_extract_all(html, F.lit(kind), F.lit(0)).alias("tags"), F.split(html, kind, -1).alias("texts"))

    def elements(part: Column) -> Column:
        tags, texts = part["tags"], part["texts"]
        # 0: closing, 1: opening, 2: opening with the conditions.
        kinds = F.transform(tags, lambda t: F.when(t.startswith("</"), 0).when(t.rlike(opens), 2).otherwise(1))
        none = F.array().cast("array<struct<first:int,end:int>>")
        zero = F.lit(0)
        start = F.struct(zero.alias("at"), zero.alias("depth"), zero.alias("level"), zero.alias("first"), none.alias("found"))

        def step(s: Column, k: Column) -> Column:
            at, depth = s["at"] + 1, s["depth"] + F.when(k == 0, -1).otherwise(1)
            begins = (s["first"] == 0) & (k == 2)
            ends = (s["first"] > 0) & (depth < s["level"])
            return F.struct(
                at.alias("at"), depth.alias("depth"), F.when(begins, depth).otherwise(s["level"]).alias("level"),
                F.when(begins, at).when(ends, 0).otherwise(s["first"]).alias("first"),
                F.when(ends, F.concat(s["found"], F.array(F.struct(s["first"].alias("first"), at.alias("end"))))).otherwise(s["found"]).alias("found"),
            )

        def finish(s: Column) -> Column:
            rest = F.array(F.struct(s["first"].alias("first"), (s["at"] + 1).alias("end")))
            return F.when(s["first"] > 0, F.concat(s["found"], rest)).otherwise(s["found"])

        def source(e: Column) -> Column:
            inner = F.zip_with(
                F.slice(tags, e["first"] + 1, e["end"] - e["first"] - 1),
                F.slice(texts, e["first"] + 2, e["end"] - e["first"] - 1), lambda t, x: F.concat(t, x),
            )
            return F.concat(F.lit(">"), F.element_at(texts, e["first"] + 1), F.array_join(inner, ""))

        return F.transform(F.aggregate(kinds, start, step, finish), source)

    return _bound(parts, elements)


# Both take the text before each thing that goes in one match, up to the end of the page in the last.
_SCRIPT, _STYLE = (rf"(?i:{t})(?=[\s>]){_upto(f'/(?i:{t})' + r'\s*>')}" for t in ("script", "style"))
_SCRIPT_END, _STYLE_END = (rf"</(?i:{t})\s*>" for t in ("script", "style"))
_COMMENT = r"<!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->|\z)"
_COMMENTED = rf"([^<]*+(?:(?:<(?![!sS])|<{_SCRIPT}{_SCRIPT_END}|<{_STYLE}{_STYLE_END}|<(?!!--))[^<]*+)*+)(?:{_COMMENT}|\z)"
_SCRIPTED = rf"([^<]*+(?:<(?:(?![sS])|(?!(?i:script|style)[\s>]))[^<]*+)*+)(?:<{_SCRIPT}(?:{_SCRIPT_END}|\z)|<{_STYLE}(?:{_STYLE_END}|\z)|\z)"


def strip_comments(html: Column) -> Column:
    """The page without its comments; what looks like one inside a script or style stays."""
    return F.when(html.contains("<!--"), F.regexp_replace(html, _COMMENTED, "$1")).otherwise(html)


def strip_scripts(page: Column) -> Column:
    """The page without scripts and styles, so that no element is found in them."""
    return F.regexp_replace(page, _SCRIPTED, "$1")


def _past_comments(tag: str, *conditions: str, whole_tag: bool, nested: bool = False) -> str:
    """Pattern for ``first_element`` (or, ``whole_tag``, its opening tag) of ``strip_comments(html)`` on the page as it is.

    From the start it takes what ``strip_comments`` tells apart (comments, scripts, styles, other "<"), up to the
    element.  It matches only where the comments before cannot have cut a tag in two and the element
    has none inside: there both ways find the same.  Any other page is left without a match.
    ``nested`` takes an element that holds others of its kind, scripts or styles as well.
    """
    kind, either, met = rf"(?i:{tag})", r"(?i:script|style)[\s>]", "".join(conditions)
    clean = r"""[^<>"']*+(?:(?:"[^"<]*+"|'[^'<]*+')[^<>"']*+)*+"""
    own = rf"{kind}[\s>]"
    raw = tag in ("script", "style")

    def block(t: str, opening: str = "") -> str:
        return rf"<(?i:{t})(?=[\s>]){opening}{_upto(rf'/(?i:{t})' + rf'\s*>|{own}')}</(?i:{t})\s*>"

    # A tag of this kind that lacks the conditions; of a script or style, what it holds as well.
    other = block(tag, rf"(?!{met}){clean}>") if raw else rf"<{kind}(?=[\s>])(?!{met}){clean}>"
    comment = r"(?<![^>\s])<!--[^-]*+(?:-(?!->)[^-]*+)*+-->"
    units = [rf"<(?!!--|{either}|{own})", other, comment, *(block(t) for t in ("script", "style") if t != tag)]
    before = rf"\A[^<]*+(?:(?:{'|'.join(units)})[^<]*+)*+"
    head = rf"<{kind}(?=[\s>]){met}{clean}"
    if whole_tag:
        return rf"{before}({head}>)"
    plain = rf"{own}|/{kind}\s*>" + ("" if raw else rf"|!--|{either}")
    held = _upto(plain)
    if nested:
        # Scripts stay as they are, also what looks like a comment there; tags of this kind must not be in them.
        scripts = "|".join(rf"<(?i:{t})(?=[\s>]){_upto(f'/?{own}|/(?i:{t})' + r'\s*>')}</(?i:{t})\s*>" for t in ("script", "style"))
        for _ in range(NESTING - 1):
            held = rf"[^<]*+(?:(?:<(?!{plain})|<{kind}(?=[\s>]){clean}>{held}</{kind}\s*>)[^<]*+)*+"
        held = rf"[^<]*+(?:(?:<(?!{plain})|{scripts}|<{kind}(?=[\s>]){clean}>{held}</{kind}\s*>)[^<]*+)*+"
    return rf"{before}{head}(>{held})</{kind}\s*>"


_MARKUP = rf"(?is)<(script|style)(?=[\s>]).*?(?:</\1\s*>|\z)|</?[a-z!]{_INSIDE}>"


def source_of(element: Column) -> Column:
    """What an element holds, verbatim; NULL if it is absent."""
    return F.when(element != "", F.substring(element, 2, 2**31 - 1))


def encoded_text(element: Column) -> Column:
    """Text of an element and its descendants, character references still encoded."""
    held = source_of(element)
    return F.when(element.contains("<"), F.regexp_replace(held, _MARKUP, "")).otherwise(held)


def text_of(element: Column) -> Column:
    return decode_entities(encoded_text(element))


def attribute_source(open_tag: Column, name: str) -> Column:
    """Value of an attribute in an opening tag, as written; '' if the tag has none."""
    pattern = rf"""\s(?i:{name})\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""
    return F.regexp_replace(
        F.regexp_extract(open_tag, pattern, 1), r"""(?s)^(["'])(.*)\1\z""", "$2"
    )


# --- elements of a listing page; all take the page with its comments stripped ---------------

_NAME = ("a", by_class("valu makemodel"))
_YEAR = ("span", by_class("valu year"))
_TITLE = ("span", by_id("titletextonly"))
_TIME = ("time", by_class("date timeago"))
_IMAGES = ("span", by_class("slider-info"))
_JSONLD = ("script", by_id("ld_posting_data"))
_BODY = ("section", by_id("postingbody"))


def name_element(page: Column) -> Column:
    return first_element(page, *_NAME)


def year_element(page: Column) -> Column:
    return first_element(page, *_YEAR)


def title_element(page: Column) -> Column:
    return first_element(page, *_TITLE)


def body_element(page: Column) -> Column:
    return first_element(page, *_BODY)


def time_tag(page: Column) -> Column:
    return F.regexp_extract(page, opening_tag(*_TIME), 0)


def images_element(page: Column) -> Column:
    return first_element(page, *_IMAGES)


def jsonld_element(page: Column) -> Column:
    return first_element(page, *_JSONLD)


#: Of those, what finds the same on a page that still has its comments, without reading past it; '' where that cannot be told.
PAST_COMMENTS = {
    find: _past_comments(*where, whole_tag=find is time_tag)
    for find, where in (
        (name_element, _NAME), (year_element, _YEAR), (title_element, _TITLE), (time_tag, _TIME), (images_element, _IMAGES), (jsonld_element, _JSONLD),
    )
}
_IN_SOURCE = {**PAST_COMMENTS, body_element: _past_comments(*_BODY, whole_tag=False, nested=True)}


def find_in_source(pages: DataFrame, find, html: str = "raw_html", name: str = "found") -> DataFrame:
    """``find(strip_comments(html))`` as a column: in one pass up to the element where possible, else on the stripped page."""
    stripped = find(strip_comments(F.col(html)))
    if find not in _IN_SOURCE:
        return pages.withColumn(name, stripped)
    near = pages.withColumn(name, F.regexp_extract(html, _IN_SOURCE[find], 1))
    return near.withColumn(name, F.when(F.col(name) != "", F.col(name)).otherwise(stripped))


# --- readers -------------------------------------------------------------------------------


def listing_name(element: Column) -> Column:
    return strip_ws(text_of(element))


def listing_year(element: Column) -> Column:
    return strip_ws(encoded_text(element)).try_cast("int")


# Other spellings of a date and time that pages use; a day of the week before it and a zone after it
# are cut off first.
_DATE_FORMATS = [
    "MM/dd/yyyy HH:mm[:ss]", "MM/dd/yyyy", "MMM d, yyyy h:mm[:ss] a", "MMM d, yyyy HH:mm[:ss]", "MMM d, yyyy",
    "d MMM yyyy HH:mm[:ss]", "d MMM yyyy", "MMMM d, yyyy", "MMMM d, yyyy h:mm[:ss] a", "yyyy/MM/dd HH:mm[:ss]", "yyyy/MM/dd",
]


def time_posted(tag: Column) -> Column:
    """Posting time as written on the page: the zone offset is dropped, not applied.

    The wall clock is taken for UTC, whatever the session's zone.
    """
    text = F.trim(attribute_source(tag, "datetime"))
    iso = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?))?", 0)
    clock = F.concat(F.replace(iso, F.lit("T"), F.lit(" ")), F.when(F.length(iso) == 10, F.lit(" 00:00")).otherwise(F.lit("")), F.lit("Z"))
    bare = F.regexp_replace(text, r"^[A-Za-z]+,?\s+(?=\d)|\s*(?:[+-]\d{2}:?\d{2}|Z|GMT|UTC|[ECMP][SD]T)$", "")
    other = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in _DATE_FORMATS])
    wall = F.concat(F.date_format(other, "yyyy-MM-dd HH:mm:ss"), F.lit("Z"))
    return F.when(iso != "", clock).when(text != "", wall).try_cast("timestamp")


def num_images(element: Column) -> Column:
    """Last word of the slide counter, as in ``image 1 of 12``."""
    return F.regexp_extract(encoded_text(element), r"(\S+)\s*$", 1).try_cast("int")


def attr_entries(page: Column) -> Column:
    """Attribute rows as an array of (label, value), in page order.

    Rows lacking either part are left out.  Each step binds its result before the next
    one uses it more than once.  The long patterns for nested elements are for spans that hold others.
    """
    labl, valu = ("span", by_class("labl")), ("span", by_class("valu"))
    spans = F.transform(
        all_elements(page, "div", by_class("attr")),
        lambda block: F.struct(
            _near_element(block, *labl).alias("label"), _near_element(block, *valu).alias("value"), block.alias("block")
        ),
    )

    def whole(e: Column, part: str, element: tuple[str, str]) -> Column:
        return F.when(e[part].endswith("<"), first_element(e["block"], *element)).otherwise(e[part])

    complete = F.filter(spans, lambda e: (e["label"] != "") & (e["value"] != ""))
    texts = F.transform(
        complete,
        lambda e: F.struct(
            encoded_text(whole(e, "label", labl)).alias("label"), encoded_text(whole(e, "value", valu)).alias("value")
        ),
    )
    return F.transform(
        texts,
        lambda e: F.struct(
            F.rtrim(strip_ws(decode_entities(e["label"])), F.lit(":")).alias("label"),
            strip_ws(decode_entities(e["value"])).alias("value"),
        ),
    )


def last_wins(entries: Column) -> Column:
    """Array of (label, value) to a map in which later entries replace earlier ones."""
    kept = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["label"] == e["label"]
        ),
    )
    return F.map_from_entries(kept)


def pick(entries: Column, label: str) -> Column:
    """Value of the last entry with this label."""
    hits = F.filter(entries, lambda e: e["label"] == label)
    return F.try_element_at(hits, F.lit(-1))["value"]


def repair_odometer(text: Column) -> Column:
    """Readings under a thousand were typed in thousands of miles."""
    miles = number(text)
    return F.when(miles < 1000, miles * 1000).otherwise(miles)


# --- structured data; ``doc`` is the JSON-LD text ------------------------------------------


def jsonld_fields(doc: Column) -> Column:
    """The document read once, as far as listings need it; NULL where it cannot be read."""
    geo = "geo: struct<latitude: string, longitude: string>"
    return F.from_json(
        doc, f"offers struct<price: string, availableAtOrFrom: struct<{geo}>>", {"mode": "PERMISSIVE"}
    )


def jsonld_price(doc: Column) -> Column:
    return number(F.get_json_object(doc, "$.offers.price"))


def jsonld_latitude(doc: Column) -> Column:
    return number(F.get_json_object(doc, "$.offers.availableAtOrFrom.geo.latitude"))


def jsonld_longitude(doc: Column) -> Column:
    return number(F.get_json_object(doc, "$.offers.availableAtOrFrom.geo.longitude"))


def jsonld_description(doc: Column) -> Column:
    return F.concat(
        F.get_json_object(doc, "$.name"), F.lit(">>>"), F.get_json_object(doc, "$.description")
    )
