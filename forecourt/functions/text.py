"""String cleaning, number reading and ordered substitution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spelling corrections, tried in this order, first hit only.
MAKE_CORRECTIONS = [
    ("chevy", "chevrolet"),
    ("cheverolet", "chevrolet"),
    ("mercedez", "mercedes"),
    ("vw", "volkswagen"),
    ("volkswagon", "volkwagen"),
    ("volkwagen", "volkswagen"),
    ("infinity", "infiniti"),
    ("chysler", "chrysler"),
]
MODEL_CORRECTIONS = [("oddysey", "odyssey")]

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Names that HTML reads without a closing semicolon, longest first.
_BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_ENTITY = rf"&(#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;|(?:{'|'.join(_BARE_NAMES)}))"
# A text in pieces: references, what stands between them, and each "&" that begins none.
_PIECES = rf"{_ENTITY}|[^&]+|&"
# References replaced without cutting the text.  They yield no "&", so no new references.
_COMMON = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]
_UNCOMMON = rf"&(?!(?:amp;|{'|'.join(ref[1:] for ref, _ in _COMMON)})){_ENTITY[1:]}"
# What numbers 128 to 159 stand for: that block of Windows-1252.
_WINDOWS = [bytes([n]).decode("cp1252", "replace") for n in range(128, 160)]
# Names are looked up by bucket: Spark searches a map from end to end.
_NAME_BUCKETS = 64
_SPACES = "".join(chr(p) for p in range(0x3001) if chr(p).isspace())


def strip_ws(text: Column) -> Column:
    """Trim any Unicode whitespace, not only blanks."""
    return F.btrim(text, F.lit(_SPACES))


def number(text: Column) -> Column:
    """Plain decimal text as a double, anything else NULL (never an error)."""
    return F.regexp_extract(text, _NUMBER, 0).try_cast("double")


def first_substitution(text: Column, corrections: Sequence[tuple[str, str]]) -> Column:
    """Lower-case ``text`` and apply the first correction whose typo occurs in it."""
    low = F.lower(text)
    chain = reduce(
        lambda acc, fix: acc.when(
            low.contains(fix[0]), F.replace(low, F.lit(fix[0]), F.lit(fix[1]))
        ),
        corrections,
        F.when(low.isNull(), F.lit(None).cast("string")),
    )
    return chain.otherwise(low)


def correct_make(text: Column) -> Column:
    return first_substitution(text, MAKE_CORRECTIONS)


def correct_model(text: Column) -> Column:
    return first_substitution(text, MODEL_CORRECTIONS)


def _character(code_point: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code_point), 8, "0")), "UTF-32")


def _named_entity(name: Column) -> Column:
    """The characters of a name of HTML 5, as hexadecimal UTF-8; NULL for other names."""
    buckets: list[list[str]] = [[] for _ in range(_NAME_BUCKETS)]
    for known, chars in sorted(html5.items()):
        buckets[crc32(known.encode()) % _NAME_BUCKETS].append(f"{known}:{chars.encode().hex()}")
    maps = F.array(*[F.str_to_map(F.lit(",".join(b)), F.lit(","), F.lit(":")) for b in buckets])
    return F.try_element_at(F.get(maps, (F.crc32(name) % _NAME_BUCKETS).cast("int")), name)


def decode_entities(text: Column) -> Column:
    """Replace HTML character references once over (``&amp;lt;`` becomes ``&lt;``).

    Text without ``&`` is returned as it is and the common references are replaced
    directly; only text with others is cut at its references and put together again.
    """
    plain = reduce(
        lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), _COMMON, text
    )
    ampersand = F.replace(plain, F.lit("&amp;"), F.lit("&"))
    return (
        F.when(~text.contains("&"), text)
        .when(~text.rlike(_UNCOMMON), ampersand)
        .otherwise(_decode_any(plain))
    )


def _number_character(ref: Column, base: int) -> Column:
    """The character of a numeric reference; the reference as written where there is none."""
    digits = F.regexp_extract(ref, "^#[xX]?([^;]+)", 1)
    short = F.regexp_replace(digits, "^0+", "")
    code = F.when(
        (short != "") & (F.length(short) <= 8), F.conv(short, base, 10).try_cast("bigint")
    )
    return (
        F.when(code.between(128, 159), F.try_element_at(F.array(*map(F.lit, _WINDOWS)), (code - 127).cast("int")))
        .when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), _character(code))
        .otherwise(F.concat(F.lit("&"), ref))
    )


def _decode_any(text: Column) -> Column:
    """References by number or by any name of HTML 5; unknown names stay as written."""

    def decoded(piece: Column) -> Column:
        ref = F.substring(piece, 2, 2**31 - 1)
        return (
            F.when(~piece.startswith("&") | (piece == "&"), piece)
            .when(piece.rlike("^&#[xX]"), _number_character(ref, 16))
            .when(piece.startswith("&#"), _number_character(ref, 10))
            .otherwise(F.coalesce(F.decode(F.unhex(_named_entity(ref)), "UTF-8"), piece))
        )

    # Not ``split``, which compiles its pattern anew for every row.
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)), decoded), "")
