"""Text folding as Column expressions: whitespace, tags, entities, slugs."""

from __future__ import annotations

import html.entities
import json
from functools import cache

from pyspark.sql import Column, functions as F

# The Unicode white space that `str.strip()` and `\s` know in Python.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# Vietnamese letters by the ASCII letter they fold to.
VIETNAMESE = {
    "a": "áàảãạăắằẳẵặâấầẩẫậ",
    "e": "éèẻẽẹêếềểễệ",
    "i": "íìỉĩị",
    "o": "óòỏõọôốồổỗộơớờởỡợ",
    "u": "úùủũụưứừửữự",
    "y": "ýỳỷỹỵ",
    "d": "đ",
}
_LOWER_FROM = "".join(VIETNAMESE.values())
_LOWER_TO = "".join(base * len(letters) for base, letters in VIETNAMESE.items())
FOLD_FROM = _LOWER_FROM + _LOWER_FROM.upper()
FOLD_TO = _LOWER_TO + _LOWER_TO.upper()

# Curly quotes and what they fold to when asked for.
CURLY_QUOTES = "“”‘’"
STRAIGHT_QUOTES = "\"\"''"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def fold_diacritics(c: Column) -> Column:
    return F.translate(c, FOLD_FROM, FOLD_TO)


@cache
def _entities() -> tuple[str, str, str]:
    """JSON of named references, JSON of numbers with a meaning of their own, legacy names."""
    legacy = [name for name in html.entities.html5 if not name.endswith(";")]
    odd = {0: "\ufffd"}
    for code in range(0x80, 0xA0):
        # A number in the C1 range means the Windows-1252 character there.
        odd[code] = bytes([code]).decode("cp1252", "ignore") or chr(code)
    controls = [*range(1, 9), 0xB, *range(0xE, 0x20), 0x7F, *range(0xFDD0, 0xFDF0)]
    for code in controls + [plane + last for plane in range(0, 0x110000, 0x10000)
                            for last in (0xFFFE, 0xFFFF)]:
        odd[code] = ""
    longest_first = "|".join(sorted(legacy, key=len, reverse=True))
    return json.dumps(html.entities.html5), json.dumps(odd), longest_first


def _literal_map(text: str) -> Column:
    return F.from_json(F.lit(text), "map<string,string>")


def _numbered(digits: Column) -> Column:
    """Character of a reference ``#123`` or ``#x7b`` without its mark."""
    n = F.when(
        F.startswith(F.lower(digits), F.lit("x")), F.conv(F.substr(digits, F.lit(2)), 16, 10)
    ).otherwise(digits).try_cast("decimal(38,0)")
    beyond = n.isNull() | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    utf32 = F.decode(F.unhex(F.lpad(F.hex(n.try_cast("bigint")), 8, "0")), "UTF-32")
    odd = F.try_element_at(_literal_map(_entities()[1]), n.cast("string"))
    return F.coalesce(odd, F.when(beyond, F.lit("\ufffd")).otherwise(utf32))


def _after_ampersand(seg: Column) -> Column:
    """Text that stands for ``'&' + seg``; at most one reference starts there."""
    names, _, legacy = _entities()
    table = _literal_map(names)
    ref = F.regexp_extract(seg, r"^([^\t\n\f <&#;]{1,32};?)", 1)
    prefix = F.regexp_extract(ref, f"^({legacy})", 1)
    name = F.get(F.filter(F.array(ref, prefix), lambda k: F.map_contains_key(table, k)), 0)
    number = F.regexp_extract(seg, r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?)", 1)
    digits = F.btrim(number, F.lit("#;"))

    def rest(taken: Column) -> Column:
        return F.substr(seg, F.length(taken) + 1)

    return (
        F.when(F.startswith(seg, F.lit("amp;")), F.concat(F.lit("&"), F.substr(seg, F.lit(5))))
        .when(number != "", F.concat(_numbered(digits), rest(number)))
        .when(name.isNotNull(), F.concat(F.try_element_at(table, name), rest(name)))
        .otherwise(F.concat(F.lit("&"), seg))
    )


def unescape(c: Column) -> Column:
    """Decode HTML character references in one pass, inside the JVM."""
    parts = F.split(c, "&")
    decoded = F.transform(
        parts, lambda seg, i: F.when(i == 0, seg).otherwise(_after_ampersand(seg))
    )
    return F.when(F.contains(c, F.lit("&")), F.array_join(decoded, "")).otherwise(c)


def _collapse(c: Column) -> Column:
    s = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), f"[{WS}]+", " ")
    return F.regexp_replace(s, "<[^>]+>", "")


def _decode(c: Column, fold_quotes: bool) -> Column:
    s = unescape(c)
    return strip(F.translate(s, CURLY_QUOTES, STRAIGHT_QUOTES) if fold_quotes else s)


def normalize_texts(columns: list[Column], fold_quotes: bool = False) -> Column:
    """Collapse white space, drop tags, decode entities, for all columns in one array.

    NULL becomes ``''``. Tags go before entities are decoded, so an escaped tag survives as
    text. Two steps, since a lambda computes an expression each time it is mentioned.
    """
    collapsed = F.transform(F.array(*columns), lambda c: _collapse(c))
    return F.transform(collapsed, lambda c: _decode(c, fold_quotes))


def normalize_text(c: Column, fold_quotes: bool = False) -> Column:
    return F.get(normalize_texts([c], fold_quotes), 0)


def _slug_core(s: Column) -> Column:
    s = F.translate(s, FOLD_FROM + WHITESPACE, FOLD_TO + "-" * len(WHITESPACE))
    s = F.regexp_replace(s, r"[^\p{L}\p{N}_-]", "")
    s = F.btrim(F.regexp_replace(s, "-{2,}", "-"), F.lit("-"))
    # Mentioned once: Spark would work out a test for '' and its value one after the other.
    return F.get(F.filter(F.array(s, F.lit("unknown")), lambda x: x != ""), 0)


def generate_slug(c: Column) -> Column:
    """Slug of a category name; nothing left over gives ``unknown``."""
    return _slug_core(F.lower(F.coalesce(c, F.lit(""))))


def normalize_slug(c: Column) -> Column:
    """Slug of a given slug text; a missing one stays ``''``."""
    present = c.isNotNull() & (c != "")
    return F.when(present, _slug_core(F.btrim(F.lower(strip(c)), F.lit("/ ")))).otherwise(
        F.lit("")
    )
