"""Rules for URLs, flags, stock states, article numbers and image lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import blank_to_null, strip

# Texts that mean true.
TRUE_WORDS = ("true", "1", "yes", "on", "active")

# Stock phrases in the order in which they are tried.
AVAILABILITY = {
    "in_stock": "in_stock",
    "instock": "in_stock",
    "available": "in_stock",
    "có sẵn": "in_stock",
    "còn hàng": "in_stock",
    "out_of_stock": "out_of_stock",
    "outofstock": "out_of_stock",
    "unavailable": "out_of_stock",
    "hết hàng": "out_of_stock",
    "ngừng bán": "out_of_stock",
    "pre_order": "pre_order",
    "preorder": "pre_order",
    "đặt trước": "pre_order",
}

# Badge words per label, the first label that fits wins.
BADGES = {
    "new": ("new", "mới"),
    "sale": ("sale", "giảm", "khuyến mãi"),
    "bestseller": ("bestseller", "bán chạy", "hot"),
    "featured": ("featured", "nổi bật"),
}

_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    hit = F.contains(c, F.lit(words[0]))
    for word in words[1:]:
        hit = hit | F.contains(c, F.lit(word))
    return hit


def normalize_url(c: Column) -> Column:
    s = strip(F.coalesce(c, F.lit("")))
    return F.when((s == "") | s.rlike("^(?:https?://|/)"), s).otherwise(F.concat(F.lit("/"), s))


def is_valid_url(c: Column) -> Column:
    return F.coalesce(c.rlike("^(?:/|(?i:https?)://[^/?#]+)"), F.lit(False))


def slug_from_url(c: Column) -> Column:
    """Last non-empty path segment, without query, fragment or ``;`` parameters."""
    path = F.regexp_replace(F.regexp_extract(c, _PATH, 1), ";[^/]*$", "")
    last = F.regexp_extract(path, "([^/]+)/*$", 1)
    return F.coalesce(blank_to_null(last), F.lit("unknown"))


def url_origin(c: Column) -> Column:
    return F.regexp_extract(c, _ORIGIN, 1)


def resolve_dots(path: Column, squeeze: bool = False) -> Column:
    """A rooted path without ``.`` and ``..`` segments; ``..`` goes no higher than the root.

    Segments are folded into a stack. ``squeeze`` also drops empty segments between others, as a
    path has them that was put together.
    """
    parts = F.split(path, "/")
    inner, last = F.slice(parts, F.lit(2), F.size(parts) - 1), F.element_at(parts, -1)
    if squeeze:
        inner = F.concat(F.filter(F.slice(inner, F.lit(1), F.size(inner) - 1), lambda x: x != ""), F.array(last))
    stack = F.aggregate(
        inner, F.array().cast("array<string>"),
        lambda held, x: F.when(x == "..", F.slice(held, F.lit(1), F.greatest(F.size(held) - 1, F.lit(0))))
        .when(x == ".", held).otherwise(F.concat(held, F.array(x))),
    )
    end = F.when(last.isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(stack, end), "/"))


def _tidy(path: Column, squeeze: bool = False) -> Column:
    """Most paths have nothing to resolve and are left as they are."""
    odd = path.rlike(r"/\.{1,2}(?:/|$)|//" if squeeze else r"/\.{1,2}(?:/|$)")
    return F.when(odd, resolve_dots(path, squeeze)).otherwise(path)


def _cut(c: Column) -> tuple[Column, Column]:
    """The path of a link without scheme or host, and its query and fragment."""
    return F.regexp_extract(c, "^([^?#]*)", 1), F.regexp_extract(c, "^[^?#]*(.*)$", 1)


def absolute_url(base: Column, c: Column) -> Column:
    """Only rooted links are resolved; other relative links stay as they are."""
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.\\-]*:)", 1)
    path, rest = _cut(c)
    return (
        F.when(F.startswith(c, F.lit("//")), F.concat(scheme, c))
        .when(F.startswith(c, F.lit("/")), F.concat(url_origin(base), _tidy(path), rest))
        .otherwise(c)
    )


def join_url(base: Column, c: Column) -> Column:
    """Resolve any link against a base, as a browser would."""
    folder = F.regexp_replace(F.regexp_extract(base, _PATH, 1), "[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    bare = F.regexp_extract(base, "^([^?#]*)", 1)
    path, rest = _cut(c)
    return (
        F.when(c.rlike("^[A-Za-z][A-Za-z0-9+.\\-]*:"), c)
        .when(F.startswith(c, F.lit("/")), absolute_url(base, c))
        .when(F.startswith(c, F.lit("?")), F.concat(bare, c))
        .when(F.startswith(c, F.lit("#")), F.concat(F.regexp_extract(base, "^([^#]*)", 1), c))
        .when(c == "", base)
        .otherwise(F.concat(url_origin(base), _tidy(F.concat(folder, path), squeeze=True), rest))
    )


def page_url(base: Column, page: Column) -> Column:
    """Address of the n-th page of a listing."""
    glue = F.when(F.contains(base, F.lit("?")), F.lit("&page=")).otherwise(F.lit("?page="))
    return F.when(page == 1, base).otherwise(F.concat(base, glue, page.cast("string")))


def normalize_boolean(c: Column, kind: str = "text") -> Column:
    if kind == "bool":
        hit = c
    elif kind == "number":
        hit = c != 0
    else:
        hit = F.lower(c).isin(*TRUE_WORDS)
    return F.coalesce(hit, F.lit(False))


def normalize_sku(c: Column) -> Column:
    s = F.upper(strip(F.coalesce(c, F.lit(""))))
    return F.regexp_replace(s, "[^A-Z0-9_-]", "")


def normalize_availability(c: Column) -> Column:
    """Exact phrase first, then the first phrase contained in the text."""
    s = F.lower(strip(c))
    exact = None
    for status in ("in_stock", "out_of_stock", "pre_order"):
        phrases = [k for k, v in AVAILABILITY.items() if v == status]
        cond = s.isin(*phrases)
        exact = F.when(cond, status) if exact is None else exact.when(cond, status)
    partial = None
    for phrase, status in AVAILABILITY.items():
        cond = F.contains(s, F.lit(phrase))
        partial = F.when(cond, status) if partial is None else partial.when(cond, status)
    return F.coalesce(exact, partial, F.lit("unknown"))


def normalize_images(c: Column, is_list: bool = False) -> Column:
    """Image addresses as an array; text that is no JSON list counts as one address."""
    listed = c if is_list else F.from_json(c, "array<string>")
    urls = F.transform(F.filter(listed, lambda u: u.isNotNull() & (u != "")), normalize_url)
    single = F.lit("") if is_list else normalize_url(c)
    return F.coalesce(urls, F.filter(F.array(single), lambda u: u != ""))


def badge_label(c: Column) -> Column:
    """The one label a badge text stands for, or NULL."""
    s = F.lower(strip(c))
    label = None
    for name, words in BADGES.items():
        cond = contains_any(s, words)
        label = F.when(cond, name) if label is None else label.when(cond, name)
    return label


def sql_escape(c: Column) -> Column:
    """SQL string literal with doubled quotes; NULL is the empty literal."""
    return F.concat(
        F.lit("'"), F.replace(F.coalesce(c, F.lit("")), F.lit("'"), F.lit("''")), F.lit("'")
    )
