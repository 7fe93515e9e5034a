"""Listing pages to product rows: cards, prices, badges, paging."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import jsonld
from ..functions.fields import absolute_url, badge_label, contains_any, page_url, slug_from_url
from ..functions.html import NODE_TYPE
from ..functions.numbers import discount_pct, first_int, first_number, parse_float, parse_price_text
from ..functions.rows import compute_once, keep_where
from ..functions.selectors import (
    Scope, Sel, attr, attribute, cls, is_below, picked, read, some_attribute, tag,
)
from .discover import scope

# Where each part of a card is looked for, in the order of the tries.
CARDS = (
    cls("product-item"), cls("product"), cls("product-card"), cls("item-product"),
    cls("product-list-item"), cls("grid-item"), cls("product-grid-item"),
    attr("data-product-id"), cls("woocommerce-product-list") / cls("product"),
)
NAMES = (
    cls("product-title") / tag("a"), cls("product-name") / tag("a"), tag("h3") / tag("a"),
    tag("h2") / tag("a"), cls("title") / tag("a"), attr("title", on="a"),
)
PRICES = (
    cls("price"), cls("product-price"), cls("price-current"), cls("current-price"),
    cls("sale-price"),
)
ORIGINAL_PRICES = (
    cls("price-original"), cls("original-price"), cls("old-price"), cls("regular-price"),
    cls("price-old"),
)
IMAGES = (
    cls("product-image") / tag("img"), cls("product-img") / tag("img"), cls("thumb") / tag("img"),
    tag("img", "product-image"), tag("img"),
)
RATINGS = (cls("stars"), cls("rating"), cls("star-rating"), cls("product-rating"))
REVIEWS = (cls("review-count"), cls("reviews"), cls("num-reviews"), cls("review-num"))
FILLED_STARS = (
    cls("star", "filled"), cls("star-filled"), cls("fa-star"), cls("glyphicon-star"),
)
SKUS = (attr("data-sku"), cls("sku"), cls("product-sku"), cls("product-code"))
STOCK_TEXTS = (cls("availability"), cls("stock-status"), cls("in-stock"), cls("out-of-stock"))
BADGE_NODES = (cls("badge"), cls("label"), cls("flag"), cls("tag"))
FEATURED_CLASS_PARTS = ("featured", "bestseller", "hot")
NEXT_PAGE = (
    cls("next"), cls("pagination-next"), attr("rel", equals="next", on="a"), cls("page-next"),
)
IMAGE_ATTRIBUTES = ("data-src", "src", "data-original")
RATING_ATTRIBUTES = ("data-rating", "data-score", "data-stars")


@dataclass(frozen=True)
class CardRules:
    """Selector orders and the price notation; reorder them for a shop that needs it."""

    cards: Sequence[Sel] = CARDS
    names: Sequence[Sel] = NAMES
    prices: Sequence[Sel] = PRICES
    original_prices: Sequence[Sel] = ORIGINAL_PRICES
    locale: str = "plain"


LISTING_COLUMNS = (
    "name", "url", "slug", "price", "original_price", "discount_percentage", "image_url",
    "rating", "review_count", "sku", "availability",
    "is_featured", "is_bestseller", "is_new", "is_sale",
)


def non_zero(c: Column) -> Column:
    return F.when(c != 0, c)


def price_reader(where: Scope, locale: str):
    """A price that is neither missing nor zero."""
    return lambda n: non_zero(parse_price_text(where.text_of(n), locale))


def rating_reader(where: Scope, stars: Column):
    """Rating attribute, else first number in the text, else number of filled ``stars`` below."""

    def reader(n: Column) -> Column:
        given = F.filter(
            F.transform(
                F.array(*[F.lit(a) for a in RATING_ATTRIBUTES]),
                lambda a: parse_float(F.try_element_at(n["attrs"], a)),
            ),
            lambda x: x.isNotNull(),
        )
        filled = F.size(F.filter(stars, lambda s: is_below(s, n))).cast("double")
        return non_zero(F.coalesce(F.get(given, 0), first_number(where.text_of(n)), filled))

    return reader


def reviews_reader(where: Scope):
    return lambda n: first_int(where.text_of(n))


def sku_reader(where: Scope):
    return lambda n: F.coalesce(some_attribute(n, "data-sku"), where.some_text(n))


def image_reader(base: Column):
    return lambda n: absolute_url(base, some_attribute(n, *IMAGE_ATTRIBUTES))


def badge_labels(where: Scope) -> Column:
    """Distinct labels of all badges in scope."""
    labels = F.transform(where.all(BADGE_NODES), lambda n: badge_label(where.text_of(n)))
    return F.array_distinct(F.array_compact(labels))


def flag_columns(labels: Column, also_featured: Column | None = None) -> dict[str, Column]:
    featured = F.array_contains(labels, "featured")
    return {
        "is_featured": featured if also_featured is None else featured | also_featured,
        "is_bestseller": F.array_contains(labels, "bestseller"),
        "is_new": F.array_contains(labels, "new"),
        "is_sale": F.array_contains(labels, "sale"),
    }


def card_slices(where: Scope, rules: CardRules) -> Column:
    """Each card with its own elements, the elements around it and its own text.

    Exploding these small structs keeps the page text out of the exploded rows.
    """
    found, nodes, text = where.all_by_rank(rules.cards), F.col(where.nodes), F.col(where.text)

    def cut(c: Column) -> Column:
        around = F.transform(c["up"], lambda i: F.get(nodes, i))
        inner = F.slice(nodes, c["pre"] + 1, c["post"] - c["pre"] + 1)
        return F.struct(
            c.alias("card"),
            F.concat(around, inner).alias("nodes"),
            F.substr(text, c["start"] + 1, c["stop"] - c["start"]).alias("text"),
        )

    return F.transform(found, cut)


def _card_fields(rules: CardRules) -> dict[str, Sequence[Sel]]:
    return {
        "name": rules.names, "price": rules.prices, "original_price": rules.original_prices,
        "image": IMAGES, "rating": RATINGS, "reviews": REVIEWS, "sku": SKUS, "stock": STOCK_TEXTS,
        "there": (cls("available"),), "gone": (cls("unavailable"),),
    }


def _card_scope() -> Scope:
    return Scope("c.nodes", "c.text", shift="c.card.start", root="c.card")


def _search_card(rows: DataFrame, rules: CardRules) -> DataFrame:
    """Find a card's elements once; the columns below read from what was found."""
    where = _card_scope()
    return compute_once(
        rows, *rows.columns, where.picks(_card_fields(rules)).alias("picks"),
        where.all(FILLED_STARS).alias("stars"), where.all((tag("a"),)).alias("anchors"),
    )


def _card_product(rules: CardRules, base: Column) -> list[Column]:
    """Columns of a card from ``c`` and its ``picks``."""
    where, picks = _card_scope(), F.col("picks")
    lone = F.filter("anchors", lambda n: n["lone_text"])

    def link_of(n: Column) -> Column:
        return F.struct(
            where.text_of(n).alias("text"),
            F.coalesce(attribute(n, "href"), F.lit("")).alias("href"),
        )

    stock = F.coalesce(
        read(picks, "stock", where.text_of),
        F.when(picked(picks, "there"), F.lit("in_stock")),
        F.when(picked(picks, "gone"), F.lit("out_of_stock")),
        F.lit("unknown"),
    )
    class_text = F.array_join(F.col("c.card.classes"), " ")
    return [
        F.coalesce(read(picks, "name", link_of), F.get(F.transform(lone, link_of), 0)).alias("link"),
        read(picks, "price", price_reader(where, rules.locale)).alias("price"),
        read(picks, "original_price", price_reader(where, rules.locale)).alias("original_price"),
        read(picks, "image", image_reader(base)).alias("image_url"),
        read(picks, "rating", rating_reader(where, F.col("stars"))).alias("rating"),
        read(picks, "reviews", reviews_reader(where)).alias("review_count"),
        read(picks, "sku", sku_reader(where)).alias("sku"),
        stock.alias("availability"),
        badge_labels(where).alias("labels"),
        contains_any(class_text, FEATURED_CLASS_PARTS).alias("class_featured"),
    ]


def card_products(docs: DataFrame, base: Column, *keep: str,
                  rules: CardRules = CardRules()) -> DataFrame:
    """One row per card that has a name link; ``pos`` is the card's place on the page."""
    cards = docs.select(*keep, F.posexplode(card_slices(scope(), rules)).alias("pos", "c"))
    parts = _search_card(cards, rules).select(*keep, "pos", *_card_product(rules, base))
    parts = keep_where(parts, F.col("link").isNotNull())
    url = absolute_url(base, F.col("link.href"))
    flags = flag_columns(F.col("labels"), F.col("class_featured"))
    return parts.select(
        *keep, "pos",
        F.col("link.text").alias("name"),
        url.alias("url"),
        slug_from_url(url).alias("slug"),
        "price", "original_price",
        discount_pct(F.col("price"), F.col("original_price")).alias("discount_percentage"),
        "image_url", "rating", "review_count", "sku", "availability",
        *[c.alias(name) for name, c in flags.items()],
    )


def jsonld_products(docs: DataFrame, *keep: str) -> DataFrame:
    """Products of a page's linked data, in script order."""
    items = jsonld.listing_items(scope())
    rows = docs.select(*keep, F.posexplode(items).alias("pos", "item"))
    flat = jsonld.listing_product(F.col("item"))
    rows = rows.select(*keep, "pos", *[c.alias(n) for n, c in flat.items()])
    rows = keep_where(rows, F.col("name").isNotNull())
    missing = [c for c in LISTING_COLUMNS if c not in rows.columns]
    types = {"original_price": "double", "discount_percentage": "double", "sku": "string",
             "availability": "string"}
    return rows.select(
        *keep, "pos",
        *[
            F.lit(None).cast(types.get(c, "boolean")).alias(c) if c in missing else F.col(c)
            for c in LISTING_COLUMNS
        ],
    )


def listing_products(docs: DataFrame, base: Column, *keep: str,
                     rules: CardRules = CardRules()) -> DataFrame:
    """Products of listing pages: cards where there are any, linked data elsewhere.

    Both kinds leave the page in one array, so a page is parsed and exploded once.
    """
    where = scope()
    no_card = F.lit(None).cast(f"struct<card:{NODE_TYPE},nodes:array<{NODE_TYPE}>,text:string>")
    cards = F.transform(
        card_slices(where, rules),
        lambda c: F.struct(c.alias("c"), F.lit(None).cast("variant").alias("item")),
    )
    linked = F.transform(
        jsonld.listing_items(where), lambda i: F.struct(no_card.alias("c"), i.alias("item"))
    )
    rows = docs.select(*keep, F.posexplode(F.coalesce(cards, linked)).alias("pos", "found"))
    rows = rows.select(*keep, "pos", "found.c", "found.item")
    rows = _search_card(rows, rules)
    from_ld = jsonld.listing_product(F.col("item"))
    is_card = F.col("c").isNotNull()
    parts = rows.select(
        *keep, "pos", is_card.alias("is_card"),
        *_card_product(rules, base),
        F.struct(*[c.alias(name) for name, c in from_ld.items()]).alias("ld"),
    )
    parts = keep_where(parts, F.col("link").isNotNull() | F.col("ld.name").isNotNull())
    flags = flag_columns(F.col("labels"), F.col("class_featured"))
    url = absolute_url(base, F.col("link.href"))
    of_card = {
        "name": F.col("link.text"),
        "url": url,
        "slug": slug_from_url(url),
        "discount_percentage": discount_pct(F.col("price"), F.col("original_price")),
        **flags,
    }

    def pick(name: str) -> Column:
        card = of_card.get(name, F.col(name))
        other = F.col(f"ld.{name}") if name in from_ld else F.lit(None)
        return F.when(F.col("is_card"), card).otherwise(other).alias(name)

    return parts.select(*keep, "pos", *[pick(name) for name in LISTING_COLUMNS])


def has_next_page(where: Scope) -> Column:
    return F.size(where.all(NEXT_PAGE)) > 0


def page_urls(base: Column, n: Column) -> Column:
    """Addresses of pages 1 to n."""
    return F.transform(F.sequence(F.lit(1), n), lambda i: page_url(base, i))


def listing_keys(url: Column) -> Column:
    """The (listing address, page number) pairs a page may be: page 1 of itself, or page n."""
    numbered = r"^(.*)[?&]page=([1-9][0-9]*)$"
    base = F.regexp_extract(url, numbered, 1)
    number = F.regexp_extract(url, numbered, 2).try_cast("int")
    # ``?page=`` only continues an address without a query, ``&page=`` one that has it.
    follows = F.contains(base, F.lit("?")) == url.rlike(r"&page=[0-9]+$")
    itself = F.struct(url.alias("listing_url"), F.lit(1).alias("page_no"))
    later = F.struct(base.alias("listing_url"), number.alias("page_no"))
    return F.when((number > 1) & follows, F.array(itself, later)).otherwise(F.array(itself))


def pagination_prefix(pages: DataFrame, key: Sequence[str], max_pages: int | None = None,
                      page: str = "page_no", products: str = "n_products",
                      has_next: str = "has_next") -> DataFrame:
    """Pages a reader walks through: 1, 2, … until one is missing, empty, last or over the limit.

    The first page that ends the walk is a minimum per listing, so the only shuffle before
    the join is an aggregate that combines on the map side; a listing with very many pages
    is never gathered into one window.
    """
    p = F.col(page)
    empty = F.col(products) == 0
    last = ~F.col(has_next)
    keyed = pages.where(p <= max_pages) if max_pages else pages
    # A page whose successor does not exist is where the walk ends as well.
    following = keyed.select(*key, (p - 1).alias(page), F.lit(True).alias("_followed"))
    linked = keyed.join(following, [*key, page], "left")
    stops = linked.groupBy(*key).agg(
        F.min(p).alias("_first"),
        F.min(F.when(empty, p - 1).when(last | F.col("_followed").isNull(), p)).alias("_stop"),
    )
    return keyed.join(stops, list(key)).where(
        (F.col("_first") == 1) & (p <= F.col("_stop"))
    ).drop("_first", "_stop")
