"""Product pages to product rows: linked data first, markup otherwise."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import jsonld
from ..functions.fields import contains_any, slug_from_url
from ..functions.numbers import discount_pct
from ..functions.rows import compute_once, keep_where
from ..functions.selectors import Scope, Sel, attr, cls, is_below, picked, read, tag
from .discover import scope
from .listing import (
    badge_labels, flag_columns, image_reader, price_reader, rating_reader, reviews_reader,
    sku_reader,
)

# Where each part of a product page is looked for, in the order of the tries.
NAMES = (
    tag("h1", "product-title"), tag("h1", "product-name"), cls("product-title") / tag("h1"),
    cls("product-name") / tag("h1"), tag("h1"), cls("product-info") / tag("h1"),
    cls("product-details") / tag("h1"),
)
DESCRIPTIONS = (
    cls("product-description"), cls("product-desc"), cls("product-detail"), cls("description"),
    cls("product-content"), cls("product-info") / cls("description"),
    attr("id", contains="description"), cls("tab-content") / cls("description"),
)
PRICES = (
    cls("price-current"), cls("current-price"), cls("sale-price"), cls("price", "current"),
    cls("product-price") / cls("current"), cls("price-box") / cls("price"),
)
ORIGINAL_PRICES = (
    cls("price-original"), cls("original-price"), cls("old-price"), cls("regular-price"),
    cls("price", "old"), cls("product-price") / cls("old"), cls("price-box") / cls("old-price"),
)
MAIN_IMAGES = (
    cls("product-image") / tag("img"), cls("product-img") / tag("img"),
    cls("main-image") / tag("img"), cls("product-gallery") / cls("main") / tag("img"),
    cls("product-photo") / tag("img"),
)
GALLERIES = (
    cls("product-gallery") / tag("img"), cls("product-images") / tag("img"),
    cls("product-thumbnails") / tag("img"), cls("image-gallery") / tag("img"),
)
SKUS = (
    attr("data-sku"), cls("sku"), cls("product-sku"), cls("product-code"), cls("item-code"),
)
SKU_WORDS = ("sku", "mã", "code")
BRANDS = (
    cls("product-brand"), cls("brand"), cls("manufacturer"), cls("brand-name"),
    cls("product-manufacturer"),
)
BRAND_WORDS = ("brand", "thương hiệu", "hãng")
INFO_ROWS = (cls("product-info") / tag("tr"), cls("product-details") / tag("tr"))
INFO_CELLS = (tag("td"), tag("th"))
STOCK_TEXTS = (
    cls("availability"), cls("stock-status"), cls("product-availability"), cls("stock"),
)
IN_STOCK_PHRASES = ("in stock", "có sẵn", "còn hàng")
OUT_OF_STOCK_PHRASES = ("out of stock", "hết hàng", "ngừng bán")
CART_BUTTONS = (cls("add-to-cart"), cls("btn-add-cart"))
RATINGS = (cls("rating"), cls("stars"), cls("star-rating"), cls("product-rating"))
FILLED_STARS = (cls("star", "filled"), cls("star-filled"), cls("fa-star"))
REVIEWS = (cls("review-count"), cls("reviews-count"), cls("num-reviews"), cls("total-reviews"))
INGREDIENTS = (
    cls("ingredients"), cls("product-ingredients"), cls("composition"), cls("thành-phần"),
)
USAGES = (
    cls("usage"), cls("instructions"), cls("how-to-use"), cls("cách-sử-dụng"), cls("hướng-dẫn"),
)
MIN_NAME_LENGTH = 5
MIN_DESCRIPTION_LENGTH = 10

DETAIL_COLUMNS = (
    "name", "description", "price", "original_price", "discount_percentage", "image_url",
    "images", "sku", "brand_name", "category_name", "availability", "currency", "rating",
    "review_count", "ingredients", "usage_instructions",
    "is_featured", "is_bestseller", "is_new", "is_sale",
)


@dataclass(frozen=True)
class DetailRules:
    names: Sequence[Sel] = NAMES
    descriptions: Sequence[Sel] = DESCRIPTIONS
    prices: Sequence[Sel] = PRICES
    original_prices: Sequence[Sel] = ORIGINAL_PRICES
    locale: str = "plain"


def _longer_reader(where: Scope, least: int):
    def reader(n: Column) -> Column:
        text = where.text_of(n)
        return F.when(F.length(text) > least, text)

    return reader


def _info_rows(where: Scope) -> Column:
    """Cell texts of the product tables' rows that have a key and a value."""
    rows = F.transform(F.col("table_rows"), lambda row: F.transform(
        F.filter(F.col("cells"), lambda cell: is_below(cell, row)), where.text_of
    ))
    return F.filter(rows, lambda r: F.size(r) >= 2)


def _from_info_rows(rows: Column, words: tuple[str, ...]) -> Column:
    """Value cell of the first row whose key cell has one of the words."""
    fits = F.filter(rows, lambda r: contains_any(F.lower(F.get(r, 0)), words))
    return F.get(F.get(fits, 0), 1)


def _stock_reader(where: Scope):
    def reader(n: Column) -> Column:
        s = F.lower(where.text_of(n))
        return (
            F.when(contains_any(s, IN_STOCK_PHRASES), "in_stock")
            .when(contains_any(s, OUT_OF_STOCK_PHRASES), "out_of_stock")
            .otherwise(s)
        )

    return reader


def gallery(where: Scope, base: Column, main: Column) -> Column:
    """Main image, then the images of each gallery, each once; NULL if there are none."""
    reader = image_reader(base)
    sources = [F.transform(where.all((sel,)), reader) for sel in GALLERIES]
    every = F.array_distinct(F.array_compact(F.concat(F.array(main), *sources)))
    return F.when(F.size(every) > 0, every)


def _fields(rules: DetailRules) -> dict[str, Sequence[Sel]]:
    return {
        "name": rules.names, "description": rules.descriptions, "price": rules.prices,
        "original_price": rules.original_prices, "image": MAIN_IMAGES, "sku": SKUS,
        "brand": BRANDS, "stock": STOCK_TEXTS, "cart": CART_BUTTONS, "rating": RATINGS,
        "reviews": REVIEWS, "ingredients": INGREDIENTS, "usage": USAGES,
    }


def html_detail(docs: DataFrame, base: Column, *keep: str,
                rules: DetailRules = DetailRules()) -> DataFrame:
    """Markup reading of every page, with a NULL name where the page has none."""
    where, picks = scope(), F.col("picks")
    found = compute_once(
        docs, *keep, "doc", where.picks(_fields(rules)).alias("picks"),
        where.all(FILLED_STARS).alias("stars"), where.all(INFO_ROWS).alias("table_rows"),
        where.all(INFO_CELLS).alias("cells"),
    ).withColumn("info", _info_rows(where))
    cart = F.when(picked(picks, "cart"), F.lit("in_stock"))
    parts = found.select(
        *keep, "doc",
        read(picks, "name", _longer_reader(where, MIN_NAME_LENGTH)).alias("name"),
        F.coalesce(
            read(picks, "description", _longer_reader(where, MIN_DESCRIPTION_LENGTH)), F.lit("")
        ).alias("description"),
        read(picks, "price", price_reader(where, rules.locale)).alias("price"),
        read(picks, "original_price", price_reader(where, rules.locale)).alias("original_price"),
        read(picks, "image", image_reader(base)).alias("image_url"),
        F.coalesce(
            read(picks, "sku", sku_reader(where)), _from_info_rows(F.col("info"), SKU_WORDS), F.lit("")
        ).alias("sku"),
        F.coalesce(
            read(picks, "brand", where.some_text), _from_info_rows(F.col("info"), BRAND_WORDS),
            F.lit(""),
        ).alias("brand_name"),
        F.coalesce(read(picks, "stock", _stock_reader(where)), cart, F.lit("unknown")).alias(
            "availability"
        ),
        read(picks, "rating", rating_reader(where, F.col("stars"))).alias("rating"),
        read(picks, "reviews", reviews_reader(where)).alias("review_count"),
        read(picks, "ingredients", where.some_text).alias("ingredients"),
        read(picks, "usage", where.some_text).alias("usage_instructions"),
        badge_labels(where).alias("labels"),
    )
    flags = flag_columns(F.col("labels"))
    extra = {
        "discount_percentage": discount_pct(F.col("price"), F.col("original_price")),
        "images": gallery(where, base, F.col("image_url")),
        "category_name": F.lit(None).cast("string"),
        "currency": F.lit(None).cast("string"),
        **flags,
    }
    return parts.select(*keep, *[extra.get(c, F.col(c)).alias(c) for c in DETAIL_COLUMNS])


def jsonld_detail(docs: DataFrame, *keep: str) -> DataFrame:
    """Linked-data reading of the pages that hold a product."""
    rows = docs.select(*keep, jsonld.detail_item(scope()).alias("item"))
    rows = keep_where(rows, F.col("item").isNotNull())
    return rows.select(*keep, *[c.alias(n) for n, c in jsonld.detail_product(F.col("item")).items()])


def product_detail(docs: DataFrame, base: Column, *keep: str,
                   rules: DetailRules = DetailRules()) -> DataFrame:
    """One row per page that shows a product; address and slug are those of the page.

    ``keep`` must hold ``url``.
    """
    found = compute_once(docs, *keep, "doc", jsonld.detail_item(scope()).alias("item"))
    # Without its elements a linked-data page costs the markup rules nothing.
    unread = F.when(F.col("item").isNull(), F.col("doc")).alias("doc")
    with_item = found.select(*keep, unread, "item")
    markup = html_detail(with_item, base, *keep, "item", rules=rules)
    linked = jsonld.detail_product(F.col("item"))
    has_item = F.col("item").isNotNull()

    def pick(name: str) -> Column:
        other = linked.get(name, F.lit(None))
        return F.when(has_item, other).otherwise(F.col(name)).alias(name)

    rows = keep_where(markup, has_item | (F.col("name") != ""))
    kept = [F.col(c) for c in keep]
    return rows.select(
        *kept, slug_from_url(F.col("url")).alias("slug"), *[pick(c) for c in DETAIL_COLUMNS]
    )


def merge_list_detail(listed: DataFrame, detail: DataFrame) -> DataFrame:
    """Listing rows joined with their product page; a value the page gives beats the listing's."""
    shared = [c for c in listed.columns if c in detail.columns and c != "url"]
    only_detail = [c for c in detail.columns if c not in listed.columns]
    d, li = detail.alias("d"), listed.alias("l")
    return li.join(d, F.col("l.url") == F.col("d.url")).select(
        *[F.col(f"l.{c}") for c in listed.columns if c not in shared],
        *[F.coalesce(F.col(f"d.{c}"), F.col(f"l.{c}")).alias(c) for c in shared],
        *[F.col(f"d.{c}") for c in only_detail],
    )
