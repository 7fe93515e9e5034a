"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fields, numbers, text
from ..functions.selectors import tag
from ..operators import (
    detail, discover, export, hierarchy, listing, lookup, merge, normalize, quality, runlog, stats,
)
from ..plans import refresh
from ..session import lay_out, new_folder, spread, stage
from ..sources.catalog import Snapshot
from ..sources.pages import latest_versions, read_pages, stream_pages
from ..streaming import ingest
from . import shop, tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
NOW = datetime(2024, 2, 1)
RUNS_NOW = datetime(2024, 1, 31)
# The menus of the landed pages carry no classes.
PLAIN_MENU = discover.MenuRules(nav=(*discover.NAV_SELECTORS, tag("nav") / tag("a")))
ANY_PATH = discover.MenuRules(paths=("/c", "/e", "/t"))


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def pages(spark: SparkSession, d: str) -> DataFrame:
    return spread(read_pages(spark, f"{d}/pages.parquet"))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(t.table(spark, d, "documents"))


def address_forms(spark: SparkSession, d: str) -> DataFrame:
    """Each page address in full, without scheme, and as a path."""
    u = F.col("url")
    forms = F.array(
        u, F.regexp_replace(u, "^https?://", ""), F.regexp_replace(u, "^https?://[^/]*", ""),
        F.regexp_replace(u, "^https?:", ""),
    )
    return pages(spark, d).select("page_id", "url", F.posexplode(forms).alias("form", "c"))


def joined(c: Column) -> Column:
    return F.array_join(c, "|")


# Sources and lookups --------------------------------------------------------------------


@query
def pages_scan(spark, d):
    return pages(spark, d).select("page_id", "url", F.length("html").alias("n_chars"))


@query
def categories_by_parent(spark, d):
    found = hierarchy.children(t.categories(spark, d), "asia")
    return found.select("slug", "name", "parent_slug")


@query
def all_categories(spark, d):
    return hierarchy.children(t.categories(spark, d)).select("slug", "name", "parent_slug")


@query
def category_roots(spark, d):
    return hierarchy.roots(t.categories(spark, d)).select("slug", "name")


@query
def products_by_category_limit(spark, d):
    found = lookup.products_of_category(t.products(spark, d), "nation_3", limit=5)
    return found.select("slug", "name", "price")


@query
def exists_semi(spark, d):
    batch = t.change_batch(spark, d).select("slug", "pos")
    return lookup.existing(batch, t.stored_offers(spark, d))


@query
def new_products_anti(spark, d):
    batch = t.change_batch(spark, d).select("slug", "pos")
    return lookup.missing(batch, t.stored_offers(spark, d))


@query
def modified_since(spark, d):
    return lookup.modified_since(t.products(spark, d), t.ts("2020-02-01 00:00:00")).select(
        "slug", "updated_at"
    )


@query
def lookup_by_slug(spark, d):
    wanted = t.table(spark, d, "customer").select(
        text.normalize_slug(F.col("c_mktsegment")).alias("seg"), F.col("c_nationkey")
    ).select(F.concat(F.lit("nation_"), F.col("c_nationkey"), F.lit("-"), F.col("seg")).alias("slug"))
    wanted = wanted.unionByName(t.brands(spark, d).select("slug"))
    return lookup.by_slug(wanted, t.categories(spark, d).select("slug", "name", "parent_slug"))


@query
def match_slug_or_url(spark, d):
    stored = stage(t.stored_offers(spark, d).select("slug", "url"))
    batch = t.change_batch(spark, d)
    # A third of the feed writes its slugs in another way, so only the address matches.
    renamed = F.when(F.col("is_sale"), F.concat(F.lit("x-"), F.col("slug"))).otherwise(F.col("slug"))
    return merge.match_slug_or_url(stored, batch.withColumn("slug", renamed)).select(
        "pos", "slug", "url", "match_slug"
    )


@query
def merge_by_url(spark, d):
    """The slug each feed row belongs to, or why it fails."""
    batch = t.change_batch(spark, d)
    renamed = F.when(F.col("is_sale"), F.concat(F.lit("x-"), F.col("slug"))).otherwise(F.col("slug"))
    stored = stage(t.stored_offers(spark, d).select("slug", "url"))
    clear, unclear = merge.resolve_identity(stored, batch.withColumn("slug", renamed))
    return clear.select("pos", "slug", F.lit("").alias("reason")).unionByName(unclear.select("pos", "slug", "reason"))


@query
def merge_replay(spark, d):
    """A feed that moves products to other addresses, some of them taken: its rows, and the products then."""
    batch = t.change_batch(spark, d)
    part = F.regexp_extract("slug", "^(p[0-9]+)-", 1)
    line = F.split("pos", "-")[2].cast("int")
    url = F.when(line % 3 == 0, F.col("url")).when(
        line % 3 == 1, F.concat(F.lit("/offers/"), part, F.lit("-x"), line)).otherwise(F.concat(F.lit("/offers/"), part))
    slug = F.when(line % 4 == 0, F.concat(part, F.lit("-n"), line)).otherwise(F.col("slug"))
    stored = lay_out(t.stored_offers(spark, d, laid=True), "slug").rows
    clear, failed = merge.resolve_identity(stored, lay_out(batch.withColumns({"slug": slug, "url": url}), "slug", "url"))
    out = merge.merge_products(stored, t.categories(spark, d), t.brands(spark, d), clear, t.ts(t.NOW))
    accepted = lookup.missing(out.batch.select("pos", "slug"), out.rejects, "pos")
    refused = failed.select("pos", "reason").unionByName(out.rejects.select("pos", "reason"))
    none = F.lit("")
    return (
        accepted.select("pos", "slug", none.alias("url"), none.alias("reason"))
        .unionByName(refused.select("pos", none.alias("slug"), none.alias("url"), "reason"))
        .unionByName(out.products.rows.select(none.alias("pos"), "slug", "url", none.alias("reason")))
    )


@query
def latest_pages(spark, d):
    """The last landing of each host, as if every page of a host had landed at one address."""
    rows = pages(spark, d).withColumn("url", F.regexp_extract("url", "//([^/]+)", 1)).withColumn(
        "landed_at", F.pmod(F.col("page_id") * 7, F.lit(11))
    )
    return latest_versions(rows).select("url", "page_id", "landed_at")


# Extraction from the landed pages --------------------------------------------------------


def nav_links(spark, d) -> DataFrame:
    docs = discover.with_document(pages(spark, d))
    where = discover.scope()
    found = discover.links(where, where.all_by_rank(PLAIN_MENU.nav))
    return discover.explode_links(docs, found, "page_id", "url").withColumnRenamed("url", "page_url")


@query
def page_links(spark, d):
    return nav_links(spark, d).select("page_id", "pos", "href", "text")


@query
def category_links(spark, d):
    kept = nav_links(spark, d).where(discover.is_category_link(F.col("href"), F.col("text")))
    base = fields.url_origin(F.col("page_url"))
    return discover.to_categories(kept, base, "page_id")


def _found_on_pages(spark, d, rules) -> DataFrame:
    docs = discover.with_document(pages(spark, d))
    rows = discover.explode_links(docs, discover.menu_links(discover.scope(), rules), "page_id", "url")
    base = fields.url_origin(F.col("page_url"))
    return discover.to_categories(rows.withColumnRenamed("url", "page_url"), base, "page_id")


@query
def nav_categories(spark, d):
    return _found_on_pages(spark, d, PLAIN_MENU)


@query
def category_link_fallback(spark, d):
    return _found_on_pages(spark, d, ANY_PATH)


@query
def dedupe_first_by_slug(spark, d):
    return discover.dedupe_first(_found_on_pages(spark, d, PLAIN_MENU), "slug", "page_id", "pos")


@query
def category_link_counts(spark, d):
    found = _found_on_pages(spark, d, PLAIN_MENU)
    return found.groupBy("slug").agg(
        F.count("*").alias("n_links"), F.count_distinct("page_id").alias("n_pages")
    )


@query
def limit_categories(spark, d):
    found = discover.dedupe_first(_found_on_pages(spark, d, PLAIN_MENU), "slug", "page_id", "pos")
    return discover.limit_categories(found, 20, "page_id", "pos").select("slug", "name")


@query
def html_detail(spark, d):
    docs = discover.with_document(pages(spark, d))
    found = detail.html_detail(docs, fields.url_origin(F.col("url")), "page_id", "url")
    return found.select(
        "page_id", "name", "description", "sku", "brand_name", "availability", "price", "is_new"
    )


@query
def page_products(spark, d):
    docs = discover.with_document(pages(spark, d))
    found = detail.product_detail(docs, fields.url_origin(F.col("url")), "page_id", "url")
    return found.select("page_id", "url", "slug", "name", "availability")


# Extraction from rendered shop pages ------------------------------------------------------


def listing_docs(spark, d) -> DataFrame:
    return discover.with_document(shop.listing_pages(spark, d))


@query
def subcategories_union(spark, d):
    found = discover.discover(shop.menu_pages(spark, d), shop.BASE)
    return found.select("name", "slug", "url", "full_url", "parent_slug")


@query
def listing_cards(spark, d):
    found = listing.card_products(listing_docs(spark, d), shop.RULES.base, "page_id")
    return found.select("page_id", "pos", *listing.LISTING_COLUMNS)


@query
def jsonld_listing(spark, d):
    docs = discover.with_document(shop.item_list_pages(spark, d))
    return listing.jsonld_products(docs, "page_id").select(
        "page_id", "pos", "name", "url", "slug", "price", "image_url", "rating", "review_count"
    )


@query
def has_next_page(spark, d):
    docs = listing_docs(spark, d)
    return docs.select("page_id", "url", listing.has_next_page(discover.scope()).alias("has_next"))


def shop_details(spark, d) -> DataFrame:
    docs = discover.with_document(shop.product_pages(spark, d))
    return detail.product_detail(docs, shop.RULES.base, "page_id", "url")


@query
def jsonld_detail(spark, d):
    docs = discover.with_document(shop.product_pages(spark, d))
    found = detail.jsonld_detail(docs, "page_id")
    return found.withColumn("images", joined(F.col("images")))


@query
def product_detail(spark, d):
    found = shop_details(spark, d)
    return found.select(
        "page_id", "url", "slug", "name", "description", "price", "original_price",
        "discount_percentage", "sku", "brand_name", "category_name", "availability", "rating",
        "review_count", "ingredients", "image_url", joined(F.col("images")).alias("images"),
        "is_bestseller",
    )


@query
def gallery_distinct(spark, d):
    docs = discover.with_document(shop.product_pages(spark, d))
    found = detail.html_detail(docs, shop.RULES.base, "page_id")
    return found.where("images IS NOT NULL").select(
        "page_id", "image_url", joined(F.col("images")).alias("images")
    )


@query
def merge_list_detail(spark, d):
    listed = listing.listing_products(listing_docs(spark, d), shop.RULES.base)
    rows = detail.merge_list_detail(listed.drop("pos"), shop_details(spark, d).drop("page_id"))
    return rows.select(
        "url", "slug", "name", "price", "original_price", "discount_percentage", "rating",
        "review_count", "sku", "availability", "image_url", "brand_name", "category_name", "is_sale",
        "is_new", "is_bestseller",
    )


@query
def pagination_prefix(spark, d):
    li = t.table(spark, d, "lineitem")
    walk = li.groupBy(F.col("l_orderkey").alias("listing"), F.col("l_linenumber").alias("page_no")).agg(
        F.count_if(F.col("l_quantity") > 5).alias("n_products"),
        F.max(F.col("l_returnflag") != "R").alias("has_next"),
    )
    return listing.pagination_prefix(walk, ["listing"], max_pages=6)


@query
def page_urls(spark, d):
    n = F.lit(3)
    return pages(spark, d).select(
        "page_id", F.posexplode(listing.page_urls(F.col("url"), n)).alias("i", "page_url")
    )


@query
def listing_keys(spark, d):
    return pages(spark, d).select("page_id", F.explode(listing.listing_keys(F.col("url"))).alias("k")).select(
        "page_id", "k.listing_url", "k.page_no"
    )


# Scalar rules ---------------------------------------------------------------------------


@query
def normalize_text(spark, d):
    p = pages(spark, d).select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("raw"))
    doc = documents(spark, d).select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("raw"))
    return p.unionByName(doc).select("kind", "id", text.normalize_text(F.col("raw")).alias("clean"))


@query
def normalize_slug(spark, d):
    return documents(spark, d).select("doc_id", text.normalize_slug(F.col("text")).alias("slug"))


@query
def generate_slug(spark, d):
    c = t.table(spark, d, "conversations")
    return c.select("conv_id", "turn", text.generate_slug(F.col("text")).alias("slug"))


@query
def normalize_url(spark, d):
    return address_forms(spark, d).select("page_id", "form", fields.normalize_url(F.col("c")).alias("out"))


@query
def valid_url(spark, d):
    return address_forms(spark, d).select("page_id", "form", fields.is_valid_url(F.col("c")).alias("is_valid"))


@query
def slug_from_url(spark, d):
    return address_forms(spark, d).select("page_id", "form", fields.slug_from_url(F.col("c")).alias("slug"))


@query
def absolute_url(spark, d):
    base = fields.url_origin(F.col("url"))
    return address_forms(spark, d).select(
        "page_id", "form", fields.absolute_url(base, F.col("c")).alias("out")
    )


@query
def relative_links(spark, d):
    """Links of many shapes, resolved against the page they might stand on."""
    last = F.regexp_extract("url", "([^/]*)/*$", 1)
    forms = F.array(*[F.concat(F.lit(a), last, F.lit(b)) for a, b in (
        ("", ""), ("./", "/.."), ("../", "?a=../b"), ("../../../../", "/."), ("a/./b/../", "/../x/"), ("/x/../", "/./y#/../z"),
        ("a//", "//../c"), ("..", ""), ("/../", "/"))])
    return pages(spark, d).select("page_id", "url", F.posexplode(forms).alias("form", "c")).select(
        "page_id", "form", fields.join_url(F.col("url"), F.col("c")).alias("out"))


def lines(spark, d, *cols) -> DataFrame:
    return t.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *cols
    )


@query
def normalize_price(spark, d):
    shown = F.concat(F.format_number("l_extendedprice", 2), F.lit("đ"))
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    return lines(
        spark, d, numbers.normalize_price(shown).alias("from_text"),
        numbers.normalize_price(signed, text=False).alias("from_number"),
    )


@query
def parse_price_text(spark, d):
    whole = F.format_number(F.floor("o_totalprice"), 0)
    shown = F.concat(F.translate(whole, ",", "."), F.lit(" VND"))
    return t.table(spark, d, "orders").select(
        "o_orderkey", numbers.parse_price_text(shown).alias("plain"),
        numbers.parse_price_text(shown, "vi").alias("vi"),
    )


@query
def normalize_percentage(spark, d):
    shown = F.concat(F.lit(" "), F.col("l_quantity") * 3, F.lit(" %"))
    return lines(
        spark, d, numbers.normalize_percentage(shown).alias("from_text"),
        numbers.normalize_percentage(F.col("l_discount") * 100, text=False).alias("from_number"),
    )


@query
def normalize_rating(spark, d):
    e = t.table(spark, d, "events")
    return e.select(
        "event_id", numbers.normalize_rating(F.col("value").cast("string")).alias("from_text"),
        numbers.normalize_rating(F.col("value") - 3, text=False).alias("from_number"),
    )


@query
def normalize_integer(spark, d):
    e = t.table(spark, d, "events")
    return e.select(
        "event_id", numbers.normalize_integer(F.format_number(F.col("value") * 1000, 2)).alias("from_text"),
        numbers.normalize_integer(F.col("value") - 10, text=False).alias("from_number"),
        numbers.normalize_integer(F.col("props")).alias("from_junk"),
    )


@query
def normalize_boolean(spark, d):
    lab = t.table(spark, d, "labels")
    return lab.select(
        "doc_id", fields.normalize_boolean(F.col("quality").cast("string")).alias("from_text"),
        fields.normalize_boolean(F.col("toxic"), "number").alias("from_number"),
        fields.normalize_boolean(F.when(F.col("quality") == 1, "ACTIVE").otherwise(" yes")).alias("from_word"),
        fields.normalize_boolean(F.col("toxic") == 1, "bool").alias("from_bool"),
    )


@query
def normalize_sku(spark, d):
    raw = F.concat(F.lit(" "), F.col("p_name"), F.lit("/"), F.col("p_brand"), F.lit("_"), F.col("p_partkey"))
    return t.table(spark, d, "part").select("p_partkey", fields.normalize_sku(raw).alias("sku"))


def stock_text() -> Column:
    flags = F.concat("l_returnflag", "l_linestatus")
    return (
        F.when(flags == "RO", " Còn hàng ").when(flags == "AO", "currently unavailable")
        .when(flags == "NF", "Hết hàng rồi").when(flags == "AF", "LimitedAvailability")
        .when(flags == "NO", "PreOrder").otherwise("")
    )


@query
def normalize_availability(spark, d):
    return lines(spark, d, fields.normalize_availability(stock_text()).alias("stock"))


def image_text() -> Column:
    typ, key = F.col("p_type"), F.col("p_partkey").cast("string")
    return (
        F.when(typ == "SMALL", F.concat(F.lit('["/i/'), key, F.lit('.jpg", "", null, "i/'), key, F.lit('"]')))
        .when(typ == "LARGE", F.concat(F.lit("http://img.example/"), key))
        .when(typ == "MEDIUM", F.concat(F.lit('{"a": '), key, F.lit("}")))
        .when(typ == "PROMO", F.concat(F.lit(' ["broken'), key))
        .when(typ == "ECONOMY", F.lit("[]")).otherwise(F.lit(""))
    )


@query
def normalize_images(spark, d):
    out = fields.normalize_images(image_text())
    return t.table(spark, d, "part").select("p_partkey", F.size(out).alias("n"), joined(out).alias("images"))


@query
def first_number(spark, d):
    return documents(spark, d).select("doc_id", numbers.first_number(F.col("text")).alias("n"))


@query
def first_int(spark, d):
    e = t.table(spark, d, "events")
    shown = F.format_number(F.col("value") * 1000, 0)
    return e.select("event_id", numbers.first_int(F.col("props")).alias("k"), numbers.first_int(shown).alias("v"))


@query
def badge_flags(spark, d):
    label = fields.badge_label(F.col("text"))
    flags = listing.flag_columns(F.array(label))
    # A text without any badge word has no flag set.
    named = [F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()]
    return documents(spark, d).select("doc_id", label.alias("label"), *named)


@query
def discount_pct(spark, d):
    price, original = F.floor("l_extendedprice"), F.floor(F.col("l_extendedprice") * 1.25)
    return lines(spark, d, numbers.discount_pct(price, original).alias("pct"))


@query
def sql_escape(spark, d):
    return documents(spark, d).select("doc_id", fields.sql_escape(F.col("text")).alias("literal"))


# Records --------------------------------------------------------------------------------


def raw_feed(spark, d) -> DataFrame:
    """The feed as text, as a scraper would hand it over."""
    li, p = spread(t.table(spark, d, "lineitem")), t.table(spark, d, "part")
    rows = li.join(p, li.l_partkey == p.p_partkey)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows.select(
        key.alias("pos"),
        F.when(F.col("l_quantity") == 1, " ").otherwise(
            F.concat(F.lit(" <b>"), F.col("p_name"), F.lit("</b> &amp;\n Co"))).alias("name"),
        F.concat(F.lit("/"), F.col("p_name"), F.lit(" "), F.col("l_partkey")).alias("slug"),
        F.when(F.col("l_tax") == 0, F.concat(F.lit("http:///"), F.col("l_partkey"))).when(
            F.col("l_tax") == 0.01, "").otherwise(F.concat(F.lit("o/"), F.col("l_partkey"))).alias("url"),
        F.concat(F.format_number("l_extendedprice", 2), F.lit("đ")).alias("price"),
        F.concat(F.col("l_discount") * 1000, F.lit("%")).alias("discount_percentage"),
        (F.col("l_tax") * 100).cast("string").alias("rating"),
        F.col("l_quantity").cast("string").alias("review_count"),
        stock_text().alias("availability"),
        F.col("p_brand").alias("brand_name"),
        F.when(F.col("l_returnflag") == "A", "yes").otherwise("no").alias("is_sale"),
    )


@query
def normalize_products(spark, d):
    out = normalize.normalize_products(raw_feed(spark, d), "pos")
    return out.select(
        "pos", "name", "slug", "url", "price", "original_price", "discount_percentage", "rating",
        "review_count", "availability", "brand_name", "description", "is_sale", "is_new",
        F.size("images").alias("n_images"),
    )


@query
def normalize_categories(spark, d):
    raw = t.table(spark, d, "customer").join(
        t.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        "c_custkey", F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.col("c_name").alias("slug"), F.concat(F.lit("c/"), F.col("c_custkey")).alias("url"),
        F.col("n_name").alias("parent_slug"),
    )
    return normalize.normalize_categories(raw, "c_custkey")


@query
def validate_products(spark, d):
    out = quality.validate(normalize.normalize_products(raw_feed(spark, d), "pos"))
    return out.select(
        "pos", F.col("validation.is_valid").alias("is_valid"),
        joined(F.col("validation.errors")).alias("errors"),
        joined(F.col("validation.warnings")).alias("warnings"),
    )


@query
def quarantine_split(spark, d):
    # Which half a row goes to is a column of one pass.
    checked = quality.validate(normalize.normalize_products(raw_feed(spark, d), "pos"))
    return checked.select("pos", F.array_join("validation.errors", "; ").alias("reason"))


@query
def fk_audit(spark, d):
    rows = t.products(spark, d).select("slug", "category_slug", "brand_slug")
    cats, orders = t.categories(spark, d), t.table(spark, d, "orders")
    lost = quality.missing_references(rows, "category_slug", cats.where("parent_slug LIKE 'nation%'"), "slug")
    # Orders are stored references of line items as well.
    busy = orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    gone = quality.missing_references(
        t.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", busy, "l_orderkey"
    )
    counts = gone.groupBy("l_orderkey").agg(F.count("*").alias("n_rows"))
    return lost.select("slug", F.col("category_slug").alias("target"), F.lit(1).cast("bigint").alias("n_rows")).unionByName(
        counts.select(F.col("l_orderkey").cast("string").alias("slug"), F.lit("order").alias("target"), "n_rows")
    )


@query
def unique_audit(spark, d):
    return quality.repeated_keys(t.offers(spark, d), "slug")


@query
def unique_url_audit(spark, d):
    return quality.repeated_keys(t.offers(spark, d), "url")


@query
def range_audit(spark, d):
    li = t.table(spark, d, "lineitem")
    rows = li.select(
        (F.col("l_extendedprice") - 20000).alias("price"), F.col("l_extendedprice").alias("original_price"),
        (F.col("l_tax") * 100).alias("rating"), (F.col("l_quantity") * 3).alias("discount_percentage"),
        (F.col("l_quantity") - 5).cast("bigint").alias("review_count"),
    )
    return quality.range_audit(rows)


@query
def length_audit(spark, d):
    rows = documents(spark, d).select(F.col("text").alias("name"), F.col("source").alias("slug"), F.col("text").alias("url"))
    return quality.length_audit(rows, {"name": 500, "slug": 3, "url": 2000})


# Merges ---------------------------------------------------------------------------------


def feed_categories(spark, d) -> DataFrame:
    """A category feed: every customer's segment names its category again, later names win."""
    c, n = t.table(spark, d, "customer"), t.table(spark, d, "nation")
    both = c.join(n, c.c_nationkey == n.n_nationkey)
    # Segments of nations that open with a parent which only turns up later get none.
    return both.select(
        F.col("c_custkey").alias("pos"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(
            F.concat_ws(" / ", "n_name", "c_mktsegment")).alias("name"),
        F.concat_ws("-", F.lower("c_mktsegment"), F.lower("n_name")).alias("slug"),
        F.concat(F.lit("/cat/"), F.col("c_custkey")).alias("url"),
        F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("Customer "), F.col("c_custkey"))).otherwise("").alias("description"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lower("n_name")).otherwise(
            F.concat(F.lit("building-"), F.lower("n_name"))).alias("parent_slug"),
    )


@query
def merge_categories(spark, d):
    current = t.categories(spark, d)
    out = merge.merge_dimension(current, feed_categories(spark, d), t.ts(t.NOW))
    return out.rows.select(
        "slug", "name", "url", "parent_slug", "description", "created_at", "updated_at", "change"
    )


@query
def merge_brands(spark, d):
    current = t.brands(spark, d)
    li, p = t.table(spark, d, "lineitem"), t.table(spark, d, "part")
    feed = li.join(p, li.l_partkey == p.p_partkey).select(
        F.concat_ws("-", F.lpad("l_orderkey", 12, "0"), F.lpad("l_linenumber", 3, "0"),
                    F.lpad("l_partkey", 12, "0"), F.lpad("l_suppkey", 12, "0")).alias("pos"),
        F.when(F.col("l_tax") == 0, "").otherwise(F.concat_ws(" ", "p_brand", "l_returnflag")).alias("name"),
        F.when(F.col("p_size") > 40, F.concat(text.normalize_slug(F.col("p_brand")), F.lit("-xl"))).otherwise(
            text.normalize_slug(F.col("p_brand"))).alias("slug"),
        F.when(F.col("l_quantity") > 25, F.concat(F.lit("/b/"), F.col("l_orderkey"))).otherwise("").alias("url"),
        F.lit("").alias("description"),
    )
    out = merge.merge_dimension(current, feed, t.ts(t.NOW))
    return out.rows.select("slug", "name", "url", "created_at", "updated_at", "change")


def offer_merge(spark, d) -> merge.ProductMerge:
    return merge.merge_products(
        t.stored_offers(spark, d, laid=True), t.categories(spark, d), t.brands(spark, d),
        t.change_batch(spark, d), t.ts(t.NOW),
    )


def flat_products(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "slug", "name", "url", "description", "price", "original_price", "discount_percentage",
        "sku", "availability", "rating", "review_count", "image_url",
        joined(F.col("images")).alias("images"), "category_slug", "brand_slug", "is_bestseller",
        "is_new", "is_sale", "created_at", "updated_at", *more,
    )


@query
def merge_products(spark, d):
    return flat_products(offer_merge(spark, d).products.rows, "change")


@query
def merge_rejects(spark, d):
    return offer_merge(spark, d).rejects.select("pos", "slug", "reason")


@query
def bulk_merge_stats(spark, d):
    return offer_merge(spark, d).stats()


@query
def resolve_categories(spark, d):
    return offer_merge(spark, d).categories.rows.select("slug", "name", "parent_slug", "change")


@query
def resolve_brands(spark, d):
    return offer_merge(spark, d).brands.rows.select("slug", "name", "updated_at", "change")


@query
def merge_idempotent(spark, d):
    """The accepted rows once more: nothing is created, and no value changes but the time."""
    once = offer_merge(spark, d)
    batch = once.batch
    # A place of a row with a category is never that of a rejected one, so only the others are looked up.
    blank = text.blank_to_null(F.col("category_name")).isNull()
    refused = stage(once.rejects.select("pos"))
    good = batch.where(~blank).unionByName(lookup.missing(batch.where(blank), refused, "pos"))
    stored = lay_out(once.products.table, "slug").rows
    twice = merge.merge_products(stored, once.categories.table, once.brands.table, good, t.ts(t.NOW))
    return flat_products(twice.products.rows, "change")


@query
def process_batch(spark, d):
    current = Snapshot(t.categories(spark, d), t.brands(spark, d), t.products(spark, d))
    raw = raw_feed(spark, d).withColumn("category_name", F.lit("Feed")).withColumn(
        "pos", F.col("pos"))
    out, _ = refresh.process_batch(current, current.categories, raw, t.ts(t.NOW))
    return out.products.rows.where("change <> 'untouched'").select(
        "slug", "name", "url", "price", "category_slug", "brand_slug", "change"
    )


# Hierarchy and joins --------------------------------------------------------------------


@query
def products_enriched(spark, d):
    out = lookup.enrich(t.products(spark, d), t.categories(spark, d), t.brands(spark, d))
    return out.select("slug", "category_slug", "category_name", "brand_slug", "brand_name")


@query
def brands_of_category(spark, d):
    mine = t.products(spark, d).where("category_slug = 'nation_3'")
    return lookup.brands_of(mine, t.brands(spark, d)).select("slug", "name")


@query
def subtree_products(spark, d):
    out = hierarchy.subtree_products(t.categories(spark, d), t.products(spark, d))
    return out.select("root", "slug", "category_slug")


@query
def direct_products(spark, d):
    return hierarchy.direct_counts(t.categories(spark, d), t.products(spark, d))


@query
def ancestor_chain(spark, d):
    return hierarchy.ancestors(t.categories(spark, d))


@query
def rollup_by_root(spark, d):
    return hierarchy.rollup(t.categories(spark, d), t.products(spark, d))


@query
def top_n_per_category(spark, d):
    rows = t.products(spark, d).select("category_slug", "slug", "price")
    return discover.keep_top(rows, "category_slug", ["price", "slug"], 3)


# Figures and the run log ----------------------------------------------------------------


@query
def catalog_stats(spark, d):
    runs = runlog.state(t.runs(spark, d))
    return stats.catalog_stats(t.categories(spark, d), t.brands(spark, d), t.products(spark, d), runs)


@query
def run_stats(spark, d):
    return runlog.totals(t.runs(spark, d))


@query
def run_log_latest(spark, d):
    return runlog.state(t.runs(spark, d))


@query
def retention_keep(spark, d):
    events = t.runs(spark, d)
    # Each user's day of activity is a run of its own.
    daily = events.withColumn("run_id", F.concat_ws("@", "run_id", F.date_format("at", "yyyy-MM-dd")))
    return runlog.retain(daily, RUNS_NOW, days=10).select("run_id", "at", "status")


# Export ---------------------------------------------------------------------------------


@query
def export_all_manifest(spark, d):
    return export.export_manifest(t.categories(spark, d), t.products(spark, d))


@query
def export_totals(spark, d):
    return export.export_totals(t.categories(spark, d), t.products(spark, d))


@query
def insert_lines(spark, d):
    part_id = F.regexp_extract("slug", "-([0-9]+)$", 1)
    ids = {"id": part_id, "category_id": fields.sql_escape(F.col("category_slug")),
           "brand_id": fields.sql_escape(F.col("brand_slug"))}
    return export.insert_lines(t.products(spark, d), "products", "slug", ids=ids)


def dumps(spark, d, **options) -> DataFrame:
    return export.dump_lines(
        t.categories(spark, d), t.brands(spark, d), t.products(spark, d), t.ts(t.NOW), **options
    )


@query
def dump_lines(spark, d):
    """Lines per section of every dump; the fixed ones in full."""
    rows = dumps(spark, d)
    shown = F.when(F.col("section").isin(export.HEADER, export.TRAILER), F.col("line")).otherwise("")
    return rows.groupBy("output", "section", shown.alias("line")).agg(F.count("*").alias("n_lines"))


@query
def export_category(spark, d):
    """Subtree dumps of every root: which rows they hold."""
    cats = t.categories(spark, d)
    rows = dumps(spark, d, subtree=True, outputs=hierarchy.roots(cats).select("slug"))
    return rows.where(F.col("slug") != "").select("output", "section", "slug")


@query
def export_summary(spark, d):
    cats, prods = t.categories(spark, d), t.products(spark, d)
    figures = stats.catalog_stats(cats, t.brands(spark, d), prods, runlog.state(t.runs(spark, d)))
    return export.export_summary(figures, export.export_manifest(cats, prods))


@query
def export_reconcile(spark, d):
    return export.reconcile(dumps(spark, d), t.categories(spark, d), t.products(spark, d))


@query
def export_values(spark, d):
    """The product rows of written dumps, read back from the text of their statements."""
    path = new_folder(spark)
    export.write_dumps(dumps(spark, d), path)
    rows = export.read_rows(spark, path, "products")
    equal = export.reconcile_values(spark, path, t.categories(spark, d), t.products(spark, d))
    return rows.join(equal.select(F.col("slug").alias("output"), "n_source", "n_written", "is_equal"), "output").select(
        "output", "slug", "name", "url", "description", "price", "original_price", "sku", "availability", "rating",
        "review_count", "image_url", joined(F.col("images")).alias("images"), "is_new", "is_sale", "created_at", "updated_at",
        F.col("category_id").isNotNull().alias("has_category"), "n_source", "n_written", "is_equal")


@query
def export_orphans(spark, d):
    """Parts whose category the tree has lost: here all below one nation."""
    cats = t.categories(spark, d).where("slug NOT LIKE 'nation_3-%'")
    return export.export_orphans(cats, t.products(spark, d))


# Whole jobs -----------------------------------------------------------------------------


def nothing(spark) -> Snapshot:
    from ..schemas import TABLES

    return Snapshot(*[spark.createDataFrame([], s) for s in TABLES.values()])


def known_parts(spark, d) -> Snapshot:
    """A catalogue that knows all parts but the promoted ones, under the shop's addresses."""
    prods = t.products(spark, d).where("NOT is_new").withColumn(
        "url", F.concat(F.lit(shop.BASE + "/products/"), F.col("slug"))
    )
    return Snapshot(t.categories(spark, d), t.brands(spark, d), prods)


def landed(spark, d) -> DataFrame:
    """The shop's pages, written out as a crawler would have landed them."""
    return stage(shop.shop_pages(spark, d))


@query
def full_refresh(spark, d):
    out = refresh.full_refresh(landed(spark, d), nothing(spark), shop.RULES, NOW)
    return flat_products(out.snapshot.products)


@query
def full_refresh_stats(spark, d):
    return refresh.full_refresh(landed(spark, d), nothing(spark), shop.RULES, NOW).stats


@query
def listing_refresh(spark, d):
    """Listings only, products named after the listing they came from."""
    out = refresh.full_refresh(
        landed(spark, d), nothing(spark), shop.RULES, NOW, skip_details=True,
        on_missing_category="assign_source",
    )
    return out.snapshot.products.select("slug", "name", "price", "category_slug", "availability")


@query
def incremental_refresh(spark, d):
    at = datetime(2020, 2, 20)
    # Promoted parts have no category on their pages, so new ones are refused; see the stats.
    out = refresh.incremental_refresh(landed(spark, d), known_parts(spark, d), shop.RULES, at, since_days=20)
    return out.merged.products.rows.select(
        "slug", "name", "price", "category_slug", "brand_slug", "updated_at", "change"
    )


@query
def incremental_new_pages(spark, d):
    """The same where all pages landed on one day: products stored after it are not read again."""
    at, day = datetime(2020, 2, 20), t.ts("2020-02-10 00:00:00")
    pages = landed(spark, d).withColumn("landed_at", day)
    out = refresh.incremental_refresh(pages, known_parts(spark, d), shop.RULES, at, since_days=20)
    return out.merged.products.rows.select("slug", "name", "price", "updated_at", "change")


def _land(spark, d, path: str, day: int) -> None:
    """What a crawler lands on each of three days, old versions of pages among it."""
    details, odd = shop.product_pages(spark, d), F.col("page_id") % 2 == 1
    changed = details.withColumn("html", F.replace("html", F.lit("About "), F.lit("Now ")))
    late = changed.withColumn("html", F.replace("html", F.lit("Now "), F.lit("Once ")))
    rows = {
        1: [(shop.home_page(spark, d), 1), (details.where(~odd), 1)],
        2: [(shop.listing_pages(spark, d), 2), (late.where(~odd), 0)],
        3: [(details.where(odd), 3), (changed.where(F.col("page_id") % 4 == 0), 3)],
    }[day]
    for pages, landed_on in rows:
        stamped = pages.withColumn("landed_at", F.lit(datetime(2024, 1, 1 + landed_on)))
        stamped.write.mode("append").parquet(path)


@query
def stream_incremental(spark, d):
    """Three days of landed pages through the stream, and the catalogue after the last."""
    root = new_folder(spark)
    store = ingest.shop_store(spark, f"{root}/store", shop.RULES)
    for day in (1, 2, 3):
        _land(spark, d, f"{root}/land", day)
        ingest.ingest_shop(stream_pages(spark, f"{root}/land", timed=True), store, shop.RULES, "shop", f"{root}/checkpoint",
                           lambda day=day: datetime(2024, 1, 1 + day), listing_pages=None).awaitTermination()
    return store.current().products.select(
        "slug", "name", "price", "description", "category_slug", "brand_slug", "created_at", "updated_at")


@query
def category_refresh(spark, d):
    out = refresh.category_refresh(
        stage(shop.listing_pages(spark, d)), _shop_snapshot(spark, d), shop.RULES, "nation_3", NOW,
        on_missing_category="assign_source",
    )
    return out.merged.products.rows.where("change <> 'untouched'").select(
        "slug", "name", "price", "category_slug", "change"
    )


def _shop_snapshot(spark, d) -> Snapshot:
    known = known_parts(spark, d)
    cats = known.categories.withColumn("url", F.concat(F.lit("/category/"), F.col("slug")))
    return Snapshot(cats, known.brands, known.products)
