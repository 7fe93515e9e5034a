"""Category discovery: links of parsed pages to category rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.fields import contains_any, join_url
from ..functions.html import parse_pages
from ..functions.selectors import Scope, Sel, attr, attribute, cls, tag, tags_of
from ..functions.text import generate_slug
from ..session import small_side, stage

# Where menus are looked for, where sub-menus are looked for, path parts
# of category links, and parts of links that are none.
NAV_SELECTORS = (
    tag("nav") / cls("menu") / tag("a"),
    cls("main-menu") / tag("a"),
    cls("navigation") / tag("a"),
    cls("navbar") / tag("a"),
    cls("category-menu") / tag("a"),
    tag("header") / tag("nav") / tag("a"),
    cls("header-menu") / tag("a"),
)
SUBCATEGORY_SELECTORS = (
    cls("subcategory-menu") / tag("a"),
    cls("sub-categories") / tag("a"),
    cls("category-sidebar") / tag("a"),
    cls("filter-categories") / tag("a"),
    cls("sub-nav") / tag("a"),
)
CATEGORY_PATHS = ("/danh-muc/", "/category/", "/categories/", "/c/", "/san-pham/", "/products/")
SKIP_PARTS = (
    "javascript:", "mailto:", "tel:", "#", "/search", "/contact", "/about", "/blog", "/news",
)
MAX_NAME_LENGTH = 200


@dataclass(frozen=True)
class MenuRules:
    nav: Sequence[Sel] = NAV_SELECTORS
    sub: Sequence[Sel] = SUBCATEGORY_SELECTORS
    paths: tuple[str, ...] = CATEGORY_PATHS


def with_document(pages: DataFrame, *rules: object) -> DataFrame:
    """Replace ``html`` by the parsed ``doc``. Filter pages before calling this.

    Pass the rules that will search it, so that the elements they name are listed.
    """
    return parse_pages(pages, tags_of(rules))


def scope(doc: str = "doc") -> Scope:
    return Scope(f"{doc}.nodes", f"{doc}.text")


def is_category_link(href: Column, text: Column) -> Column:
    return (
        (href != "")
        & (text != "")
        & (F.length(text) <= MAX_NAME_LENGTH)
        & ~contains_any(F.lower(href), SKIP_PARTS)
    )


def links(where: Scope, found: Column) -> Column:
    """Link elements to ``array<struct<href, text>>``."""
    return F.transform(
        found,
        lambda a: F.struct(
            F.coalesce(attribute(a, "href"), F.lit("")).alias("href"),
            where.text_of(a).alias("text"),
        ),
    )


def category_links(found: Column) -> Column:
    return F.filter(found, lambda x: is_category_link(x["href"], x["text"]))


def menu_links(where: Scope, rules: MenuRules = MenuRules()) -> Column:
    """Category links of the page's menu, or else links with a category path."""
    menu = category_links(links(where, where.all_by_rank(rules.nav)))
    return F.when(F.size(F.coalesce(menu, F.array())) > 0, menu).otherwise(
        path_links(where, rules)
    )


def path_links(where: Scope, rules: MenuRules = MenuRules()) -> Column:
    listed = links(where, where.all((attr("href", on="a"),)))
    return F.filter(category_links(listed), lambda x: contains_any(x["href"], rules.paths))


def explode_links(docs: DataFrame, found: Column, *keep: str) -> DataFrame:
    return docs.select(*keep, F.posexplode(found).alias("pos", "link")).select(
        *keep, "pos", F.col("link.href").alias("href"), F.col("link.text").alias("text")
    )


def to_categories(link_rows: DataFrame, base: Column, *keep: str) -> DataFrame:
    return link_rows.select(
        *keep,
        "pos",
        F.col("text").alias("name"),
        generate_slug(F.col("text")).alias("slug"),
        F.col("href").alias("url"),
        join_url(base, F.col("href")).alias("full_url"),
    )


def dedupe_first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Keep each key's first row.

    A minimum over (order, row) combines on the map side, so a key that holds a large
    share of the rows costs one partial row per task, where a window would gather them all.
    """
    rest = [c for c in rows.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return rows.groupBy(key).agg(first).select(key, "first.*").select(*rows.columns)


def main_categories(docs: DataFrame, base: Column, rules: MenuRules = MenuRules()) -> DataFrame:
    """Categories of the menu pages in ``docs(page_id, url, doc)``, first of each slug."""
    rows = explode_links(docs, menu_links(scope(), rules), "page_id", "url")
    found = to_categories(rows.withColumnRenamed("url", "page_url"), base, "page_id")
    return dedupe_first(found, "slug", "page_id", "pos")


def subcategories(docs: DataFrame, parents: DataFrame, base: Column,
                  rules: MenuRules = MenuRules()) -> DataFrame:
    """Categories in the side menus of the parents' own pages, with ``parent_slug``."""
    own = docs.join(
        parents.select(
            F.col("full_url").alias("url"),
            F.col("slug").alias("parent_slug"),
            F.struct("page_id", "pos").alias("parent_at"),
        ),
        "url",
    )
    where = scope()
    listed = links(where, where.all_by_rank(rules.sub))
    rows = explode_links(own, category_links(listed), "page_id", "parent_slug", "parent_at")
    return to_categories(rows, base, "page_id", "parent_slug", "parent_at")


def discover(pages: DataFrame, base_url: str, rules: MenuRules = MenuRules()) -> DataFrame:
    """All categories of a shop in discovery order ``at``: the menu first, then side menus."""
    base = F.lit(base_url.rstrip("/"))
    home = pages.where(F.col("url").isin(base_url.rstrip("/"), base_url.rstrip("/") + "/"))
    main = stage(main_categories(with_document(home, rules), base, rules))
    addresses = small_side(main.select(F.col("full_url").alias("url")).distinct())
    own = pages.join(addresses, "url", "left_semi")
    sub = subcategories(with_document(own, rules), main, base, rules)
    here = F.struct("page_id", "pos")
    none = F.struct(F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("int").alias("pos"))
    return main.select(
        "name", "slug", "url", "full_url", F.lit("").alias("parent_slug"),
        F.struct(F.lit(0).alias("level"), here.alias("first"), none.alias("second")).alias("at"),
    ).unionByName(
        sub.select(
            "name", "slug", "url", "full_url", "parent_slug",
            F.struct(
                F.lit(1).alias("level"), F.col("parent_at").alias("first"), here.alias("second")
            ).alias("at"),
        )
    )


def limit_categories(categories: DataFrame, n: int | None, *order: str) -> DataFrame:
    return categories.orderBy(*order).limit(n) if n else categories


def keep_top(rows: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows per key. The rank filter becomes a window group limit before the shuffle."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")
