"""Whole jobs: full, incremental and single-category refresh of a catalogue from landed pages.

Pages are wide, everything taken from them is narrow. So pages are filtered, parsed and
reduced to rows where they are read, and only those rows are shuffled. Each set of extracted
rows is written once (``stage``) because several results are built from it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.fields import absolute_url
from ..functions.text import normalize_slug
from ..operators import discover, export, lookup, merge, runlog
from ..operators.detail import DetailRules, merge_list_detail, product_detail
from ..operators.discover import MenuRules, scope, with_document
from ..operators.listing import (
    CardRules, LISTING_COLUMNS, has_next_page, listing_keys, listing_products, pagination_prefix,
)
from ..operators.normalize import normalize_categories, normalize_products
from ..operators.quality import split_checked, validate as checked
from ..operators.stats import catalog_stats, side_by_side
from ..session import deal, lay_out, small_side, stage, staging_scope
from ..sources.catalog import CatalogStore, Snapshot
from ..sources.pages import landed_after, latest_versions


@dataclass(frozen=True)
class ShopRules:
    base_url: str
    menu: MenuRules = field(default_factory=MenuRules)
    cards: CardRules = field(default_factory=CardRules)
    detail: DetailRules = field(default_factory=DetailRules)

    @property
    def base(self) -> Column:
        return F.lit(self.base_url.rstrip("/"))


@dataclass(frozen=True)
class Refresh:
    """What a job leads to; nothing is stored until a store commits the snapshot."""

    snapshot: Snapshot
    merged: merge.ProductMerge
    invalid: DataFrame
    stats: DataFrame
    dumps: Callable[[Snapshot], DataFrame] | None = None


def listed_products(pages: DataFrame, targets: DataFrame, rules: ShopRules,
                    max_pages: int | None = None) -> DataFrame:
    """Products of the listings in ``targets(listing_url)``, page by page until a listing ends.

    Only pages of these listings are parsed. A page without products does not show up in the
    rows, which ends a listing just like a missing page.
    """
    keyed = pages.select(
        "page_id", "html", F.explode(listing_keys(F.col("url"))).alias("k")
    ).select("page_id", "html", "k.listing_url", "k.page_no")
    wanted = small_side(targets.select("listing_url").distinct())
    mine = deal(keyed.join(wanted, "listing_url", "left_semi"), "listing_url", "page_no")
    docs = with_document(mine, rules.cards).withColumn("has_next", has_next_page(scope()))
    rows = stage(listing_products(
        docs, rules.base, "page_id", "listing_url", "page_no", "has_next", rules=rules.cards
    ))
    per_page = rows.groupBy("listing_url", "page_no").agg(
        F.count("*").alias("n_products"), F.max("has_next").alias("has_next")
    )
    walked = pagination_prefix(per_page, ["listing_url"], max_pages)
    return rows.drop("has_next").join(
        walked.select("listing_url", "page_no"), ["listing_url", "page_no"], "left_semi"
    )


def detail_rows(pages: DataFrame, rules: ShopRules, wanted: DataFrame | None = None) -> DataFrame:
    """Product rows of product pages; ``wanted(url)`` narrows the pages before they are parsed.

    Where ``wanted`` also has ``since``, only pages that landed after it are. Leave ``wanted`` out where most pages are wanted: then rows, not pages, are joined later.
    """
    if wanted is not None and "since" in wanted.columns:
        pages = landed_after(pages, wanted)
    elif wanted is not None:
        pages = pages.join(small_side(wanted.select("url").distinct()), "url", "left_semi")
    docs = with_document(pages, rules.detail)
    return product_detail(docs, rules.base, "url", rules=rules.detail)


def pages_listed(pages: DataFrame, targets: DataFrame, listed: DataFrame) -> DataFrame:
    """``pages`` without those of the listings in ``targets``, unless ``listed(url)`` has them too.

    The others are only told by their products, and no product is told of a page nobody lists; a
    listing's page has the most elements to read.
    """
    names = small_side(targets.select("listing_url").distinct())
    keys = listing_keys(F.col("url"))
    own, first = names.toDF("_own"), names.toDF("_first")
    rest = pages.withColumn("_first_page", F.get(keys, F.lit(1))["listing_url"]).join(
        own, F.col("url") == F.col("_own"), "left_anti").join(
        first, F.col("_first_page") == F.col("_first"), "left_anti").drop("_first_page")
    walked = pages.select("url", F.explode(keys["listing_url"]).alias("listing_url")).join(
        names, "listing_url", "left_semi").select("url").distinct()
    both = stage(walked.join(listed.select("url"), "url", "left_semi"))
    return rest if both.isEmpty() else rest.unionByName(pages.join(small_side(both), "url", "left_semi"))


def current_pages(pages: DataFrame) -> DataFrame:
    """One page per address. Where none landed twice, the pages as they are: nothing is shuffled."""
    repeated = pages.groupBy("url").count().where("count > 1")
    return pages if repeated.isEmpty() else stage(latest_versions(pages))


def process_batch(current: Snapshot, categories: DataFrame, raw: DataFrame, now: Column,
                  on_missing_category: str = "reject", locale: str = "plain",
                  validate: bool = True, part: Callable[[DataFrame], DataFrame] | None = None,
                  ) -> tuple[merge.ProductMerge, DataFrame]:
    """Normalize, validate and merge raw rows with columns ``pos`` and, optionally, ``source``.

    A row is a stored product's if it has its slug or else its address, in batch order; rows
    that fail there are handed back with the rejected ones.

    ``assign_source`` names a row without a category after the listing it came from. ``part``
    gives the stored products to merge with, once the slugs of the batch are known: those with
    these slugs, at least. Without it all of ``current.products`` are read and merged.
    """
    if on_missing_category not in ("reject", "assign_source"):
        raise ValueError(f"unknown policy: {on_missing_category}")
    keep = ["pos", *(["source"] if "source" in raw.columns else [])]
    rows = normalize_products(raw, *keep, locale=locale)
    verdict = F.col("validation").dropFields("warnings")
    good, bad = split_checked(stage(checked(rows).withColumn("validation", verdict))) if validate else (stage(rows), None)
    bad = bad if bad is None or "source" not in keep else bad.drop("source")
    if on_missing_category == "assign_source":
        good = merge.assign_source_category(good, "source")
    if "source" in keep:
        good = good.drop("source")
    good, unclear = merge.resolve_identity(current.products, good)
    bad = bad.unionByName(unclear.select(*bad.columns)) if validate else unclear
    laid = lay_out(good, "slug")
    products = current.products if part is None else part(laid.plain.select("slug"))
    return merge.merge_products(products, categories, current.brands, laid, now), bad


def _numbers(df: DataFrame, **counts: Column) -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in counts.items()])


def _result(merged: merge.ProductMerge, invalid: DataFrame, *figures: DataFrame,
            dumps: Callable[[Snapshot], DataFrame] | None = None) -> Refresh:
    table = Snapshot(merged.categories.table, merged.brands.table, merged.products.table)
    batch = merged.stats().select(
        (F.col("total") - F.col("errors")).alias("products_processed"),
        F.col("created").alias("products_created"),
        F.col("updated").alias("products_updated"),
        "errors",
    )
    return Refresh(table, merged, invalid, side_by_side(*figures, batch), dumps)


def full_refresh(pages: DataFrame, current: Snapshot, rules: ShopRules, now: datetime,
                 max_categories: int | None = None, max_products_per_category: int | None = None,
                 skip_details: bool = False, on_missing_category: str = "reject") -> Refresh:
    """Discover categories, walk their listings, read product pages, merge, lay out dumps."""
    at = F.lit(now)
    pages = current_pages(pages)
    found = stage(discover.discover(pages, rules.base_url, rules.menu))
    batch = normalize_categories(found, F.col("at").alias("pos"))
    cats = merge.merge_dimension(current.categories, batch, at)
    visited = discover.limit_categories(found, max_categories, "at")
    targets = visited.select(
        F.col("full_url").alias("listing_url"), F.col("name").alias("source"), "at"
    )
    listed = listed_products(pages, targets, rules).join(targets, "listing_url")
    listed = listed.withColumn("pos", F.struct("at", "page_no", "pos"))
    if max_products_per_category:
        listed = discover.keep_top(listed, "at", ["pos"], max_products_per_category)
    listed = listed.select("pos", "source", *LISTING_COLUMNS)
    raw = listed if skip_details else merge_list_detail(
        listed, detail_rows(deal(pages_listed(pages, targets, listed), "url"), rules))
    merged, invalid = process_batch(
        current, cats.table, raw, at, on_missing_category, rules.cards.locale
    )
    figures = (
        _numbers(found, categories_found=F.count("*")),
        _numbers(visited, categories_processed=F.count("*")),
        _numbers(listed, products_found=F.count("*")),
    )
    def dumps(stored: Snapshot) -> DataFrame:
        return export.dump_lines(stored.categories, stored.brands, stored.products, at)

    return _result(merged, invalid, *figures, dumps=dumps)


def incremental_refresh(pages: DataFrame, current: Snapshot, rules: ShopRules, now: datetime,
                        since_days: int = 1) -> Refresh:
    """Re-read recently changed products, then take unknown ones from first listing pages.

    Of the changed ones only pages that landed after the product was stored are parsed, where
    the pages tell when they landed.
    """
    at = F.lit(now)
    pages = current_pages(pages)
    recent = lookup.modified_since(current.products, F.lit(now - timedelta(days=since_days)))
    addresses = recent.select(absolute_url(rules.base, F.col("url")).alias("url"), F.col("updated_at").alias("since"))
    reread = detail_rows(pages, rules, addresses).withColumn(
        "pos", F.struct(F.lit(0).alias("phase"), F.col("url").alias("key"))
    )
    found = stage(discover.discover(pages, rules.base_url, rules.menu))
    cats = merge.merge_dimension(
        current.categories, normalize_categories(found, F.col("at").alias("pos")), at
    )
    targets = found.select(F.col("full_url").alias("listing_url"), "at")
    listed = listed_products(pages, targets, rules, max_pages=1).join(targets, "listing_url")
    keyed = listed.select("url", normalize_slug(F.col("slug")).alias("slug"), "at", "pos")
    unknown = stage(lookup.missing(keyed, current.products).select("url", "at", "pos"))
    fresh = detail_rows(pages, rules, unknown)
    first = discover.dedupe_first(
        unknown.join(fresh, "url").withColumn("key", normalize_slug(F.col("slug"))), "key", "at", "pos"
    )
    new = first.drop("key", "at", "pos").withColumn(
        "pos", F.struct(F.lit(1).alias("phase"), F.col("url").alias("key"))
    )
    merged, invalid = process_batch(
        current, cats.table, reread.unionByName(new), at, locale=rules.cards.locale, validate=False
    )
    figures = (_numbers(found, categories_found=F.count("*")),
               _numbers(recent, products_checked=F.count("*")))
    return _result(merged, invalid, *figures)


def category_refresh(pages: DataFrame, current: Snapshot, rules: ShopRules, slug: str,
                     now: datetime, max_products: int | None = None,
                     on_missing_category: str = "reject") -> Refresh:
    """Walk one stored category's listing, without product pages; dump its whole subtree."""
    at = F.lit(now)
    pages = current_pages(pages)
    mine = current.categories.where(F.col("slug") == slug)
    targets = mine.select(
        absolute_url(rules.base, F.col("url")).alias("listing_url"), F.col("name").alias("source")
    )
    listed = listed_products(pages, targets, rules).join(targets, "listing_url")
    listed = listed.withColumn("pos", F.struct("page_no", "pos"))
    if max_products:
        listed = listed.orderBy("pos").limit(max_products)
    listed = listed.select("pos", "source", *LISTING_COLUMNS)
    merged, invalid = process_batch(
        current, current.categories, listed, at, on_missing_category, rules.cards.locale
    )
    def dumps(stored: Snapshot) -> DataFrame:
        return export.dump_lines(
            stored.categories, stored.brands, stored.products, at, subtree=True,
            outputs=mine.select("slug"),
        )

    return _result(merged, invalid, _numbers(listed, products_found=F.count("*")), dumps=dumps)


def export_all_data(spark: SparkSession, snapshot: Snapshot, runs: DataFrame, path: str,
                    exported_at: datetime) -> DataFrame:
    """Write schema text, all dumps, their summary and what no dump holds below ``path``.

    Returns the reconciliation of the files written with the tables they came from.
    """
    cats, brands, prods = snapshot.categories, snapshot.brands, snapshot.products
    schema = export.schema_lines(spark).coalesce(1).sortWithinPartitions("seq")
    schema.select("line").write.mode("overwrite").text(f"{path}/schema")
    export.write_dumps(export.dump_lines(cats, brands, prods, F.lit(exported_at)), f"{path}/dumps")
    figures = catalog_stats(cats, brands, prods, runlog.state(runs))
    summary = export.export_summary(figures, export.export_manifest(cats, prods))
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    export.export_orphans(cats, prods).write.mode("overwrite").parquet(f"{path}/orphans")
    return export.reconcile(export.read_dumps(spark, f"{path}/dumps"), cats, prods)


def commit_refresh(store: CatalogStore, run_id: str, now: datetime, job, **options) -> Snapshot:
    """Run a job against the store's current snapshot and commit it under ``run_id``.

    ``job`` is one of the functions above with pages and rules bound. The run log gets a
    start and an end event; a job that fails is logged and the error goes on. Dumps are written
    from the stored tables, and only then does the version become current. A run that is
    already committed is left alone.
    """
    spark = store.spark
    if store.has_version(run_id):
        return store.snapshot(run_id)
    store.append_run(runlog.event(spark, run_id, now, runlog.RUNNING))
    try:
        with staging_scope():
            result = job(store.current(), now, **options)
            stored = store.write(run_id, result.snapshot)
            figures = result.stats.first().asDict()
            if result.dumps is not None:
                export.write_dumps(result.dumps(stored), f"{store.root}/exports/version={run_id}")
            store.publish(run_id)
    except Exception as e:
        failed = runlog.event(spark, run_id, datetime.now(timezone.utc), runlog.FAILED, errors=str(e))
        store.append_run(failed)
        raise
    store.append_run(runlog.event(spark, run_id, datetime.now(timezone.utc), runlog.COMPLETED, figures))
    return stored
