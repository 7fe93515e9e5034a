"""Bulk merges that give the state a row-by-row upsert in batch order would give.

A batch is collapsed to one row per slug first: per column the latest value that the null
policy accepts. That is an aggregate with map-side combining, so a slug that holds a large
share of the batch costs one partial row per task. The collapsed batch then meets the
current table in one equi-join on a key that is unique on both sides.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import join_unique
from ..functions.text import blank_to_null, normalize_slug
from ..schemas import BRAND, CATEGORY, PRODUCT, PRODUCT_DEFAULTS, SPARSE_PRODUCT_COLUMNS
from ..session import Laid, lay_out, small_side, stage
from .identity import resolve_identity, url_owners
from .stats import side_by_side

REFERENCES = ("category_name", "brand_name")
CREATED, UPDATED, UNTOUCHED = "created", "updated", "untouched"


@dataclass(frozen=True)
class Merged:
    """A merged table. ``rows`` has the table's columns plus ``change``."""

    rows: DataFrame

    @property
    def table(self) -> DataFrame:
        return self.rows.drop("change")

    def changes(self) -> DataFrame:
        return self.rows.groupBy("change").agg(F.count("*").alias("n_rows"))


def _latest(order: Column, name: str, keep: Column) -> Column:
    return F.max(F.when(keep, F.struct(order.alias("o"), F.col(name).alias("v"))))


# Categories and brands ------------------------------------------------------------------


def _collapse_truthy(batch: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    o = F.col(order)
    aggs = [
        _latest(o, c, blank_to_null(F.col(c)).isNotNull()).getField("v").alias(c) for c in columns
    ]
    return batch.groupBy("slug").agg(
        *aggs,
        F.min(F.struct(o.alias("o"), *([F.col("parent_slug").alias("p")]
                                       if "parent_slug" in batch.columns else []))).alias("first"),
    )


def merge_dimension(current: DataFrame, batch: DataFrame, now: Column, order: str = "pos") -> Merged:
    """Merge categories or brands by slug; empty values never replace anything.

    A parent is set when a category is created, and only if it is known by then: it is in
    the current table, or it came earlier in the batch.
    """
    has_parent = "parent_slug" in current.columns
    values = ["name", "url", "description"]
    new = _collapse_truthy(batch, order, values)
    if has_parent:
        firsts = new.select(
            F.col("slug").alias("p_slug"), F.col("first.o").alias("p_first")
        ).alias("f")
        known = current.select(F.col("slug").alias("k_slug")).alias("k")
        n = new.alias("n")
        parent = blank_to_null(F.col("n.first.p"))
        new = (
            n.join(firsts, parent == F.col("f.p_slug"), "left")
            .join(known, parent == F.col("k.k_slug"), "left")
            .select(
                "n.slug", *[f"n.{v}" for v in values],
                F.when(
                    F.col("k.k_slug").isNotNull() | (F.col("f.p_first") < F.col("n.first.o")),
                    parent,
                ).alias("parent_slug"),
            )
        )
    c, b = current.alias("c"), new.alias("b")
    exists, given = F.col("c.slug").isNotNull(), F.col("b.slug").isNotNull()
    out = {
        "slug": F.coalesce("c.slug", "b.slug"),
        **{v: F.coalesce(F.col(f"b.{v}"), F.col(f"c.{v}"), F.lit("")) for v in values},
        "created_at": F.when(exists, F.col("c.created_at")).otherwise(now),
        "updated_at": F.when(given, now).otherwise(F.col("c.updated_at")),
        "change": F.when(~exists, CREATED).when(given, UPDATED).otherwise(UNTOUCHED),
    }
    if has_parent:
        out["parent_slug"] = F.when(exists, F.col("c.parent_slug")).otherwise(F.col("b.parent_slug"))
    joined = c.join(b, F.col("c.slug") == F.col("b.slug"), "full_outer")
    order_of = [*[f.name for f in (CATEGORY if has_parent else BRAND)], "change"]
    return Merged(joined.select(*[out[x].alias(x) for x in order_of]))


def distinct_names(batch: DataFrame, column: str, order: str = "pos") -> DataFrame:
    """Non-empty names of a batch with their first and last place."""
    return (
        batch.where(blank_to_null(F.col(column)).isNotNull())
        .groupBy(F.col(column).alias("name"))
        .agg(F.min(order).alias("first_pos"), F.max(order).alias("last_pos"))
    )


def resolve_names(current: DataFrame, names: DataFrame) -> DataFrame:
    """Slug of each name: that of the row with exactly this name, else the name's own slug."""
    exact = current.select("name", F.col("slug").alias("known_slug"))
    return names.join(exact, "name", "left").select(
        "name", "first_pos", "last_pos",
        F.coalesce("known_slug", normalize_slug(F.col("name"))).alias("slug"),
    )


def merge_names(current: DataFrame, resolved: DataFrame, now: Column) -> Merged:
    """Create missing rows for resolved names; names that share a slug share a row, last one wins."""
    final = resolved.groupBy("slug").agg(F.max_by("name", "last_pos").alias("name"))
    c, b = current.alias("c"), final.alias("b")
    exists = F.col("c.slug").isNotNull()
    renamed = F.coalesce(F.col("b.name") != F.col("c.name"), F.lit(False))
    out = {
        "name": F.coalesce("b.name", "c.name"),
        "slug": F.coalesce("c.slug", "b.slug"),
        "url": F.coalesce(F.col("c.url"), F.lit("")),
        "description": F.coalesce(F.col("c.description"), F.lit("")),
        "parent_slug": F.col("c.parent_slug") if "parent_slug" in current.columns else None,
        "created_at": F.when(exists, F.col("c.created_at")).otherwise(now),
        "updated_at": F.when(exists & ~renamed, F.col("c.updated_at")).otherwise(now),
        "change": F.when(~exists, CREATED).when(renamed, UPDATED).otherwise(UNTOUCHED),
    }
    joined = c.join(b, F.col("c.slug") == F.col("b.slug"), "full_outer")
    return Merged(joined.select(*[out[x].alias(x) for x in [*current.columns, "change"]]))


# Products -------------------------------------------------------------------------------


@dataclass(frozen=True)
class ProductMerge:
    """A merge of products. What became of which row is worked out when it is asked for."""

    products: Merged
    categories: Merged
    brands: Merged
    laid: Laid  # the batch by slug
    current: DataFrame  # slugs
    order: str

    @property
    def batch(self) -> DataFrame:
        return self.laid.plain

    @cached_property
    def first_valid(self) -> DataFrame:
        """``slug, valid_from, n_rows``: the first place at which a slug could be inserted."""
        found = self.laid.grouped(
            F.min(F.when(_has_category(), F.col(self.order))).alias("valid_from"), F.count("*").alias("n_rows"))
        return found if self.laid.even else stage(found)

    @cached_property
    def rejects(self) -> DataFrame:
        """Batch rows with a ``reason``. Only those without a category can be, so only they meet other tables."""
        late = F.col("valid_from").isNull() | (F.col(self.order) < F.col("valid_from"))
        blank = self.laid.rows.where(~_has_category())
        known = (blank.join(self.first_valid, "slug") if self.laid.even
                 else join_unique(blank, self.first_valid, ["slug"]))
        return (
            known.where(late).join(self.current, "slug", "left_anti")
            .select(*self.batch.columns, F.lit("missing_category").alias("reason"))
        )

    @cached_property
    def created(self) -> DataFrame:
        """Slugs that the batch has created."""
        return self.first_valid.where("valid_from IS NOT NULL").select("slug").join(self.current, "slug", "left_anti")

    def stats(self) -> DataFrame:
        """One row: batch rows by what became of them."""
        total = self.batch.agg(F.count("*").alias("total"))
        created = self.created.agg(F.count("*").alias("created"))
        errors = self.rejects.agg(F.count("*").alias("errors"))
        return side_by_side(total, created, errors).select(
            "total", "created",
            (F.col("total") - F.col("created") - F.col("errors")).alias("updated"),
            "errors",
        )


def _has_category() -> Column:
    return blank_to_null(F.col("category_name")).isNotNull()


def match_slug_or_url(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Add ``match_slug``: the stored row with the same slug, else the one with the same address.

    Where several stored rows have one address, the smallest slug owns it, so no batch row is
    repeated. Two equi-joins on the distinct pairs; an OR condition would become a nested loop.
    """
    pairs = stage(batch.groupBy("slug", "url").agg(F.count("*").alias("n_rows")))
    by_slug = current.select("slug", F.col("slug").alias("s_slug")).distinct()
    matched = pairs.join(by_slug, "slug", "left").join(url_owners(current), "url", "left").select(
        "slug", "url", "n_rows", F.coalesce("s_slug", "u_slug").alias("match_slug"),
        F.col("u_slug").alias("url_owner"),
    )
    return join_unique(batch, stage(matched), ["slug", "url"])


def collapse_products(laid: Laid, order: str = "pos",
                      sparse: Iterable[str] = SPARSE_PRODUCT_COLUMNS) -> DataFrame:
    """One row per slug: per column the latest value that is not NULL, with its place ``o``.

    Columns without a NULL in this batch travel together in the latest row; ``sparse`` ones are
    known to have some, of the others the batch is asked. ``valid_from`` is the first place at
    which the slug could be inserted, i.e. where a category is known.
    """
    batch = laid.plain
    o = F.col(order)
    sparse = tuple(sparse)
    special = {"slug", order, *REFERENCES, *sparse}
    rest = [c for c in batch.columns if c not in special]
    gaps = batch.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in rest]).first().asDict() if rest else {}
    sparse += tuple(c for c in rest if gaps[c])
    dense = [c for c in rest if not gaps[c]]
    return laid.grouped(
        F.max(F.struct(o.alias("o"), *dense)).alias("last"),
        *[_latest(o, c, F.col(c).isNotNull()).alias(c) for c in sparse],
        *[_latest(o, c, blank_to_null(F.col(c)).isNotNull()).alias(c) for c in REFERENCES],
        F.min(F.when(_has_category(), o)).alias("valid_from"),
    )


def assign_source_category(batch: DataFrame, source: str) -> DataFrame:
    """Give rows without a category the one whose listing they came from."""
    name = F.coalesce(blank_to_null(F.col("category_name")), F.col(source), F.lit(""))
    return batch.withColumn("category_name", name)


def merge_products(current: DataFrame, categories: DataFrame, brands: DataFrame,
                   batch: DataFrame | Laid, now: Column, order: str = "pos",
                   sparse: Iterable[str] = SPARSE_PRODUCT_COLUMNS) -> ProductMerge:
    """Merge normalized, validated product rows by slug, in batch order.

    Updates take every value that is not NULL, including empty ones. New slugs need a
    category: rows before the first one that has it are rejected. The batch is laid out by slug,
    unless it is already; where ``current`` is as well, no wide row goes through an exchange.
    """
    laid = batch if isinstance(batch, Laid) else lay_out(batch, "slug")
    batch = laid.plain
    # Names are counted and then broadcast: a join by name would deal the batch out by a few names.
    cat_names = stage(resolve_names(categories, distinct_names(batch, "category_name", order)))
    brand_names = stage(resolve_names(brands, distinct_names(batch, "brand_name", order)))

    # Collapsed rows lie by slug already when they meet the current table.
    one = collapse_products(laid, order, sparse)
    dense = [c for c in one.schema["last"].dataType.names if c != "o"]
    sparse = [c for c in one.columns if c not in ("slug", "last", "valid_from", *REFERENCES)]
    cats = cat_names.select(F.col("name").alias("category"), F.col("slug").alias("category_slug"))
    labels = brand_names.select(F.col("name").alias("brand"), F.col("slug").alias("brand_slug"))
    resolved = (
        one.join(small_side(cats), F.col("category_name.v") == F.col("category"), "left")
        .join(small_side(labels), F.col("brand_name.v") == F.col("brand"), "left")
    )
    c, b = current.alias("c"), resolved.alias("b")
    exists, given = F.col("c.slug").isNotNull(), F.col("b.slug").isNotNull()

    def counts(name: str) -> Column:
        # On insert nothing from before the first acceptable row counts.
        return exists | (F.col(f"b.{name}.o") >= F.col("b.valid_from"))

    incoming = {
        **{name: F.col(f"b.last.{name}") for name in dense},
        **{name: F.when(counts(name), F.col(f"b.{name}.v")) for name in sparse},
        "category_slug": F.col("b.category_slug"),
        "brand_slug": F.when(counts("brand_name"), F.col("b.brand_slug")),
    }

    def merged(name: str) -> Column:
        both = [incoming[name]] if name in incoming else []
        if name == "images":
            default = F.array().cast("array<string>")
        else:
            default = F.lit(PRODUCT_DEFAULTS.get(name))
        return F.when(exists, F.coalesce(*both, F.col(f"c.{name}"))).otherwise(
            F.coalesce(*both, default)
        )

    out = {f.name: merged(f.name) for f in PRODUCT}
    out["slug"] = F.coalesce("c.slug", "b.slug")
    out["created_at"] = F.when(exists, F.col("c.created_at")).otherwise(now)
    out["updated_at"] = F.when(given, now).otherwise(F.col("c.updated_at"))
    out["change"] = F.when(~exists, CREATED).when(given, UPDATED).otherwise(UNTOUCHED)
    joined = c.join(b, F.col("c.slug") == F.col("b.slug"), "full_outer").where(
        exists | F.col("b.valid_from").isNotNull()
    )
    rows = joined.select(*[col.alias(name) for name, col in out.items()])

    return ProductMerge(
        Merged(rows),
        merge_names(categories, cat_names, now),
        merge_names(brands, brand_names, now),
        laid, current.select("slug"), order,
    )
