"""The category tree: closure, chains, roll-ups.

The closure doubles the length of its paths in each round, over (slug, parent_slug) pairs only,
until a round finds nothing new: a tree of any depth takes as many rounds as its depth has
binary digits, and a cycle ends like any other path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage


def closure(categories: DataFrame) -> DataFrame:
    """(root, slug, depth) for every category and everything below it, itself included."""
    pairs = categories.select("slug", "parent_slug")
    itself = pairs.select(F.col("slug").alias("root"), "slug", F.lit(0).alias("depth"))
    known = pairs.select(F.col("slug").alias("parent_slug"))
    steps = pairs.join(known, "parent_slug", "left_semi").where("parent_slug <> slug").select(
        F.col("parent_slug").alias("root"), "slug", F.lit(1).alias("depth")
    )
    paths = stage(itself.unionByName(steps).distinct())
    size, before = paths.count(), -1
    while size != before:
        low = paths.select(F.col("root").alias("slug"), F.col("slug").alias("end"), F.col("depth").alias("more"))
        longer = paths.join(low, "slug").select(
            "root", F.col("end").alias("slug"), (F.col("depth") + F.col("more")).alias("depth")
        )
        paths = stage(longer.groupBy("root", "slug").agg(F.min("depth").alias("depth")))
        size, before = paths.count(), size
    return paths


def cycles(categories: DataFrame) -> DataFrame:
    """(slug): categories that are their own ancestors."""
    paths = closure(categories)
    up = paths.where("root <> slug").select(F.col("slug").alias("root"), F.col("root").alias("slug"))
    looped = paths.join(up, ["root", "slug"], "left_semi").select(F.col("root").alias("slug"))
    own = categories.where("slug = parent_slug").select("slug")
    return looped.unionByName(own).distinct()


def subtree(categories: DataFrame, slug: str) -> DataFrame:
    """(slug, depth) of one category and everything below it."""
    return closure(categories).where(F.col("root") == slug).select("slug", "depth")


def ancestors(categories: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """(slug, ancestor, step): step 0 is the root, the last step the category itself.

    ``paths`` is the closure, where it is known already.
    """
    # A window over one category's chain holds as many rows as the tree has levels.
    levels = F.max("depth").over(Window.partitionBy("slug"))
    return (closure(categories) if paths is None else paths).select(
        "slug", F.col("root").alias("ancestor"), (levels - F.col("depth")).alias("step")
    )


def roots(categories: DataFrame) -> DataFrame:
    return categories.where("parent_slug IS NULL")


def children(categories: DataFrame, parent_slug: str | None = None) -> DataFrame:
    """Categories below one parent; all of them if none is named."""
    if parent_slug is None:
        return categories
    return categories.where(F.col("parent_slug") == parent_slug)


def direct_counts(categories: DataFrame, products: DataFrame) -> DataFrame:
    """Every category with the number of its own products."""
    n = products.groupBy(F.col("category_slug").alias("slug")).agg(F.count("*").alias("n_products"))
    return categories.select("slug").join(n, "slug", "left").select(
        "slug", F.coalesce("n_products", F.lit(0)).alias("n_products")
    )


def subtree_products(categories: DataFrame, products: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """(root, products' columns): each product once per category that holds it, at any depth.

    Products of unknown categories are in no subtree; ``orphans`` has them. ``paths`` is the
    closure, where it is known already.
    """
    tree = (closure(categories) if paths is None else paths).select("root", F.col("slug").alias("category_slug"))
    return products.join(tree, "category_slug")


def orphans(categories: DataFrame, products: DataFrame) -> DataFrame:
    """Products whose category is not in the table."""
    return products.join(categories.select(F.col("slug").alias("category_slug")), "category_slug", "left_anti")


def rollup(categories: DataFrame, products: DataFrame) -> DataFrame:
    """Per category: categories, outputs and products in its subtree.

    Products are counted per category first; only the counts meet the closure.
    """
    counts = direct_counts(categories, products)
    return (
        closure(categories).join(counts, "slug").groupBy("root")
        .agg(
            F.count("*").alias("categories_processed"),
            F.count_if(F.col("n_products") > 0).alias("files_created"),
            F.sum("n_products").alias("products_exported"),
        )
    )
