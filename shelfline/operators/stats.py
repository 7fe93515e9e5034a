"""Catalogue figures, one scan per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns into one row, without a product of frames."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def catalog_stats(categories: DataFrame, brands: DataFrame, products: DataFrame,
                  runs: DataFrame) -> DataFrame:
    """One row of catalogue figures."""
    p = products.agg(
        F.count("*").alias("products"),
        F.count_if(F.col("image_url") != "").alias("products_with_images"),
        F.count("price").alias("products_with_prices"),
        F.count("rating").alias("products_with_ratings"),
    )
    sizes = [
        df.agg(F.count("*").alias(name))
        for name, df in (("categories", categories), ("brands", brands), ("runs", runs))
    ]
    return side_by_side(*sizes, p)
