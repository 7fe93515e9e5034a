"""Raw rows to normalized rows, one projection per record kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import fields, numbers, text
from ..schemas import NORMALIZED_PRODUCT

_TEXTS = ("name", "description", "ingredients", "usage_instructions", "brand_name", "category_name")
_URLS = ("url", "image_url")
_FLAGS = ("is_featured", "is_bestseller", "is_new", "is_sale")


def _flag_kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    return "text" if numbers.is_text(dtype) else "number"


def normalize_products(raw: DataFrame, *keep: str, locale: str = "plain") -> DataFrame:
    """Normalized product rows; a column the input lacks counts as absent in every row.

    All texts that are there go through one array expression, so the plan holds the text rule once.
    """
    types = {f.name: f.dataType for f in raw.schema}

    def col(name: str) -> tuple[Column, bool]:
        if name not in types:
            return F.lit(None).cast("string"), True
        return F.col(name), numbers.is_text(types[name])

    given = [name for name in _TEXTS if name in types]
    out: dict[str, Column] = {
        **{name: F.lit("") for name in _TEXTS},
        **{name: F.get("_texts", i) for i, name in enumerate(given)},
        **{name: fields.normalize_url(col(name)[0]) for name in _URLS},
    }
    for name in ("price", "original_price"):
        out[name] = numbers.normalize_price(*col(name), locale=locale)
    out["discount_percentage"] = numbers.normalize_percentage(*col("discount_percentage"))
    out["rating"] = numbers.normalize_rating(*col("rating"))
    out["review_count"] = numbers.normalize_integer(*col("review_count"))
    out["slug"] = text.normalize_slug(col("slug")[0])
    out["sku"] = fields.normalize_sku(col("sku")[0])
    out["availability"] = fields.normalize_availability(col("availability")[0])
    is_list = isinstance(types.get("images"), T.ArrayType)
    out["images"] = fields.normalize_images(col("images")[0], is_list)
    for name in _FLAGS:
        out[name] = fields.normalize_boolean(col(name)[0], _flag_kind(types.get(name, T.StringType())))
    lists = raw
    if given:
        texts = text.normalize_texts([F.col(n).cast("string") for n in given])
        lists = raw.select("*", texts.alias("_texts"))
    return lists.select(*keep, *[out[name].alias(name) for name in NORMALIZED_PRODUCT])


def _given(raw: DataFrame, name: str) -> Column:
    return F.col(name) if name in raw.columns else F.lit(None).cast("string")


def normalize_brands(raw: DataFrame, *keep: str) -> DataFrame:
    return raw.select(
        *keep,
        text.normalize_text(_given(raw, "name")).alias("name"),
        text.normalize_slug(_given(raw, "slug")).alias("slug"),
        fields.normalize_url(_given(raw, "url")).alias("url"),
        text.normalize_text(_given(raw, "description")).alias("description"),
    )


def normalize_categories(raw: DataFrame, *keep: str) -> DataFrame:
    parent = text.normalize_slug(_given(raw, "parent_slug")).alias("parent_slug")
    with_parent = raw.select(*raw.columns, parent.alias("_parent"))
    return normalize_brands(with_parent, *keep, "_parent").withColumnRenamed(
        "_parent", "parent_slug"
    )
