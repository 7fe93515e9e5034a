"""Catalogue tables. The slug is the key; references between tables are slugs as well.

``sql_type`` in a field's metadata is the declared type in exported DDL.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, dtype: T.DataType, sql_type: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"sql_type": sql_type})


_STR, _NUM, _INT = T.StringType(), T.DoubleType(), T.LongType()
_FLAG, _TIME = T.BooleanType(), T.TimestampType()

CATEGORY = T.StructType([
    _field("name", _STR, "VARCHAR(200) NOT NULL"),
    _field("slug", _STR, "VARCHAR(200) NOT NULL UNIQUE"),
    _field("url", _STR, "VARCHAR(500) NOT NULL"),
    _field("parent_slug", _STR, "INTEGER"),
    _field("description", _STR, "TEXT"),
    _field("created_at", _TIME, "DATETIME DEFAULT CURRENT_TIMESTAMP"),
    _field("updated_at", _TIME, "DATETIME DEFAULT CURRENT_TIMESTAMP"),
])

BRAND = T.StructType([
    _field("name", _STR, "VARCHAR(200) NOT NULL UNIQUE"),
    _field("slug", _STR, "VARCHAR(200) NOT NULL UNIQUE"),
    _field("url", _STR, "VARCHAR(500)"),
    _field("description", _STR, "TEXT"),
    _field("created_at", _TIME, "DATETIME DEFAULT CURRENT_TIMESTAMP"),
    _field("updated_at", _TIME, "DATETIME DEFAULT CURRENT_TIMESTAMP"),
])

PRODUCT = T.StructType([
    _field("name", _STR, "VARCHAR(500) NOT NULL"),
    _field("slug", _STR, "VARCHAR(500) NOT NULL UNIQUE"),
    _field("url", _STR, "VARCHAR(500) NOT NULL UNIQUE"),
    _field("description", _STR, "TEXT"),
    _field("price", _NUM, "REAL"),
    _field("original_price", _NUM, "REAL"),
    _field("discount_percentage", _NUM, "REAL"),
    _field("sku", _STR, "VARCHAR(100)"),
    _field("availability", _STR, "VARCHAR(50)"),
    _field("rating", _NUM, "REAL"),
    _field("review_count", _INT, "INTEGER DEFAULT 0"),
    _field("image_url", _STR, "VARCHAR(500)"),
    _field("images", T.ArrayType(_STR), "TEXT"),
    _field("ingredients", _STR, "TEXT"),
    _field("usage_instructions", _STR, "TEXT"),
    _field("category_slug", _STR, "INTEGER NOT NULL"),
    _field("brand_slug", _STR, "INTEGER"),
    _field("is_featured", _FLAG, "BOOLEAN DEFAULT 0"),
    _field("is_bestseller", _FLAG, "BOOLEAN DEFAULT 0"),
    _field("is_new", _FLAG, "BOOLEAN DEFAULT 0"),
    _field("is_sale", _FLAG, "BOOLEAN DEFAULT 0"),
    _field("created_at", _TIME, "DATETIME DEFAULT CURRENT_TIMESTAMP"),
    _field("updated_at", _TIME, "DATETIME DEFAULT CURRENT_TIMESTAMP"),
])

RUN_EVENT = T.StructType([
    T.StructField("run_id", _STR),
    T.StructField("at", _TIME),
    T.StructField("status", _STR),
    T.StructField("categories_found", _INT),
    T.StructField("products_found", _INT),
    T.StructField("products_updated", _INT),
    T.StructField("products_created", _INT),
    T.StructField("errors", _STR),
])

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", _STR),
    T.StructField("html", _STR),
])

TABLES = {"categories": CATEGORY, "brands": BRAND, "products": PRODUCT}

# Declared lengths by table and column, for the audit.
MAX_LENGTH = {
    table: {
        f.name: int(f.metadata["sql_type"].split("(")[1].split(")")[0])
        for f in schema if f.metadata["sql_type"].startswith("VARCHAR")
    }
    for table, schema in TABLES.items()
}

# Columns of a normalized product row.
NORMALIZED_PRODUCT = tuple(
    {"category_slug": "category_name", "brand_slug": "brand_name"}.get(f.name, f.name)
    for f in PRODUCT if f.name not in ("created_at", "updated_at")
)

# Normalized columns that may be NULL; all others always hold a value.
SPARSE_PRODUCT_COLUMNS = ("price", "original_price", "discount_percentage", "rating")

# What an insert stores where the row gives nothing.
PRODUCT_DEFAULTS = {
    "description": "", "sku": "", "availability": "unknown", "review_count": 0, "image_url": "",
    "ingredients": "", "usage_instructions": "",
    "is_featured": False, "is_bestseller": False, "is_new": False, "is_sale": False,
}
