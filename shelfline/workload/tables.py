"""The given tables in the roles of a catalogue.

categories  regions, their nations, and the market segments customers have in each nation
brands      part brands
products    parts
offers      line items as product records of a feed: one product per (part, supplier), many
            records per product, ordered by ``pos``, some without a category
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import normalize_slug
from ..session import lay_out

# The feed up to this day makes the stored catalogue; what ships later is the change batch.
CUT = "1999-01-01"
NOW = "2024-02-01 00:00:00"
CREATED = "2020-01-01 00:00:00"
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@cache
def _schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A given table. Its schema is looked up once, since inference is a job of its own."""
    path = f"{d}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _row(name: Column, slug: Column, parent: Column) -> list[Column]:
    return [
        name.alias("name"), slug.alias("slug"), F.concat(F.lit("/c/"), slug).alias("url"),
        parent.alias("parent_slug"),
    ]


def nation_names(spark: SparkSession, d: str) -> DataFrame:
    """Every nation, and every nation's segments, with the slug of what they stand under."""
    n = table(spark, d, "nation")
    c = table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()
    nation_slug = F.lower("n_name")
    seg = F.concat_ws(" ", "n_name", "c_mktsegment")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        *_row(seg, normalize_slug(seg), nation_slug)
    )


def categories(spark: SparkSession, d: str) -> DataFrame:
    r, n = table(spark, d, "region"), table(spark, d, "nation")
    top = r.select(*_row(F.col("r_name"), normalize_slug(F.col("r_name")), F.lit(None).cast("string")))
    mid = n.join(r, n.n_regionkey == r.r_regionkey).select(
        *_row(F.col("n_name"), F.lower("n_name"), normalize_slug(F.col("r_name")))
    )
    return top.unionByName(mid).unionByName(nation_names(spark, d)).select(
        "name", "slug", "url", "parent_slug", F.lit("").alias("description"),
        ts(CREATED).alias("created_at"), ts(CREATED).alias("updated_at"),
    )


def brands(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "part").select("p_brand").distinct()
    return b.select(
        F.col("p_brand").alias("name"), normalize_slug(F.col("p_brand")).alias("slug"),
        F.lit("").alias("url"), F.lit("").alias("description"),
        ts(CREATED).alias("created_at"), ts(CREATED).alias("updated_at"),
    )


def part_slug() -> Column:
    return F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), F.col("p_partkey"))


def part_category() -> Column:
    nation = F.concat(F.lit("nation_"), F.col("p_size") % 25)
    segments = F.array(*[F.lit(s.lower()) for s in SEGMENTS])
    segment = F.get(segments, (F.col("p_partkey") % 5).cast("int"))
    return F.when(F.col("p_type") == "ECONOMY", nation).otherwise(F.concat_ws("-", nation, segment))


def products(spark: SparkSession, d: str) -> DataFrame:
    slug, none = part_slug(), F.lit(None).cast("double")
    p = table(spark, d, "part")
    return p.select(
        F.concat_ws(" ", "p_name", "p_partkey").alias("name"),
        slug.alias("slug"),
        F.concat(F.lit("/p/"), slug).alias("url"),
        F.concat_ws("'s ", "p_type", "p_brand").alias("description"),
        F.col("p_retailprice").alias("price"),
        F.when(F.col("p_size") > 25, F.col("p_retailprice") * 2).alias("original_price"),
        none.alias("discount_percentage"),
        F.concat(F.lit("SKU-"), F.col("p_partkey")).alias("sku"),
        F.when(F.col("p_size") > 5, "in_stock").otherwise("out_of_stock").alias("availability"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_size") / 10).alias("rating"),
        F.col("p_size").cast("bigint").alias("review_count"),
        F.when(F.col("p_type") == "PROMO", "").otherwise(
            F.concat(F.lit("/i/"), slug, F.lit(".jpg"))).alias("image_url"),
        F.array(F.concat(F.lit("/i/"), slug, F.lit(".jpg"))).alias("images"),
        F.lit("").alias("ingredients"),
        F.lit("").alias("usage_instructions"),
        part_category().alias("category_slug"),
        normalize_slug(F.col("p_brand")).alias("brand_slug"),
        F.lit(False).alias("is_featured"),
        F.lit(False).alias("is_bestseller"),
        (F.col("p_type") == "PROMO").alias("is_new"),
        (F.col("p_size") > 25).alias("is_sale"),
        ts(CREATED).alias("created_at"),
        (ts(CREATED) + F.make_dt_interval(F.col("p_size"))).alias("updated_at"),
    )


def offers(spark: SparkSession, d: str) -> DataFrame:
    """Normalized feed records with ``pos`` and the day ``shipped``."""
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    rows = (
        li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
        .join(n, s.s_nationkey == n.n_nationkey)
    )
    slug = F.concat(F.lit("p"), F.col("l_partkey"), F.lit("-s"), F.col("l_suppkey"))
    many, few = F.col("l_quantity") > 45, F.col("l_quantity") < 3
    odd = F.col("l_linenumber") == 7
    image = F.concat(F.lit("/i/"), slug)

    def key(c: str, width: int) -> Column:
        return F.lpad(F.col(c).cast("string"), width, "0")

    return rows.select(
        F.concat_ws(
            "-", F.date_format("l_shipdate", "yyyyMMdd"), key("l_orderkey", 12),
            key("l_linenumber", 3), key("l_partkey", 12), key("l_suppkey", 12),
        ).alias("pos"),
        F.col("l_shipdate").alias("shipped"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("l_orderkey")).alias("name"),
        slug.alias("slug"),
        F.concat(F.lit("/offers/"), slug).alias("url"),
        F.concat_ws(" ", "p_type", "l_linenumber").alias("description"),
        F.when((F.col("l_returnflag") != "R") | (F.col("l_linestatus") != "F"),
               F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice") + 1000).alias("original_price"),
        F.when(F.col("l_discount") > 0.02, F.col("l_discount") * 100).alias("discount_percentage"),
        F.concat(F.lit("SKU-"), F.col("l_partkey")).alias("sku"),
        F.when(F.col("l_linestatus") == "O", "in_stock").otherwise("out_of_stock").alias("availability"),
        F.when(F.col("l_tax") > 0, F.col("l_tax") * 50).alias("rating"),
        F.col("l_quantity").cast("bigint").alias("review_count"),
        image.alias("image_url"),
        F.array(image, F.concat(image, F.lit("-"), F.col("l_linenumber"))).alias("images"),
        F.lit("").alias("ingredients"),
        F.lit("").alias("usage_instructions"),
        F.when(F.col("l_returnflag") == "A", "").when(
            many, F.concat(F.col("n_name"), F.lit(" Special"))
        ).otherwise(F.col("n_name")).alias("category_name"),
        F.when(few, F.concat(F.col("p_brand"), F.lit(" Mini"))).when(
            odd, F.upper("p_brand")
        ).otherwise(F.col("p_brand")).alias("brand_name"),
        F.lit(False).alias("is_featured"),
        many.alias("is_bestseller"),
        (F.col("l_linestatus") == "O").alias("is_new"),
        (F.col("l_discount") > 0.05).alias("is_sale"),
    )


def change_batch(spark: SparkSession, d: str) -> DataFrame:
    return offers(spark, d).where(F.col("shipped") >= ts(CUT)).drop("shipped")


def stored_offers(spark: SparkSession, d: str, laid: bool = False) -> DataFrame:
    """Stored products: each offer's latest record before the cut.

    ``laid``: the records are laid out by slug first, and so are the products then. It pays where
    whole products are asked for.
    """
    old = offers(spark, d).where(F.col("shipped") < ts(CUT)).drop("shipped")
    rest = [c for c in old.columns if c not in ("slug", "pos")]
    latest = F.max(F.struct("pos", *rest)).alias("r")
    last = (lay_out(old, "slug").grouped(latest) if laid else old.groupBy("slug").agg(latest)).select("slug", "r.*")
    nation = F.regexp_replace("category_name", " Special$", "")
    slug = F.when(nation == "", F.lit("unsorted")).otherwise(F.lower(nation))
    return last.withColumn("category_slug", slug).withColumn(
        "brand_slug", normalize_slug(F.regexp_replace("brand_name", " Mini$", ""))
    ).withColumn("created_at", ts(CREATED)).withColumn("updated_at", ts(CREATED)).drop(
        "pos", "category_name", "brand_name"
    )


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Run-log events: a user is a run, the event type its status, the value its counters."""
    e = table(spark, d, "events")
    status = F.when(F.col("event_type") == "signup", "running").when(
        F.col("event_type") == "error", "failed").otherwise("completed")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        F.col("user_id").cast("string").alias("run_id"), F.col("ts").alias("at"),
        status.alias("status"), k.alias("categories_found"),
        F.col("event_id").alias("products_found"), k.alias("products_updated"),
        (k * 2).alias("products_created"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("errors"),
    )
