"""SQL dumps per category: statements, layout, files, and reconciliation with the source."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.fields import sql_escape
from ..functions.numbers import python_float_text
from ..schemas import BRAND, CATEGORY, PRODUCT, TABLES
from ..session import stage
from . import hierarchy
from .stats import side_by_side

# Order and captions of the sections of a dump.
HEADER, DDL, CATEGORIES, BRANDS, PRODUCTS, TRAILER = range(6)
CAPTIONS = {
    DDL: "-- Create tables if they don't exist",
    CATEGORIES: "-- Insert category data",
    BRANDS: "-- Insert brand data",
    PRODUCTS: "-- Insert product data",
    TRAILER: "-- End of export",
}
ID_COLUMNS = {"parent_slug": "parent_id", "category_slug": "category_id", "brand_slug": "brand_id"}
FOREIGN_KEYS = {"parent_id": "categories", "category_id": "categories", "brand_id": "brands"}


def surrogate_id(slug: Column) -> Column:
    """Positive 63-bit id of a slug: the same in every run, and no global counter needed."""
    return F.xxhash64(slug).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def id_collisions(table: DataFrame) -> DataFrame:
    return (
        table.groupBy(surrogate_id(F.col("slug")).alias("id"))
        .agg(F.count_distinct("slug").alias("n_slugs")).where("n_slugs > 1")
    )


def _iso(c: Column) -> Column:
    """ISO text; microseconds only where there are any."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def json_text(images: Column) -> Column:
    """Image list as JSON text, ``''`` for an empty one."""
    return F.when(F.size(images) > 0, F.to_json(images)).otherwise(F.lit(""))


def _literal(field: T.StructField) -> Column:
    c, null = F.col(field.name), F.lit("NULL")
    if field.name in ID_COLUMNS:
        return _reference(field.name)
    if isinstance(field.dataType, T.DoubleType):
        return F.coalesce(python_float_text(c), null)
    if isinstance(field.dataType, T.LongType):
        return F.coalesce(c.cast("string"), null)
    if isinstance(field.dataType, T.BooleanType):
        return F.when(c, F.lit("1")).otherwise(F.lit("0"))
    if isinstance(field.dataType, T.TimestampType):
        return F.concat(F.lit("'"), _iso(c), F.lit("'"))
    if isinstance(field.dataType, T.ArrayType):
        return sql_escape(json_text(c))
    return sql_escape(c)


def _reference(c: str) -> Column:
    """NULL-safe id of a reference; hashing NULL would give an id."""
    return F.when(F.col(c).isNotNull(), surrogate_id(F.col(c)).cast("string")).otherwise(F.lit("NULL"))


def _head(table: str) -> str:
    """First line of a row's statement."""
    names = ["id", *[ID_COLUMNS.get(f.name, f.name) for f in TABLES[table]]]
    return f"INSERT OR REPLACE INTO {table} ({', '.join(names)}) VALUES ("


def insert_statement(table: str, ids: dict[str, Column] | None = None) -> Column:
    """``INSERT OR REPLACE`` text of a row. ``ids`` overrides how ids are written."""
    schema, ids = TABLES[table], ids or {}
    values = [ids.get("id", surrogate_id(F.col("slug")).cast("string"))]
    for f in schema:
        if f.name in ID_COLUMNS:
            values.append(ids.get(ID_COLUMNS[f.name], _reference(f.name)))
        else:
            values.append(_literal(f))
    return F.concat(F.lit(_head(table) + "\n    "), F.concat_ws(",\n    ", *values), F.lit("\n);"))


def insert_lines(rows: DataFrame, table: str, *keep: str,
                 ids: dict[str, Column] | None = None) -> DataFrame:
    return rows.select(*keep, insert_statement(table, ids).alias("line"))


def ddl(table: str, schema: T.StructType) -> str:
    """``CREATE TABLE`` text from a table's schema."""
    lines = ["id INTEGER PRIMARY KEY AUTOINCREMENT"]
    references = []
    for f in schema:
        name = ID_COLUMNS.get(f.name, f.name)
        sql_type = f.metadata["sql_type"]
        if table == "categories" and name == "name":
            sql_type = sql_type.replace(" UNIQUE", "")
        lines.append(f"{name} {sql_type}")
        if name in FOREIGN_KEYS:
            references.append(f"FOREIGN KEY({name}) REFERENCES {FOREIGN_KEYS[name]} (id)")
    body = ",\n    ".join(lines + references)
    return f"CREATE TABLE IF NOT EXISTS {table} (\n    {body}\n);"


def schema_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, ddl(t, s)) for i, (t, s) in enumerate(TABLES.items())], "seq int, line string"
    )


def _membership(categories: DataFrame, products: DataFrame, subtree: bool, paths: DataFrame) -> DataFrame:
    """Products with the output they go to: their own category's, or every ancestor's too.

    A product of an unknown category goes nowhere; ``export_orphans`` counts those.
    """
    if not subtree:
        known = categories.select(F.col("slug").alias("category_slug"))
        return products.join(known, "category_slug", "left_semi").withColumn("output", F.col("category_slug"))
    return hierarchy.subtree_products(categories, products, paths).withColumnRenamed("root", "output")


def dump_lines(categories: DataFrame, brands: DataFrame, products: DataFrame, exported_at: Column,
               subtree: bool = False, include_descendants: bool = True,
               outputs: DataFrame | None = None) -> DataFrame:
    """(output, section, seq, line) of all dumps; only categories with products get one.

    ``subtree`` puts a category's whole subtree into its output; ``include_descendants``
    then adds the sub-categories the products refer to. ``outputs`` (slug) limits what is
    written.
    """
    paths = hierarchy.closure(categories)
    members = _membership(categories, products, subtree, paths)
    if outputs is not None:
        members = members.join(outputs.select(F.col("slug").alias("output")), "output", "left_semi")
    # Direct products per category are counted before any join.
    totals = members.groupBy("output").agg(F.count("*").alias("n_products"))
    heads = totals.join(categories.withColumnRenamed("slug", "output"), "output")

    header = F.array(
        F.lit("-- Product data export"),
        F.concat(F.lit("-- Category: "), F.col("name"), F.lit(" ("), F.col("output"), F.lit(")")),
        F.concat(F.lit("-- Exported at: "), _iso(exported_at)),
        F.concat(F.lit("-- Total products: "), F.col("n_products").cast("string")),
    )
    fixed = [(DDL, CAPTIONS[DDL]), *[(DDL, ddl(t, s)) for t, s in TABLES.items()],
             (CATEGORIES, CAPTIONS[CATEGORIES]), (PRODUCTS, CAPTIONS[PRODUCTS]),
             (TRAILER, CAPTIONS[TRAILER])]
    frame = F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit("").alias("slug"), F.lit(-9 + i).alias("n"),
                 F.lit(line).alias("line"))
        for i, (section, line) in enumerate(fixed)
    ])
    head_rows = heads.select(
        "output",
        F.explode(F.concat(
            F.transform(header, lambda line, i: F.struct(
                F.lit(HEADER).alias("section"), F.lit("").alias("slug"), i.alias("n"),
                line.alias("line"))),
            frame,
        )).alias("r"),
    ).select("output", "r.section", "r.slug", "r.n", "r.line")

    chain = hierarchy.ancestors(categories, paths).select(
        F.col("slug").alias("output"), F.col("ancestor").alias("slug"), F.col("step").alias("n")
    )
    if subtree and include_descendants:
        below = paths.where("depth > 0").select(
            F.col("root").alias("output"), "slug", (F.col("depth") + 1000).alias("n")
        )
        chain = chain.unionByName(below)
    chain = chain.join(totals.select("output"), "output", "left_semi")
    category_rows = chain.join(categories, "slug").select(
        "output", F.lit(CATEGORIES).alias("section"), "slug", "n",
        insert_statement("categories").alias("line"),
    )
    used = members.where("brand_slug IS NOT NULL").select(
        "output", F.col("brand_slug").alias("slug")
    ).distinct()
    brand_rows = used.join(brands, "slug").select(
        "output", F.lit(BRANDS).alias("section"), "slug", F.lit(0).alias("n"),
        insert_statement("brands").alias("line"),
    )
    brand_heads = used.select("output").distinct().select(
        "output", F.lit(BRANDS).alias("section"), F.lit("").alias("slug"), F.lit(-1).alias("n"),
        F.lit(CAPTIONS[BRANDS]).alias("line"),
    )
    product_rows = members.select(
        "output", F.lit(PRODUCTS).alias("section"), "slug", F.lit(0).alias("n"),
        insert_statement("products").alias("line"),
    )
    return (
        head_rows.unionByName(category_rows).unionByName(brand_heads)
        .unionByName(brand_rows).unionByName(product_rows)
    )


def export_orphans(categories: DataFrame, products: DataFrame) -> DataFrame:
    """``category_slug, n_products``: what no dump can hold, by the category that is missing."""
    lost = hierarchy.orphans(categories, products)
    return lost.groupBy("category_slug").agg(F.count("*").alias("n_products"))


ORDER = ("output", "section", "n", "slug")


def write_dumps(lines: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write one folder per output; its part files, read by name, are the dump in order.

    Range partitioning on the line order splits a large output over many tasks.
    """
    by = [F.col(c) for c in ORDER]
    spread = lines.repartitionByRange(partitions, *by) if partitions else lines.repartitionByRange(*by)
    (
        spread.sortWithinPartitions(*by).select("output", "line")
        .write.partitionBy("output").mode("overwrite").text(path)
    )


def export_manifest(categories: DataFrame, products: DataFrame) -> DataFrame:
    """One row per category: its direct products, and whether it gets an output."""
    return hierarchy.direct_counts(categories, products).select(
        "slug", "n_products", (F.col("n_products") > 0).alias("has_output")
    )


def export_totals(categories: DataFrame, products: DataFrame) -> DataFrame:
    manifest = export_manifest(categories, products)
    return manifest.agg(
        F.count("*").alias("categories_processed"),
        F.count_if("has_output").alias("files_created"),
        F.coalesce(F.sum("n_products"), F.lit(0)).alias("total_products"),
    )


def output_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per written output; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.txt"
    ).load(path).select("path", "length")
    return (
        files.select(
            F.try_url_decode(F.regexp_extract("path", "output=([^/]+)/", 1)).alias("slug"), "length"
        )
        .groupBy("slug").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
    )


def export_summary(stats: DataFrame, manifest: DataFrame) -> DataFrame:
    """Catalogue figures next to the export's own totals, in one row."""
    return side_by_side(stats, manifest.agg(
        F.count_if("has_output").alias("outputs"),
        F.coalesce(F.sum("n_products"), F.lit(0)).alias("exported_products"),
    ))


def read_dumps(spark: SparkSession, path: str) -> DataFrame:
    # The schema keeps an output named like a number a text.
    return spark.read.schema("value string, output string").text(path).withColumnRenamed(
        "value", "line"
    )


def reconcile(written: DataFrame, categories: DataFrame, products: DataFrame) -> DataFrame:
    """Per category: products in the source and products found in what was written."""
    # The whole first line of a statement, so that no text with a line break passes for one.
    statement = F.substring_index("line", "\n", 1) == _head("products")
    found = (
        written.groupBy(F.col("output").alias("slug"))
        .agg(F.count_if(statement).alias("n_written"))
    )
    source = export_manifest(categories, products).where("has_output")
    both = source.join(found, "slug", "full_outer")
    n_source, n_written = F.coalesce("n_products", F.lit(0)), F.coalesce("n_written", F.lit(0))
    return both.select(
        "slug", n_source.alias("n_source"), n_written.alias("n_written"),
        (n_source == n_written).alias("is_valid"),
    )


_END = "\n);\n"  # of a statement
_TOKENS = "'[^']*+'|,|[^',]++"


def statement_bodies(spark: SparkSession, path: str, table: str) -> DataFrame:
    """``output, body``: what stands between the brackets of a table's statements in written dumps.

    Files are cut at the ends of statements, so a task reads a share of a file. A text may hold
    such an end as well; its pieces then have an odd number of quotes, and the few files with
    such pieces are read whole and cut where an end is outside of quotes.
    """
    schema, head = "value string, output string", _head(table) + "\n"

    # What comes before a statement, captions with apostrophes among it, does not count.
    pieces = spark.read.schema(schema).text(path, lineSep=_END).withColumn("head", F.lit(head)).where("instr(value, head) > 0").select(
        "output", F.col("_metadata.file_path").alias("file"),
        F.expr("substr(value, length(head) + instr(value, head))").alias("body"))
    quotes = F.length("body") - F.length(F.replace("body", F.lit("'"), F.lit("")))
    odd = stage(pieces.where(quotes % 2 == 1).select("file").distinct())
    if odd.isEmpty():
        return pieces.select("output", "body")
    plain = pieces.join(odd, "file", "left_anti").select("output", "body")
    whole = spark.read.schema(schema).text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path")).join(odd, "file", "left_semi")
    # Outside of quotes no value holds a bracket.
    found = F.regexp_extract_all("value", F.lit(re.escape(head) + r"((?:[^')]++|'[^']*+')*+)\)"), F.lit(1))
    return plain.unionByName(whole.select("output", F.explode(found).alias("body")))


def literals(body: Column) -> Column:
    """The values of a statement as ``array<struct<text, quoted>>``; doubled quotes are single ones."""
    start = F.struct(F.array().cast("array<struct<text:string,quoted:boolean>>").alias("done"), F.lit("").alias("text"), F.lit(False).alias("quoted"))

    def fold(held: Column, token: Column) -> Column:
        one = F.struct(held["text"].alias("text"), held["quoted"].alias("quoted"))
        inner = F.substr(token, F.lit(2), F.length(token) - 2)
        more = F.concat(held["text"], F.when(held["quoted"], F.lit("'")).otherwise(""), inner)
        bare = F.concat(held["text"], F.when(held["quoted"], F.lit("")).otherwise(F.regexp_replace(token, r"^\s+|\s+$", "")))
        return (
            F.when(token == ",", F.struct(F.concat(held["done"], F.array(one)).alias("done"), F.lit("").alias("text"), F.lit(False).alias("quoted")))
            .when(F.startswith(token, F.lit("'")), F.struct(held["done"].alias("done"), more.alias("text"), F.lit(True).alias("quoted")))
            .otherwise(F.struct(held["done"].alias("done"), bare.alias("text"), held["quoted"].alias("quoted")))
        )

    def finish(held: Column) -> Column:
        return F.concat(held["done"], F.array(F.struct(held["text"].alias("text"), held["quoted"].alias("quoted"))))

    return F.aggregate(F.regexp_extract_all(body, F.lit(_TOKENS), F.lit(0)), start, fold, finish)


def _value(field: T.StructField, v: Column) -> Column:
    """A field's value from its literal."""
    text = F.when(v["quoted"] | (v["text"] != "NULL"), v["text"])
    if field.name in ID_COLUMNS:
        return text.cast("long")
    if isinstance(field.dataType, T.BooleanType):
        return text == "1"
    if isinstance(field.dataType, T.TimestampType):
        return F.to_timestamp(F.replace(text, F.lit("T"), F.lit(" ")))
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))
    return text.cast(field.dataType)


def read_rows(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The rows of a table's statements in written dumps, with ``output`` and ``id``.

    Columns have the types of the table; references are ids under the names they have in a dump.
    """
    rows = statement_bodies(spark, path, table).select("output", literals(F.col("body")).alias("v"))
    columns = [F.get("v", i + 1) for i in range(len(TABLES[table]))]
    return rows.select("output", F.get("v", F.lit(0))["text"].cast("long").alias("id"), *[
        _value(f, v).alias(ID_COLUMNS.get(f.name, f.name)) for f, v in zip(TABLES[table], columns)])


def _row_hash(table: str, as_written: bool) -> Column:
    """Hash of a row's values, the same for a source row and for what a dump makes of it."""
    parts = []
    for f in TABLES[table]:
        c = F.col(ID_COLUMNS.get(f.name, f.name) if as_written else f.name)
        if f.name in ID_COLUMNS:
            c = c if as_written else F.when(c.isNotNull(), surrogate_id(c))
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))  # a dump does not tell them apart
        elif isinstance(f.dataType, T.BooleanType):
            c = F.coalesce(c, F.lit(False))
        elif isinstance(f.dataType, T.ArrayType):
            c = F.coalesce(c, F.array().cast("array<string>"))
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)


def reconcile_values(spark: SparkSession, path: str, categories: DataFrame, products: DataFrame) -> DataFrame:
    """Per category: product rows in the source and in the written dumps, and whether they are equal.

    Rows are rebuilt from the statements and compared as multisets: by their number and the sum
    of their hashes.
    """
    def sums(rows: DataFrame, key: str, h: Column, name: str) -> DataFrame:
        total = F.sum(h.cast("decimal(38,0)"))
        return rows.groupBy(F.col(key).alias("slug")).agg(F.count("*").alias(f"n_{name}"), total.alias(f"h_{name}"))

    known = categories.select(F.col("slug").alias("category_slug"))
    source = sums(products.join(known, "category_slug", "left_semi"), "category_slug", _row_hash("products", False), "source")
    found = sums(read_rows(spark, path, "products"), "output", _row_hash("products", True), "written")
    n_source, n_written = F.coalesce("n_source", F.lit(0)), F.coalesce("n_written", F.lit(0))
    return source.join(found, "slug", "full_outer").select(
        "slug", n_source.alias("n_source"), n_written.alias("n_written"), F.col("h_source").eqNullSafe(F.col("h_written")).alias("is_equal"))


def reconcile_totals(result: DataFrame) -> DataFrame:
    return result.agg(
        F.count("*").alias("total_files"),
        F.count_if("is_valid").alias("valid_files"),
        F.count_if(~F.col("is_valid")).alias("invalid_files"),
        F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("n_written"))), F.lit(0)).alias(
            "total_records"
        ),
    )
