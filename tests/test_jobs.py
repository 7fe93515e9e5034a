"""Whole jobs on disk: commit, replay, exports, streaming, tree limits."""

from datetime import datetime
from functools import partial

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from shelfline import session
from shelfline.operators import export, hierarchy, lookup, runlog
from shelfline.plans import refresh
from shelfline.schemas import CATEGORY, PAGE, TABLES
from shelfline.sources.catalog import CatalogStore
from shelfline.sources.pages import read_pages, stream_pages
from shelfline.streaming.ingest import ingest
from shelfline.workload import shop, tables as t

NOW, LATER = datetime(2024, 1, 1), datetime(2024, 1, 2)
LD = """<html><script type="application/ld+json">{"@type":"Product","name":"%s","brand":"Ash","category":"Decor",
"offers":{"price":%s}}</script></html>"""


@pytest.fixture(scope="module")
def shop_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shop") / "pages")
    shop.shop_pages(spark, SMALL).write.parquet(path)
    return path


def test_full_refresh_commits_once_and_reconciles(spark, shop_dir, tmp_path):
    store = CatalogStore(spark, str(tmp_path))
    pages = read_pages(spark, shop_dir)
    job = lambda current, now: refresh.full_refresh(pages, current, shop.RULES, now)
    done = refresh.commit_refresh(store, "run-1", NOW, job)
    n = done.products.count()
    assert n > 0 and done.categories.count() == 25
    again = refresh.commit_refresh(store, "run-1", NOW, job)
    assert again.products.count() == n and store.current_version() == "run-1"
    second = refresh.commit_refresh(store, "run-2", LATER, job)
    before = {r.slug: r for r in store.snapshot("run-1").products.drop("updated_at").collect()}
    after = {r.slug: r for r in second.products.drop("updated_at").collect()}
    assert before == after
    runs = {r.run_id: r.status for r in runlog.state(store.runs()).collect()}
    assert runs == {"run-1": "completed", "run-2": "completed"}
    written = export.read_dumps(spark, f"{tmp_path}/exports/version=run-2")
    result = export.reconcile(written, second.categories, second.products)
    totals = export.reconcile_totals(result).first()
    assert (totals.invalid_files, totals.total_records) == (0, n)
    sizes = export.output_sizes(spark, f"{tmp_path}/exports/version=run-2").collect()
    assert len(sizes) == totals.total_files and all(r.n_bytes > 0 for r in sizes)


def test_failed_job_is_logged(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path))

    def broken(current, now):
        raise RuntimeError("no pages")

    with pytest.raises(RuntimeError):
        refresh.commit_refresh(store, "bad", NOW, broken)
    row = runlog.state(store.runs()).first()
    assert (row.status, row.errors, store.current_version()) == ("failed", "no pages", None)


def test_stream_is_incremental_and_replay_safe(spark, tmp_path):
    store, land = CatalogStore(spark, f"{tmp_path}/store"), f"{tmp_path}/land"
    rules = refresh.ShopRules("https://s")

    def put(*rows):
        spark.createDataFrame(list(rows), PAGE).coalesce(1).write.mode("append").parquet(land)

    def run():
        ingest(stream_pages(spark, land), store, rules, "s1", f"{tmp_path}/cp", lambda: NOW).awaitTermination()
        return {r.slug: r.price for r in store.current().products.collect()}

    put((1, "https://s/p/a", LD % ("Alpha", 1)), (2, "https://s/p/a", LD % ("Alpha", 2)), (3, "https://s/x", "<p>"))
    assert run() == {"a": 2.0}
    version = store.current_version()
    assert run() == {"a": 2.0} and store.current_version() == version
    put((4, "https://s/p/b", LD % ("Beta", 5)), (5, "https://s/p/a", LD % ("Alpha", 3)))
    assert run() == {"a": 3.0, "b": 5.0}
    # A batch that comes again after its commit leaves everything as it is.
    from shelfline.streaming.ingest import merge_batch

    merge_batch(store, rules, "s1", lambda: LATER)(read_pages(spark, land), 0)
    assert {r.updated_at for r in store.current().products.collect()} == {NOW}
    assert store.runs().count() == 2


def test_dump_order_and_layout(spark, tmp_path):
    cats, brands, prods = t.categories(spark, SMALL), t.brands(spark, SMALL), t.products(spark, SMALL)
    lines = export.dump_lines(cats, brands, prods, F.lit(NOW))
    path = str(tmp_path / "dumps")
    export.write_dumps(lines, path, partitions=3)
    one = prods.groupBy("category_slug").count().join(
        cats, F.col("category_slug") == cats.slug).orderBy(F.desc("count")).first()
    text = "\n".join(
        p.read_text() for p in sorted((tmp_path / "dumps" / f"output={one.category_slug}").glob("part-*"))
    )
    marks = [text.index(s) for s in (
        "-- Product data export", "-- Create tables", "-- Insert category", "-- Insert brand",
        "-- Insert product", "-- End of export")]
    assert marks == sorted(marks)
    assert text.count("INSERT OR REPLACE INTO products ") == one["count"]
    assert "FOREIGN KEY(category_id) REFERENCES categories (id)" in text


def test_ids_do_not_collide(spark):
    assert export.id_collisions(t.offers(spark, SMALL)).count() == 0


@pytest.mark.parametrize("depth", [1, 6, 150])
def test_closure_of_a_chain(spark, depth):
    rows = [(f"n{i}", f"n{i}", "/", f"n{i - 1}" if i else None, "", NOW, NOW) for i in range(depth)]
    chain = spark.createDataFrame(rows + [("o", "orphan", "/", "gone", "", NOW, NOW)], CATEGORY)
    assert hierarchy.closure(chain).count() == depth * (depth + 1) // 2 + 1
    assert hierarchy.subtree(chain, "n0").count() == depth
    assert [r.slug for r in hierarchy.roots(chain).collect()] == ["n0"]


def test_cycles_end_and_are_reported(spark):
    rows = [(s, s, "/", p, "", NOW, NOW) for s, p in (("a", "c"), ("b", "a"), ("c", "b"), ("d", "a"), ("e", "e"), ("f", None))]
    loop = spark.createDataFrame(rows, CATEGORY)
    assert {r.slug for r in hierarchy.cycles(loop).collect()} == {"a", "b", "c", "e"}
    assert hierarchy.closure(loop).where("root = 'a'").count() == 4


def test_pages_landed_twice_count_once(spark, tmp_path):
    card = "<div class='product'><h3><a href='/p/%s'>%s</a></h3><b class='price'>%s</b></div>"
    menu = "<div class='navbar'><a href='/c/all'>All</a></div>"
    rows = [
        (9, "https://s/", menu, LATER), (1, "https://s/", "<p>old</p>", NOW),
        (2, "https://s/c/all", card % ("zeta", "Zeta old", 1), NOW), (3, "https://s/c/all", card % ("zeta", "Alpha new", 2), LATER),
        (4, "https://s/p/zeta", LD % ("Zeta old", 1), NOW), (5, "https://s/p/zeta", LD % ("Alpha new", 2), LATER),
        (5, "https://s/p/zeta", LD % ("Alpha new", 2), LATER),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, landed_at timestamp")
    store = CatalogStore(spark, str(tmp_path))
    out = refresh.full_refresh(pages, store.current(), refresh.ShopRules("https://s"), NOW)
    assert [(r["name"], r.price) for r in out.snapshot.products.collect()] == [("Alpha new", 2.0)]
    figures = out.stats.first()
    assert (figures.products_found, figures.products_processed, figures.products_created, figures.products_updated) == (1, 1, 1, 0)


def test_export_of_everything(spark, tmp_path):
    cats = t.categories(spark, SMALL).where("slug NOT LIKE 'nation_3-%'")
    snapshot = refresh.Snapshot(cats, t.brands(spark, SMALL), t.products(spark, SMALL))
    result = refresh.export_all_data(spark, snapshot, t.runs(spark, SMALL), str(tmp_path), NOW)
    assert result.where("NOT is_valid").count() == 0 and result.where("is_valid").count() > 0
    held = result.agg(F.sum("n_written")).first()[0]
    lost = spark.read.parquet(f"{tmp_path}/orphans").agg(F.sum("n_products")).first()[0]
    assert held + (lost or 0) == snapshot.products.count()
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "schema").glob("part-*")))
    assert text.count("CREATE TABLE") == len(TABLES)
    assert spark.read.json(f"{tmp_path}/summary").first().exported_products == held


def test_dumps_read_back_value_by_value(spark, tmp_path):
    odd = ["it's", "''", "a,\n    'b',\n);\nINSERT OR REPLACE INTO products", "NULL", "", "x\n);\n", "(1, 'a')", "'" * 500, "tail'"]
    plain = t.products(spark, SMALL).where("slug LIKE '%1%'")
    texts = F.array(*[F.lit(x) for x in odd])
    prods = plain.withColumn("description", F.get(texts, F.pmod(F.xxhash64("slug"), F.lit(len(odd))).cast("int"))).withColumn(
        "images", F.when(F.length("slug") % 2 == 0, F.array(F.lit("/i/'x',"), F.lit("b"))).otherwise(F.array().cast("array<string>")))
    prods = prods.withColumn("rating", F.when(F.col("rating") > 2, F.col("rating") / 3)).withColumn("brand_slug", F.when(F.col("is_sale"), F.col("brand_slug")))
    cats, path = t.categories(spark, SMALL), str(tmp_path / "dumps")
    prods = lookup.missing(prods, hierarchy.orphans(cats, prods), "slug")
    prods = spark.createDataFrame(prods.collect(), prods.schema)
    export.write_dumps(export.dump_lines(cats, t.brands(spark, SMALL), prods, F.lit(NOW)), path, partitions=3)
    columns = ["slug", "name", "description", "price", "original_price", "rating", "review_count", "images", "is_sale", "updated_at"]
    got = {r.slug: r for r in export.read_rows(spark, path, "products").select(*columns).collect()}
    assert got == {r.slug: r for r in prods.select(*columns).collect()}
    result = export.reconcile_values(spark, path, cats, prods)
    assert result.where("NOT is_equal").isEmpty() and result.agg(F.sum("n_written")).first()[0] == prods.count()
    one = prods.first().slug
    other = prods.withColumn("description", F.when(F.col("slug") == one, "changed").otherwise(F.col("description")))
    wrong = export.reconcile_values(spark, path, cats, other).where("NOT is_equal").collect()
    assert [r.n_source == r.n_written for r in wrong] == [True]  # the counts alone would not tell


def test_retention(spark):
    events = runlog.event(spark, "a", datetime(2024, 1, 1), "running").union(
        runlog.event(spark, "a", datetime(2024, 3, 1), "completed")).union(
        runlog.event(spark, "b", datetime(2024, 2, 20), "running"))
    kept = runlog.retain(events, datetime(2024, 3, 2), days=30)
    assert {r.run_id for r in kept.collect()} == {"b"}


def test_schema_text(spark):
    ddl = [r.line for r in export.schema_lines(spark).collect()]
    assert len(ddl) == len(TABLES) and "name VARCHAR(200) NOT NULL," in ddl[0]


def test_pages_of_listings_are_not_read_as_products(spark):
    """Unless a listing names them; a page that only looks like one of a listing stays."""
    base = "https://s.example"
    pages = spark.createDataFrame([(i, base + u, "") for i, u in enumerate(
        ["/c/a", "/c/a?page=2", "/c/a?page=x", "/c/b", "/c/b?page=2", "/p/1", "/p/1?page=2", "/c/other"])], PAGE)
    targets = spark.createDataFrame([(f"{base}/c/a",), (f"{base}/c/b",)], "listing_url string")
    listed = spark.createDataFrame([(f"{base}/p/1",), (f"{base}/c/b?page=2",)], "url string")
    kept = refresh.pages_listed(pages, targets, listed)
    assert sorted(r.url.removeprefix(base) for r in kept.collect()) == [
        "/c/a?page=x", "/c/b?page=2", "/c/other", "/p/1", "/p/1?page=2"]
    dealt = session.deal(kept.coalesce(1), "url")
    assert dealt.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism and dealt.count() == 5
