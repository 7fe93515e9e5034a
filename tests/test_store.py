"""The bucketed store, and pages of all kinds through the stream."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from shelfline.plans import refresh
from shelfline.sources.catalog import CatalogStore, Snapshot, bucket_of
from shelfline.sources.pages import landed_after, newest_pages, stream_pages
from shelfline.streaming.ingest import ingest_shop, merge_batch, shop_batch, shop_store
from shelfline.workload import tables as t

DAY = [datetime(2024, 1, 1) + timedelta(days=i) for i in range(20)]
LD = """<html><script type="application/ld+json">{"@type":"Product","name":"%s","brand":"Ash","category":"Decor",
"offers":{"price":%s}}</script></html>"""
MENU = "<div class='navbar'><a href='/c/decor'>Decor</a></div>"
SIDE = "<div class='sub-nav'><a href='/c/lamps'>Lamps</a></div>"
CARD = "<div class='product'><h3><a href='/p/%s'>%s</a></h3></div>"
TIMED = "page_id long, url string, html string, landed_at timestamp"


def written(root, version):
    return sum(p.stat().st_size for p in Path(root).rglob("*.parquet") if f"version={version}" in str(p))


def test_a_small_batch_writes_only_its_buckets(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path), buckets=32)
    whole = Snapshot(t.categories(spark, SMALL), t.brands(spark, SMALL), t.products(spark, SMALL))
    store.commit("v0", whole)
    before = {r.slug: r for r in store.current().products.collect()}
    assert len(before) == whole.products.count() > 100
    pages = spark.createDataFrame([(1, "https://s/p/new", LD % ("New", 5))], "page_id long, url string, html string")
    handle = merge_batch(store, refresh.ShopRules("https://s"), "s", lambda: DAY[3])
    handle(pages, 0)
    after = {r.slug: r for r in store.current().products.collect()}
    assert after.keys() - before.keys() == {"new"} and all(after[s] == r for s, r in before.items())
    assert written(tmp_path / "products", "s-000000000000") < written(tmp_path / "products", "v0") / 8
    assert len([*(tmp_path / "products" / "version=s-000000000000").glob("bucket=*")]) == 1
    assert store.snapshot("v0").products.count() == len(before)  # older versions stay readable
    handle(pages, 0)  # a replay
    assert store.current_version() == "s-000000000000" and store.runs().count() == 1


def test_rows_outside_their_buckets_are_refused(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path), buckets=8)
    products = t.products(spark, SMALL)
    store.commit("v0", Snapshot(t.categories(spark, SMALL), t.brands(spark, SMALL), products))
    with pytest.raises(ValueError):
        store.write_part("v1", {"products": (products, [0])})
    assert store.current_version() == "v0"


def test_an_unfinished_version_list_does_not_count(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path))
    empty = store.current()
    assert store.current_version() is None and empty.products.count() == 0
    store.commit("v0", empty)
    (tmp_path / "versions" / "seq=1").mkdir()
    assert store.current_version() == "v0" and store.has_version("v0") and not store.has_version("v1")
    store.commit("v1", empty)
    assert store.current_version() == "v1"


def test_buckets_of_equal_slugs(spark):
    rows = spark.range(1000).select(bucket_of(F.concat(F.lit("p"), F.col("id")), 16).alias("b"))
    assert rows.agg(F.min("b"), F.max("b"), F.count_distinct("b")).first()[:] == (0, 15, 16)


def test_pages_landed_after(spark):
    pages = spark.createDataFrame([(1, "/a", "x", DAY[1]), (2, "/a", "y", DAY[5]), (3, "/b", "z", DAY[1]), (4, "/c", "", None)], TIMED)
    known = spark.createDataFrame([("/a", DAY[3]), ("/a", DAY[2]), ("/b", DAY[1]), ("/c", DAY[1]), ("/d", None)], "url string, since timestamp")
    assert sorted(r.page_id for r in landed_after(pages, known).collect()) == [2, 4]
    assert sorted(r.page_id for r in landed_after(pages.drop("landed_at"), known).collect()) == [1, 2, 3, 4]


def test_stream_of_all_kinds_of_pages(spark, tmp_path):
    rules, land = refresh.ShopRules("https://s"), str(tmp_path / "land")
    store = shop_store(spark, str(tmp_path / "store"), rules, buckets=4)

    def run(day, *pages):
        rows = [(i, f"https://s{u}", html, DAY[at]) for i, (u, html, at) in enumerate(pages)]
        spark.createDataFrame(rows, TIMED).coalesce(1).write.mode("append").parquet(land)
        ingest_shop(stream_pages(spark, land, timed=True), store, rules, "s", str(tmp_path / "cp"), lambda: DAY[day]).awaitTermination()
        now = store.current()
        return {r.slug: (r["name"], r.price) for r in now.products.collect()}, {r.slug: r.parent_slug for r in now.categories.collect()}

    # A product page that nobody has listed waits, for as long as it takes.
    assert run(1, ("/p/a", LD % ("Alpha", 1), 1), ("/p/z", LD % ("Zeta", 9), 1)) == ({}, {})
    # The listing comes before the menu that makes it one: it is not known as a listing yet.
    assert run(2, ("", MENU, 2), ("/c/decor", CARD % ("a", "Alpha") + CARD % ("b", "Beta"), 2))[0] == {"a": ("Alpha", 1.0)}
    # A listed address waits for its page; an older landing changes nothing.
    products, categories = run(3, ("/p/b", LD % ("Beta", 2), 3), ("/p/a", LD % ("Old", 7), 0), ("/c/decor", SIDE, 3))
    assert products == {"a": ("Alpha", 1.0), "b": ("Beta", 2.0)}
    assert categories == {"decor": None, "lamps": "decor"}
    # Side categories are listings as well; two landings at once: the later one counts.
    products, _ = run(4, ("/c/lamps", CARD % ("z", "Zeta"), 4), ("/p/a", LD % ("Alpha", 3), 4), ("/p/a", LD % ("Alpha", 4), 4))
    assert products == {"a": ("Alpha", 4.0), "b": ("Beta", 2.0), "z": ("Zeta", 9.0)}
    version = store.current_version()
    # Later than the watermark allows: dropped, though the state may have forgotten the address.
    run(5, ("/p/q", LD % ("Quick", 1), 18))
    assert run(6, ("/p/a", LD % ("Late", 8), 3))[0]["a"] == ("Alpha", 4.0)
    # A batch that comes again is left alone.
    shop_batch(store, rules, "s", lambda: DAY[9])(spark.createDataFrame([(1, "https://s/p/a", LD % ("No", 0), DAY[9])], TIMED), 0)
    assert version in {r.version for r in store._markers().select("version").distinct().collect()}
    assert {r.slug: r.price for r in store.current().products.collect()}["a"] == 4.0


@pytest.mark.parametrize("buckets", [1, 1 << 13])
def test_addresses_share_a_state(spark, tmp_path, buckets):
    land, out, schema = str(tmp_path / "land"), [], "page_id long, url string, html string, landed_at timestamp"

    def run(*rows):
        pages = [(i, url, f"{url}{i}", datetime(2024, 1, day)) for i, url, day in rows]
        spark.createDataFrame(pages, schema).coalesce(1).write.mode("append").parquet(land)
        out.clear()
        query = newest_pages(stream_pages(spark, land, timed=True), "3 days", buckets).writeStream.foreachBatch(
            lambda df, _: out.extend((r.page_id, r.url, r.html) for r in df.collect())).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(out), query.recentProgress

    got, progress = run((1, "a", 5), (2, "a", 6), (3, "a", 4), (4, "b", 5), (6, "c", 5), (5, "c", 5))
    assert got == [(2, "a", "a2"), (4, "b", "b4"), (6, "c", "c6")]
    states = max(p.stateOperators[0].numRowsTotal for p in progress)
    assert states == 1 if buckets == 1 else states <= 3
    assert run((7, "a", 5), (4, "b", 5), (8, "b", 5), (9, "d", 20))[0] == [(8, "b", "b8"), (9, "d", "d9")]
    # Day 16 lies before the watermark; a has been forgotten, but what lands now is new anyway.
    assert run((10, "a", 16), (11, "a", 18), (12, "d", 19))[0] == [(11, "a", "a11")]
