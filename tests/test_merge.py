"""Bulk merges against a row-by-row model of the same rules, on random batches."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from shelfline import session
from shelfline.functions.joins import join_unique
from shelfline.operators import identity, merge
from shelfline.plans import refresh
from shelfline.schemas import BRAND, CATEGORY, NORMALIZED_PRODUCT, PRODUCT, PRODUCT_DEFAULTS, TABLES
from shelfline.session import stage
from shelfline.sources.catalog import Snapshot
from shelfline.workload import queries

OLD, NOW = datetime(2020, 1, 1), datetime(2024, 1, 1)
TEXTS = ("description", "sku", "availability", "image_url", "ingredients", "usage_instructions")
FLAGS = ("is_featured", "is_bestseller", "is_new", "is_sale")


def to_slug(name):
    return name.lower().replace(" ", "-")


def random_batch(rng, n):
    rows = []
    for pos in range(n):
        slug = rng.choice(["hot"] * 4 + [f"p{i}" for i in range(12)])
        rows.append({
            "pos": pos, "name": f"n{pos}", "slug": slug, "url": f"/{rng.randint(0, 3)}/{slug}",
            "price": rng.choice([None, 1.0, 2.0, 3.0]), "original_price": rng.choice([None, 9.0]),
            "discount_percentage": None, "rating": rng.choice([None, 4.0]), "review_count": rng.randint(0, 9),
            "images": rng.choice([[], ["/a"]]),
            "category_name": rng.choice(["", "", "Cat A", "cat a", "Cat B"]),
            "brand_name": rng.choice(["", "Brand X", "BRAND X"]),
            **{t: rng.choice(["", f"{t}{pos}"]) for t in TEXTS}, **{f: rng.random() < 0.5 for f in FLAGS},
        })
    return rows


def upsert_one_by_one(products, categories, brands, batch):
    """Dicts by slug, changed in place; returns what became of the rows."""
    stats = {"total": len(batch), "created": 0, "updated": 0, "errors": 0}

    def resolve(table, name):
        for slug, row in table.items():
            if row["name"] == name:
                return slug
        table[to_slug(name)] = {"name": name}
        return to_slug(name)

    for row in batch:
        brand = resolve(brands, row["brand_name"]) if row["brand_name"] else None
        category = resolve(categories, row["category_name"]) if row["category_name"] else None
        values = {k: v for k, v in row.items() if k not in ("pos", "slug", "category_name", "brand_name")}
        old = products.get(row["slug"])
        if old is None and category is None:
            stats["errors"] += 1
            continue
        if old is None:
            products[row["slug"]] = {**values, "category_slug": category, "brand_slug": brand,
                                     "created_at": NOW, "updated_at": NOW}
            stats["created"] += 1
            continue
        old.update({k: v for k, v in values.items() if v is not None})
        old["category_slug"] = category or old["category_slug"]
        old["brand_slug"] = brand or old["brand_slug"]
        old["updated_at"] = NOW
        stats["updated"] += 1
    return stats


BATCH = (
    "pos long, name string, slug string, url string, price double, original_price double, discount_percentage double,"
    "rating double, review_count long, images array<string>, category_name string, brand_name string,"
    + ",".join(f"{t} string" for t in TEXTS) + "," + ",".join(f"{f} boolean" for f in FLAGS)
)


def stored_product(slug):
    return {"name": f"old {slug}", "url": f"/0/{slug}", "price": 7.0, "original_price": None, "discount_percentage": None,
            "rating": None, "review_count": 1, "images": ["/old"], "category_slug": "cat-b", "brand_slug": None,
            "created_at": OLD, "updated_at": OLD, **{t: "old" for t in TEXTS}, **{f: False for f in FLAGS}}


@pytest.mark.parametrize("seed,sparse", [
    (0, merge.SPARSE_PRODUCT_COLUMNS), (1, merge.SPARSE_PRODUCT_COLUMNS), (2, None),
])
def test_products_like_single_upserts(spark, seed, sparse):
    rng = random.Random(seed)
    batch = random_batch(rng, 60)
    products = {s: stored_product(s) for s in ("p0", "p1", "far")}
    categories, brands = {"cat-b": {"name": "Cat B"}}, {}
    frame = lambda rows, schema: spark.createDataFrame(
        [tuple(r[f.name] for f in schema) for r in rows], schema)
    current = frame([{**v, "slug": k} for k, v in products.items()], PRODUCT)
    cats = frame([{"name": "Cat B", "slug": "cat-b", "url": "/c", "parent_slug": None, "description": "",
                   "created_at": OLD, "updated_at": OLD}], CATEGORY)
    rows = spark.createDataFrame([tuple(r[c.split()[0]] for c in BATCH.split(",")) for r in batch], BATCH)
    sparse = sparse or [c for c in rows.columns if c not in ("pos", "slug", "category_name", "brand_name", "name")]
    out = merge.merge_products(current, cats, spark.createDataFrame([], BRAND), rows.repartition(5),
                               F.lit(NOW), sparse=sparse)
    stats = upsert_one_by_one(products, categories, brands, batch)
    got = {r.slug: {k: v for k, v in r.asDict().items() if k not in ("slug", "change")}
           for r in out.products.rows.collect()}
    assert got == products
    assert out.stats().first().asDict() == stats
    assert out.rejects.count() == stats["errors"]
    assert {r.slug: r["name"] for r in out.categories.table.collect()} == {k: v["name"] for k, v in categories.items()}
    assert {r.slug: r["name"] for r in out.brands.table.collect()} == {k: v["name"] for k, v in brands.items()}


def test_products_are_dealt_out_by_slug_alone(spark):
    batch = random_batch(random.Random(3), 20)
    rows = spark.createDataFrame([tuple(r[c.split()[0]] for c in BATCH.split(",")) for r in batch], BATCH)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = merge.merge_products(spark.createDataFrame([], PRODUCT), spark.createDataFrame([], CATEGORY),
                                   spark.createDataFrame([], BRAND), rows, F.lit(NOW))
        plan = out.products.rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Neither by the few names of categories and brands, nor once more after the batch is collapsed.
    assert re.findall(r"hashpartitioning\((\w+?)#", plan) == ["slug", "slug"]


def test_dimension_policy_and_parents(spark):
    cats = spark.createDataFrame([("Root", "root", "/r", None, "d", OLD, OLD)], CATEGORY)
    feed = spark.createDataFrame([
        (1, "Late", "late", "/l", "", "soon"), (2, "Soon", "soon", "/s", "", "root"),
        (3, "Kid", "kid", "/k", "", "soon"), (4, "", "root", "/r2", "", "kid"), (5, "Kid 2", "kid", "", "x", "root"),
    ], "pos int, name string, slug string, url string, description string, parent_slug string")
    rows = {r.slug: r for r in merge.merge_dimension(cats, feed, F.lit(NOW)).rows.collect()}
    assert rows["late"].parent_slug is None and rows["kid"].parent_slug == "soon"
    assert (rows["root"]["name"], rows["root"].url, rows["root"].parent_slug) == ("Root", "/r2", None)
    assert (rows["kid"]["name"], rows["kid"].url, rows["kid"].description) == ("Kid 2", "/k", "x")
    assert (rows["root"].change, rows["kid"].change) == ("updated", "created")


def test_identity(spark):
    current = spark.createDataFrame([("a", "/a"), ("b", "/b")], "slug string, url string")
    batch = spark.createDataFrame([
        (1, "a", "/a"), (2, "new", "/new"), (3, "b2", "/b"), (4, "a", "/b"), (5, "c", "/x"), (6, "d", "/x"),
    ], "pos int, slug string, url string")
    clear, failed = merge.resolve_identity(current, batch)
    assert sorted((r.pos, r.slug) for r in clear.collect()) == [(1, "a"), (2, "new"), (3, "b"), (5, "c"), (6, "c")]
    assert [(r.pos, r.slug, r.reason) for r in failed.collect()] == [(4, "a", "url_conflict")]


def identities_one_by_one(stored, batch):
    """What single writes in order do: (pos, target, reason)."""
    url_of = dict(stored)
    out = []
    for pos, slug, url, category in batch:
        owner = min((s for s, u in url_of.items() if u == url), default=None)
        if slug in url_of:
            if owner not in (None, slug):
                out.append((pos, slug, "url_conflict"))
                continue
            url_of[slug] = url
            out.append((pos, slug, None))
        elif owner is not None:
            out.append((pos, owner, None))
        elif category:
            url_of[slug] = url
            out.append((pos, slug, None))
        else:
            out.append((pos, None, "missing_category"))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_identity_like_single_writes(spark, seed):
    rng = random.Random(seed)
    wide = rng.choice([4, 15, 60])
    slugs, urls = [f"s{i}" for i in range(wide)], [f"/u{i}" for i in range(wide)]
    stored = [(s, urls[i]) for i, s in enumerate(slugs) if rng.random() < 0.4]
    if seed == 0:
        stored.append(("zz", stored[0][1]))  # an address that is not unique
    batch = [(i, rng.choice(slugs), rng.choice(urls), rng.choice(["", "C"])) for i in range(80)]
    batch += [(100 + i, f"own{i}", f"/own{i}", rng.choice(["", "C"])) for i in range(20)]
    current = spark.createDataFrame(stored, "slug string, url string")
    rows = spark.createDataFrame(batch, "pos int, slug string, url string, category_name string").repartition(5)
    clear, failed = merge.resolve_identity(current, rows)
    got = {r.pos: (r.slug, None) for r in clear.collect()} | {r.pos: (None, r.reason) for r in failed.collect()}
    assert len(got) == len(batch)
    for pos, target, reason in identities_one_by_one(stored, batch):
        _, slug, _, category = batch[pos] if pos < 100 else batch[80 + pos - 100]
        if got[pos] == (slug, None) and reason == "missing_category":
            continue  # the merge itself refuses rows before the first with a category
        if reason == "missing_category" and got[pos][1] is None and not category:
            continue  # likewise, under the slug that is created later
        assert got[pos] == ((target, None) if reason is None else (None, reason)), (pos, slug)


def test_one_slug_with_a_third_of_the_rows(spark):
    """Every task gets a share of a hot slug, address and rejected row; no row is lost."""
    feed = spark.range(30_000).selectExpr(
        "id AS pos", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id % 5000) END AS slug",
        "CASE WHEN id % 3 = 0 THEN '/hot' ELSE concat('/p', id % 5000) END AS url", "'' AS category_name")
    clear, failed = merge.resolve_identity(spark.createDataFrame([("hot", "/old")], "slug string, url string"), feed)
    assert failed.count() == 0 and clear.where("slug = 'hot'").count() == 10_000 and clear.count() == 30_000
    classes = feed.groupBy("slug").agg(F.count("*").alias("n_rows"), F.min("pos").alias("first"))
    plan = join_unique(feed, classes, ["slug"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2
    joined = join_unique(feed, classes, ["slug"])
    assert joined.count() == 30_000 and joined.where("first > pos").count() == 0


@pytest.mark.parametrize("few", [100_000, 1, 0])
def test_rows_that_keep_their_slug_stay_where_they_are(spark, monkeypatch, few):
    monkeypatch.setattr(identity, "FEW_MOVES", few)
    current = spark.createDataFrame([("a", "/a"), ("b", "/b")], "slug string, url string")
    kept = [(1, "a", "/a"), (2, "a", "/a2"), (3, "new", "/new"), (4, None, "/a"), (5, "b", None)]
    schema = "pos int, slug string, url string"
    clear, failed = merge.resolve_identity(current, spark.createDataFrame(kept, schema), staged=True)
    assert sorted(map(tuple, clear.collect())) == kept and failed.isEmpty()
    assert "Join" not in clear._jdf.queryExecution().optimizedPlan().toString()
    moved = kept + [(6, "b2", "/b"), (7, "b3", "/b")]
    clear, failed = merge.resolve_identity(current, spark.createDataFrame(moved, schema), staged=True)
    assert sorted(map(tuple, clear.collect())) == kept + [(6, "b", "/b"), (7, "b", "/b")] and failed.isEmpty()


def test_the_batch_is_written_once(spark, monkeypatch):
    wide = []
    monkeypatch.setattr(refresh, "stage", lambda df: wide.append(df) or stage(df))
    empty = Snapshot(*[spark.createDataFrame([], t) for t in TABLES.values()])
    raw = spark.createDataFrame([(1, "A", "a", "/a", "C"), (2, "", "b", "/b", "C"), (3, "A2", "a", "/a", "")],
                                "pos int, name string, slug string, url string, category_name string")
    out, bad = refresh.process_batch(empty, empty.categories, raw, F.lit(NOW))
    assert [(r.slug, r["name"]) for r in out.products.rows.collect()] == [("a", "A2")]
    assert [(r.pos, r.reason) for r in bad.collect()] == [(2, "Missing required field: name")]
    assert len(wide) == 1 and out.batch.columns == ["pos", *NORMALIZED_PRODUCT]


def test_an_address_that_two_stored_rows_have(spark):
    current = spark.createDataFrame([("a", "/u"), ("b", "/u")], "slug string, url string")
    rows = spark.createDataFrame([(1, "n", "/u"), (2, "a", "/u"), (3, "b", "/u"), (4, "b", "/v"), (5, "m", "/u")],
                                 "pos int, slug string, url string")
    clear, failed = merge.resolve_identity(current, rows)
    assert sorted((r.pos, r.slug) for r in clear.collect()) == [(1, "a"), (2, "a"), (4, "b"), (5, "a")]
    assert [(r.pos, r.reason) for r in failed.collect()] == [(3, "url_conflict")]
    assert sorted((r.pos, r.match_slug) for r in merge.match_slug_or_url(current, rows).collect()) == [
        (1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "a")]


def test_a_null_never_hides_an_earlier_value(spark):
    """Whatever column it is in: the latest value that is not NULL counts, as in single writes."""
    rng = random.Random(5)
    batch = random_batch(rng, 60)
    for row in batch:
        for c in ("name", "url", "review_count", "images", *TEXTS, *FLAGS):
            if rng.random() < 0.4:
                row[c] = None
    products = {s: stored_product(s) for s in ("p0", "p1", "hot")}
    frame = lambda rows, schema: spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)
    current = frame([{**v, "slug": k} for k, v in products.items()], PRODUCT)
    cats = frame([{"name": "Cat B", "slug": "cat-b", "url": "/c", "parent_slug": None, "description": "",
                   "created_at": OLD, "updated_at": OLD}], CATEGORY)
    rows = spark.createDataFrame([tuple(r[c.split()[0]] for c in BATCH.split(",")) for r in batch], BATCH)
    out = merge.merge_products(current, cats, spark.createDataFrame([], BRAND), rows.repartition(5), F.lit(NOW))
    upsert_one_by_one(products, {"cat-b": {"name": "Cat B"}}, {}, batch)
    defaults = {**PRODUCT_DEFAULTS, "images": []}
    want = {s: {k: defaults.get(k) if v is None else v for k, v in row.items()} for s, row in products.items()}
    got = {r.slug: {k: v for k, v in r.asDict().items() if k not in ("slug", "change")} for r in out.products.rows.collect()}
    assert got == want


def test_wide_rows_laid_out_by_slug_are_not_shuffled(spark, monkeypatch):
    """Neither the batch nor a current table that lies by slug goes through an exchange; the outcome is that of single writes."""
    batch = random_batch(random.Random(7), 400)  # a third of it is one slug
    products = {s: stored_product(s) for s in ("p0", "p1", "far")}
    frame = lambda rows, schema: spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)
    current = frame([{**v, "slug": k} for k, v in products.items()], PRODUCT)
    cats = frame([{"name": "Cat B", "slug": "cat-b", "url": "/c", "parent_slug": None, "description": "",
                   "created_at": OLD, "updated_at": OLD}], CATEGORY)
    brands = spark.createDataFrame([], BRAND)
    rows = spark.createDataFrame([tuple(r[c.split()[0]] for c in BATCH.split(",")) for r in batch], BATCH)
    stats = upsert_one_by_one(products, {"cat-b": {"name": "Cat B"}}, {}, batch)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for few in (20, 0):  # with hot slugs, and as if no slug were hot
            monkeypatch.setattr(session, "FEW_ROWS", few)
            laid, stored = session.lay_out(rows, "slug"), session.lay_out(current, "slug").rows
            if few:
                assert "hot" in [r.slug for r in laid.hot.collect()]
            else:
                laid.__dict__["hot"] = None
            out = merge.merge_products(stored, cats, brands, laid, F.lit(NOW))
            plan = out.products.rows._jdf.queryExecution().executedPlan().toString()
            got = {r.slug: {k: v for k, v in r.asDict().items() if k not in ("slug", "change")}
                   for r in out.products.rows.collect()}
            assert got == products
            assert out.stats().first().asDict() == stats and out.rejects.count() == stats["errors"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning" not in plan


def test_identity_of_a_batch_laid_out_by_slug_and_address(spark, monkeypatch):
    """The same outcome, and the batch itself meets what is found without an exchange."""
    monkeypatch.setattr(session, "FEW_ROWS", 0)
    monkeypatch.setattr(identity, "FEW_MOVES", 0)
    rng = random.Random(11)
    stored = [(f"s{i}", f"/u{i}") for i in range(6)]
    batch = [(i, f"s{rng.randint(0, 9)}", f"/u{rng.randint(0, 9)}", rng.choice(["", "C"])) for i in range(60)]
    batch += [(100 + i, f"x{i}", f"/x{i % 3}", "C") for i in range(9)]  # settled by joins: one address each
    current = spark.createDataFrame(stored, "slug string, url string")
    rows = spark.createDataFrame(batch, "pos int, slug string, url string, category_name string")
    laid = session.lay_out(rows, "slug", "url")
    laid.__dict__["hot"] = None
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        both = [merge.resolve_identity(current, x) for x in (rows, laid)]
        told = both[1][0].where("pos >= 100")
        plan = told._jdf.queryExecution().optimizedPlan().toString()
        (was, lost), (now, gone) = [[sorted(map(tuple, f.collect())) for f in x] for x in both]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert (now, gone) == (was, lost) and len(now) + len(gone) == len(batch)
    assert "laid_" in plan
    with pytest.raises(ValueError):
        merge.resolve_identity(current, session.lay_out(rows, "slug"))


def test_components_of_any_shape_take_few_rounds(spark, monkeypatch):
    """A path in order of its names, a star, a loop and a pair: one root for each."""
    mix = lambda n: (n * 0x9E3779B97F4A7C15 + 12345) % (1 << 63)
    path = [(mix(i), mix(i + 1)) for i in range(200)]
    star = [(mix(1000), mix(1001 + i)) for i in range(50)]
    edges = path + star + [(mix(2000), mix(2000)), (mix(3000), mix(3001)), (mix(3001), mix(3000))]
    written = []
    monkeypatch.setattr(identity, "stage", lambda df: written.append(df) or stage(df))
    found = identity.components(spark.createDataFrame(edges, "a long, b long").repartition(3))
    roots = {r.node: r.root for r in found.collect()}
    assert set(roots) == {n for e in edges for n in e}
    assert all(roots[a] == roots[b] for a, b in edges) and len(set(roots.values())) == 4
    assert len(written) <= 2 * 12 + 1  # two tables a round
    alone = identity.components(spark.createDataFrame([(5, 5)], "a long, b long"))
    assert [tuple(r) for r in alone.collect()] == [(5, 5)]


def test_the_second_run_uses_the_batch_of_the_first(spark, monkeypatch):
    asked, feed = [], queries.t.change_batch
    monkeypatch.setattr(queries.t, "change_batch", lambda *a: asked.append(a) or feed(*a))
    out = queries.merge_idempotent(spark, SMALL)
    assert len(asked) == 1 and out.where("change = 'created'").isEmpty() and not out.isEmpty()
