"""Extraction from invented shop pages that cover each markup rule and linked-data shape."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfline.functions import html
from shelfline.functions.selectors import attr, cls, tag
from shelfline.operators import detail, discover, listing
from shelfline.plans.refresh import ShopRules, detail_rows, listed_products

def base():
    return F.lit("https://kiln.test")

TOOLS = """<!doctype html><title>Kiln</title><body><p>Clay and glaze</p>
<div class="navbar"><ul><li><a href="/category/am-tra">Ấm trà</a></li><li><a href="/category/gom-su/">Gốm sứ</a></li>
<li><a href="tel:0901">Call</a></li><li><a href="/blog/1">Notes</a></li></ul></div>
<section><div class="product-card is-hot"><div class="title"><a href="https://kiln.test/c/teapot-7?ref=g">Teapot &lt;7&gt;</a></div>
<figure class="product-img"><img src="//cdn.test/t7.png" data-original="/t7-big.png"></figure>
<em class="sale-price">84,500đ</em><del class="regular-price">130,000đ</del>
<p class="star-rating" data-score="3.5">liked by 3 of 4</p><p class="num-reviews">seen 1,208 times</p>
<b class="flag">Mới</b><b class="label">Giảm giá</b><i class="product-code">kn 07</i><u class="stock-status">Pre-order now</u></div>
<div class="product-card"><h2><a href="bowl">Bowl</a></h2><s class="price-old">75</s><span class="price">0 đ</span>
<span class="current-price">62.25</span><div class="stars"><i class="star-filled"></i><i class="star-filled"></i>
<i class="glyphicon-star"></i></div><span class="unavailable"></span></div>
<div class="product-card"><a href="/lost"><i>no</i> lone text</a></div></section>
<div class="page-next">more</div></body>"""

KETTLE = """<html><main class="product-details"><h1>Pot</h1><h1 class="product-name">Cast iron kettle</h1>
<section class="product-content">Holds two litres of water.<script>let n = "<p>"</script></section>
<div class="price-box"><p class="price">1,240,000</p></div><div class="product-price"><p class="old">1,550,000</p></div>
<table><tr><td>Hãng sản xuất</td><td>Foundry</td></tr><tr><td>Code</td><td>ci-2</td></tr><tr><td>alone</td></tr></table>
<div class="product-rating"><i class="fa-star"></i><i class="star filled"></i><i class="fa-star"></i></div>
<span class="total-reviews">58 notes</span><p>open <p>still open
<div class="image-gallery"><img data-src="/k1.jpg"><img src="/k2.jpg"></div><div class="product-images"><img src="/k1.jpg"></div>
<a class="btn-add-cart">take it</a><span class="badge">Bán chạy</span><div class="how-to-use">Rinse, dry.</div></main></html>"""

LINKED = """<html><h1>Shown elsewhere</h1><script type="application/ld+json">[1,</script>
<script type="application/ld+json">[{"@type":"WebSite"},{"@type":"Product","name":"Vase","image":["/v1","/v2","/v3"],
"brand":"Ash","offers":[{"price":"71.75","availability":"https://schema.org/PreOrder"},{"price":"9"}],
"aggregateRating":{"ratingValue":2.25,"reviewCount":"340"},"category":"Decor"}]</script></html>"""

SINGLE = """<html><script type="application/ld+json">{"@type":"Product","name":"Plate","brand":{"name":"Oak"},"image":"/pl",
"offers":{"price":"ask","priceCurrency":"EUR"},"aggregateRating":{"reviewCount":15.2}}</script></html>"""

ITEMS = """<html><script type="application/ld+json">{"itemListElement":["x",{"name":"Cup","image":"/cup",
"offers":[{"price":8}]},{"image":"no name"},{"name":"Jug","url":"https://kiln.test/p/jug","offers":{"price":41}}]}</script></html>"""


def docs(spark, *pages):
    rows = [(i, f"https://kiln.test/page/{i}", html) for i, html in enumerate(pages)]
    return discover.with_document(spark.createDataFrame(rows, "page_id long, url string, html string"))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_text_and_tree(spark):
    page = "<h4>one</h4>two &lt;3 <u>x<h4>y<br>z<style>h4 {}</style><section id='k' class=' a  b '>\t<em>in</em></section></zz>"
    row = one(docs(spark, page).select("doc.text", "doc.nodes"))
    assert row.text == "onetwo <3 xyz in"
    [node] = row.nodes
    assert (node.tag, node.classes, node.attrs["id"]) == ("section", ["a", "b"], "k")
    assert row.text[node.start:node.stop] == " in"

def test_menu(spark):
    found = discover.main_categories(docs(spark, TOOLS), base()).orderBy("pos").collect()
    assert [(r.slug, r.full_url) for r in found] == [
        ("am-tra", "https://kiln.test/category/am-tra"), ("gom-su", "https://kiln.test/category/gom-su/"),
    ]

def test_menu_fallback(spark):
    page = "<a href='/help'>H</a><a href='/products/mugs'>Big Mugs</a><a href='/PRODUCTS/no'>N</a><a href='/c/lids'>Lids</a><a href='/c/none'> </a>"
    rows = discover.main_categories(docs(spark, page), base()).orderBy("pos").collect()
    assert [r.slug for r in rows] == ["big-mugs", "lids"]

def test_cards(spark):
    first, second = listing.listing_products(docs(spark, TOOLS), base(), "page_id").orderBy("pos").collect()
    assert (first["name"], first.slug, first.url) == ("Teapot <7>", "teapot-7", "https://kiln.test/c/teapot-7?ref=g")
    assert (first.price, first.original_price, first.discount_percentage) == (84500.0, 130000.0, 35.0)
    assert (first.rating, first.review_count, first.sku, first.availability) == (3.5, 1208, "kn 07", "Pre-order now")
    assert (first.is_new, first.is_sale, first.is_featured, first.is_bestseller) == (True, True, True, False)
    assert (second["name"], second.slug, second.price, second.original_price) == ("Bowl", "bowl", 62.25, 75.0)
    assert (second.rating, second.availability) == (3.0, "out_of_stock")


def test_wrapped_prices_run_together(spark):
    page = "<div class='product'><h3><a href='/p/w'>Wok</a></h3><p class='product-price'><b class='price-current'>12</b><i class='old-price'>15</i></p></div>"
    row = one(listing.listing_products(docs(spark, page), base()))
    assert (row.price, row.original_price) == (1215.0, 15.0) and row.discount_percentage < 0

def test_price_order_is_a_rule(spark):
    rules = listing.CardRules(prices=(cls("regular-price"),), original_prices=(cls("sale-price"),))
    rows = listing.listing_products(docs(spark, TOOLS), base(), rules=rules).orderBy("pos").collect()
    assert (rows[0].price, rows[0].original_price, rows[1].price) == (130000.0, 84500.0, None)


def test_rules_decide_which_elements_are_listed(spark):
    rules = detail.DetailRules(names=(cls("caption"),), prices=(cls("cost") / tag("span"),))
    page = "<div class='caption'>Long spoon</div><div class='cost'><span>5</span></div>"
    rows = spark.createDataFrame([(1, "https://kiln.test/p/spoon", page)], "page_id long, url string, html string")
    for row in (one(detail.product_detail(discover.with_document(rows, rules), base(), "url", rules=rules)),
                one(detail_rows(rows, ShopRules("https://kiln.test", detail=rules)))):
        assert (row["name"], row.price) == ("Long spoon", 5.0)

def test_listing_linked_data(spark):
    a, b = listing.listing_products(docs(spark, ITEMS), base()).orderBy("pos").collect()
    assert (a["name"], a.price, a.image_url) == ("Cup", None, "/cup")
    assert (b["name"], b.slug, b.price, b.image_url) == ("Jug", "jug", 41.0, None)

def test_next_page(spark):
    flags = docs(spark, TOOLS, KETTLE, "<a rel=next>", "<a rel='next last'>").select(
        "page_id", listing.has_next_page(discover.scope()).alias("n")).orderBy("page_id").collect()
    # The link's whole ``rel`` text must be the word, as an attribute selector has it.
    assert [r.n for r in flags] == [True, False, True, False]

def test_detail_markup(spark):
    r = one(detail.product_detail(docs(spark, KETTLE), base(), "url"))
    assert (r["name"], r.slug, r.description) == ("Cast iron kettle", "0", "Holds two litres of water.")
    assert (r.price, r.original_price, r.discount_percentage) == (1240000.0, 1550000.0, 20.0)
    assert (r.sku, r.brand_name, r.availability) == ("ci-2", "Foundry", "in_stock")
    assert (r.rating, r.review_count, r.image_url) == (3.0, 58, None)
    assert r.images == ["https://kiln.test/k1.jpg", "https://kiln.test/k2.jpg"]
    assert (r.is_bestseller, r.is_new, r.ingredients, r.usage_instructions) == (True, False, None, "Rinse, dry.")

def test_detail_linked_data(spark):
    a, b = detail.product_detail(docs(spark, LINKED, SINGLE), base(), "page_id", "url").orderBy("page_id").collect()
    assert (a["name"], a.brand_name, a.price, a.availability, a.currency) == ("Vase", "Ash", 71.75, "preorder", "VND")
    assert (a.image_url, a.images, a.rating, a.review_count, a.category_name) == (
        "/v1", ["/v1", "/v2", "/v3"], 2.25, 340, "Decor")
    assert (b["name"], b.brand_name, b.price, b.availability, b.currency) == ("Plate", "Oak", None, "", "EUR")
    assert (b.images, b.review_count, b.is_new, b.description) == (["/pl"], 15, None, "")

def test_page_without_product(spark):
    assert detail.product_detail(docs(spark, "<h1>Ab</h1>", ""), base(), "url").count() == 0


def test_selector_steps():
    chain = tag("nav") / cls("menu") / tag("a")
    assert [o["tag"] or o["classes"] for o in chain.rule("f")["outer"]] == [["menu"], "nav"]
    with pytest.raises(ValueError):
        (tag("a") / tag("b") / tag("c") / attr("d")).rule("f")


def card(name):
    return f"<div class='product'><h2><a href='/p/{name}'>{name}</a></h2></div>"


def test_listing_walk_stops_at_gap_and_end(spark):
    more = "<a class='next'></a>"
    pages = [
        ("https://s/c/a", card("a1") + card("a2") + more), ("https://s/c/a?page=2", card("a3") + more),
        ("https://s/c/a?page=4", card("a4") + more),
        ("https://s/c/b?x=1", card("b1") + more), ("https://s/c/b?x=1&page=2", "<p>empty</p>"),
        ("https://s/c/b?x=1&page=3", card("b3")),
        ("https://s/c/d", card("d1")), ("https://s/c/d?page=2", card("d2")), ("https://s/other", card("o")),
    ]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    targets = spark.createDataFrame([("https://s/c/a",), ("https://s/c/b?x=1",), ("https://s/c/d",)], "listing_url string")
    rules = ShopRules("https://s")
    names = lambda rows: sorted(r["name"] for r in rows.select("name").collect())
    assert names(listed_products(df, targets, rules)) == ["a1", "a2", "a3", "b1", "d1"]
    assert names(listed_products(df, targets, rules, max_pages=1)) == ["a1", "a2", "b1", "d1"]


def test_documents_leave_the_worker_a_few_pages_at_a_time(spark, monkeypatch):
    small, large = "<p class='x'>a</p>", "<p class='x'>" + "b" * html.PIECE_BYTES + "</p>"
    markup = pa.array([small] * 300 + [large, None, ""] + [large] * 2)
    pieces = list(html._pieces(markup))
    assert [at for at, _ in pieces] == [0, *[at + n for at, n in pieces[:-1]]] and sum(n for _, n in pieces) == len(markup)
    assert all(n <= html.PIECE_PAGES for _, n in pieces) and pieces[-1] == (304, 1)
    monkeypatch.setattr(html, "PIECE_PAGES", 2)
    rows = spark.createDataFrame([(i, h) for i, h in enumerate([TOOLS, None, "", KETTLE, LINKED])], "page_id long, html string")
    parsed = html.parse_pages(rows.coalesce(1))
    assert "MapInArrow" in parsed._jdf.queryExecution().toString()
    whole = rows.select("page_id", html.parse_page(F.col("html")).alias("doc"))
    assert sorted(parsed.collect()) == sorted(whole.collect())
