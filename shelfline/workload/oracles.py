"""SQL counterparts of the registered queries, written against the given tables only."""

from __future__ import annotations

# Common table expressions ---------------------------------------------------------------

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
STRIP = f"'^[{WS}]+|[{WS}]+$', '', 'g'"
FOLD_FROM = "áàảãạăắằẳẵặâấầẩẫậéèẻẽẹêếềểễệíìỉĩịóòỏõọôốồổỗộơớờởỡợúùủũụưứừửữựýỳỷỹỵđ"
FOLD_TO = "aaaaaaaaaaaaaaaaaeeeeeeeeeeeiiiiiooooooooooooooooouuuuuuuuuuuyyyyyd"
CREATED = "TIMESTAMP '2020-01-01 00:00:00'"
NOW = "TIMESTAMP '2024-02-01 00:00:00'"
CUT = "TIMESTAMP '1999-01-01 00:00:00'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {STRIP})"


def slug(x: str) -> str:
    """Slug of a text that is not empty."""
    clean = f"regexp_replace(translate(lower({x}), '{FOLD_FROM}', '{FOLD_TO}'), '[^\\p{{L}}\\p{{N}}_{WS}-]', '', 'g')"
    return f"coalesce(nullif(trim(regexp_replace({clean}, '[{WS}-]+', '-', 'g'), '-'), ''), 'unknown')"


def entities(x: str) -> str:
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"),
                       ("nbsp", " "), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def clean(x: str) -> str:
    collapsed = f"regexp_replace({strip(x)}, '[{WS}]+', ' ', 'g')"
    untagged = f"regexp_replace({collapsed}, '<[^>]+>', '', 'g')"
    return strip(entities(untagged))


CATS = f"""cats AS (
  SELECT r_name AS name, replace(lower(r_name), ' ', '-') AS slug, NULL::VARCHAR AS parent_slug FROM region
  UNION ALL
  SELECT n_name, lower(n_name), replace(lower(r_name), ' ', '-') FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT DISTINCT n_name || ' ' || c_mktsegment, lower(n_name) || '-' || lower(c_mktsegment), lower(n_name)
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

BRANDS = "brands AS (SELECT DISTINCT p_brand AS name, lower(replace(p_brand, '#', '')) AS slug FROM part)"

PRODS = f"""prods AS (
  SELECT p_name || ' ' || p_partkey AS name, replace(p_name, ' ', '-') || '-' || p_partkey AS slug,
    p_type || '''s ' || p_brand AS description, p_retailprice AS price,
    CASE WHEN p_size > 25 THEN p_retailprice * 2 END AS original_price,
    'SKU-' || p_partkey AS sku, CASE WHEN p_size > 5 THEN 'in_stock' ELSE 'out_of_stock' END AS availability,
    CASE WHEN p_size % 7 <> 0 THEN p_size / 10.0::DOUBLE END AS rating, p_size AS review_count,
    CASE WHEN p_type = 'PROMO' THEN '' ELSE '/i/' || replace(p_name, ' ', '-') || '-' || p_partkey || '.jpg' END AS image_url,
    'nation_' || (p_size % 25) || CASE WHEN p_type = 'ECONOMY' THEN '' ELSE '-' ||
      (['automobile', 'building', 'furniture', 'household', 'machinery'])[p_partkey % 5 + 1] END AS category_slug,
    lower(replace(p_brand, '#', '')) AS brand_slug, p_type = 'PROMO' AS is_new, p_size > 25 AS is_sale,
    {CREATED} + p_size * INTERVAL 1 DAY AS updated_at, p_partkey, p_type, p_size, p_name, p_brand, p_retailprice
  FROM part)"""

TREE = """tree(root, slug, depth) AS (
  SELECT slug, slug, 0 FROM cats
  UNION ALL
  SELECT t.root, c.slug, t.depth + 1 FROM tree t JOIN cats c ON c.parent_slug = t.slug)"""

OFFERS = """offers AS (
  SELECT strftime(l_shipdate, '%Y%m%d') || '-' || lpad(l_orderkey::VARCHAR, 12, '0') || '-' || lpad(l_linenumber::VARCHAR, 3, '0')
      || '-' || lpad(l_partkey::VARCHAR, 12, '0') || '-' || lpad(l_suppkey::VARCHAR, 12, '0') AS pos,
    l_shipdate AS shipped, p_name || ' ' || l_orderkey AS name, 'p' || l_partkey || '-s' || l_suppkey AS slug,
    '/offers/p' || l_partkey || '-s' || l_suppkey AS url, p_type || ' ' || l_linenumber AS description,
    CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'F') THEN l_extendedprice END AS price,
    CASE WHEN l_discount > 0 THEN l_extendedprice + 1000 END AS original_price,
    CASE WHEN l_discount > 0.02::DOUBLE THEN l_discount * 100 END AS discount_percentage,
    'SKU-' || l_partkey AS sku, CASE WHEN l_linestatus = 'O' THEN 'in_stock' ELSE 'out_of_stock' END AS availability,
    CASE WHEN l_tax > 0 THEN l_tax * 50 END AS rating, l_quantity::BIGINT AS review_count,
    '/i/p' || l_partkey || '-s' || l_suppkey AS image_url,
    '/i/p' || l_partkey || '-s' || l_suppkey || '|/i/p' || l_partkey || '-s' || l_suppkey || '-' || l_linenumber AS images,
    CASE WHEN l_returnflag = 'A' THEN '' WHEN l_quantity > 45 THEN n_name || ' Special' ELSE n_name END AS category_name,
    CASE WHEN l_quantity < 3 THEN p_brand || ' Mini' WHEN l_linenumber = 7 THEN upper(p_brand) ELSE p_brand END AS brand_name,
    l_quantity > 45 AS is_bestseller, l_linestatus = 'O' AS is_new, l_discount > 0.05::DOUBLE AS is_sale
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey)"""

STORED = f"""batch AS (SELECT * FROM offers WHERE shipped >= {CUT}),
latest AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY pos DESC) AS rn FROM offers WHERE shipped < {CUT}),
stored AS (SELECT * EXCLUDE (rn, category_name, brand_name),
    CASE WHEN category_name = '' THEN 'unsorted' ELSE lower(replace(category_name, ' Special', '')) END AS category_slug,
    lower(replace(replace(brand_name, ' Mini', ''), '#', '')) AS brand_slug
  FROM latest WHERE rn = 1)"""

# What each batch row may do, what each slug ends up with.
MERGE = f"""{OFFERS}, {STORED}, {CATS}, {BRANDS},
valid_from AS (SELECT b.slug, min(CASE WHEN category_name <> '' THEN b.pos END) AS vf,
    bool_or(s.slug IS NOT NULL) AS known FROM batch b LEFT JOIN stored s ON b.slug = s.slug GROUP BY b.slug),
judged AS (SELECT b.*, known, (known OR coalesce(pos >= vf, false)) AS accepted FROM batch b JOIN valid_from USING (slug)),
cat_names AS (SELECT category_name AS name, max(pos) AS last_pos FROM batch WHERE category_name <> '' GROUP BY 1),
cat_of AS (SELECT n.name, n.last_pos, coalesce(c.slug, replace(lower(n.name), ' ', '-')) AS slug FROM cat_names n LEFT JOIN cats c USING (name)),
brand_names AS (SELECT brand_name AS name, max(pos) AS last_pos FROM batch GROUP BY 1),
brand_of AS (SELECT n.name, n.last_pos, coalesce(b.slug, replace(replace(lower(n.name), '#', ''), ' ', '-')) AS slug FROM brand_names n LEFT JOIN brands b USING (name)),
news AS (SELECT slug, arg_max(name, pos) AS name, arg_max(url, pos) AS url, arg_max(description, pos) AS description,
    arg_max(price, pos) FILTER (price IS NOT NULL) AS price,
    arg_max(original_price, pos) FILTER (original_price IS NOT NULL) AS original_price,
    arg_max(discount_percentage, pos) FILTER (discount_percentage IS NOT NULL) AS discount_percentage,
    arg_max(sku, pos) AS sku, arg_max(availability, pos) AS availability,
    arg_max(rating, pos) FILTER (rating IS NOT NULL) AS rating, arg_max(review_count, pos) AS review_count,
    arg_max(image_url, pos) AS image_url, arg_max(images, pos) AS images,
    arg_max(category_name, pos) FILTER (category_name <> '') AS category_name, arg_max(brand_name, pos) AS brand_name,
    arg_max(is_bestseller, pos) AS is_bestseller, arg_max(is_new, pos) AS is_new, arg_max(is_sale, pos) AS is_sale
  FROM judged WHERE accepted GROUP BY slug),
placed AS (SELECT n.*, c.slug AS category_slug, b.slug AS brand_slug FROM news n
  LEFT JOIN cat_of c ON n.category_name = c.name LEFT JOIN brand_of b ON n.brand_name = b.name),
merged AS (SELECT coalesce(s.slug, n.slug) AS slug, coalesce(n.name, s.name) AS name, coalesce(n.url, s.url) AS url,
    coalesce(n.description, s.description) AS description, coalesce(n.price, s.price) AS price,
    coalesce(n.original_price, s.original_price) AS original_price,
    coalesce(n.discount_percentage, s.discount_percentage) AS discount_percentage,
    coalesce(n.sku, s.sku) AS sku, coalesce(n.availability, s.availability) AS availability,
    coalesce(n.rating, s.rating) AS rating, coalesce(n.review_count, s.review_count) AS review_count,
    coalesce(n.image_url, s.image_url) AS image_url, coalesce(n.images, s.images) AS images,
    coalesce(n.category_slug, s.category_slug) AS category_slug, coalesce(n.brand_slug, s.brand_slug) AS brand_slug,
    coalesce(n.is_bestseller, s.is_bestseller) AS is_bestseller, coalesce(n.is_new, s.is_new) AS is_new,
    coalesce(n.is_sale, s.is_sale) AS is_sale,
    CASE WHEN s.slug IS NULL THEN {NOW} ELSE {CREATED} END AS created_at,
    CASE WHEN n.slug IS NULL THEN {CREATED} ELSE {NOW} END AS updated_at,
    CASE WHEN s.slug IS NULL THEN 'created' WHEN n.slug IS NULL THEN 'untouched' ELSE 'updated' END AS change
  FROM stored s FULL JOIN placed n ON s.slug = n.slug)"""

LINKS = """links AS (
  SELECT page_id, url AS page_url, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
    unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS text,
    generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1), 1) - 1 AS pos
  FROM pages)"""

SKIPPED = " OR ".join(f"contains(lower(href), '{p}')" for p in (
    "javascript:", "mailto:", "tel:", "#", "/search", "/contact", "/about", "/blog", "/news"))
NAV = f"""{LINKS}, nav AS (
  SELECT page_id, pos, trim(text) AS name, {slug('trim(text)')} AS slug, href AS url,
    regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1) || href AS full_url, href
  FROM links WHERE href <> '' AND trim(text) <> '' AND length(trim(text)) <= 200 AND NOT ({SKIPPED})),
firsts AS (SELECT * FROM nav QUALIFY row_number() OVER (PARTITION BY slug ORDER BY page_id, pos) = 1)"""

FORMS = """forms AS (
  SELECT page_id, url, unnest([url, regexp_replace(url, '^https?://', ''), regexp_replace(url, '^https?://[^/]*', ''),
      regexp_replace(url, '^https?:', '')]) AS c, unnest([0, 1, 2, 3]) AS form FROM pages)"""

TITLE = entities("regexp_extract(html, '<h1>(.*?)</h1>', 1)")

SHOP = """shop AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, n_name, (p_partkey % 25)::INT AS k,
    (p_partkey // 25 // 20 + 1)::INT AS page_no, (p_partkey // 25 % 20)::INT AS spot,
    replace(p_name, ' ', '-') || '-' || p_partkey AS p_slug,
    'https://shop.example/products/' || replace(p_name, ' ', '-') || '-' || p_partkey AS p_url,
    CASE WHEN p_size > 25 THEN round(p_retailprice + 100, 2) END AS old_price,
    CASE WHEN p_size > 5 THEN 'in_stock' ELSE 'out_of_stock' END AS stock
  FROM part JOIN nation ON p_partkey % 25 = n_nationkey)"""

CARDS = f"""{SHOP}, cards AS (
  SELECT page_no::BIGINT * 1000 + k + 1000000000000 AS page_id, spot AS pos, p_name || ' & ' || p_partkey AS name,
    p_url AS url, p_slug AS slug, p_retailprice AS price, old_price AS original_price,
    round((old_price - p_retailprice) / old_price * 100, 2) AS discount_percentage,
    'https://shop.example/i/' || p_partkey || '.jpg' AS image_url,
    CASE WHEN p_size % 7 <> 0 THEN p_size / 10.0::DOUBLE END AS rating, p_size * 100 AS review_count,
    'sku ' || p_partkey AS sku, CASE WHEN p_size > 5 THEN 'Còn hàng' ELSE 'out_of_stock' END AS availability,
    false AS is_featured, false AS is_bestseller, p_type = 'PROMO' AS is_new, p_size > 25 AS is_sale, shop.* EXCLUDE (spot)
  FROM shop)"""

DETAILS = f"""{SHOP}, details AS (
  SELECT p_partkey AS page_id, p_url AS url, p_slug AS slug, p_type,
    CASE WHEN p_type = 'SMALL' THEN p_name || ' no. ' || p_partkey ELSE p_name || ' #' || p_partkey END AS name,
    CASE WHEN p_type = 'SMALL' THEN 'A text on ' || p_name ELSE 'About "' || p_name || '"' END AS description,
    p_retailprice AS price, CASE WHEN p_type = 'SMALL' THEN round(p_retailprice + 100, 2) END AS original_price,
    CASE WHEN p_type = 'SMALL' THEN round((round(p_retailprice + 100, 2) - p_retailprice) / round(p_retailprice + 100, 2) * 100, 2) END AS discount_percentage,
    CASE WHEN p_type = 'SMALL' THEN 'T-' ELSE 'ld-' END || p_partkey AS sku, p_brand AS brand_name,
    CASE WHEN p_type IN ('STANDARD', 'MEDIUM', 'ECONOMY') THEN n_name END AS category_name,
    CASE WHEN p_type = 'SMALL' THEN stock WHEN p_size > 5 THEN 'instock' ELSE 'outofstock' END AS availability,
    CASE WHEN p_type = 'SMALL' THEN 2.0 WHEN p_type IN ('STANDARD', 'MEDIUM') THEN p_size / 10.0::DOUBLE END AS rating,
    CASE WHEN p_type IN ('STANDARD', 'MEDIUM') THEN p_size END AS review_count,
    CASE WHEN p_type = 'SMALL' THEN 'Aqua, SMALL' END AS ingredients,
    CASE WHEN p_type <> 'PROMO' THEN 'https://shop.example/i/' || p_partkey || '.jpg' END AS image_url,
    CASE WHEN p_type = 'SMALL' THEN 'https://shop.example/i/' || p_partkey || '.jpg|https://shop.example/i/' || p_partkey || '-2.jpg'
      WHEN p_type IN ('STANDARD', 'MEDIUM') THEN 'https://shop.example/i/' || p_partkey || '.jpg|https://shop.example/i/' || p_partkey || '.jpg?2'
      WHEN p_type = 'ECONOMY' THEN 'https://shop.example/i/' || p_partkey || '.jpg' END AS images,
    CASE WHEN p_type = 'SMALL' THEN true END AS is_bestseller, stock, k, p_size, n_name, old_price, p_name, p_partkey
  FROM shop WHERE p_type <> 'LARGE')"""

STOCK_TEXT = """CASE l_returnflag || l_linestatus WHEN 'RO' THEN ' Còn hàng ' WHEN 'AO' THEN 'currently unavailable'
  WHEN 'NF' THEN 'Hết hàng rồi' WHEN 'AF' THEN 'LimitedAvailability' WHEN 'NO' THEN 'PreOrder' ELSE '' END"""
STOCK = """CASE l_returnflag || l_linestatus WHEN 'RO' THEN 'in_stock' WHEN 'AO' THEN 'in_stock'
  WHEN 'NF' THEN 'out_of_stock' WHEN 'AF' THEN 'unknown' WHEN 'NO' THEN 'pre_order' ELSE 'unknown' END"""

FEED = f"""feed AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS pos,
    CASE WHEN l_quantity = 1 THEN '' ELSE p_name || ' & Co' END AS name,
    replace(p_name, ' ', '-') || '-' || l_partkey AS slug,
    CASE WHEN l_tax = 0 THEN 'http:///' || l_partkey WHEN l_tax = 0.01::DOUBLE THEN '' ELSE '/o/' || l_partkey END AS url,
    l_extendedprice AS price, CASE WHEN l_discount * 1000 <= 100 THEN l_discount * 1000 END AS discount_percentage,
    CASE WHEN l_tax * 100 <= 5 THEN l_tax * 100 END AS rating, l_quantity::BIGINT AS review_count,
    {STOCK} AS availability, p_brand AS brand_name, l_returnflag = 'A' AS is_sale
  FROM lineitem JOIN part ON l_partkey = p_partkey),
checked AS (SELECT *, list_filter([CASE WHEN name = '' THEN 'Missing required field: name' END,
    CASE WHEN url = '' THEN 'Missing required field: url' END,
    CASE WHEN url <> '' AND NOT regexp_matches(url, '^(/|https?://[^/?#]+)') THEN 'Invalid URL: ' || url END],
    lambda x: x IS NOT NULL) AS errors FROM feed)"""

RUNS = """runs AS (
  SELECT user_id::VARCHAR AS run_id, ts AS happened, CASE event_type WHEN 'signup' THEN 'running' WHEN 'error' THEN 'failed' ELSE 'completed' END AS status,
    json_extract(props, '$.k')::BIGINT AS k, event_id, CASE WHEN event_type = 'error' THEN props END AS errors FROM events)"""

COUNTS = f"""{CATS}, {PRODS}, direct AS (SELECT c.slug, count(p.slug) AS n_products FROM cats c
  LEFT JOIN prods p ON p.category_slug = c.slug GROUP BY c.slug)"""

MERGED_COLUMNS = """slug, name, url, description, price, original_price, discount_percentage, sku, availability,
  rating, review_count, image_url, images, category_slug, brand_slug, is_bestseller, is_new, is_sale, created_at, updated_at"""

ORACLES: dict[str, str] = {
    # Sources and lookups
    "pages_scan": "SELECT page_id, url, length(html) AS n_chars FROM pages",
    "categories_by_parent": f"WITH {CATS} SELECT slug, name, parent_slug FROM cats WHERE parent_slug = 'asia'",
    "all_categories": f"WITH {CATS} SELECT slug, name, parent_slug FROM cats",
    "category_roots": f"WITH {CATS} SELECT slug, name FROM cats WHERE parent_slug IS NULL",
    "products_by_category_limit": f"WITH {PRODS} SELECT slug, name, price FROM prods WHERE category_slug = 'nation_3' ORDER BY slug LIMIT 5",
    "exists_semi": f"WITH {OFFERS}, {STORED} SELECT slug, pos FROM batch WHERE slug IN (SELECT slug FROM stored)",
    "new_products_anti": f"WITH {OFFERS}, {STORED} SELECT slug, pos FROM batch WHERE slug NOT IN (SELECT slug FROM stored)",
    "modified_since": f"WITH {PRODS} SELECT slug, updated_at FROM prods WHERE updated_at >= TIMESTAMP '2020-02-01'",
    "lookup_by_slug": f"""WITH {CATS}, {BRANDS}, wanted AS (
        SELECT DISTINCT 'nation_' || c_nationkey || '-' || lower(c_mktsegment) AS slug FROM customer UNION SELECT slug FROM brands)
      SELECT w.slug, name, parent_slug FROM wanted w LEFT JOIN cats c ON w.slug = c.slug""",
    "match_slug_or_url": f"""WITH {OFFERS}, {STORED}, b AS (
        SELECT pos, CASE WHEN is_sale THEN 'x-' || slug ELSE slug END AS slug, url FROM batch)
      SELECT b.pos, b.slug, b.url, coalesce(s.slug, u.slug) AS match_slug FROM b
      LEFT JOIN stored s ON b.slug = s.slug LEFT JOIN stored u ON b.url = u.url""",
    "merge_by_url": f"""WITH {OFFERS}, {STORED}, b AS (
        SELECT pos, CASE WHEN is_sale THEN 'x-' || slug ELSE slug END AS slug, url, category_name FROM batch),
      f AS (SELECT url, arg_min(slug, pos) AS slug FROM b WHERE category_name <> '' GROUP BY url)
      SELECT b.pos, coalesce(u.slug, f.slug, b.slug) AS slug, '' AS reason
      FROM b LEFT JOIN stored u ON b.url = u.url LEFT JOIN f ON b.url = f.url""",
    "merge_replay": f"""WITH RECURSIVE {OFFERS}, {STORED},
      l AS (SELECT pos, slug, url, category_name, split_part(pos, '-', 3)::INT AS line, regexp_extract(slug, '^(p[0-9]+)-', 1) AS part FROM batch),
      b AS (SELECT pos, part, category_name <> '' AS known, CASE WHEN line % 4 = 0 THEN part || '-n' || line ELSE slug END AS slug,
          CASE line % 3 WHEN 0 THEN url WHEN 1 THEN '/offers/' || part || '-x' || line ELSE '/offers/' || part END AS url,
          row_number() OVER (PARTITION BY part ORDER BY pos) AS i FROM l),
      s0 AS (SELECT regexp_extract(slug, '^(p[0-9]+)-', 1) AS part, list({{'slug': slug, 'url': url}}) AS state FROM stored GROUP BY ALL),
      w AS (  -- one row of every part at a time
        SELECT p.part, 0::BIGINT AS i, coalesce(s0.state, []::STRUCT(slug VARCHAR, url VARCHAR)[]) AS state,
          NULL::VARCHAR AS pos, NULL::VARCHAR AS target, NULL::VARCHAR AS reason
        FROM (SELECT DISTINCT part FROM b) p LEFT JOIN s0 USING (part)
        UNION ALL
        SELECT part, i,
          CASE WHEN mine AND (owner IS NULL OR owner = slug) THEN
              list_append(list_filter(state, lambda x: x.slug <> slug), {{'slug': slug, 'url': url}})
            WHEN NOT mine AND owner IS NULL AND known THEN list_append(state, {{'slug': slug, 'url': url}}) ELSE state END,
          pos, CASE WHEN mine AND owner <> slug THEN NULL WHEN mine THEN slug WHEN owner IS NOT NULL THEN owner WHEN known THEN slug END,
          CASE WHEN mine AND owner <> slug THEN 'url_conflict' WHEN NOT mine AND owner IS NULL AND NOT known THEN 'missing_category' ELSE '' END
        FROM (SELECT b.*, w.state, len(list_filter(w.state, lambda x: x.slug = b.slug)) > 0 AS mine,
                list_filter(w.state, lambda x: x.url = b.url)[1].slug AS owner
              FROM w JOIN b ON b.part = w.part AND b.i = w.i + 1))
      SELECT pos, coalesce(target, '') AS slug, '' AS url, reason FROM w WHERE i > 0
      UNION ALL SELECT '', unnest(state).slug, unnest(state).url, '' FROM (
        SELECT state FROM w QUALIFY row_number() OVER (PARTITION BY part ORDER BY i DESC) = 1)
      UNION ALL SELECT '', slug, url, '' FROM stored WHERE regexp_extract(slug, '^(p[0-9]+)-', 1) NOT IN (SELECT part FROM b)""",
    "latest_pages": """WITH p AS (SELECT regexp_extract(url, '//([^/]+)', 1) AS url, page_id, page_id * 7 % 11 AS landed_at FROM pages)
      SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY url ORDER BY landed_at DESC, page_id DESC) = 1""",
    # Extraction from the landed pages
    "page_links": f"WITH {LINKS} SELECT page_id, pos, href, trim(text) AS text FROM links",
    "category_links": f"WITH {NAV} SELECT page_id, pos, name, slug, url, full_url FROM nav",
    "nav_categories": f"WITH {NAV} SELECT page_id, pos, name, slug, url, full_url FROM nav",
    "category_link_fallback": f"""WITH {NAV} SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS pos,
        name, slug, url, full_url FROM nav WHERE contains(href, '/c') OR contains(href, '/e') OR contains(href, '/t')""",
    "dedupe_first_by_slug": f"WITH {NAV} SELECT page_id, pos, name, slug, url, full_url FROM firsts",
    "category_link_counts": f"WITH {NAV} SELECT slug, count(*) AS n_links, count(DISTINCT page_id) AS n_pages FROM nav GROUP BY slug",
    "limit_categories": f"WITH {NAV} SELECT slug, name FROM firsts ORDER BY page_id, pos LIMIT 20",
    "html_detail": f"""WITH h AS (SELECT page_id, {strip(TITLE)} AS t FROM pages)
      SELECT page_id, CASE WHEN length(t) > 5 THEN t END AS name, '' AS description, '' AS sku, '' AS brand_name,
        'unknown' AS availability, NULL::DOUBLE AS price, false AS is_new FROM h""",
    "page_products": f"""WITH h AS (SELECT page_id, url, {strip(TITLE)} AS t FROM pages)
      SELECT page_id, url, coalesce(nullif(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]+)/*$', 1), ''), 'unknown') AS slug,
        t AS name, 'unknown' AS availability FROM h WHERE length(t) > 5""",
    # Extraction from rendered shop pages
    "subcategories_union": f"""SELECT n_name AS name, lower(n_name) AS slug, '/category/' || lower(n_name) AS url,
        'https://shop.example/category/' || lower(n_name) AS full_url, '' AS parent_slug FROM nation
      UNION ALL SELECT DISTINCT n_name || ' ' || c_mktsegment, lower(n_name) || '-' || lower(c_mktsegment),
        '/category/' || lower(n_name) || '/' || lower(c_mktsegment),
        'https://shop.example/category/' || lower(n_name) || '/' || lower(c_mktsegment), lower(n_name)
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "listing_cards": f"""WITH {CARDS} SELECT page_id, pos, name, url, slug, price, original_price, discount_percentage, image_url,
        rating, review_count, sku, availability, is_featured, is_bestseller, is_new, is_sale FROM cards""",
    "jsonld_listing": f"""WITH {SHOP} SELECT page_no::BIGINT * 1000 + k AS page_id, spot AS pos, p_name || ' ' || p_partkey AS name,
        p_url AS url, p_slug AS slug, p_retailprice AS price, '/i/' || p_partkey AS image_url, p_size / 10.0::DOUBLE AS rating,
        p_size AS review_count FROM shop""",
    "has_next_page": f"""WITH {SHOP}, lp AS (SELECT DISTINCT k, page_no, n_name, max(page_no) OVER (PARTITION BY k) AS last_page FROM shop)
      SELECT page_no::BIGINT * 1000 + k + 1000000000000 AS page_id, 'https://shop.example/category/' || lower(n_name)
        || CASE WHEN page_no > 1 THEN '?page=' || page_no ELSE '' END AS url, page_no < last_page AS has_next FROM lp""",
    "jsonld_detail": f"""WITH {DETAILS} SELECT page_id, name, description, sku, brand_name, price, availability, 'VND' AS currency,
        image_url, images, rating, review_count, category_name FROM details WHERE p_type <> 'SMALL'""",
    "product_detail": f"""WITH {DETAILS} SELECT page_id, url, slug, name, description, price, original_price, discount_percentage, sku,
        brand_name, category_name, availability, rating, review_count, ingredients, image_url, images, is_bestseller FROM details""",
    "gallery_distinct": f"WITH {DETAILS} SELECT page_id, image_url, images FROM details WHERE p_type = 'SMALL'",
    "merge_list_detail": f"""WITH {DETAILS} SELECT url, slug, name, price, coalesce(original_price, old_price) AS original_price,
        coalesce(discount_percentage, round((old_price - price) / old_price * 100, 2)) AS discount_percentage,
        coalesce(rating, CASE WHEN p_size % 7 <> 0 THEN p_size / 10.0::DOUBLE END) AS rating,
        coalesce(review_count, p_size * 100) AS review_count, sku, availability,
        coalesce(image_url, 'https://shop.example/i/' || p_partkey || '.jpg') AS image_url, brand_name, category_name,
        CASE WHEN p_type = 'SMALL' THEN false ELSE p_size > 25 END AS is_sale, p_type = 'PROMO' AS is_new,
        coalesce(is_bestseller, false) AS is_bestseller FROM details""",
    "pagination_prefix": """WITH walk AS (SELECT l_orderkey AS listing, l_linenumber AS page_no, count(*) FILTER (l_quantity > 5) AS n_products,
        bool_or(l_returnflag <> 'R') AS has_next FROM lineitem GROUP BY ALL),
      numbered AS (SELECT *, row_number() OVER w AS rn,
          min(CASE WHEN n_products = 0 THEN 0 ELSE 1 END) OVER w AS filled,
          coalesce(min(CASE WHEN has_next THEN 1 ELSE 0 END) OVER (PARTITION BY listing ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS goes_on
        FROM walk WINDOW w AS (PARTITION BY listing ORDER BY page_no))
      SELECT listing, page_no, n_products, has_next FROM numbered WHERE rn = page_no AND filled = 1 AND goes_on = 1 AND page_no <= 6""",
    "page_urls": """SELECT page_id, i - 1 AS i, url || CASE WHEN i = 1 THEN '' WHEN contains(url, '?') THEN '&page=' || i ELSE '?page=' || i END AS page_url
      FROM pages, (SELECT unnest([1, 2, 3]) AS i)""",
    "listing_keys": r"""SELECT page_id, url AS listing_url, 1 AS page_no FROM pages UNION ALL
      SELECT page_id, regexp_extract(url, '^(.*)[?&]page=([1-9][0-9]*)$', 1), regexp_extract(url, '^(.*)[?&]page=([1-9][0-9]*)$', 2)::INT
      FROM pages WHERE regexp_matches(url, '^[^?]*\?page=[1-9][0-9]*$|^.*\?.*&page=[1-9][0-9]*$') AND NOT regexp_matches(url, 'page=1$')""",
    # Scalar rules
    "normalize_text": f"""SELECT 'page' AS kind, page_id AS id, {clean('html')} AS clean FROM pages UNION ALL
      SELECT 'document', doc_id, {clean('text')} FROM documents""",
    "normalize_slug": f"SELECT doc_id, {slug('text')} AS slug FROM documents",
    "generate_slug": f"SELECT conv_id, turn, {slug('text')} AS slug FROM conversations",
    "normalize_url": f"""WITH {FORMS} SELECT page_id, form, CASE WHEN c = '' OR regexp_matches(c, '^(https?://|/)') THEN c ELSE '/' || c END AS out FROM forms""",
    "valid_url": f"WITH {FORMS} SELECT page_id, form, form <> 1 AND c <> '' AS is_valid FROM forms",
    "slug_from_url": f"""WITH {FORMS}, paths AS (SELECT page_id, form, CASE WHEN form IN (0, 3) THEN regexp_extract(c, '//[^/?#]*([^?#]*)', 1)
        ELSE regexp_extract(c, '^([^?#]*)', 1) END AS path FROM forms)
      SELECT page_id, form, coalesce(nullif(regexp_extract(path, '([^/]+)/*$', 1), ''), 'unknown') AS slug FROM paths""",
    "absolute_url": f"""WITH {FORMS} SELECT page_id, form, CASE form WHEN 1 THEN c ELSE url END AS out FROM forms""",
    "relative_links": """WITH f AS (SELECT page_id, url, regexp_extract(url, '([^/]*)/*$', 1) AS last FROM pages),
      c AS (SELECT page_id, url, unnest(range(9)) AS form, unnest([last, './' || last || '/..', '../' || last || '?a=../b', '../../../../' || last || '/.',
          'a/./b/../' || last || '/../x/', '/x/../' || last || '/./y#/../z', 'a//' || last || '//../c', '..' || last, '/../' || last || '/']) AS c FROM f),
      p AS (SELECT *, regexp_extract(c, '^([^?#]*)', 1) AS path, regexp_extract(c, '^[^?#]*(.*)$', 1) AS rest, c[1] = '/' AS rooted,
          regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', '') AS folder FROM c),
      s AS (SELECT *, string_split(CASE WHEN rooted THEN path ELSE coalesce(nullif(folder, ''), '/') || path END, '/')[2:] AS segs FROM p),
      k AS (SELECT *, CASE WHEN rooted THEN segs ELSE list_concat(list_filter(segs[:-2], lambda x: x <> ''), segs[-1:]) END AS parts FROM s),
      r AS (SELECT *, list_reduce(list_transform(parts, lambda x: [x]),
          lambda held, x: CASE x[1] WHEN '..' THEN held[:len(held) - 1] WHEN '.' THEN held ELSE list_concat(held, x) END, []::VARCHAR[]) AS stack FROM k)
      SELECT page_id, form::INT AS form, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/'
        || array_to_string(list_concat(stack, CASE WHEN segs[-1] IN ('.', '..') THEN [''] ELSE []::VARCHAR[] END), '/') || rest AS out FROM r""",
    "normalize_price": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS from_text,
        CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS from_number FROM lineitem""",
    "parse_price_text": """SELECT o_orderkey, CASE WHEN o_totalprice < 1000000 THEN floor(o_totalprice) / CASE WHEN o_totalprice < 1000 THEN 1 ELSE 1000 END END AS plain,
        floor(o_totalprice) AS vi FROM orders""",
    "normalize_percentage": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity * 3 <= 100 THEN l_quantity * 3 END AS from_text,
        l_discount * 100 AS from_number FROM lineitem""",
    "normalize_rating": """SELECT event_id, CASE WHEN value BETWEEN 0 AND 5 THEN value END AS from_text,
        CASE WHEN value - 3 BETWEEN 0 AND 5 THEN value - 3 END AS from_number FROM events""",
    "normalize_integer": """SELECT event_id, trunc(round(value * 1000, 2))::BIGINT AS from_text, greatest(0, trunc(value - 10))::BIGINT AS from_number,
        0 AS from_junk FROM events""",
    "normalize_boolean": """SELECT doc_id, quality = 1 AS from_text, toxic <> 0 AS from_number, quality = 1 AS from_word, toxic = 1 AS from_bool FROM labels""",
    "normalize_sku": "SELECT p_partkey, upper(replace(p_name, ' ', '')) || upper(replace(p_brand, '#', '')) || '_' || p_partkey AS sku FROM part",
    "normalize_availability": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {STOCK} AS stock FROM lineitem",
    "normalize_images": """SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 2 WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 0 ELSE 1 END AS n,
        CASE p_type WHEN 'SMALL' THEN '/i/' || p_partkey || '.jpg|/i/' || p_partkey WHEN 'LARGE' THEN 'http://img.example/' || p_partkey
          WHEN 'MEDIUM' THEN '/{"a": ' || p_partkey || '}' WHEN 'PROMO' THEN '/["broken' || p_partkey ELSE '' END AS images FROM part""",
    "first_number": r"SELECT doc_id, nullif(regexp_extract(text, '(\d+\.?\d*)', 1), '')::DOUBLE AS n FROM documents",
    "first_int": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, round_even(value * 1000, 0)::BIGINT AS v FROM events",
    "badge_flags": """WITH d AS (SELECT doc_id, lower(text) AS t FROM documents), l AS (SELECT doc_id, CASE
        WHEN contains(t, 'new') OR contains(t, 'mới') THEN 'new'
        WHEN contains(t, 'sale') OR contains(t, 'giảm') OR contains(t, 'khuyến mãi') THEN 'sale'
        WHEN contains(t, 'bestseller') OR contains(t, 'bán chạy') OR contains(t, 'hot') THEN 'bestseller'
        WHEN contains(t, 'featured') OR contains(t, 'nổi bật') THEN 'featured' END AS label FROM d)
      SELECT doc_id, label, coalesce(label = 'featured', false) AS is_featured, coalesce(label = 'bestseller', false) AS is_bestseller,
        coalesce(label = 'new', false) AS is_new, coalesce(label = 'sale', false) AS is_sale FROM l""",
    "discount_pct": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        round((floor(l_extendedprice * 1.25::DOUBLE) - floor(l_extendedprice)) / floor(l_extendedprice * 1.25::DOUBLE) * 100, 2) AS pct FROM lineitem""",
    "sql_escape": "SELECT doc_id, '''' || replace(text, '''', '''''') || '''' AS literal FROM documents",
    # Records
    "normalize_products": f"""WITH {FEED} SELECT pos, name, slug, url, price, NULL::DOUBLE AS original_price, discount_percentage, rating,
        review_count, availability, brand_name, '' AS description, is_sale, false AS is_new, 0 AS n_images FROM feed""",
    "normalize_categories": """SELECT c_custkey, c_name AS name, lower(replace(c_name, '#', '')) AS slug, '/c/' || c_custkey AS url, '' AS description,
        lower(n_name) AS parent_slug FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "validate_products": f"WITH {FEED} SELECT pos, len(errors) = 0 AS is_valid, array_to_string(errors, '|') AS errors, '' AS warnings FROM checked",
    "quarantine_split": f"WITH {FEED} SELECT pos, array_to_string(errors, '; ') AS reason FROM checked",
    "fk_audit": f"""WITH {CATS}, {PRODS} SELECT slug, category_slug AS target, 1 AS n_rows FROM prods
        WHERE category_slug NOT IN (SELECT slug FROM cats WHERE parent_slug LIKE 'nation%')
      UNION ALL SELECT l_orderkey::VARCHAR, 'order', count(*) FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey""",
    "unique_audit": f"WITH {OFFERS} SELECT slug, count(*) AS n_rows FROM offers GROUP BY slug HAVING count(*) > 1",
    "unique_url_audit": f"WITH {OFFERS} SELECT url, count(*) AS n_rows FROM offers GROUP BY url HAVING count(*) > 1",
    "range_audit": """SELECT count(*) FILTER (l_extendedprice - 20000 < 0) AS bad_price, count(*) FILTER (l_extendedprice < 0) AS bad_original_price,
        count(*) FILTER (l_tax * 100 NOT BETWEEN 0 AND 5) AS bad_rating, count(*) FILTER (l_quantity * 3 NOT BETWEEN 0 AND 100) AS bad_discount_percentage,
        count(*) FILTER (l_quantity - 5 < 0) AS bad_review_count FROM lineitem""",
    "length_audit": """SELECT count(*) FILTER (length(text) > 500) AS long_name, count(*) FILTER (length(source) > 3) AS long_slug,
        count(*) FILTER (length(text) > 2000) AS long_url FROM documents""",
    # Merges
    "merge_categories": f"""WITH {CATS}, feed AS (
        SELECT c_custkey AS pos, CASE WHEN c_acctbal < 0 THEN '' ELSE n_name || ' / ' || c_mktsegment END AS name,
          lower(c_mktsegment) || '-' || lower(n_name) AS slug, '/cat/' || c_custkey AS url,
          CASE WHEN c_acctbal > 5000 THEN 'Customer ' || c_custkey ELSE '' END AS description,
          CASE WHEN c_mktsegment = 'BUILDING' THEN lower(n_name) ELSE 'building-' || lower(n_name) END AS parent
        FROM customer JOIN nation ON c_nationkey = n_nationkey),
      one AS (SELECT slug, coalesce(arg_max(name, pos) FILTER (name <> ''), '') AS name, arg_max(url, pos) AS url,
          coalesce(arg_max(description, pos) FILTER (description <> ''), '') AS description, min(pos) AS first_pos, arg_min(parent, pos) AS parent
        FROM feed GROUP BY slug),
      new AS (SELECT o.*, CASE WHEN k.slug IS NOT NULL OR p.first_pos < o.first_pos THEN o.parent END AS parent_slug
        FROM one o LEFT JOIN cats k ON k.slug = o.parent LEFT JOIN one p ON p.slug = o.parent)
      SELECT slug, name, url, parent_slug, description, {NOW} AS created_at, {NOW} AS updated_at, 'created' AS change FROM new
      UNION ALL SELECT slug, name, '/c/' || slug, parent_slug, '', {CREATED}, {CREATED}, 'untouched' FROM cats""",
    "merge_brands": f"""WITH {BRANDS}, feed AS (
        SELECT lpad(l_orderkey::VARCHAR, 12, '0') || lpad(l_linenumber::VARCHAR, 3, '0') || lpad(l_partkey::VARCHAR, 12, '0') || lpad(l_suppkey::VARCHAR, 12, '0') AS pos,
          CASE WHEN l_tax = 0 THEN '' ELSE p_brand || ' ' || l_returnflag END AS name,
          lower(replace(p_brand, '#', '')) || CASE WHEN p_size > 40 THEN '-xl' ELSE '' END AS slug,
          CASE WHEN l_quantity > 25 THEN '/b/' || l_orderkey ELSE '' END AS url
        FROM lineitem JOIN part ON l_partkey = p_partkey),
      one AS (SELECT slug, arg_max(name, pos) FILTER (name <> '') AS name, arg_max(url, pos) FILTER (url <> '') AS url FROM feed GROUP BY slug)
      SELECT coalesce(b.slug, o.slug) AS slug, coalesce(o.name, b.name, '') AS name, coalesce(o.url, '') AS url,
        CASE WHEN b.slug IS NULL THEN {NOW} ELSE {CREATED} END AS created_at, CASE WHEN o.slug IS NULL THEN {CREATED} ELSE {NOW} END AS updated_at,
        CASE WHEN b.slug IS NULL THEN 'created' WHEN o.slug IS NULL THEN 'untouched' ELSE 'updated' END AS change
      FROM brands b FULL JOIN one o ON b.slug = o.slug""",
    "merge_products": f"WITH {MERGE} SELECT {MERGED_COLUMNS}, change FROM merged",
    "merge_rejects": f"WITH {MERGE} SELECT pos, slug, 'missing_category' AS reason FROM judged WHERE NOT accepted",
    "bulk_merge_stats": f"""WITH {MERGE}, s AS (SELECT (SELECT count(*) FROM batch) AS total, (SELECT count(*) FROM merged WHERE change = 'created') AS created,
        (SELECT count(*) FROM judged WHERE NOT accepted) AS errors) SELECT total, created, total - created - errors AS updated, errors FROM s""",
    "resolve_categories": f"""WITH {MERGE}, f AS (SELECT slug, arg_max(name, last_pos) AS name FROM cat_of GROUP BY slug)
      SELECT coalesce(c.slug, f.slug) AS slug, coalesce(f.name, c.name) AS name, parent_slug,
        CASE WHEN c.slug IS NULL THEN 'created' WHEN f.name <> c.name THEN 'updated' ELSE 'untouched' END AS change
      FROM cats c FULL JOIN f ON c.slug = f.slug""",
    "resolve_brands": f"""WITH {MERGE}, f AS (SELECT slug, arg_max(name, last_pos) AS name FROM brand_of GROUP BY slug)
      SELECT coalesce(c.slug, f.slug) AS slug, coalesce(f.name, c.name) AS name,
        CASE WHEN c.slug IS NULL OR f.name <> c.name THEN {NOW} ELSE {CREATED} END AS updated_at,
        CASE WHEN c.slug IS NULL THEN 'created' WHEN f.name <> c.name THEN 'updated' ELSE 'untouched' END AS change
      FROM brands c FULL JOIN f ON c.slug = f.slug""",
    "process_batch": f"""WITH {FEED}, {PRODS}, good AS (SELECT * FROM checked WHERE len(errors) = 0),
      one AS (SELECT slug, arg_max(name, pos) AS name, arg_max(url, pos) AS url, arg_max(price, pos) AS price, arg_max(brand_name, pos) AS brand_name FROM good GROUP BY slug)
      SELECT o.slug, o.name, o.url, o.price, 'feed' AS category_slug, lower(replace(o.brand_name, '#', '')) AS brand_slug,
        CASE WHEN p.slug IS NULL THEN 'created' ELSE 'updated' END AS change FROM one o LEFT JOIN prods p ON o.slug = p.slug""",
    # Hierarchy and joins
    "products_enriched": f"""WITH {CATS}, {PRODS}, {BRANDS} SELECT p.slug, category_slug, c.name AS category_name, brand_slug, b.name AS brand_name
      FROM prods p LEFT JOIN cats c ON p.category_slug = c.slug LEFT JOIN brands b ON p.brand_slug = b.slug""",
    "export_values": f"""WITH {CATS}, {PRODS} SELECT category_slug AS output, slug, name, '/p/' || slug AS url, description, price, original_price, sku, availability, rating,
        review_count, image_url, '/i/' || slug || '.jpg' AS images, is_new, is_sale, {CREATED} AS created_at, updated_at, true AS has_category,
        count(*) OVER (PARTITION BY category_slug) AS n_source, count(*) OVER (PARTITION BY category_slug) AS n_written, true AS is_equal
      FROM prods WHERE category_slug IN (SELECT slug FROM cats)""",
    "export_orphans": f"""WITH {CATS}, {PRODS} SELECT category_slug, count(*) AS n_products FROM prods
      WHERE category_slug NOT IN (SELECT slug FROM cats WHERE slug NOT LIKE 'nation_3-%') GROUP BY category_slug""",
    "brands_of_category": f"WITH {PRODS}, {BRANDS} SELECT slug, name FROM brands WHERE slug IN (SELECT brand_slug FROM prods WHERE category_slug = 'nation_3')",
    "subtree_products": f"WITH RECURSIVE {CATS}, {PRODS}, {TREE} SELECT root, p.slug, category_slug FROM prods p JOIN tree t ON t.slug = p.category_slug",
    "direct_products": f"WITH {COUNTS} SELECT slug, n_products FROM direct",
    "ancestor_chain": f"""WITH RECURSIVE {CATS}, {TREE} SELECT slug, root AS ancestor, max(depth) OVER (PARTITION BY slug) - depth AS step FROM tree""",
    "rollup_by_root": f"""WITH RECURSIVE {COUNTS}, {TREE} SELECT root, count(*) AS categories_processed, count(*) FILTER (n_products > 0) AS files_created,
        sum(n_products) AS products_exported FROM tree JOIN direct USING (slug) GROUP BY root""",
    "top_n_per_category": f"""WITH {PRODS} SELECT category_slug, slug, price FROM prods
      QUALIFY row_number() OVER (PARTITION BY category_slug ORDER BY price, slug) <= 3""",
    # Figures and the run log
    "catalog_stats": f"""WITH {CATS}, {PRODS}, {BRANDS} SELECT (SELECT count(*) FROM cats) AS categories, (SELECT count(*) FROM brands) AS brands,
        (SELECT count(*) FROM prods) AS products, (SELECT count(DISTINCT user_id) FROM events) AS runs,
        (SELECT count(*) FROM prods WHERE image_url <> '') AS products_with_images, (SELECT count(price) FROM prods) AS products_with_prices,
        (SELECT count(rating) FROM prods) AS products_with_ratings""",
    "run_stats": f"WITH {RUNS} SELECT run_id, sum(k) AS categories_found, sum(event_id) AS products_found, sum(k) AS products_updated, sum(k * 2) AS products_created FROM runs GROUP BY run_id",
    "run_log_latest": f"""WITH {RUNS}, l AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY happened DESC) = 1),
      a AS (SELECT run_id, min(happened) AS started_at, max(happened) FILTER (status <> 'running') AS finished_at FROM runs GROUP BY run_id)
      SELECT run_id, started_at, finished_at, status, k AS categories_found, event_id AS products_found, k AS products_updated,
        k * 2 AS products_created, errors FROM l JOIN a USING (run_id)""",
    "retention_keep": f"""WITH {RUNS}, d AS (SELECT run_id || '@' || strftime(happened, '%Y-%m-%d') AS run_id, happened, status FROM runs)
      SELECT run_id, happened AS "at", status FROM d QUALIFY min(happened) OVER (PARTITION BY run_id) >= TIMESTAMP '2024-01-21'""",
    # Export
    "export_all_manifest": f"WITH {COUNTS} SELECT slug, n_products, n_products > 0 AS has_output FROM direct",
    "export_totals": f"WITH {COUNTS} SELECT count(*) AS categories_processed, count(*) FILTER (n_products > 0) AS files_created, sum(n_products) AS total_products FROM direct",
    "insert_lines": f"""WITH {PRODS} SELECT slug, 'INSERT OR REPLACE INTO products (id, name, slug, url, description, price, original_price, '
        || 'discount_percentage, sku, availability, rating, review_count, image_url, images, ingredients, usage_instructions, category_id, '
        || 'brand_id, is_featured, is_bestseller, is_new, is_sale, created_at, updated_at) VALUES (' || chr(10) || '    ' || array_to_string([
        p_partkey::VARCHAR, '''' || name || '''', '''' || slug || '''', '''/p/' || slug || '''', '''' || replace(description, '''', '''''') || '''',
        price::VARCHAR, coalesce(original_price::VARCHAR, 'NULL'), 'NULL', '''' || sku || '''', '''' || availability || '''',
        coalesce(rating::VARCHAR, 'NULL'), review_count::VARCHAR, '''' || image_url || '''', '''["/i/' || slug || '.jpg"]''', '''''', '''''',
        '''' || category_slug || '''', '''' || brand_slug || '''', '0', '0', CASE WHEN is_new THEN '1' ELSE '0' END,
        CASE WHEN is_sale THEN '1' ELSE '0' END, '''2020-01-01T00:00:00''', '''' || strftime(updated_at, '%Y-%m-%dT%H:%M:%S') || ''''],
        ',' || chr(10) || '    ') || chr(10) || ');' AS line FROM prods""",
    "dump_lines": f"""WITH RECURSIVE {COUNTS}, {TREE}, o AS (SELECT d.slug AS output, name, n_products FROM direct d JOIN cats USING (slug) WHERE n_products > 0),
      b AS (SELECT category_slug AS output, count(DISTINCT brand_slug) AS n FROM prods WHERE category_slug IN (SELECT output FROM o) GROUP BY 1)
      SELECT output, 0 AS section, unnest(['-- Product data export', '-- Category: ' || name || ' (' || output || ')',
        '-- Exported at: 2024-02-01T00:00:00', '-- Total products: ' || n_products]) AS line, 1 AS n_lines FROM o
      UNION ALL SELECT output, 1, '', 4 FROM o
      UNION ALL SELECT output, 2, '', 1 + (SELECT count(*) FROM tree WHERE tree.slug = output) FROM o
      UNION ALL SELECT output, 3, '', 1 + n FROM b
      UNION ALL SELECT category_slug, 4, '', 1 + count(*) FROM prods WHERE category_slug IN (SELECT output FROM o) GROUP BY category_slug
      UNION ALL SELECT output, 5, '-- End of export', 1 FROM o""",
    "export_category": f"""WITH RECURSIVE {CATS}, {PRODS}, {BRANDS}, {TREE}, roots AS (SELECT slug FROM cats WHERE parent_slug IS NULL),
      m AS (SELECT root AS output, p.slug, brand_slug FROM tree t JOIN prods p ON p.category_slug = t.slug WHERE root IN (SELECT slug FROM roots))
      SELECT output, 4 AS section, slug FROM m UNION ALL SELECT DISTINCT output, 3, brand_slug FROM m
      UNION ALL SELECT root, 2, slug FROM tree WHERE root IN (SELECT output FROM m)""",
    "export_summary": f"""WITH {COUNTS}, {BRANDS} SELECT (SELECT count(*) FROM cats) AS categories, (SELECT count(*) FROM brands) AS brands,
        (SELECT count(*) FROM prods) AS products, (SELECT count(DISTINCT user_id) FROM events) AS runs,
        (SELECT count(*) FROM prods WHERE image_url <> '') AS products_with_images, (SELECT count(price) FROM prods) AS products_with_prices,
        (SELECT count(rating) FROM prods) AS products_with_ratings, (SELECT count(*) FROM direct WHERE n_products > 0) AS outputs,
        (SELECT sum(n_products) FROM direct) AS exported_products""",
    "export_reconcile": f"WITH {COUNTS} SELECT slug, n_products AS n_source, n_products AS n_written, true AS is_valid FROM direct WHERE n_products > 0",
    # Whole jobs
    "full_refresh": f"""WITH {DETAILS} SELECT slug, name, url, description, price, old_price AS original_price,
        round((old_price - price) / old_price * 100, 2) AS discount_percentage, upper(sku) AS sku, stock AS availability,
        coalesce(rating, CASE WHEN p_size % 7 <> 0 THEN p_size / 10.0::DOUBLE END) AS rating,
        coalesce(review_count, p_size * 100) AS review_count, image_url, images, lower(n_name) AS category_slug,
        lower(replace(brand_name, '#', '')) AS brand_slug, false AS is_bestseller, false AS is_new, p_size > 25 AS is_sale,
        {NOW} AS created_at, {NOW} AS updated_at
      FROM details WHERE category_name IS NOT NULL""",
    "full_refresh_stats": """SELECT 25 AS categories_found, 25 AS categories_processed, count(*) AS products_found,
        count(*) FILTER (p_type IN ('STANDARD', 'MEDIUM', 'ECONOMY')) AS products_processed,
        count(*) FILTER (p_type IN ('STANDARD', 'MEDIUM', 'ECONOMY')) AS products_created, 0 AS products_updated,
        count(*) FILTER (p_type IN ('PROMO', 'SMALL')) AS errors FROM part""",
    "listing_refresh": f"""WITH {CARDS} SELECT slug, name, price, lower(n_name) AS category_slug, stock AS availability FROM cards""",
    "incremental_refresh": f"""WITH {PRODS}, {DETAILS}, known AS (SELECT *, updated_at >= TIMESTAMP '2020-01-31' AS recent FROM prods WHERE NOT is_new)
      SELECT k.slug, coalesce(d.name, k.name) AS name, coalesce(d.price, k.price) AS price,
        coalesce(lower(d.category_name), k.category_slug) AS category_slug, k.brand_slug,
        CASE WHEN d.slug IS NOT NULL THEN TIMESTAMP '2020-02-20' ELSE k.updated_at END AS updated_at,
        CASE WHEN d.slug IS NOT NULL THEN 'updated' ELSE 'untouched' END AS change
      FROM known k LEFT JOIN details d ON d.slug = k.slug AND k.recent""",
    "incremental_new_pages": f"""WITH {PRODS}, {DETAILS}, known AS (SELECT *, updated_at >= TIMESTAMP '2020-01-31' AND updated_at < TIMESTAMP '2020-02-10' AS due FROM prods WHERE NOT is_new)
      SELECT k.slug, coalesce(d.name, k.name) AS name, coalesce(d.price, k.price) AS price,
        CASE WHEN d.slug IS NOT NULL THEN TIMESTAMP '2020-02-20' ELSE k.updated_at END AS updated_at,
        CASE WHEN d.slug IS NOT NULL THEN 'updated' ELSE 'untouched' END AS change
      FROM known k LEFT JOIN details d ON d.slug = k.slug AND k.due""",
    "stream_incremental": f"""WITH {DETAILS} SELECT slug, name, price, lower(n_name) AS category_slug, lower(replace(brand_name, '#', '')) AS brand_slug,
        CASE WHEN p_partkey % 4 = 0 THEN replace(description, 'About ', 'Now ') ELSE description END AS description,
        CASE WHEN p_partkey % 2 = 1 THEN TIMESTAMP '2024-01-04' ELSE TIMESTAMP '2024-01-03' END AS created_at,
        CASE WHEN p_partkey % 2 = 1 OR p_partkey % 4 = 0 THEN TIMESTAMP '2024-01-04' ELSE TIMESTAMP '2024-01-03' END AS updated_at
      FROM details WHERE category_name IS NOT NULL""",
    "category_refresh": f"""WITH {CARDS}, {PRODS} SELECT c.slug, c.name, c.price, 'nation_3' AS category_slug,
        CASE WHEN p.slug IS NOT NULL THEN 'updated' ELSE 'created' END AS change
      FROM cards c LEFT JOIN prods p ON c.slug = p.slug AND NOT p.is_new WHERE c.n_name = 'NATION_3'""",
}

# The second run of a batch: every slug the first run left behind, updated where the batch has it.
ORACLES["merge_idempotent"] = f"""WITH {MERGE} SELECT {MERGED_COLUMNS},
    CASE WHEN change = 'untouched' THEN 'untouched' ELSE 'updated' END AS change FROM merged"""
