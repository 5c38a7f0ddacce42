"""Queries over listing shaping and grouped output."""

from __future__ import annotations

from pyspark.sql import functions as F

from adledger import rules
from adledger.catalog.inputs import ATTRIBUTE_COUNT, ATTRIBUTE_FIELDS, attribute_rows, source
from adledger.catalog.registry import query
from adledger.functions import text as t
from adledger.functions import variants as V
from adledger.operators import listings as p
from adledger.operators import output as g
from adledger.session import scratch_dir

DAY = "2024-01-15"
KEY = ["category"]


@query("p1_filter_listing_day", f"SELECT id FROM @cards WHERE date_published LIKE '{DAY}%'")
def p1(spark, sf):
    return p.filter_listing_day(source(spark, sf, "cards"), DAY).select("id")


@query("p1_filter_listing_day_keep_null", f"SELECT id, date_published FROM @cards WHERE date_published IS NULL OR date_published LIKE '{DAY}%'")
def p1_null(spark, sf):
    return p.filter_listing_day(source(spark, sf, "cards"), DAY, keep_null=True).select("id", "date_published")


@query(
    "p2_cut_pages_first_empty",
    f"""WITH r AS (SELECT * FROM @cards WHERE date_published LIKE '{DAY}%' AND page <= 5), pg AS (SELECT DISTINCT category, page FROM r),
    run AS (SELECT category, page, row_number() OVER (PARTITION BY category ORDER BY page) AS rn FROM pg)
    SELECT r.id, r.category, r.page FROM r JOIN run USING (category, page) WHERE run.page = run.rn""",
)
def p2(spark, sf):
    return p.cut_pages_first_empty(source(spark, sf, "cards"), DAY, 5, KEY).select("id", "category", "page")


@query(
    "p2_cut_pages_by_total",
    "WITH tp AS (SELECT category, 1 + count(*) % 5 AS total_pages FROM @cards GROUP BY 1) SELECT id, category, page FROM @cards c JOIN tp USING (category) WHERE page <= total_pages",
)
def p2_total(spark, sf):
    cards = source(spark, sf, "cards")
    totals = cards.groupBy("category").agg((F.count(F.lit(1)) % 5 + 1).alias("total_pages"))
    return p.cut_pages_by_total(cards, totals, KEY).select("id", "category", "page")


@query(
    "p3_cut_pages_found_older",
    f"""WITH pg AS (SELECT category, page, bool_or(coalesce(substr(date_published, 1, 10) < '{DAY}', false)) AS older FROM @cards GROUP BY 1, 2),
    seen AS (SELECT category, page, coalesce(bool_or(older) OVER (PARTITION BY category ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS before FROM pg)
    SELECT id, category, page FROM @cards c JOIN seen USING (category, page) WHERE NOT before AND date_published LIKE '{DAY}%'""",
)
def p3(spark, sf):
    return p.cut_pages_found_older(source(spark, sf, "cards"), DAY, KEY).select("id", "category", "page")


@query("p5_join_cards_details", "SELECT d.slug, d.title, c.status, coalesce(nullif(c.pin, ''), 'Not Pinned') AS pin FROM @cards c JOIN @card_details d ON d.slug = c.slug AND c.slug <> ''")
def p5(spark, sf):
    return p.join_cards_details(source(spark, sf, "cards"), source(spark, sf, "card_details"), ["status", "pin"], "Not Pinned")


LISTED = "SELECT CASE WHEN c_acctbal < 0 THEN '' ELSE concat('u/', CAST(c_custkey AS STRING)) END AS url, c_name AS name, c_mktsegment AS segment FROM customer"
PROFILED = "SELECT concat('u/', CAST(c_custkey AS STRING)) AS url, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) END AS name, c_nationkey AS rating FROM customer WHERE c_mktsegment <> 'BUILDING'"


@query("p6_join_business_profiles", f"WITH l AS ({LISTED}), f AS ({PROFILED}) SELECT l.url, CASE WHEN f.url IS NOT NULL THEN f.name ELSE l.name END AS name, segment, rating FROM l LEFT JOIN f USING (url) WHERE l.url <> ''")
def p6(spark, sf):
    customers = source(spark, sf, "customer")
    url = F.concat(F.lit("u/"), F.col("c_custkey").cast("string"))
    listed = customers.select(F.when(F.col("c_acctbal") < 0, "").otherwise(url).alias("url"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    profiled = customers.filter("c_mktsegment <> 'BUILDING'").select(
        url.alias("url"), F.when(F.col("c_custkey") % 2 == 0, F.upper("c_name")).alias("name"), F.col("c_nationkey").alias("rating")
    )
    return p.join_business_profiles(listed, profiled)


@query(
    "p7_union_category_pages",
    """SELECT o_orderkey AS id, 'Main' AS child, o_custkey AS seller, NULL::VARCHAR AS district FROM orders UNION ALL
    SELECT o_orderkey, 'East', NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'West', NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'O'""",
)
def p7(spark, sf):
    orders = source(spark, sf, "orders")
    part = lambda s: orders.filter(F.col("o_orderstatus") == s).select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("district"))
    return p.union_category_pages({"Main": orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("seller")), "East": part("F"), "West": part("O")})


BRANDS = "SELECT p_brand AS slug, count(*) FILTER (p_size = 50) AS listings_count FROM part GROUP BY 1"


@query("p8_skip_empty_categories", f"WITH b AS ({BRANDS}) SELECT p_partkey AS id, p_brand AS category FROM part WHERE p_brand IN (SELECT slug FROM b WHERE listings_count <> 0)")
def p8(spark, sf):
    parts = source(spark, sf, "part")
    brands = parts.groupBy(F.col("p_brand").alias("slug")).agg(F.count_if(F.col("p_size") == 50).alias("listings_count"))
    return p.skip_empty_categories(parts.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("category")), brands)


KNOWN = {"id": "o_orderkey", "title": "'t' || o_custkey", "price": "CAST(o_custkey AS VARCHAR)", "s3_images": "CASE WHEN o_orderkey % 2 = 0 THEN 'a.jpg | b.jpg' ELSE '' END"}
BLANK = ("description", "specification_en", "specification_ar")


@query(
    "p10_rename_for_export",
    "SELECT " + ", ".join(f"""{KNOWN.get(c, "''" if c in BLANK else 'NULL::VARCHAR')} AS "{h}" """ for c, h in rules.EXPORT_HEADERS.items()) + " FROM orders",
)
def p10(spark, sf):
    images = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("a.jpg"), F.lit("b.jpg")))
    rows = source(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("title"), F.col("o_custkey").cast("string").alias("price"), images.alias("s3_images")
    )
    return p.rename_for_export(rows)


ATTRS = f"""WITH a AS ({' UNION ALL '.join(f"SELECT id, {i} AS pos, {', '.join(f'a{i}_{f} AS {f}' for f in ATTRIBUTE_FIELDS)} FROM @attribute_cells" for i in range(ATTRIBUTE_COUNT))})"""


def pairs_sql(rule: str) -> str:
    number = "false" if rule == "new" else "coalesce(type = 'number', false)"
    value = lambda f, yes, no: f"CASE WHEN val_kind = 'object' THEN {f} WHEN {number} THEN val WHEN val = '1' THEN '{yes}' ELSE '{no}' END"
    keep = "v <> ''" if rule == "standard" else "true"
    return ATTRS + f""", e AS (SELECT id, pos * 2 AS pos, name_en AS k, {value('val_en', 'Yes', 'No')} AS v FROM a WHERE val_kind IN ('object', 'string') AND name_en <> ''),
    r AS (SELECT id, pos * 2 + 1 AS pos, name_ar AS k, {value('val_ar', 'نعم', 'لا')} AS v FROM a WHERE val_kind IN ('object', 'string') AND name_ar <> ''),
    u AS (SELECT 'en' AS m, * FROM e WHERE {keep} UNION ALL SELECT 'ar', * FROM r WHERE {keep} UNION ALL SELECT 'both', * FROM e WHERE {keep} UNION ALL SELECT 'both', * FROM r WHERE {keep}),
    kv AS (SELECT id, m, k, min(pos) AS first_pos, last(v ORDER BY pos) AS v FROM u GROUP BY 1, 2, 3),
    maps AS (SELECT id, string_agg(k || '=' || coalesce(v, '?'), '|' ORDER BY first_pos) FILTER (m = 'en') AS spec_en, string_agg(k || '=' || coalesce(v, '?'), '|' ORDER BY first_pos) FILTER (m = 'ar') AS spec_ar,
      string_agg(k || '=' || coalesce(v, '?'), '|' ORDER BY first_pos) FILTER (m = 'both') AS attributes FROM kv GROUP BY 1)
    SELECT * FROM maps"""


def as_text(name: str):
    pair = lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("?")))
    return F.nullif(F.array_join(F.transform(F.map_entries(name), pair), "|"), F.lit("")).alias(name)


def add_attributes(rule: str) -> None:
    @query(f"p11_attributes_to_maps_{rule}", pairs_sql(rule))
    def run(spark, sf):
        return p.attributes_to_maps(attribute_rows(spark, sf), rule).select("id", as_text("spec_en"), as_text("spec_ar"), as_text("attributes"))


for _rule in ("standard", "property", "new"):
    add_attributes(_rule)


@query("p12_widen_attributes", """SELECT p_partkey AS id, p_brand AS "Brand", CASE WHEN p_size % 3 = 0 THEN p_type ELSE CAST(p_size AS VARCHAR) END AS "Size", CASE WHEN p_size % 2 = 1 THEN 'Yes' ELSE 'No' END AS "New" FROM part""")
def p12(spark, sf):
    maps = p.attributes_to_maps(attribute_rows(spark, sf)).select("id", "attributes")
    return p.widen_attributes(maps, ["Brand", "Size", "New"])


IMAGE_FOLDER = "'data/store/year=' || strftime(save_date, '%Y') || '/month=' || strftime(save_date, '%m') || '/day=' || strftime(save_date, '%d') || '/images/' || category || '/'"


def image_lists(spark, sf):
    """Orders with a list of up to four images each; every sixth order has no id."""
    n = (F.col("o_orderkey") % 5).cast("int")
    url = lambda i: F.concat(F.lit("https://img.example/"), F.col("o_custkey").cast("string"), F.lit("-"), i.cast("string"), F.lit(".webp"))
    images = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), url)).otherwise(F.array().cast("array<string>"))
    return source(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderkey")).alias("id"), F.col("o_orderstatus").alias("category"), F.col("o_orderdate").cast("date").alias("save_date"), images.alias("images")
    )


def assigned_sql(limit: int | None) -> str:
    top = "o_orderkey % 5" if limit is None else f"least(o_orderkey % 5, {limit})"
    return f"""WITH o AS (SELECT CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey END AS id, o_orderstatus AS category, CAST(o_orderdate AS DATE) AS save_date, o_custkey, unnest(range(1, {top} + 1)) AS i FROM orders)
    SELECT id, category, save_date, CAST(i - 1 AS INT) AS image_index, 'https://img.example/' || o_custkey || '-' || i || '.webp' AS url,
      {IMAGE_FOLDER} || coalesce(id || '_' || (i - 1) || '.jpg', o_custkey || '-' || i || '.webp') AS image_key FROM o"""


@query("p13_assign_image_keys", assigned_sql(None))
def p13(spark, sf):
    return p.assign_image_keys(image_lists(spark, sf), "data/store")


@query("p13_assign_image_keys_limit", assigned_sql(3))
def p13_limit(spark, sf):
    return p.assign_image_keys(image_lists(spark, sf), "data/store", limit=3)


@query("p13_assign_image_keys_parent", assigned_sql(None).replace("|| category ||", "|| 'main-' || category || '/' || category ||"))
def p13_parent(spark, sf):
    rows = image_lists(spark, sf).withColumn("main", F.concat(F.lit("main-"), "category"))
    return p.assign_image_keys(rows, "data/store", parent="main").drop("main")


COLLECTED = f"SELECT id, image_index, {IMAGE_FOLDER} || id || '_' || image_index || '.jpg' AS image_key FROM @image_rows"


@query(
    "p14_collect_image_keys",
    f"""WITH k AS ({COLLECTED}) SELECT id, string_agg('s3://b/' || image_key, ' | ' ORDER BY image_index, image_key) AS images_text,
      CAST(to_json(list('s3://b/' || image_key ORDER BY image_index, image_key)) AS VARCHAR) AS images_json FROM k GROUP BY 1""",
)
def p14(spark, sf):
    rows = source(spark, sf, "image_rows")
    key = p.image_key(F.lit("data/store"), F.col("save_date"), F.col("category"), F.col("id"), F.col("url"), F.col("image_index"))
    return p.collect_image_keys(rows.withColumn("image_key", key), "s3://b/").drop("image_keys")


@query("p22_reorder_columns", """SELECT c_custkey AS id, c_name AS title, c_mktsegment AS category_slug, c_acctbal AS extra FROM customer""")
def p22(spark, sf):
    rows = source(spark, sf, "customer").select(
        F.col("c_acctbal").alias("extra"), F.col("c_mktsegment").alias("category_slug"), F.col("c_name").alias("title"), F.col("c_custkey").alias("id")
    )
    return p.reorder_columns(rows, rules.COMMERCIAL_COLUMN_ORDER, keep_rest=True)


# --- grouped output ---------------------------------------------------------------------------------------

NAMES = "concat('o''neil ', lower(o_orderpriority), '-hilux-2020 ', CAST(o_orderkey % 100 AS STRING), CASE WHEN o_custkey % 2 = 0 THEN ' and more * words' ELSE '' END)"
TITLED = "array_to_string(list_transform(regexp_extract_all(replace(n, '-', ' '), '\\p{L}+|\\P{L}+'), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '')"


@query(
    "g1_sheet_name",
    f"""SELECT o_orderkey, CASE WHEN length(n) <= 31 THEN n ELSE substr(n, 1, 28) || '...' END AS ellipsis, substr(n, 1, 31) AS cut, substr({TITLED}, 1, 31) AS slug,
      substr(regexp_replace(replace(n, ' ', '_'), '[\\\\/*?:\\[\\]]', '', 'g'), 1, 31) AS clean FROM (SELECT o_orderkey, {NAMES} AS n FROM orders)""",
)
def g1(spark, sf):
    rows = source(spark, sf, "orders").selectExpr("o_orderkey", f"{NAMES} AS n")
    return rows.select("o_orderkey", *[t.sheet_name("n", rule).alias(rule) for rule in ("ellipsis", "cut", "slug", "clean")])


@query(
    "g2_info_rollup",
    "SELECT category, count(*) AS total_listings, bool_or(child <> 'Main') AS has_subcategories, count(DISTINCT child) AS subcategories_count, DATE '2024-01-30' AS scraped_date, DATE '2024-01-31' AS saved_date FROM @listing_rows GROUP BY 1",
)
def g2(spark, sf):
    return g.info_rollup(source(spark, sf, "listing_rows"), F.lit("2024-01-30"))


@query(
    "g2_info_by_type",
    """SELECT category, CASE WHEN bool_or(child <> 'Main') THEN 'Has Child Categories' ELSE 'Direct Listings' END AS type, count(DISTINCT CASE WHEN child <> 'Main' THEN child END) AS child_categories_count,
      count(*) AS total_listings, max(page) AS total_pages FROM @listing_rows GROUP BY 1""",
)
def g2_type(spark, sf):
    return g.info_by_type(source(spark, sf, "listing_rows"))


@query("g3_category_totals", "SELECT category, child, count(*) AS listings, CAST(grouping(category) * 2 + grouping(child) AS BIGINT) AS level FROM @listing_rows GROUP BY ROLLUP (category, child)")
def g3_totals(spark, sf):
    return g.category_totals(source(spark, sf, "listing_rows"))


SUMMARY = """WITH c AS (SELECT category, child, count(*) AS n FROM @listing_rows GROUP BY 1, 2),
s AS (SELECT category, CAST(sum(n) AS BIGINT) AS listings_count, count(*) AS subcategories_count, string_agg(child || '=' || n, '|' ORDER BY child) AS subcategories FROM c GROUP BY 1)
"""


@query("g3_category_summary", SUMMARY + "SELECT * FROM s")
def g3(spark, sf):
    summary = g.category_summary(source(spark, sf, "listing_rows"))
    entry = lambda s: F.concat(s["child"], F.lit("="), s["listings"].cast("string"))
    return summary.withColumn("subcategories", F.array_join(F.transform("subcategories", entry), "|"))


@query("g3_summary_document", SUMMARY + "SELECT (SELECT count(*) FROM s) AS total_subcategories, (SELECT CAST(sum(listings_count) AS BIGINT) FROM s) AS total_listings, category AS slug, listings_count FROM s")
def g3_document(spark, sf):
    doc = g.summary_document(g.category_summary(source(spark, sf, "listing_rows")), F.lit("2024-01-30")).select(V.parse("body").alias("d"))
    rows = doc.select(V.whole("d", "$.total_subcategories").alias("total_subcategories"), V.whole("d", "$.total_listings").alias("total_listings"), F.explode(V.items("d", "$.subcategories")).alias("s"))
    return rows.select("total_subcategories", "total_listings", V.text("s", "$.category").alias("slug"), V.whole("s", "$.listings_count").alias("listings_count"))


@query("g4_write_grouped", "SELECT category, child, CAST(year(save_date) AS INT) AS year, CAST(month(save_date) AS INT) AS month, CAST(day(save_date) AS INT) AS day, count(*) AS n FROM @listing_rows GROUP BY ALL")
def g4(spark, sf):
    path = scratch_dir(spark, "grouped")
    g.write_grouped(source(spark, sf, "listing_rows"), path)
    return spark.read.parquet(path).groupBy("category", "child", "year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@query(
    "g5_run_metrics",
    """WITH r AS (SELECT run_id, greatest(count(*), max(session_count)) AS requests_total, count(*) FILTER (failed) AS requests_failed, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS sec FROM @request_log GROUP BY 1)
    SELECT run_id, requests_total, requests_failed, round(requests_failed * 100.0::DOUBLE / requests_total, 2) AS error_rate_pct, CASE WHEN sec > 0 THEN round(requests_total / (sec / 60.0::DOUBLE), 2) ELSE 0 END AS requests_per_min, round(sec, 2) AS duration_sec FROM r""",
)
def g5(spark, sf):
    return g.run_metrics(source(spark, sf, "request_log"))


@query("g6_fetch_log_dedupe", "SELECT url, arg_min(request_id, (ts, request_id)) AS request_id FROM @request_log GROUP BY 1")
def g6(spark, sf):
    return g.fetch_log_dedupe(source(spark, sf, "request_log")).select("url", "request_id")


@query("g6_cache_hits", "SELECT run_id, count(*) AS requests, count(DISTINCT url) AS fetched, count(*) - count(DISTINCT url) AS cache_hits FROM @request_log GROUP BY 1")
def g6_hits(spark, sf):
    return g.cache_hits(source(spark, sf, "request_log"), ["run_id"])


@query(
    "g7_coverage_summary",
    """SELECT category, child, count(*) AS listings, count(DISTINCT concat(category, '/', child, '/', page)) AS pages, count(*) FILTER (has_detail) AS detail_fetches, count(*) FILTER (is_error) AS errors,
      CAST(grouping(category) * 2 + grouping(child) AS BIGINT) AS level FROM @listing_rows GROUP BY ROLLUP (category, child)""",
)
def g7(spark, sf):
    return g.coverage_summary(source(spark, sf, "listing_rows").withColumnRenamed("page", "page_key"), ["category", "child"])


@query(
    "g7_coverage_make_model",
    """SELECT p_type AS make, p_brand AS model, count(*) AS listings, count(DISTINCT concat_ws('/', p_type, p_brand, l_orderkey % 50)) AS pages, count(*) FILTER (l_returnflag <> 'R') AS detail_fetches,
      count(*) FILTER (l_returnflag = 'R') AS errors, CAST(grouping(p_type) * 2 + grouping(p_brand) AS BIGINT) AS level FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ROLLUP (p_type, p_brand)""",
)
def g7_models(spark, sf):
    lines = source(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_returnflag")
    joined = lines.join(source(spark, sf, "part").select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    rows = joined.select(
        F.col("p_type").alias("make"), F.col("p_brand").alias("model"), (F.col("l_orderkey") % 50).alias("page_key"),
        (F.col("l_returnflag") != "R").alias("has_detail"), (F.col("l_returnflag") == "R").alias("is_error"),
    )
    return g.coverage_summary(rows, ["make", "model"])
