"""Queries over pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from adledger.catalog.documents import elements, txt, whole
from adledger.catalog.inputs import source
from adledger.catalog.registry import query
from adledger.functions import variants as V
from adledger.operators import listings as p
from adledger.operators import pages as x
from adledger.operators.ordering import keep_rows
from adledger.session import saved

SCRIPT = '(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>'
LD = '(?s)<script[^>]*type="application/ld\\+json"[^>]*>(.*?)</script>'
PP = "$.props.pageProps"


def docs_sql(name: str) -> str:
    raw = f"regexp_extract(html, '{SCRIPT}', 1)"
    return f"WITH d AS (SELECT *, CASE WHEN json_valid({raw}) THEN {raw} END AS doc FROM @{name})"


CAT, DET, DIR = docs_sql("category_pages"), docs_sql("detail_pages"), docs_sql("directory_pages")


def each(ctes: str, path: str, more: str = "") -> str:
    lst = elements("doc", f"{PP}.{path}")
    return ctes + f", n AS (SELECT page_id, unnest({lst}) AS n, generate_subscripts({lst}, 1) - 1 AS pos{more} FROM d)"


def t(path: str, doc: str = "n") -> str:
    return txt(doc, f"$.{path}")


def payloads(spark, sf, name="category_pages"):
    return x.page_payload(source(spark, sf, name))


@query("x1_page_payload", CAT + f"SELECT page_id, url, doc IS NOT NULL AS has_payload, {txt('doc', f'{PP}.businessesData.data[0].id')} AS business FROM d")
def x1(spark, sf):
    return payloads(spark, sf).select(
        "page_id", "url", F.col("payload").isNotNull().alias("has_payload"), V.text("payload", f"{PP}.businessesData.data[0].id").alias("business")
    )


@query("x1_page_payload_real_pages", "SELECT page_id, regexp_extract(html, '<title>', 0) <> '' AS has_title, false AS has_payload FROM pages")
def x1_real(spark, sf):
    pages = source(spark, sf, "pages")
    return pages.select(
        "page_id", (F.regexp_extract("html", "<title>", 0) != "").alias("has_title"), x.embedded_payload("html").isNotNull().alias("has_payload")
    )


LD_BLOCKS = f"list_filter(list_transform(regexp_extract_all(html, '{LD}', 1), lambda b: CASE WHEN json_valid(b) THEN b END), lambda b: b IS NOT NULL)"


def ld(kind: str | None) -> str:
    test = "" if kind is None else f"list_filter({LD_BLOCKS}, lambda b: json_extract_string(b, '$.\"@type\"') = '{kind}')"
    return f"({test or LD_BLOCKS})[1]"


@query(
    "x2_page_jsonld",
    f"SELECT page_id, json_extract_string({ld('CollectionPage')}, '$.name') AS collection, json_extract_string({ld(None)}, '$.name') AS first_name FROM @directory_pages",
)
def x2(spark, sf):
    pages = source(spark, sf, "directory_pages")
    collection = x.page_jsonld(pages, "CollectionPage").select("page_id", V.text("jsonld", "$.name").alias("collection"))
    first = x.page_jsonld(pages).select("page_id", V.text("jsonld", "$.name").alias("first_name"))
    return collection.join(first, "page_id")


TAGS = """regexp_extract_all(html, '<a\\b[^>]*class="[^"]*pageLink[^"]*"[^>]*>')"""
LINK_COUNT = f"""coalesce(list_max(list_transform({TAGS}, lambda t: TRY_CAST(regexp_extract(t, 'href="[^"]*?page=([0-9]+)', 1) AS INT))), 1)"""


@query("x3_page_count_from_links", f"SELECT page_id, {LINK_COUNT} AS total_pages FROM @category_pages UNION ALL SELECT -1 - page_id, {LINK_COUNT} FROM pages")
def x3(spark, sf):
    made = source(spark, sf, "category_pages").select("page_id", "html")
    real = source(spark, sf, "pages").select((-1 - F.col("page_id")).alias("page_id"), "html")
    return x.page_count_from_links(made.unionByName(real))


@query("x4_page_total_pages", CAT + f"SELECT page_id, coalesce(nullif({whole('doc', f'{PP}.totalPages')}, 0), 1) AS total_pages FROM d")
def x4(spark, sf):
    return x.page_total_pages(payloads(spark, sf))


@query(
    "x4_commercial_total_pages",
    CAT + f"SELECT page_id, coalesce({whole('(list_filter(' + elements('doc', f'{PP}.categories') + ', lambda c: ' + t('slug', 'c') + ' = slug)[1])', '$.total_pages')}, 1) AS total_pages FROM d",
)
def x4_commercial(spark, sf):
    pages = source(spark, sf, "category_pages")
    with_slug = pages.select("page_id", "slug", x.embedded_payload("html").alias("payload"))
    return x.commercial_total_pages(with_slug, F.col("slug"))


def categories_sql(path: str) -> str:
    keep = f"WHERE {t('slug')} IS NULL OR {t('slug')} <> 'all'" if path == "categories" else ""
    return each(CAT, path) + f"""SELECT page_id, {whole('n', '$.id')} AS category_id, {t('slug')} AS slug, coalesce({t('name_ar')}, {t('name')}) AS name_ar, {t('name_en')} AS name_en,
      CAST({whole('n', '$.listings_count')} AS INT) AS listings_count, {t('slug_url')} AS slug_url, {t('category_type')} AS category_type,
      coalesce({t('category_type')} = 'listings_district_filteration', false) AS has_districts, {t('category_parent_slug')} AS parent_slug FROM n {keep}"""


def add_categories(path: str) -> None:
    @query(f"x5_extract_categories_{path.lower()}", categories_sql(path))
    def run(spark, sf):
        return x.extract_categories(payloads(spark, sf), path)


for _path in x.CATEGORY_LISTS:
    add_categories(_path)


@query(
    "x6_extract_districts",
    each(CAT, "districts") + f"""SELECT page_id, {whole('n', '$.id')} AS id, {', '.join(f'{t(c)} AS {c}' for c in ('name_ar', 'name_en', 'full_path_ar', 'full_path_en'))},
      replace(lower({t('full_path_en')}), ' ', '-') || '--district' AS district_slug FROM n""",
)
def x6(spark, sf):
    return x.extract_districts(payloads(spark, sf))


@query("x7_extract_businesses", each(CAT, "businessesData.data") + f"SELECT page_id, {whole('n', '$.id')} AS id, {t('slug')} AS slug, {t('name')} AS name, {t('logo')} AS logo, 'car-offices' AS category_type FROM n")
def x7(spark, sf):
    return x.extract_businesses(payloads(spark, sf), "car-offices")


CARDS = f"""SELECT page_id, CAST(pos AS INT) AS pos, {', '.join(f'{t(c)} AS {c}' for c, k in x.CARD_FIELDS.items() if k == 'string')}, CAST({whole('n', '$.images_count')} AS INT) AS images_count,
  {t('user.user_id')} AS user_id, {t('user.name')} AS user_name FROM n"""


@query("x8_extract_listing_cards", each(CAT, "listings") + CARDS + f" WHERE coalesce({t('adBoxId')}, '0') = '0'")
def x8(spark, sf):
    return x.extract_listing_cards(payloads(spark, sf))


@query("x8_extract_listing_cards_all", each(CAT, "listings") + CARDS)
def x8_all(spark, sf):
    return x.extract_listing_cards(payloads(spark, sf), skip_ad_boxes=False)


FULL = f"""SELECT page_id, CAST(pos AS INT) AS pos, {', '.join(f'{t(path)} AS {name}' for name, path in x.FULL_CARD.items())}, TRY_CAST({t('is_prem')} AS BOOLEAN) AS is_premium,
  {whole('n', '$.views_count')} AS views_count, coalesce({whole('n', '$.reactions.total_count')}, 0) AS reactions, CAST({whole('n', '$.images_count')} AS INT) AS images_count,
  array_to_string(coalesce(from_json(json_extract(n, '$.thumbs'), '["VARCHAR"]'), []), '|') AS all_images FROM n"""


@query("x8_extract_full_cards", each(CAT, "listings") + FULL)
def x8_full(spark, sf):
    return x.extract_full_cards(payloads(spark, sf)).withColumn("all_images", F.array_join("all_images", "|"))


BUSINESS_CARD = ["id", "title", "slug", "price", "image", "date_published", "cat_id", "phone", "contact", "status", "description", "user_type"]


@query(
    "x9_extract_business_cards",
    each(DET, "businessListings.data.listings.normal_items") + f"""SELECT page_id, CAST(pos AS INT) AS pos, {', '.join(f'{t(c)} AS {c}' for c in BUSINESS_CARD)}, {t('cat_en_name')} AS cat_name_en,
      {t('cat_ar_name')} AS cat_name_ar, CAST({whole('n', '$.images_count')} AS INT) AS images_count FROM n""",
)
def x9(spark, sf):
    return x.extract_business_cards(payloads(spark, sf, "detail_pages"))


COMMERCIAL = f"""{whole('n', '$.id')} AS id, {', '.join(f'{t(c)} AS {c}' for c in ('title', 'image', 'phone', 'whatsapp_phone', 'target_url', 'open_target_url'))}, {whole('n', '$.category.id')} AS category_id,
  {t('category.slug')} AS category_slug, TRY_CAST({t('is_landing')} AS BOOLEAN) AS is_landing, {whole('n', '$.views_count')} AS views_count"""


@query("x10_extract_commercial_ads", each(DET, "commercialAds") + f"SELECT page_id, {COMMERCIAL} FROM n")
def x10(spark, sf):
    return x.extract_commercial_ads(payloads(spark, sf, "detail_pages"))


@query("x10_extract_commercial_details", DET + f", n AS (SELECT page_id, url, json_extract(doc, '{PP}.adDetails') AS n FROM d) SELECT page_id, {COMMERCIAL}, url FROM n WHERE json_type(n) = 'OBJECT'")
def x10_details(spark, sf):
    return x.extract_commercial_details(payloads(spark, sf, "detail_pages"))


TYPES = "unnest(CASE WHEN len(" + elements("n", "$.types") + ") > 0 THEN " + elements("n", "$.types") + " ELSE [NULL] END)"


@query(
    "x11_extract_brand_types",
    each(CAT, "brands") + f""", b AS (SELECT page_id, n, {TYPES} AS ty FROM n)
    SELECT page_id, {t('name_en')} AS brand, {t('name_ar')} AS brand_ar, {t('slug_url')} AS brand_slug, {whole('n', '$.listings_count')} AS brand_count, {t('name_en', 'ty')} AS type, {t('name_ar', 'ty')} AS type_ar,
      {t('slug_url', 'ty')} AS type_slug, CASE WHEN ty IS NOT NULL THEN coalesce({whole('ty', '$.listings_count')}, 0) END AS type_count FROM b""",
)
def x11(spark, sf):
    return x.extract_brand_types(payloads(spark, sf))


BASE_URL = "https://directory.example/ar"
OWN = f"CASE WHEN len({elements('doc', f'{PP}.businesses')}) > 0 THEN {elements('doc', f'{PP}.businesses')} WHEN len({elements('doc', f'{PP}.items')}) > 0 THEN {elements('doc', f'{PP}.items')} ELSE {elements('doc', f'{PP}.listings')} END"


@query(
    "x12_extract_directory_list",
    DIR + f""", l AS (SELECT page_id, category_slug, {OWN} AS own, {ld('CollectionPage')} AS j FROM d),
    a AS (SELECT page_id, category_slug, unnest(own) AS n, generate_subscripts(own, 1) AS pos FROM l),
    b AS (SELECT page_id, category_slug, unnest(json_extract(j, '$.mainEntity.itemListElement[*]')) AS n FROM l WHERE len(own) = 0)
    SELECT page_id, category_slug, 'payload' AS source, CAST(pos AS BIGINT) AS position, coalesce({t('name')}, '') AS name, '{BASE_URL}/' || category_slug || '/' || coalesce({t('slug')}, '') AS url, coalesce({t('slug')}, '') AS slug,
      coalesce({t('priceRange')}, {t('price_range')}, '') AS price_range, coalesce({t('logo')}, {t('image')}, '') AS image FROM a
    UNION ALL SELECT page_id, category_slug, 'jsonld', {whole('n', '$.position')}, coalesce({t('item.name')}, ''), coalesce({t('item.url')}, ''), regexp_extract(rtrim(coalesce({t('item.url')}, ''), '/'), '([^/]*)$', 1),
      coalesce({t('item.priceRange')}, ''), coalesce({t('item.image.url')}, CASE WHEN json_type(n, '$.item.image') = 'VARCHAR' THEN {t('item.image')} END, '') FROM b WHERE len(json_keys(n, '$.item')) > 0""",
)
def x12(spark, sf):
    return x.extract_directory_list(source(spark, sf, "directory_pages"), F.col("category_slug"), BASE_URL)


def profiles(spark, sf):
    pages = source(spark, sf, "directory_pages")
    parsed = pages.select("page_id", "category_slug", x.embedded_payload("html").alias("payload"))
    return x.extract_business_profile(parsed, F.col("category_slug"))


def b(path: str) -> str:
    return txt("doc", f"{PP}.business.{path}")


def flag_sql(path: str) -> str:
    return f"coalesce(TRY_CAST({b('attributes.' + path)} AS BOOLEAN), false)"


SOCIAL = f"list_filter(list_transform({elements('doc', f'{PP}.business.social_media')}, lambda s: s ->> '$.url'), lambda u: u <> '')"
PROFILE = DIR + f""", b AS (SELECT page_id, category_slug, doc FROM d WHERE len(json_keys(doc, '{PP}.business')) > 0)
"""


@query(
    "x13_extract_business_profile",
    PROFILE + f"""SELECT page_id, {whole('doc', f'{PP}.business.id')} AS id, category_slug, coalesce({b('name')}, '') AS name, coalesce({b('about')}, '') AS about, coalesce({b('category.name')}, '') AS category_name,
      CAST({b('rating.average')} AS DOUBLE) AS rating_average, {whole('doc', f'{PP}.business.rating.count')} AS rating_count, coalesce({whole('doc', f'{PP}.business.view_count')}, 0) AS view_count,
      array_to_string(from_json(json_extract(doc, '{PP}.business.contact_info.contact_numbers'), '["VARCHAR"]'), ', ') AS contact_numbers, coalesce({b('contact_info.website')}, '') AS website,
      array_to_string({SOCIAL}, ', ') AS social_media, {', '.join(f'{flag_sql(path)} AS {name}' for name, path in (('delivery', 'delivery'), ('takeaway', 'takeaway'), ('wifi', 'wi_fi')))},
      coalesce({whole('doc', f'{PP}.tabs.reviews.summary.total_reviews')}, 0) AS reviews_count FROM b""",
)
def x13(spark, sf):
    return profiles(spark, sf).select(
        "page_id", "id", "category_slug", "name", "about", "category_name", "rating_average", "rating_count", "view_count", "contact_numbers", "website",
        "social_media", "delivery", "takeaway", "wifi", "reviews_count",
    )


def has(path: str) -> str:
    return f"len({elements('doc', f'{PP}.{path}')}) > 0"


def shape(rule: str):
    def run(spark, sf):
        return x.classify_category_shape(payloads(spark, sf), rule)

    return run


query("x14_classify_children", CAT + f"SELECT page_id, CASE WHEN {has('catChilds')} THEN 'catchilds' WHEN {has('subcategories')} THEN 'subcategories' ELSE 'direct' END AS shape FROM d")(shape("children"))
query("x14_classify_property", CAT + f"SELECT page_id, CASE WHEN {has('subcategories')} THEN 'subcategories' WHEN {has('businessesData.data')} THEN 'businesses' ELSE 'direct' END AS shape FROM d")(shape("property"))
query(
    "x14_classify_districts",
    CAT + f"""SELECT page_id, CASE WHEN {has('catChilds')} THEN 'catchilds' WHEN {txt('doc', f'{PP}.category.category_type')} IN ('listings_district_filteration', 'listings_full_filtration') THEN 'districts' ELSE 'direct' END AS shape FROM d""",
)(shape("districts"))


# --- listing operators that start from pages --------------------------------------------------------------

NOW = "2024-02-29 12:30:00"
L = f"{PP}.listing"


def l(path: str) -> str:  # noqa: E743
    return txt("doc", f"{L}.{path}")


@query(
    "p4_project_listing_detail",
    DET + f"""SELECT page_id, {l('user_adv_id')} AS id, {l('slug')} AS slug, {l('title')} AS title, {l('price')} AS price, {l('phone')} AS phone, {l('date_published')} AS date_published, {l('date_created')} AS date_created,
      CAST(json_array_length(doc, '{L}.images') AS INT) AS images_count, {l('images[0]')} AS first_image, {l('district.name')} AS address, {l('district.full_path_en')} AS full_address_en, {whole('doc', f'{L}.user_view_count')} AS views_no,
      CAST({l('lon')} AS DOUBLE) AS longitude, CAST({l('lat')} AS DOUBLE) AS latitude, {l('user.first_name')} AS user_name, coalesce({l('user.listings_count')}, 'None') || ' ads' AS user_ads,
      split_part(coalesce({l('user.member_since')}, ''), 'T', 1) AS membership, CAST({l('user.is_verified')} AS BOOLEAN) AS is_verified, CAST({l('is_private_message_enabled')} AS BOOLEAN) AS is_private_message_enabled,
      CAST({l('is_hide_my_number')} AS BOOLEAN) AS is_hide_my_number FROM d WHERE len(json_keys(doc, '{L}')) > 0""",
)
def p4(spark, sf):
    details = p.project_listing_detail(payloads(spark, sf, "detail_pages"), F.lit(NOW))
    return details.select(
        "page_id", "id", "slug", "title", "price", "phone", "date_published", "date_created", "images_count", F.try_element_at("images", F.lit(1)).alias("first_image"),
        "address", "full_address_en", "views_no", "longitude", "latitude", "user_name", "user_ads", "membership", "is_verified", "is_private_message_enabled", "is_hide_my_number",
    )


S = f"{PP}.service"


def s(path: str) -> str:
    return txt("doc", f"{S}.{path}")


@query(
    "p9_normalize_service_listing",
    DET + f"""SELECT coalesce(nullif({s('id')}, ''), {s('user_adv_id')}) AS "ID", {s('title')} AS "Title", coalesce(nullif({s('phone')}, ''), {s('contact')}) AS "Phone", coalesce(nullif({s('user.name')}, ''), {s('user.first_name')}, '') AS "User",
      coalesce({s('user.user_id')}, {s('user.id')}, '') AS "User ID", coalesce({s('user.email')}, '') AS "User Email", coalesce({s('description')}, {s('desc_en')}) AS "Description", {s('price')} AS "Price", NULL::VARCHAR AS "Date Published",
      NULL::VARCHAR AS "Date Created", NULL::VARCHAR AS "Date Expired", NULL::VARCHAR AS "Date Sort", CAST(json_array_length(doc, '{S}.images') AS INT) AS "Images Count",
      array_to_string(from_json(json_extract(doc, '{S}.images'), '["VARCHAR"]'), ',') AS "Image URLs", coalesce({s('district.name')}, {s('district_name_localize.en')}, '') AS "District", {s('category.name')} AS "Category",
      array_to_string(from_json(json_extract(doc, '{S}.contacts'), '["VARCHAR"]'), ',') AS "Contacts", true AS "PM Enabled", {s('lat')} AS "Latitude", '' AS "Longitude", '' AS "Slug", {s('status')} AS "Status"
    FROM d WHERE doc IS NOT NULL""",
)
def p9(spark, sf):
    services = keep_rows(payloads(spark, sf, "detail_pages"), F.col("payload").isNotNull())
    return p.normalize_service_listing(services.select(V.get("payload", S, "variant").alias("listing")))


MEDIA = elements("doc", f"{PP}.tabs.media.data.media")
USABLE = f"list_filter({MEDIA}, lambda m: regexp_matches(m ->> '$.url', '^https?://') AND NOT regexp_matches(lower(m ->> '$.url'), 'lh[345]\\.googleusercontent\\.com|gps-cs-s|gps-proxy'))"
ENABLED = f"len(list_filter({elements('doc', f'{PP}.business.tabs')}, lambda g: (g ->> '$.slug') = 'media' AND (g ->> '$.enabled') = 'true')) > 0"


def media_text(kind: str | None) -> str:
    kept = USABLE if kind is None else f"list_filter({USABLE}, lambda m: (m ->> '$.media_category') = '{kind}')"
    return f"CASE WHEN {ENABLED} THEN array_to_string(list_transform({kept}, lambda m: m ->> '$.url'), ' | ') ELSE '' END"


@query(
    "p16_filter_image_urls",
    PROFILE + f", u AS (SELECT page_id, unnest(list_transform({MEDIA}, lambda m: m ->> '$.url')) AS url FROM b UNION ALL SELECT page_id, {b('cover_image')} FROM b) SELECT page_id, url FROM u WHERE regexp_matches(url, '^https?://') AND NOT regexp_matches(lower(url), 'lh[345]\\.googleusercontent\\.com|gps-cs-s|gps-proxy')",
)
def p16(spark, sf):
    found = profiles(spark, sf)
    media = found.select("page_id", F.explode(F.transform("media", lambda m: m["url"])).alias("url"))
    return p.filter_image_urls(media.unionByName(found.select("page_id", F.col("cover_image").alias("url"))))


@query(
    "p17_split_media",
    PROFILE + f"SELECT {whole('doc', f'{PP}.business.id')} AS id, CASE WHEN {ENABLED} THEN CAST(len({USABLE}) AS INT) ELSE 0 END AS media_count, {media_text(None)} AS media_urls, {media_text('gallery')} AS gallery_urls, {media_text('menu')} AS menu_urls FROM b",
)
def p17(spark, sf):
    return p.split_media(profiles(spark, sf))


BLOCKED = ["lh3.googleusercontent.com", "lh4.googleusercontent.com", "lh5.googleusercontent.com", "gps-cs-s", "gps-proxy"]


def image(url: str) -> str:
    """SQL for an image address that may be fetched, else an empty text."""
    return f"CASE WHEN regexp_matches({url}, '^https?://') AND NOT ({' OR '.join(f"contains(lower({url}), '{h}')" for h in BLOCKED)}) THEN {url} ELSE '' END"


MEDIA_URLS = f"CASE WHEN {ENABLED} THEN list_transform({USABLE}, lambda m: m ->> '$.url') ELSE [] END"
EXT = """lower(regexp_extract(regexp_replace(url, '^[a-zA-Z]+://[^/?#]*|[?#].*$', '', 'g'), '[^/](\\.[^./]+)$', 1))"""


@query(
    "p15_business_image_roster",
    PROFILE + f""", m AS (SELECT {whole('doc', f'{PP}.business.id')} AS id, {image(b('logo'))} AS logo, {image(b('cover_image'))} AS cover, {MEDIA_URLS} AS media FROM b),
    r AS (SELECT id, 'logo' AS kind, logo AS url FROM m WHERE logo <> '' UNION ALL SELECT id, 'cover', cover FROM m WHERE cover NOT IN ('', 'media')
      UNION ALL SELECT id, 'media_' || (generate_subscripts(media, 1) - 1), unnest(media) FROM m)
    SELECT id, kind, url, 'business_' || id || '_image_N' || CASE WHEN {EXT} = '' OR length({EXT}) > 5 THEN '.jpg' ELSE {EXT} END AS name_shape FROM r""",
)
def p15(spark, sf):
    """The number in a file name is a hash only Spark makes; the check sees the name without it."""
    found = saved(profiles(spark, sf).select("id", "logo", "cover_image", "tabs", "media"), "profiles")  # pages are parsed once
    with_media = p.split_media(found).select("id", F.split("media_urls", " [|] ").alias("media_urls"))
    media = with_media.withColumn("media_urls", F.filter("media_urls", lambda u: u != ""))
    roster = p.business_image_roster(found.select("id", "logo", "cover_image").join(media, "id"))
    return roster.select("id", "kind", "url", F.regexp_replace("file_name", r"_image_\d+", "_image_N").alias("name_shape"))


BRANCHES = elements("doc", f"{PP}.tabs.about.data.branches")
MAIN = f"coalesce(list_filter({BRANCHES}, lambda r: (r ->> '$.is_main') = 'true')[1], ({BRANCHES})[1])"


@query(
    "p18_pick_main_branch",
    PROFILE + f"""SELECT {whole('doc', f'{PP}.business.id')} AS id, coalesce(({MAIN}) ->> '$.address', '') AS main_branch_address, coalesce(({MAIN}) ->> '$.phone', '') AS main_branch_phone, CAST(({MAIN}) ->> '$.latitude' AS DOUBLE) AS main_branch_latitude,
      CAST(({MAIN}) ->> '$.longitude' AS DOUBLE) AS main_branch_longitude, CAST(len({BRANCHES}) AS INT) AS branches_count FROM b""",
)
def p18(spark, sf):
    return p.pick_main_branch(profiles(spark, sf)).drop("branches_json")


REVIEWS = elements("doc", f"{PP}.tabs.reviews.data.reviews")


@query(
    "p19_recent_reviews",
    PROFILE + f"""SELECT {whole('doc', f'{PP}.business.id')} AS id, {whole('doc', f'{PP}.tabs.reviews.summary.total_reviews')} AS reviews_count, CAST({txt('doc', f'{PP}.tabs.reviews.summary.average_rating')} AS DOUBLE) AS reviews_average,
      least(len({REVIEWS}), 5) AS listed, ({REVIEWS})[1] ->> '$.comment' AS first_comment FROM b""",
)
def p19(spark, sf):
    shown = p.recent_reviews(profiles(spark, sf))
    parsed = V.parse("recent_reviews_json")
    return shown.select("id", "reviews_count", "reviews_average", F.size(V.items(parsed, "$")).alias("listed"), V.text(parsed, "$[0].comment").alias("first_comment"))


HOURS = f"list_filter({elements('doc', f'{PP}.business.working_hours')}, lambda h: (h ->> '$.day_name') <> '' AND (h ->> '$.open_time') <> '' AND (h ->> '$.close_time') <> '')"


@query(
    "p20_format_working_hours",
    PROFILE + f"SELECT page_id, array_to_string(list_transform({HOURS}, lambda h: (h ->> '$.day_name') || ': ' || (h ->> '$.open_time') || '-' || (h ->> '$.close_time')), ' | ') AS working_hours FROM b",
)
def p20(spark, sf):
    return profiles(spark, sf).select("page_id", p.format_working_hours("hours").alias("working_hours"))


def ages_sql(c: str, now: str) -> str:
    months = "(year(n) - year(ts)) * 12 + month(n) - month(ts)"
    return f"""g0 AS (SELECT *, TRY_CAST({c} AS TIMESTAMP) AS ts, TIMESTAMP '{now}' AS n FROM src),
g1 AS (SELECT *, CASE WHEN ts + to_months(CAST({months} AS INT)) > n THEN {months} - 1 ELSE {months} END AS m FROM g0),
g2 AS (SELECT *, epoch(n) - epoch(ts + to_months(CAST(m AS INT))) AS rest FROM g1),
g3 AS (SELECT *, [CAST(m // 12 AS BIGINT), CAST(m AS BIGINT), CAST(floor(rest / 86400) AS BIGINT), CAST(floor(rest / 3600) AS BIGINT), CAST(floor(rest / 60) AS BIGINT)] AS v FROM g2),
g4 AS (SELECT *, list_filter([1, 2, 3, 4, 5], lambda i: v[i] > 0)[1] AS i FROM g3),
ages AS (SELECT *, CASE WHEN ts IS NULL THEN 'Unknown' WHEN ts > n OR i IS NULL THEN 'Just now'
  ELSE v[i] || ' ' || ['year', 'month', 'day', 'hour', 'minute'][i] || CASE WHEN v[i] > 1 THEN 's' ELSE '' END || ' ago' END AS age FROM g4)"""


AGE_CELL = "CASE o_orderkey % 17 WHEN 0 THEN 'soon' WHEN 1 THEN NULL ELSE concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 1', CAST(o_custkey % 10 AS STRING), ':0', CAST(o_orderkey % 10 AS STRING), ':30') END"


@query("p21_relative_age", f"WITH src AS (SELECT o_orderkey, {AGE_CELL} AS cell FROM orders), {ages_sql('cell', '2001-03-31 14:05:30')} SELECT o_orderkey, age FROM ages")
def p21(spark, sf):
    cells = source(spark, sf, "orders").selectExpr("o_orderkey", f"{AGE_CELL} AS cell")
    return cells.select("o_orderkey", p.relative_age(F.col("cell"), F.lit("2001-03-31 14:05:30")).alias("age"))


@query("p21_relative_age_of_details", DET + f", src AS (SELECT page_id, {l('date_published')} AS c FROM d WHERE len(json_keys(doc, '{L}')) > 0), {ages_sql('c', NOW)} SELECT page_id, age AS date_relative FROM ages")
def p21_details(spark, sf):
    return p.project_listing_detail(payloads(spark, sf, "detail_pages"), F.lit(NOW)).select("page_id", "date_relative")
